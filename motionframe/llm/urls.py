"""URL filtering by listed rules and, where none fits, by templates of paths learned for each host.

Templates form a tree a host.  Level by level, a segment keeps its own branch if
it is frequent enough and its labels differ from those of its siblings taken
together; all others become one wildcard branch.  Branches of one parent that
stay apart, but whose shares of bad labels don't differ, are one node of the
tree.  Nodes whose smoothed share of good labels is too low are rejected; how
low is too low is a parameter, or found on labels that the tree hasn't seen.

Equal hosts and paths are one row with counts until the verdicts are known, and
rules are a table that hosts and beginnings of paths are looked up in.  Of what
grows with pages, hosts or labels nothing is broadcast, as that passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import dropped, shared_dir, spread_join, written

WILD = "*"
#: Stands for WILD in nodes; no path has it.
_ANY = "?"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, lower-cased in A-Z; empty for a null or a url without ://."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty for a null or a url without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(place, verdict, host, path) of rules, by their place in the list."""
    return spark.createDataFrame([(i, r.verdict, r.host, r.path) for i, r in enumerate(rules)], "place int, verdict string, host string, path string")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls(host, path, ...), no two of a host and path, with rule and verdict of the longest rule that fits, or nulls.

    A rule of rules(place, verdict, host, path) fits its host and all subdomains,
    if the path starts with the rule's; of equally long ones that of least place
    wins.  A url is looked up once for each pair of a listed end of its host and a length that
    paths of that end's rules have, so what it costs doesn't grow with the rules.
    """
    listed = rules.groupBy(F.col("host").alias("of"), F.col("path").alias("start")).agg(F.min(F.struct("place", "verdict")).alias("_r"))
    parts = listed.agg(F.max(F.size(F.split("of", r"\."))).alias("n")).first().n
    if parts is None:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    lengths = listed.groupBy("of").agg(F.collect_set(F.length("start")).alias("ls"))
    label = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(label), F.lit(parts))), lambda k: F.array_join(F.slice(label, -k, k), "."))
    here = spread_join(urls.select("host").distinct().select("host", F.explode(ends).alias("of")), lengths, ["of"], ["host"])
    of_host = here.groupBy("host").agg(F.collect_list(F.struct("of", "ls")).alias("ends"))  # a host has few ends, each with few lengths
    tried = spread_join(urls.select("host", "path"), of_host, ["host"], ["path"]).select("host", "path", F.inline("ends")).select("host", "path", "of", F.explode("ls").alias("l"))
    tried = tried.where(F.length("path") >= F.col("l")).select("host", "path", "of", F.substr("path", F.lit(1), F.col("l")).alias("start"))
    fits = spread_join(tried, listed, ["of", "start"], ["host", "path"]).withColumn("rule", F.concat("of", "start"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "_r.verdict"), F.struct(F.length("rule"), -F.col("_r.place"))).alias("_best"))
    return urls.join(best.hint("merge"), ["host", "path"], "left").withColumns({"rule": F.col("_best.rule"), "verdict": F.col("_best.verdict")}).drop("_best")


@dataclass(frozen=True)
class TreeParams:
    depth: int | None = None
    min_support: int = 20
    min_labelled: int = 8
    min_z: float = 1.96
    prior_weight: float = 10.0
    #: None: found by threshold() on the third of the labels that the tree isn't made from.
    min_purity: float | None = 0.5


def merged(apart: DataFrame, p: TreeParams) -> DataFrame:
    """(host, node, _s, _as) of the branches apart(host, node, _s, m, b): _as names those of a parent that are one, after the first of them.

    By rising share of bad labels, a branch joins those before it if its share
    differs from theirs by less than min_z standard errors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent, name, all_m, all_b = None, None, 0, 0
        for batch in batches:
            names = []
            for host, node, s, m, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rate = (all_b + b) / (all_m + m)
                error = math.sqrt(rate * (1 - rate) * (1 / m + 1 / all_m)) if all_m else 0.0
                if parent != (host, node) or (error and abs(b / m - all_b / all_m) / error >= p.min_z):
                    parent, name, all_m, all_b = (host, node), s, 0, 0
                all_m, all_b = all_m + m, all_b + b
                names.append(name)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(names, pa.string())], ["host", "node", "_s", "_as"])

    rows = apart.select("host", "node", "_s", "m", "b").repartition("host", "node").sortWithinPartitions("host", "node", F.col("b") / F.col("m"), "_s")
    return rows.mapInArrow(run, "host string, node string, _s string, _as string")


def templates(urls: DataFrame, p: TreeParams) -> DataFrame:
    """urls(host, path, n, m, b) with the columns template and node; n urls have m labels, b of them bad.

    At each level a segment's branch stays apart if it has min_support urls,
    min_labelled labels, and a share of bad ones that differs from that of all
    segments beside it by min_z standard errors.  template names a path's own
    branches, node those that they are one with.  This goes on until no node is
    left that could be split, or for `depth` levels: then what is deeper is one
    wildcard.
    """
    spark = urls.sparkSession
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    now = written(urls.withColumn("_seg", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(segments)).withColumn("_size", F.size("_seg")).withColumns({"template": F.lit(""), "node": F.lit("")}))
    before, out = now, shared_dir(spark)

    def finish(rows: DataFrame, level: int) -> DataFrame:
        """Adds rows to the result; a wildcard stands for each segment that is left."""
        left = F.col("_size") if p.depth is None else F.least(F.col("_size"), F.lit(p.depth + 1))
        done = rows.withColumns({c: F.concat(c, F.repeat(F.lit("/" + w), left - level)) for c, w in (("template", WILD), ("node", _ANY))}).select(*urls.columns, "template", "node")
        done.write.mode("append").parquet(out)
        return done

    level = 0
    while p.depth is None or level < p.depth:
        deeper = now.where(F.col("_size") > level)
        whole = deeper.groupBy("host", "node").agg(F.sum("n").alias("n"), F.sum("m").alias("all_m"), F.sum("b").alias("all_b"))
        # a node of fewer urls or labels, or of labels of one kind, has no branch that stays apart, here or deeper
        whole = written(whole.where((F.col("n") >= p.min_support) & (F.col("all_m") > p.min_labelled) & (F.col("all_b") > 0) & (F.col("all_b") < F.col("all_m"))).drop("n"))
        if whole.isEmpty():
            dropped(whole)
            break
        marked = spread_join(now, whole.select("host", "node", F.lit(True).alias("_open")), ["host", "node"], ["path"], "left").withColumn("_open", F.col("_open").isNotNull() & (F.col("_size") > level))
        finish(marked.where("not _open"), level)
        now = marked.where("_open").drop("_open").withColumn("_s", F.get("_seg", F.lit(level)))
        child = now.groupBy("host", "node", "_s").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("b").alias("b"))
        m = F.nullif(F.col("m"), F.lit(0))
        rest = F.nullif(F.col("all_m") - F.col("m"), F.lit(0))
        rate = F.col("all_b") / F.col("all_m")
        error = F.sqrt(rate * (1 - rate) * (1 / m + 1 / rest))
        z = F.abs(F.col("b") / m - (F.col("all_b") - F.col("b")) / rest) / F.nullif(error, F.lit(0.0))
        strong = child.where((F.col("n") >= p.min_support) & (F.col("m") >= p.min_labelled))
        apart = merged(strong.join(whole.hint("merge"), ["host", "node"]).where(z >= p.min_z), p)
        own = F.concat(F.lit("/"), F.when(F.col("_as").isNotNull(), F.col("_s")).otherwise(F.lit(WILD)))
        # written at each level, as the next one reads it more than once
        named = spread_join(now, apart, ["host", "node", "_s"], ["path"], "left").withColumns({"template": F.concat("template", own), "node": F.concat("node", F.lit("/"), F.coalesce("_as", F.lit(_ANY)))})
        then = written(named.drop("_as", "_s"))
        dropped(before, whole)
        before = now = then
        level += 1
    done = finish(now, level)
    dropped(before)
    return spark.read.schema(done.schema).parquet(out)


def purities(nodes: DataFrame, p: TreeParams, m: str = "m", b: str = "b") -> DataFrame:
    """nodes(m, b, ...) with purity: (good + prior_weight * share of good of all) / (labelled + prior_weight); without any label the share is 1."""
    total = nodes.agg(F.sum(m).alias("_m"), F.sum(b).alias("_b"))
    prior = F.coalesce(1 - F.col("_b") / F.nullif(F.col("_m"), F.lit(0)), F.lit(1.0))
    rows = nodes.crossJoin(F.broadcast(total))  # total is one row
    return rows.withColumn("purity", (F.col(m) - F.col(b) + p.prior_weight * prior) / (F.col(m) + p.prior_weight)).drop("_m", "_b")


def thresholds(nodes: DataFrame) -> DataFrame:
    """(threshold, blocked, bad, above): of nodes(purity, m, b), how many labels, and bad ones, a threshold blocks.

    Purities count as thousandths, so these rows are few.  `above` is the least
    purity that the threshold doesn't block, or 1.
    """
    each = nodes.where("m > 0").groupBy((F.floor(F.col("purity") * 1000) + 1).alias("_t")).agg(F.sum("m").alias("m"), F.sum("b").alias("b"))
    upto = Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    return each.select((F.col("_t") / 1000).alias("threshold"), F.sum("m").over(upto).alias("blocked"), F.sum("b").over(upto).alias("bad"), F.coalesce((F.lead("_t").over(Window.orderBy("_t")) - 1) / 1000, F.lit(1.0)).alias("above"))


def threshold(nodes: DataFrame, p: TreeParams) -> float:
    """The threshold that blocks more bad labels than good ones by most; 0, which blocks nothing, unless that beats chance by min_z standard errors.

    It lies midway to what isn't blocked; of equal ones it is the least.
    """
    gain = 2 * F.col("bad") - F.col("blocked")
    best = thresholds(nodes).where((gain > 0) & (gain >= p.min_z * F.sqrt("blocked"))).orderBy(gain.desc(), "threshold").first()
    return 0.0 if best is None else (best.threshold + best.above) / 2


def _held(key: Column) -> Column:
    """Rows whose label a threshold is found on, of those that have one."""
    return F.crc32(key.cast("string")) % 3 == 1


def _counted(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, path, n, m, b, held_m, held_b): urls, and labels inside and outside the held-out third.  Repeated pages are counted before they meet their label."""
    bad = labels.where(F.col("bad").isin(0, 1) & F.col("key").isNotNull()).groupBy("key").agg(F.max("bad").cast("long").alias("bad"))
    rows = pages.groupBy("key", "host", "path").agg(F.count("*").alias("n")).join(bad.hint("merge"), "key", "left")
    held, seen = F.coalesce(_held(F.col("key")), F.lit(False)), F.col("bad").isNotNull()
    total = lambda c, when: F.sum(F.when(when, c).otherwise(0))
    b = F.col("n") * F.col("bad")
    return rows.groupBy("host", "path").agg(
        F.sum("n").alias("n"), total(F.col("n"), seen & ~held).alias("m"), total(b, seen & ~held).alias("b"), total(F.col("n"), seen & held).alias("held_m"), total(b, seen & held).alias("held_b")
    )


def _trees(pages: DataFrame, labels: DataFrame, p: TreeParams) -> tuple[DataFrame, DataFrame, float]:
    """Urls with their node, nodes with all counts and purity, and the threshold."""
    counts = _counted(pages, labels)
    if p.min_purity is not None:
        counts = counts.withColumns({"m": F.col("m") + F.col("held_m"), "b": F.col("b") + F.col("held_b"), "held_m": F.lit(0).cast("long"), "held_b": F.lit(0).cast("long")})
    tree = templates(counts, p)
    nodes = written(tree.groupBy("host", "node").agg(*(F.sum(c).alias(c) for c in ("m", "b", "held_m", "held_b"))))
    limit = p.min_purity
    if limit is None:
        limit = threshold(purities(nodes, p).select("purity", F.col("held_m").alias("m"), F.col("held_b").alias("b")), p)
    return tree, nodes, limit


def held_out(pages: DataFrame, labels: DataFrame, p: TreeParams | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """thresholds() on the labels that a tree of the others hasn't seen: what each threshold would block of them."""
    tree, nodes, _ = _trees(_parsed(pages, id_col, url_col), _of(labels, id_col), p or TreeParams(min_purity=None))
    return thresholds(purities(nodes, p or TreeParams()).select("purity", F.col("held_m").alias("m"), F.col("held_b").alias("b")))


def _parsed(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """(key, host, path) of each row."""
    read = pages.select(F.col(id_col).alias("key"), F.col(url_col).cast("string").alias("url"))
    return read.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))


def _of(labels: DataFrame, id_col: str) -> DataFrame:
    return labels.select(F.col(id_col).alias("key"), "bad")


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule] | DataFrame, p: TreeParams | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict, template, purity) of every row of pages.

    The longest rule that fits decides; rules are a list, or a table as
    rule_table() makes it.  Elsewhere a url is blocked if the smoothed share of
    good labels of its node in the host's tree, which templates of like shares
    have in common, is under min_purity.  Where that is None, the tree is made from two
    thirds of the labels and the threshold is found on the rest; purities are of all labels.
    labels has (id_col, bad), bad being 1 or 0; of several labels of an id the
    worst counts.  Without any labels the share of all is 1.  A null or
    unparsable url has empty host and path and is judged like any other; a null
    id has no label.
    """
    p = p or TreeParams()
    base = _parsed(pages, id_col, url_col)
    tree, nodes, limit = _trees(base, _of(labels, id_col), p)
    every = nodes.select("host", "node", (F.col("m") + F.col("held_m")).alias("m"), (F.col("b") + F.col("held_b")).alias("b"))
    pure = purities(every, p).select("host", "node", "purity")
    found = ruled(spread_join(tree, pure, ["host", "node"], ["path"]), rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules))
    own = F.when(F.col("purity") < limit, "block").otherwise("allow")
    decided = written(found.select("host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "template", "purity"))
    dropped(tree, nodes)
    # rows are dealt by their place in their file, as any id and any url may be repeated
    out = spread_join(base.withColumn("_at", F.monotonically_increasing_id()), decided, ["host", "path"], ["_at"])
    return out.select(F.col("key").alias(id_col), "host", "path", "rule", "verdict", "template", "purity")
