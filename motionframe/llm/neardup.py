"""Near duplicates by min-max hashing: both ends of every permutation are kept, so half as many hashes are needed.

Documents with equal shingle sets are one node.  Nodes that agree in a band of
the signature share a bucket.  Each is compared on its full set with the most
central node of each of its buckets, the pivot.  Where a pivot's nodes are still
several components, no pair that could join two of them may be lost, nor may all
pairs be listed: a filter on their differences from the pivot leaves the few
that can reach the threshold at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import slices, spread_join, written
from .words import Hasher, U, mix, runs

SHINGLE = 5
PERMUTATIONS = 48
ROWS = 4
#: Sets that are compared with one pivot's in one group.
GROUP = 64


def shingle_sets(words: np.ndarray, firsts: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than k words is one shingle, one of none has none."""
    hashes, out = runs(words, k), []
    for lo, hi in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(np.unique(hashes[lo : hi - k + 1]))
        elif hi > lo:
            out.append(mix(runs(words[lo:hi], hi - lo) + U(hi - lo)))
        else:
            out.append(np.zeros(0, U))
    return out


def families(n: int) -> np.ndarray:
    """n odd multipliers, fixed."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def fingerprint(sets: list[np.ndarray], k: int) -> np.ndarray:
    """The k-th 64-bit fingerprint of each set, whatever the order of its items; 0 of an empty one."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros(len(sets), U)
    if sizes.sum():
        full = sizes > 0
        out[full] = np.add.reduceat(mix(np.concatenate(sets) ^ U(0xA5A5 + k)), (np.cumsum(sizes) - sizes)[full])
    return out


def signatures(docs: DataFrame, shingle: int, permutations: int, rows: int) -> DataFrame:
    """(id, n_shingles, f1, f2, bands): set size, two 64-bit fingerprints of the set, one key a band (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, factors = Hasher(lower=True), families(permutations)
        for batch in slices(batches):
            words, _, _, firsts, _ = hasher.batch(batch.column(1))
            sets = shingle_sets(words, firsts, shingle)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            full = sizes > 0
            bands = np.zeros((len(sets), 2 * permutations // rows), U)
            prints = [fingerprint(sets, k) for k in range(2)]
            if full.any():
                flat = np.concatenate(sets)
                at = (np.cumsum(sizes) - sizes)[full]
                ends = np.empty((int(full.sum()), 2 * permutations), U)
                for p, factor in enumerate(factors):
                    value = flat * factor
                    value ^= value >> U(29)
                    ends[:, 2 * p] = np.minimum.reduceat(value, at)
                    ends[:, 2 * p + 1] = np.maximum.reduceat(value, at)
                key = np.zeros((len(ends), bands.shape[1]), U) + np.arange(bands.shape[1], dtype=U)
                for r in range(rows):
                    key = mix(key * U(0xD6E8FEB86659FD93) + ends[:, r::rows])
                bands[full] = key
            offsets = np.append(0, np.cumsum(full * bands.shape[1])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[full].view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), *(pa.array(x.view(np.int64)) for x in prints), lists], ["id", "n_shingles", "f1", "f2", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>")


def set_table(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, items): the sorted distinct shingle hashes of the nodes(id, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in slices(batches):
            words, _, _, firsts, _ = hasher.batch(batch.column(1))
            sets = shingle_sets(words, firsts, shingle)
            flat = np.concatenate(sets) if sets else np.zeros(0, U)
            offsets = np.append(0, np.cumsum([len(x) for x in sets])).astype(np.int32)
            f1, f2 = (pa.array(fingerprint(sets, k).view(np.int64)) for k in range(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), f1, f2, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))], ["id", "f1", "f2", "items"])

    kind = docs.schema["id"].dataType.simpleString()
    # whatever the sizes, texts are joined the same way, by their ids
    texts = docs.select("id", "text").join(nodes.select("id").distinct().hint("merge"), "id").mapInArrow(run, f"id {kind}, f1 bigint, f2 bigint, items array<bigint>")
    return texts.join(nodes, ["id", "f1", "f2"]).select("node", "items").dropDuplicates(["node"])


def compared(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """(a, b, n_a, n_b, same[, items]) of the pairs (a, b) of nodes, on their whole sets: both sizes and that of the intersection.

    With differences, items are those that only one of the two has.  A node's
    partners are compared with it in groups of about GROUP, so that one with many
    is dealt over many groups.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("_groups"))
    dealt = spread_join(pairs, counts, ["a"], ["b"]).select("a", F.pmod(F.xxhash64("b"), F.col("_groups")).cast("int").alias("_group"), F.col("b").alias("node"), F.lit(False).alias("pivot"))
    heads = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group")).select("a", "_group", F.col("a").alias("node"), F.lit(True).alias("pivot"))
    each = heads.unionByName(dealt).join(sets.hint("merge"), "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.zeros(0, U)
        for batch in slices(batches):
            at, rows, rest = [], [], []
            flat, ends = batch.column(4).flatten().to_numpy(), batch.column(4).offsets.to_numpy()
            ends = ends - ends[0]
            for k, first in enumerate(batch.column(3).to_pylist()):
                mine = flat[ends[k] : ends[k + 1]].view(U)
                if first:  # the rows of a group come pivot first
                    pivot = mine.copy()
                    continue
                there = pivot[np.minimum(np.searchsorted(pivot, mine), len(pivot) - 1)] == mine
                same = int(there.sum())
                at.append(k)
                rows.append((len(pivot), len(mine), same))
                if differences:
                    rest.append(np.setxor1d(pivot, mine, assume_unique=True))
            take = pa.array(at, pa.int64())
            out = [batch.column(0).take(take), batch.column(2).take(take), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))]
            if differences:
                offsets = np.append(0, np.cumsum([len(x) for x in rest])).astype(np.int32)
                values = np.concatenate(rest) if rest else np.zeros(0, U)
                out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))))
            yield pa.RecordBatch.from_arrays(out, ["a", "b", "n_a", "n_b", "same", "items"][: len(out)])

    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = each.select("a", "_group", "node", "pivot", "items").repartition(n, "a", "_group").sortWithinPartitions("a", "_group", F.desc("pivot"))
    kind = pairs.schema["a"].dataType.simpleString()
    return ordered.mapInArrow(compare, f"a {kind}, b {kind}, n_a bigint, n_b bigint, same bigint" + ", items array<bigint>" * differences)


def alike(percent: float) -> Column:
    """Of rows of compared(): intersection and union have the ratio at least."""
    return 100 * F.col("same") >= percent * (F.col("n_a") + F.col("n_b") - F.col("same"))


def pivots(bucket: DataFrame) -> DataFrame:
    """bucket(key, node) with its pivot a, without buckets of one node: the node that meets most others in all its buckets, as it is central to its like."""
    many = bucket.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    bucket = bucket.join(many, "key")
    weight = bucket.groupBy("node").agg(F.sum("_n").alias("_w"))
    first = bucket.drop("_n").join(weight, "node").groupBy("key").agg(F.max(F.struct("_w", "node"))["node"].alias("a"))
    return bucket.drop("_n").join(first, "key")


def possible(items: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of two components, both rows of one p, that may reach the threshold; all that do are among them.

    items(p, node, component, n, size, sh, covers) has the `size` items sh that a
    node's set of n and the set of p don't share (all of its own, if p has none).
    Two such differences are as far apart as the two sets.  So sets of n and m
    reach the threshold only if their differences, of sizes s and t, share at
    least (s + t - (n + m) * (100 - percent) / (100 + percent)) / 2 items.  Items
    that only one component has can't be shared.  The others are ordered by
    frequency: from the first shared one on, enough must be left in both.
    """
    often = items.groupBy("p", "sh").agg(F.count("*").alias("df"), F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo <> _hi").drop("_lo", "_hi")
    own = Window.partitionBy("p", "node")
    left = F.count("*").over(own) - F.row_number().over(own.orderBy("df", "sh")) + 1
    row = items.join(often, ["p", "sh"]).withColumn("left", left).where(percent * (F.col("size") - F.col("left")) <= (100 - percent) * F.col("n")).drop("df")
    a, b = row, row.select(*(F.col(c).alias(c + "2") for c in row.columns))
    share = F.least("left", "left2")
    near = (100 + percent) * (F.col("size") + F.col("size2") - 2 * share) <= (100 - percent) * (F.col("n") + F.col("n2"))
    may = (F.col("p") == F.col("p2")) & (F.col("sh") == F.col("sh2")) & (F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2")) & (F.col("covers") | F.col("covers2")) & near
    return a.join(b, may).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows(node, ...) with component, from found(id, component); a node without is its own."""
    return rows.join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def links(bucket: DataFrame, sets: DataFrame, percent: int, rounds: int = 2, cover: float = 0.5) -> DataFrame:
    """Edges (a, b) whose ends have 100 * intersection >= percent * union; they reach all that links between nodes of one bucket(key, node) reach.

    In each round every node of a bucket is compared with the bucket's pivot.
    One that shares `cover` with it is done there: whatever is linked with it is,
    by the triangle inequality of the Jaccard distance, near the pivot too, so
    both are known by their differences from the pivot, and possible() leaves the
    few pairs to compare that aren't joined yet.  Nodes that no pivot covers, all
    unlike each other, meet by the whole of their sets.
    """
    edges, seen = [], []
    for _ in range(rounds):
        bucket = written(pivots(bucket))
        if bucket.isEmpty():
            break
        now = written(compared(bucket.where("a <> node").select("a", F.col("node").alias("b")).distinct(), sets))
        edges.append(now.where(alike(percent)).select("a", "b"))
        share = F.col("same") / (F.col("n_a") + F.col("n_b") - F.col("same"))
        # a little less than the bounds, as these are fractions
        now = now.withColumn("covers", share >= cover).where(share >= percent / 100 + cover - 1 - 1e-9)
        seen.append(now.select(F.col("a").alias("p"), F.col("b").alias("node"), "covers"))
        done = now.where("covers").select("a", F.col("b").alias("node"))
        bucket = written(bucket.where("a <> node").join(done, ["a", "node"], "left_anti").select("key", "node"))
    if not edges:
        return sets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    edges = written(reduce(DataFrame.unionByName, edges))
    found = written(components(edges))
    # pivots among whose nodes two components could be linked
    near = written(labelled(reduce(DataFrame.unionByName, seen), found).groupBy("p", "node", "component").agg(F.max("covers").alias("covers")))
    mixed = near.groupBy("p").agg(F.min("component").alias("_a"), F.max("component").alias("_b"), F.max("covers").alias("_c")).where("_a <> _b and _c").select("p")
    near = written(near.join(mixed, "p"))
    apart = compared(near.select(F.col("p").alias("a"), F.col("node").alias("b")), sets, differences=True)
    item = apart.select(F.col("a").alias("p"), F.col("b").alias("node"), F.col("n_b").alias("n"), F.size("items").cast("long").alias("size"), F.explode("items").alias("sh")).join(near, ["p", "node"])
    pairs = [possible(written(item), percent)] if not near.isEmpty() else []
    rest = labelled(bucket, found)
    mixed = rest.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b").select("key")
    rest = written(rest.join(mixed, "key").select("node", "component").distinct())
    if not rest.isEmpty():
        whole = sets.join(rest, "node").select(F.lit(0).alias("p"), "node", "component", F.size("items").cast("long").alias("n"), F.explode("items").alias("sh"), F.lit(True).alias("covers"))
        pairs.append(possible(written(whole.withColumn("size", F.col("n"))), percent))
    return edges.unionByName(compared(reduce(DataFrame.unionByName, pairs).distinct(), sets).where(alike(percent)).select("a", "b")) if pairs else edges


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id that each end of the edges (a, b) reaches.  Alternates large and small stars until they stand."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = spread_join(both, least, ["a"], ["b"]).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, least, ["a"], ["b"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        now = written(small)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == state:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = seen


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE, permutations: int = PERMUTATIONS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of each row of docs.

    Texts are lower-cased in A-Z and cut at ASCII white space; a document's set
    has its distinct runs of `shingle` words (all its words, if fewer).  Two are
    linked if 100 * intersection >= percent * union; component_id is the least
    id that links reach.  A null text or one without words has an empty set and
    is linked with nothing; neither is a row with a null id, whose component_id
    and kept are null.  Rows of equal id and different text are linked through
    their id.  Other columns are left out.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    base = written(signatures(docs, shingle, permutations, rows))
    useful = base.where("id is not null and n_shingles > 0")
    classes = useful.groupBy("f1", "f2").agg(F.min("id").alias("rep"))
    # a node is known by the least id of its documents, or, if that is of several nodes, by a hash
    twice = classes.groupBy("rep").count().where("count > 1").select("rep", F.lit(True).alias("_twice"))
    number = F.when(F.col("_twice"), F.xxhash64("f1", "f2")).otherwise(F.col("rep"))
    node = written(classes.join(twice, "rep", "left").select("f1", "f2", "rep", number.alias("node")))
    member = written(useful.join(node, ["f1", "f2"]).select("id", "node"))
    one = useful.join(node, ["f1", "f2"]).where("id = rep")
    bucket = one.select("node", F.explode("bands").alias("key")).distinct()
    shared = bucket.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    bucket = written(bucket.join(shared, "key"))
    near = bucket.select("node").distinct().join(node, "node").select(F.col("rep").alias("id"), "f1", "f2", "node")
    sets = written(set_table(docs, near, shingle))
    edges = written(links(bucket, sets, percent))
    first = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("id", "a")
    same_id = member.join(first, "id").where("a <> node").select("a", F.col("node").alias("b"))
    root = components(edges.unionByName(same_id)).withColumnRenamed("id", "node")
    rooted = written(node.join(root, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("root")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    of_node = rooted.join(least, "root").select("node", "component")
    of_id = member.join(of_node, "node").groupBy("id").agg(F.min("component").alias("component"))
    out = base.join(of_id, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
