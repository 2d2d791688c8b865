"""Long passages that several documents share, found on a de Bruijn graph of words.

A run of 13 words is an edge from its first 12 words to its last 12.  Edges that
start in more than one document are kept, and paths of them without branches are
compacted by joins.  A path goes on as long as all texts that have its last edge
have the next one in the next place, and no other text has that, so each text has
all of a path or nothing.  Texts are matched with paths, then, by the paths' first
edges alone: a path in a text is one row, a span of words, which is verified at
the text's own coordinates.

Few edges repeat, so each window is first reduced to the least hash among its
runs of 5 words (its anchor).  Equal windows have equal anchors; only windows
whose anchor is seen in two documents become edges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import dropped, slices, written
from .words import Hasher, U, runs, starts_inside

WINDOW = 13
#: In place of a number of windows: all that the text has.
WHOLE = -1
ANCHOR = 5
#: Places of edges are marked by powers of a factor, modulo each of two primes.
MARKS = (((1 << 31) - 1, 1664525), ((1 << 31) - 19, 22695477))
#: Windows in one row of edges(), at most.
ROW = 1024


def _anchors(words: np.ndarray, firsts: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of windows, places of their anchors, hashes of all runs of anchor words)."""
    short = runs(words, anchor)
    starts = np.flatnonzero(starts_inside(firsts, window))
    n = max(0, len(words) - window + 1)
    best, where = short[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, window - anchor + 1):
        other = short[j : j + n]
        less = other < best
        np.copyto(best, other, where=less)
        where[less] = j
    return starts, starts + where[starts], short


def _owner(places: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The text that each place lies in."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[places]


def _cut_out(raw: bytes, stays: np.ndarray, begin: np.ndarray, end: np.ndarray, at: int, to: int) -> bytes:
    """The bytes from at to `to`, without the words that don't stay and the white space after them, or before them at the end."""
    turns = np.flatnonzero(np.diff(np.concatenate([[False], stays, [False]])))
    runs_ = list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))
    n, out = len(stays), []
    for a, b in runs_:
        last = to if b == n else int(end[b - 1]) if (a, b) == runs_[-1] else int(begin[b])
        out.append(raw[at if a == 0 else int(begin[a]) : last])
    return b"".join(out)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _powers(prime: int, factor: int, n: int) -> np.ndarray:
    """1, factor, factor**2, ... modulo the prime: n of them at least."""
    out, top = np.ones(1, U), factor
    while len(out) < n:
        out = np.concatenate([out, out * U(top) % U(prime)])
        top = top * top % prime
    return out


def _marks(of_text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A mark of each place of a text, of 31 bits for each of the primes; one place on, it is the factor times as much."""
    most = int(places.max(initial=0)) + 1
    (p, a), (q, b) = MARKS
    low = of_text % U(p) * _powers(p, a, most)[places] % U(p)
    return low | (of_text >> U(31)) % U(q) * _powers(q, b, most)[places] % U(q) << U(31)


def marked(df: DataFrame, key: list[str], *aggregates: Column) -> DataFrame:
    """df's rows by key, with aggregates and (here, next): what the places marked by low and high add up to, and what they do one place on.

    Of two edges, the next of one equals the other's here if the other one's
    places are those of the first, each one place on, and else hardly ever.
    """
    (p, a), (q, b) = MARKS
    low_of, high_of = F.col("_low") % p, F.col("_high") % q
    both = lambda x, y: x.bitwiseOR(F.shiftleft(y, 31))
    return df.groupBy(*key).agg(*aggregates, F.sum("low").alias("_low"), F.sum("high").alias("_high")).select("*", both(low_of, high_of).alias("here"), both(low_of * a % p, high_of * b % q).alias("next")).drop("_low", "_high")


def anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, print) of every text, each pair once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches):
            words, _, _, firsts, _ = hasher.batch(batch.column(1))
            _, places, short = _anchors(words, firsts, window, anchor)
            places = np.unique(places)
            text, value = _owner(places, firsts), short[places]
            order = np.lexsort((value, text))
            text, value = text[order], value[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
            yield pa.RecordBatch.from_arrays([_signed(value[new]), batch.column(0).take(pa.array(text[new]))], ["anchor", "print"])

    return docs.where("id is not null").select("print", "text").mapInArrow(run, "anchor bigint, print bigint")


def edges(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(id, start, nodes, checks, mark): runs of consecutive windows of docs whose anchors are in the column anchors.

    A window is an edge from a node to the next: nodes has the hashes of all
    but a window's last word, and in the end of all but the last window's first;
    checks has 32 bits of those of the whole windows, by another family of hashes,
    and mark is that of the first one's place.  start counts words.  Longer runs
    than of ROW windows are cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, other = Hasher(), Hasher(family=1)
        for batch in slices(batches):
            words, _, _, firsts, _ = hasher.batch(batch.column(1))
            starts, places, short = _anchors(words, firsts, window, anchor)
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            wanted = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U)
            own = np.repeat(np.arange(batch.num_rows), sizes).astype(U)
            text = _owner(starts, firsts)
            # an anchor that only its hash with another text's number equals adds an edge in vain, and no more
            hit = np.isin(short[places] + text.astype(U) * U(0x9E3779B97F4A7C15), wanted + own * U(0x9E3779B97F4A7C15))
            starts, text = starts[hit], text[hit]
            new = (np.diff(starts, prepend=-2) != 1) | (np.diff(text, prepend=-1) != 0)
            since = np.arange(len(starts)) - np.maximum.accumulate(np.where(new, np.arange(len(starts)), 0))
            opens = np.flatnonzero(since % ROW == 0)
            n = np.diff(np.append(opens, len(starts)))
            first, text = starts[opens], text[opens]
            places = first - firsts[text]

            def lists_of(values: np.ndarray, n: np.ndarray, first: np.ndarray = first) -> pa.Array:
                """values[first : first + n] of each run."""
                ends = np.append(0, np.cumsum(n))
                return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])]))

            checks = (runs(other.batch(batch.column(1))[0], window) >> U(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), pa.array(places.astype(np.int32)), lists_of(runs(words, window - 1).view(np.int64), n + 1), lists_of(checks, n), _signed(_marks(batch.column(3).to_numpy().view(U)[text], places))],
                ["id", "start", "nodes", "checks", "mark"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", "anchors", F.xxhash64("id", "print").alias("mark")).mapInArrow(run, f"id {kind}, start int, nodes array<bigint>, checks array<int>, mark bigint")


def exploded(found: DataFrame, marks: bool) -> DataFrame:
    """(tail, head, check, id, at[, low, high]) of each edge of edges(); at is its place in the text, low and high are the mark's two halves."""
    n = F.size("checks")
    each = found.select("id", "start", "mark", F.posexplode(F.arrays_zip(F.slice("nodes", 1, n).alias("tail"), F.slice("nodes", 2, n).alias("head"), "checks")).alias("_i", "e"))
    of_first = F.col("mark").bitwiseAND(0x7FFFFFFF), F.shiftright("mark", 31)
    halves = [(half * F.get(F.lit(_powers(p, a, ROW).tolist()), F.col("_i")) % p).alias(name) for half, (p, a), name in zip(of_first, MARKS, ("low", "high"), strict=True)] if marks else []
    return each.select("e.tail", "e.head", F.col("e.checks").alias("check"), "id", (F.col("start") + F.col("_i")).alias("at"), *halves)


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("print"), F.struct(*carry, F.lit(0).alias("_")).alias("carried"))


def classes(docs: DataFrame, salts: int = 16) -> DataFrame:
    """(id, print, first_id): of each document, the least id with the same text, known by 128 bits and its length.  Texts with many copies are dealt by a salt."""
    text = F.col("text")
    known = docs.where("id is not null and text is not null").select("id", "print", F.xxhash64(F.lit("other"), text).alias("_h"), F.octet_length(text).alias("_n"))
    first = known.groupBy("print", "_h", "_n").agg(F.min("id").alias("first_id"), F.max("id").alias("_last")).where("first_id < _last").drop("_last")
    first = first.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = known.withColumn("_s", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return salted.join(first, ["print", "_h", "_n", "_s"], "left").select("id", "print", F.coalesce("first_id", "id").alias("first_id"))


def compacted(edge: DataFrame) -> DataFrame:
    """edge(tail, head, check, first_id, at, here, next) with path and offset in place of here and next: a name of the path that it is on, and how many edges come before.

    at is an edge's place in the document first_id, where it is seen first.  A
    node joins two edges to one path if it has one on each side, both are seen
    first in the same document, and the next of the one is the here of the other,
    so that the same texts have them.  Edges that follow each other in the first
    document are one piece; pieces are joined to paths by going from each to the
    one before, then twice as far in each round.  A path that closes in itself,
    which no text of an end can have, is cut between its pieces.
    """
    out_of = edge.groupBy(F.col("tail").alias("node")).agg(F.count("*").alias("_out"), F.min("first_id").alias("_a"), F.min("here").alias("_here"))
    into = edge.groupBy(F.col("head").alias("node")).agg(F.count("*").alias("_in"), F.min("first_id").alias("_b"), F.min("next").alias("_next"))
    inner = written(out_of.where("_out = 1").join(into.where("_in = 1"), "node").where("_a = _b and _here = _next").select(F.col("node").alias("tail"), F.lit(True).alias("_inner")))
    known = edge.join(inner, "tail", "left")
    by = Window.partitionBy("first_id").orderBy("at", "tail", "head", "check")
    follows = F.col("_inner") & (F.lag("at").over(by) + 1 == F.col("at")) & (F.lag("head").over(by) == F.col("tail"))
    opens = ~F.coalesce(follows, F.lit(False))
    # a piece is known by its first edge
    first = F.last(F.when(opens, F.struct("tail", "head", "check", "at", "_inner")), True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    name = F.xxhash64("_first.tail", "_first.head", "_first.check")
    piece = written(known.withColumn("_first", first).select("tail", "head", "check", "first_id", "at", name.alias("piece"), (F.col("at") - F.col("_first.at")).alias("_k"), F.when(F.col("_first._inner"), F.col("_first.tail")).alias("_from")))
    before = piece.select(F.col("head").alias("_from"), F.col("piece").alias("up"), (F.col("_k") + 1).alias("far"))
    step = written(piece.where("_k = 0 and _from is not null").select("piece", "_from").join(before, "_from").select("piece", "up", "far").where("piece <> up"))
    for _ in range(step.count().bit_length() + 1):
        far = step.select(F.col("piece").alias("up"), F.col("up").alias("_up"), F.col("far").alias("_far"))
        now = written(step.join(far, "up", "left").select("piece", F.coalesce("_up", "up").alias("up"), (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far"), F.col("_up").isNotNull().alias("_on")))
        dropped(step)
        step = now.drop("_on")
        if now.where("_on").isEmpty():
            break
    step = step.join(step.select(F.col("piece").alias("up")).distinct(), "up", "left_anti")  # what still leads on goes round
    out = written(piece.join(step, "piece", "left").select("tail", "head", "check", "first_id", "at", F.coalesce("up", "piece").alias("path"), (F.col("_k") + F.coalesce("far", F.lit(0))).alias("offset")))
    dropped(piece, inner)
    return out


def spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Repeated passages that are not in their first document.

    (id, first_id, first_place, path, start, n_windows, total): n_windows
    consecutive windows from word start on, which are all edges of path, and
    start at word first_place of the smaller id first_id too; total is the sum of
    the checks that these have there, for verification.  Of a copy of a whole
    text, n_windows is WHOLE, total the text's fingerprint, and there is no path.
    Texts of one id share its spans: what isn't there in one of them isn't verified.
    """
    docs = _keyed(docs, id_col, text_col)
    same = written(classes(docs))
    # anchors go to the first document of each text; its copies are removed whole
    wanted = written(_wanted(docs, same, window, anchor))
    # whatever the sizes, texts are joined the same way, by their ids
    found = written(edges(docs.join(wanted.hint("merge"), "id"), window, anchor))
    dropped(wanted)
    key = ["tail", "head", "check"]
    edge = marked(exploded(found, marks=True), key, F.min("id").alias("first_id"), F.max("id").alias("_last"), F.min_by("at", "id").alias("at")).where("first_id < _last").drop("_last")
    edge = written(edge)
    paths = compacted(edge)
    dropped(edge)
    # they meet by a shorter hash: of two edges that share it both are found, and the sums of checks tell which it is
    short = F.xxhash64(*key).alias("k")
    opens = F.col("offset") == 0
    head = paths.groupBy("path", "first_id").agg(F.max(F.when(opens, short)).alias("k"), F.max(F.when(opens, F.col("at"))).alias("first_at"), F.count("*").cast("int").alias("n_windows"), F.sum(F.col("check").bitwiseAND(0xFFFFFFFF)).alias("total"))
    # what is hashed here is a row a path, and skewed partitions of the other side can be split
    met = exploded(found, marks=False).select(short, "id", "at").join(head.hint("shuffle_hash"), "k").where("first_id < id")
    passages = met.select("id", "first_id", F.col("first_at").alias("first_place"), "path", F.col("at").alias("start"), "n_windows", "total")
    none = F.lit(None).cast("bigint")
    copies = same.where("id > first_id").select("id", "first_id", F.lit(0).alias("first_place"), none.alias("path"), F.lit(0).alias("start"), F.lit(WHOLE).alias("n_windows"), F.col("print").alias("total"))
    out = written(passages.unionByName(copies))
    dropped(found, paths, same)
    return out


def _wanted(docs: DataFrame, same: DataFrame, window: int, anchor: int) -> DataFrame:
    """(id, anchors): of the first document of each text, the anchors that another text has too."""
    seen = anchors(docs, window, anchor)
    repeated = seen.groupBy("anchor").agg(F.min("print").alias("_a"), F.max("print").alias("_b")).where("_a < _b").select("anchor")
    first = same.where("id = first_id").select("id", "print").distinct()
    return seen.join(repeated.hint("shuffle_hash"), "anchor").distinct().join(first, "print").groupBy("id").agg(F.collect_list("anchor").alias("anchors"))


def remove(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, carry: tuple[str, ...] = (), untouched: bool = False) -> DataFrame:
    """(id_col, n_words, n_removed, kept, *carry): each document without the words that repeated windows cover.

    A word goes if it lies in a window of `window` words that also starts in a
    document of smaller id; windows are judged on the input.  Words are runs of
    anything but ASCII white space, and kept ones are joined by one blank;
    with untouched, the rest of the text, white space and all, is kept as it is.  With
    digest, kept_sha256 (lower-case hex) stands for kept.  A null text has no
    words; a document with a null id is compared with none; documents of one id
    are not compared with each other.  Of other columns, those in carry are kept.
    """
    keyed = _keyed(docs, id_col, text_col, carry)
    cut = spans(docs, window, anchor, id_col, text_col).groupBy("id").agg(F.collect_list(F.struct("start", "n_windows", "total")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, other = Hasher(), Hasher(family=1)
        for batch in slices(batches):
            lists = batch.column(2)
            part = lists.flatten()
            prints = batch.column(4).to_numpy(zero_copy_only=False)
            start, n, total = (part.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            words, begin, end, firsts, data = hasher.batch(batch.column(1))
            gone = np.zeros(len(words) + 1, np.int64)
            if len(text):
                copied = (n == WHOLE) & (prints[text] == total) & (firsts[text + 1] - firsts[text] >= window)
                np.add.at(gone, firsts[text[copied]], 1)
                np.add.at(gone, firsts[text[copied] + 1], -1)
                at = firsts[text] + start.astype(np.int64)
                to = at + n.astype(np.int64)
                ok = (n != WHOLE) & (to + window - 1 <= firsts[text + 1])
                at, to, total = at[ok], to[ok], total[ok]
                # the words at the coordinates are those of the first document
                sums = np.append(0, np.cumsum((runs(other.batch(batch.column(1))[0], window) >> U(32)).astype(np.int64)))
                ok = sums[to] - sums[at] == total
                np.add.at(gone, at[ok], 1)
                np.add.at(gone, to[ok] + window - 1, -1)
            stays = np.cumsum(gone[:-1]) == 0
            n_words = np.diff(firsts)
            counts = np.append(0, np.cumsum(stays))[firsts]
            left = np.diff(counts)
            raw = data.tobytes()
            bounds = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))).tolist()
            kept = []
            for k in range(batch.num_rows):
                lo, hi = firsts[k], firsts[k + 1]
                if left[k] == n_words[k] and untouched:
                    kept.append(batch.column(1)[k].as_py())
                    continue
                if untouched:
                    joined = _cut_out(raw, stays[lo:hi], begin[lo:hi], end[lo:hi], bounds[k], bounds[k + 1])
                elif left[k] == n_words[k]:
                    joined = b" ".join(raw[begin[lo] : end[hi - 1]].split()) if hi > lo else b""
                else:
                    mine = np.flatnonzero(stays[lo:hi]) + lo
                    joined = b" ".join(raw[a:b] for a, b in zip(begin[mine].tolist(), end[mine].tolist(), strict=True))
                kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n_words - left), pa.array(kept, pa.string()), batch.column(3)], ["id", "n_words", "n_removed", "kept", "carried"])

    kind, carried = (keyed.schema[c].dataType.simpleString() for c in ("id", "carried"))
    out = keyed.join(cut.hint("merge"), "id", "left").select("id", "text", "spans", "carried", "print").mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, kept string, carried {carried}")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digest else "kept"), *(F.col("carried")[c].alias(c) for c in carry))
