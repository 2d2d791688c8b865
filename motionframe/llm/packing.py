"""Packing token sequences into as few rows of a fixed size as can be found.

What can be packed depends only on how many pieces there are of each length, so
the plan is made from that table, whose size is bounded by the row size and not
by the data.  Martello and Toth's dominance rules fix sets that some best
packing must hold; best fit, longest first, places the rest.  The plan is then
dealt to the pieces by their rank among pieces of equal length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import named, slices, written
from .pretokens import Encoder

#: Words that are encoded at once.
WORDS = 1 << 14


@lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, Encoder(lambda words: [ids for at in range(0, len(words), WORDS) for ids in _ids_of_words(tokenizer, words[at : at + WORDS])]), special


def _ids_of_words(tokenizer, words: list[str]) -> list[np.ndarray]:
    """The ids of each word, none of which is empty: one encoding of all, as an object a word costs more than its ids."""
    encoding = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
    ids = np.array(encoding.ids, np.uint32)
    end = np.cumsum(np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(words))).tolist()
    return [ids[a:b] for a, b in zip([0, *end], end, strict=False)]


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    """The tokenizer's ids of each text.  Texts that hold one of its added tokens go through it whole, others by pre-token."""
    tokenizer, encoder, special = _tokenizer(path)
    whole = {i for i, x in enumerate(texts) if any(s in x for s in special)}
    out = encoder.batch(["" if i in whole else x for i, x in enumerate(texts)] if whole else texts)
    for i in whole:
        out[i] = np.asarray(tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
    return out


def pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32[, ids]): each whole text's ids and end_id, cut where they exceed capacity.

    Every piece of a longer document has capacity ids, but the first, which has
    what is over.  A null text counts as empty and gives one piece, end_id alone.
    ids are little-endian unsigned 32-bit integers in one binary value; with_ids
    leaves them out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, rows = [], []
            for k, ids in enumerate(token_ids([x or "" for x in batch.column(1).to_pylist()], path)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start : first if piece == 0 else start + capacity].tobytes()
                    at.append(k)
                    rows.append((piece, start, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 if with_ids else 4]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns) + 1])

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ddl).withColumnRenamed("id", id_col)


Patterns = list[tuple[tuple[int, ...], int]]


def reduce(counts: np.ndarray, capacity: int) -> Patterns:
    """Fixes sets by dominance and takes them out of counts, which has the number of pieces of each length.

    A set with piece i dominates another if the other's pieces can be dealt into
    the places of its own.  So a row may be fixed to be i and
    - nothing, if nothing else fits;
    - k, if it fills the row, or if k is the longest that fits and no two others fit together, or no two that fit are longer than k together and no three fit;
    - k and m, if no three fit, k is the longest that fits, m the longest that fits beside it, and no pair that fits has a shorter part over m.
    """
    fixed: Patterns = []
    changed = True
    while changed:
        changed = False
        for i in range(capacity, 0, -1):
            while counts[i]:
                counts[i] -= 1  # one of them is in hand
                chosen = _dominating(counts, capacity - i)
                counts[i] += 1
                if chosen is None:
                    break
                row = (i, *chosen)
                times = int(min(counts[x] // row.count(x) for x in set(row)))
                if chosen and times > 1 and len(chosen) > 1:
                    times = 1 if counts[chosen[0]] < times else times
                for x in row:
                    counts[x] -= times
                fixed.append((row, times))
                changed = True
    return fixed


def _dominating(counts: np.ndarray, room: int) -> tuple[int, ...] | None:
    """What to put beside a piece that leaves so much room, if something dominates."""
    there = np.flatnonzero(counts[: room + 1])
    if not len(there):
        return ()
    longest = int(there[-1])
    if longest == room:
        return (longest,)
    small = np.repeat(there[:3], np.minimum(counts[there[:3]], 3))[:3]
    if len(small) < 2 or small[0] + small[1] > room:
        return (longest,)
    if len(small) == 3 and small.sum() <= room:
        return None
    # two others fit at most: the longest partner of each length that is there
    at = np.searchsorted(there, room - there, "right") - 1
    partner = np.where(at >= 0, there[at], 0)
    alone = (partner == there) & (counts[there] < 2)
    partner = np.where(alone, np.where(at > 0, there[at - 1], 0), partner)
    both = np.where(partner > 0, there + partner, 0)
    if longest >= both.max():
        return (longest,)
    beside = int(partner[-1])
    if beside and beside >= np.minimum(there, partner).max():
        return (longest, beside)
    return None


def best_fit(counts: np.ndarray, capacity: int) -> Patterns:
    """Best fit, longest first, for all pieces of a length and all rows with the same room at once.  Empties counts."""
    rooms: dict[int, Patterns] = {}
    for s in range(capacity, 0, -1):
        left = int(counts[s])
        counts[s] = 0
        for room in sorted(r for r in rooms if r >= s):
            groups = rooms.pop(room)
            fits = room // s
            while groups and left:
                row, times = groups.pop()
                full = min(times, left // fits)
                if full:
                    rooms.setdefault(room - fits * s, []).append((row + (s,) * fits, full))
                    left -= full * fits
                    times -= full
                if left and times:
                    rooms.setdefault(room - left * s, []).append((row + (s,) * left, 1))
                    left, times = 0, times - 1
                if times:
                    groups.append((row, times))
            if groups:
                rooms.setdefault(room, []).extend(groups)
            if not left:
                break
        fits = capacity // s
        if full := left // fits:
            rooms.setdefault(capacity - fits * s, []).append(((s,) * fits, full))
        if rest := left % fits:
            rooms.setdefault(capacity - rest * s, []).append(((s,) * rest, 1))
    return [g for groups in rooms.values() for g in groups]


def plan(counts: dict[int, int], capacity: int) -> Patterns:
    """Rows, as (lengths, how many such rows), that hold every piece once."""
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        table[length] = n
    return reduce(table, capacity) + best_fit(table, capacity)


def slots(patterns: Patterns) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset) of each place of each pattern."""
    out, rank, sequence = [], {}, 0
    for row, times in patterns:
        offset = 0
        for length in row:
            at = rank.get(length, 0)
            out.append((length, at, at + times, sequence, offset))
            rank[length] = at + times
            offset += length
        sequence += times
    return out


def pack(parts: DataFrame, capacity: int = 1024, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), group: int = 1 << 16) -> DataFrame:
    """All columns of parts, with sequence_id and offset: rows of at most capacity, filled from 0 without gaps.

    Lengths must be from 1 to capacity; a row whose length is null or outside
    gets nulls.  Ranks are counted within (length, salt), the salt being a hash
    of the order columns, so that a length with many pieces is dealt over groups
    of about `group` pieces.  The driver holds one count for each length and the
    plan, which capacity bounds; parts is read again and again and should be a
    written table.
    Columns named sequence_id and offset are replaced.
    """
    spark = parts.sparkSession
    names = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    length, keys = named(length_col), [named(c, "_row") for c in order]
    counted = parts.select(F.struct(*map(named, names)).alias("_row"), F.when(length.between(1, capacity), length.cast("long")).alias("_len"))
    counts = {r[0]: r[1] for r in counted.where("_len is not null").groupBy("_len").count().collect()}
    table = spark.createDataFrame(slots(plan(counts, capacity)), "_len long, _from long, _to long, _seq long, _off long")
    groups = F.broadcast(spark.createDataFrame([(k, -(-n // group)) for k, n in counts.items()], "_len long, _groups long"))  # its rows are bounded by capacity
    keyed = counted.join(groups, "_len", "left").withColumn("_salt", F.pmod(F.xxhash64(*keys), F.coalesce("_groups", F.lit(1)))).drop("_groups")
    sizes = keyed.where("_len is not null").groupBy("_len", "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_len").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("_len", "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_len", "_salt").orderBy(*keys)) - 1 + F.col("_before")
    ranked = keyed.join(firsts, ["_len", "_salt"], "left").withColumn("_rank", rank)
    hit = (ranked["_len"] == table["_len"]) & (ranked["_rank"] >= table["_from"]) & (ranked["_rank"] < table["_to"])
    placed = ranked.join(F.broadcast(table), hit, "left")  # its rows are bounded by capacity
    return placed.select(*(named(c, "_row") for c in names), (F.col("_seq") + F.col("_rank") - F.col("_from")).alias("sequence_id"), F.col("_off").alias("offset"))


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """pieces() without ids, written to the shared folder, and packed."""
    parts = written(pieces(docs, path, end_id, capacity, id_col, text_col, with_ids=False))
    return pack(parts, capacity, order=(id_col, "piece"))
