"""Conversations brought into the form system?, (user, assistant)+ by the cheapest edits.

The rows of a conversation are read in order.  Four states say what has been
written so far: nothing, or last a system, user or assistant row.  For each
state the cheapest edits that lead there are kept, as a cost and a string of
letters: K keeps a row, R gives it another role, D deletes it, I inserts one
without text.  After each row a few inserts at most lead from state to state.

Rows come through a task one after the other, sorted by Spark, which spills.
What all states agree on is final and leaves memory at once, and states that
can't win any more are forgotten, so a task holds the few rows that are still
open, a digest for each different row, and the letters of one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import SPACES
from .frames import slices

ROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: States: nothing yet, and after a row whose role begins with this letter.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What a state may be followed by.
FOLLOW = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NAME = {USER: "user", ASSISTANT: "assistant"}
#: Rows after which what the states agree on is looked for.
EVERY = 32
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
BLANK, LAST = re.compile(rf"[{SPACES}]*"), re.compile(rf"[^{SPACES}](?=[{SPACES}]*\Z)")


class Repair:
    """One conversation, row by row: what is wrong with it, and its cheapest repair."""

    def __init__(self):
        self.best: list[tuple[int, str] | None] = [(0, ""), None, None, None]
        self.close()
        self.open: list[tuple[str, str] | None] = []  # rows that aren't decided, None if deleted anyhow
        self.state, self.letters, self.seen, self.turns = NOTHING, [], set(), None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.before: str | None = None

    def close(self) -> None:
        """Adds inserts; a path that takes more of them than there are states comes back to one of them."""
        for _ in FOLLOW:
            for state, way in enumerate(self.best):
                to = FOLLOW[state].get("a" if state == USER else "u")
                if way is not None:
                    self.offer(self.best, to, (way[0] + INSERT, way[1] + "I"))

    @staticmethod
    def offer(layer: list, state: int, way: tuple[int, str]) -> None:
        if layer[state] is None or way < layer[state]:
            layer[state] = way

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Takes a row, and yields (letter, role, text) of those that are decided."""
        if turn is not None:
            low, high, last = self.turns or (turn, turn, None)
            self.distinct += turn != last
            self.turns = min(low, turn), max(high, turn), turn
        first = role[:1]
        self.illegal += self.before is not None and self.before + first not in ("su", "ua", "au")
        self.before = first
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        known = digest in self.seen
        self.seen.add(digest)
        blank = BLANK.fullmatch(text) is not None
        again = known and not blank
        cut = not (blank or again) and LAST.search(text)[0] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + again, self.truncated + cut
        layer: list[tuple[int, str] | None] = [None] * 4
        for state, way in enumerate(self.best):
            if way is None:
                continue
            cost, letters = way
            self.offer(layer, state, (cost + DELETE, letters + "D"))
            if not (blank or again):
                if first in FOLLOW[state]:
                    self.offer(layer, FOLLOW[state][first], (cost + CUT * cut, letters + "K"))
                to = FOLLOW[state]["a" if state == USER else "u"]
                self.offer(layer, to, (cost + ROLE + CUT * cut, letters + "R"))
        self.best = layer
        self.close()
        self.open.append(None if blank or again else (role, text))
        if len(self.open) >= EVERY:
            yield from self.agreed()

    def agreed(self) -> Iterator[tuple[str, str, str]]:
        """Forgets states that can't win, and decides what the others agree on.

        Whatever follows, it costs no more after an assistant's row than after
        a system's, and at most a deletion more than after nothing or a user's.
        """
        end = self.best[ASSISTANT]
        for state, more in ((NOTHING, DELETE), (SYSTEM, 0), (USER, DELETE)):
            if self.best[state] is not None and self.best[state][0] > end[0] + more:
                self.best[state] = None
        live = [w[1] for w in self.best if w is not None]
        low, high = min(live), max(live)
        n = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        yield from self.decide(low[:n])
        self.best = [w and (w[0], w[1][n:]) for w in self.best]

    def decide(self, letters: str) -> Iterator[tuple[str, str, str]]:
        at = 0
        for letter in letters:
            role, text = "", ""
            if letter != "I":
                role, text = self.open[at] or ("", "")
                at += 1
            if letter in "IR":
                self.state = FOLLOW[self.state]["a" if self.state == USER else "u"]
                role = NAME[self.state]
            elif letter == "K":
                self.state = FOLLOW[self.state][role[0]]
            yield letter, role, text
        del self.open[:at]
        self.letters.append(letters)

    def end(self) -> Iterator[tuple[str, str, str]]:
        way = min(self.best[s] for s in (NOTHING, ASSISTANT) if self.best[s] is not None)
        self.cost = way[0]
        yield from self.decide(way[1])

    @property
    def gaps(self) -> int:
        return self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows of a conversation side by side, by turn, null first, then role and text; absent ones are there for their id alone."""
    text = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    has = F.coalesce(F.col("present"), F.lit(False)) if "present" in rows.columns else F.lit(True)
    read = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role"), text("text"), has.alias("present"))
    return read.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("row", id, letter, role, text) of each decided row and ("end", id, Repair) of each conversation."""
    now, at = None, None
    for batch in slices(batches):
        for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv != at:
                if now is not None:
                    for x in now.end():
                        yield "row", at, *x
                    yield "end", at, now
                now, at = Repair(), conv
            if present:
                for x in now.row(turn, role, text):
                    yield "row", at, *x
    if now is not None:
        for x in now.end():
            yield "row", at, *x
        yield "end", at, now


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _mapped(rows: DataFrame, make, columns: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *_parse_datatype_string(columns)])
    arrow = to_arrow_schema(schema)
    return _ordered(rows).mapInArrow(lambda batches: _batches(make(batches), arrow), schema)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, deleted ones too, by place from 0.

    rows has conv_id, turn, role and text, and may have `present`, false in rows
    that only say that there is such a conversation; other columns aren't read.
    A null role or text is one space; a null conv_id is one conversation.  A
    role is known by its first letter.  Rows of one turn come by role, then text.
    """

    def make(batches):
        place, last = 0, None
        for kind, conv, *x in _conversations(batches):
            if kind == "row":
                place = place + 1 if last is not None and last[0] == conv else 0
                last = (conv,)
                yield conv, place, *x
            else:
                last = None

    return _mapped(rows, make, "place bigint, edit string, role string, text string")


def report(rows: DataFrame) -> DataFrame:
    """A row a conversation of rows, as repaired() takes them: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Of a row's faults the first counts: no character but space, the role and
    text of an earlier row, no sentence's end.  Gaps are turns missing between
    the least and the greatest, null ones left out.  Of equally cheap edits the
    audit is the least by code point.  The digest is of the repaired rows as
    `role:text`, a line each.  Without rows it is that of the empty string, and
    all else is 0 or empty.  An empty table gives no rows.
    """

    def make(batches):
        digest, lines = hashlib.sha256(), 0
        for kind, conv, *x in _conversations(batches):
            if kind == "row":
                letter, role, text = x
                if letter != "D":
                    digest.update(f"{chr(10) * (lines > 0)}{role}:{text}".encode())
                    lines += 1
            else:
                yield conv, *(int(getattr(x[0], f)) for f in FIELDS), "".join(x[0].letters), digest.hexdigest()
                digest, lines = hashlib.sha256(), 0

    return _mapped(rows, make, ", ".join(f"{f} bigint" for f in FIELDS) + ", audit string, repaired_sha256 string")


def damaged(rows: DataFrame, kinds: int = 20) -> DataFrame:
    """rows(conv_id, turn, role, text) with faults, by crc32(conv_id:turn) modulo `kinds`, and `present`.

    0 drops the row, which stays as one that isn't present, 1 empties its text,
    2 takes out its ends of sentences, 3 repeats it, 4 gives it to the user.
    Nulls are one space in what is hashed, and in role and text.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % kinds
    marked: Column = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    out = rows.select("conv_id", "turn", "role", "text", kind.alias("_k")).select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(shown("role")).alias("role"), marked.alias("text"), (F.col("_k") != 0).alias("present"), F.when(F.col("_k") == 3, 2).otherwise(1).alias("n")
    )
    return out.withColumn("n", F.explode(F.array_repeat(F.lit(0), F.col("n")))).drop("n")
