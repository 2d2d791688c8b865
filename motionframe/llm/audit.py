"""What each of a set of filters removes, in every order of applying them.

A document's failures are a mask, a bit a filter.  Equal masks of one part are
one cell, so that what follows doesn't grow with the documents: each cell is
unpivoted against the steps of every order, a running bit-or over an order's
steps says what has failed before, sums under conditions give the metrics of a
step, and a window over the steps of one filter gives its total over all orders.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What keeps words apart, as a class of Java's expressions.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
#: More filters than these have too many orders to list each.
MOST_FILTERS = 6


def heuristics(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a text and its words: short (A), repetitive (B), shouting (C), marked up (D)."""
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * n, "C": 100 * capitals > 2 * F.length(text), "D": text.rlike("[#$%&*|]")}


def cells(docs: DataFrame, labels: DataFrame, filters=heuristics, copies: str | None = "E") -> DataFrame:
    """(part, mask, n, good, toxic): documents by source and failures; a null source is the part ''.

    docs has doc_id, text and source, labels has doc_id, quality and toxic;
    other columns of either, whatever their names, are not read.  `filters`
    gives a condition a letter, whose bits are 1, 2, 4, ... in turn, from the
    text (null: empty) and its words.  `copies` is the letter of one more, the
    last: the text is that of a smaller doc_id, of whatever part.  A null
    doc_id is not smaller than any, nor any than it.  Repeated rows count each,
    and are no copies of each other.  A document is good or toxic if any label
    of its doc_id says so; null labels don't.  Empty tables give no cell.

    Texts are equal if their SHA-256 is.  Rows of one id, and copies of a text,
    are counted before they are shuffled, so neither lands whole in one task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("source"), F.lit("")).alias("part"), text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    found = filters(F.col("t"), F.col("w"))
    mask = sum((F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(found.values())), F.lit(0))
    rows = read.select("id", "part", F.unhex(F.sha2("t", 256)).alias("same"), mask.alias("mask")).groupBy("id", "part", "same", "mask").agg(F.count("*").alias("c"))
    is_ = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(is_("quality"), is_("toxic"))
    known = rows.where("id is not null").join(of, "id", "left").na.fill(False, ["quality", "toxic"])
    nameless = rows.where("id is null").withColumns({"quality": F.lit(False), "toxic": F.lit(False)}).select(*known.columns)
    like = known.unionByName(nameless).groupBy("same", "part", "mask", "quality", "toxic").agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("id").isNotNull(), F.col("c")).otherwise(0)).alias("named"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c"))).alias("first")
    )
    if copies is not None:
        least = F.min("first.id").over(Window.partitionBy("same"))  # one row a part and labels of a text
        again = F.col("named") - F.when(F.col("first.id") == least, F.col("first.c")).otherwise(0)
        both = like.withColumn("again", F.coalesce(again, F.lit(0)))
        parts = F.array(F.struct(F.col("mask"), (F.col("n") - F.col("again")).alias("n")), F.struct((F.col("mask") + (1 << len(found))).alias("mask"), F.col("again").alias("n")))
        like = both.select("part", "quality", "toxic", F.inline(parts)).where("n > 0")
    return like.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("quality"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def interactions(of: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of cells.

    A row a part, order of the letters and step from 1, zeros included.
    `redundant` are failures of what an earlier step has removed, `unique_fails`
    fail this filter alone; `shapley` is the sum of what the filter removes over
    all orders.  No cells give no rows.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"one to {MOST_FILTERS} filters with letters of their own")
    orders = F.array(*(F.lit("".join(p)) for p in permutations(letters)))
    ordered = of.withColumn("filter_order", F.explode(orders)).repartition("part", "mask", "filter_order")
    steps = ordered.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))).withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    bit = F.element_at(F.create_map(*(x for i, k in enumerate(letters) for x in (F.lit(k), F.lit(1 << i)))), F.col("filter"))
    fails = F.col("mask").bitwiseAND(bit)
    before = F.bit_or("fails").over(Window.partitionBy("part", "mask", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    long = steps.withColumn("fails", fails).withColumn("before", F.coalesce(before, F.lit(0)))
    now, gone = F.col("fails") != 0, F.col("before") != 0
    total = lambda what, when: F.sum(F.when(when, F.col(what)).otherwise(0))
    out = long.groupBy("part", "filter_order", "step", "filter").agg(
        total("n", ~now & ~gone).alias("kept"), total("n", now & ~gone).alias("removed"), total("n", now & gone).alias("redundant"), total("n", now & (F.col("mask") == F.col("fails"))).alias("unique_fails"),
        total("good", now & ~gone).alias("good_lost"), total("toxic", now & ~gone).alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))


def audit(docs: DataFrame, labels: DataFrame, filters=heuristics, copies: str | None = "E") -> DataFrame:
    """interactions() of the cells() of docs."""
    letters: Mapping[str, Column] = filters(F.lit(""), F.array(F.lit("")))
    return interactions(cells(docs, labels, filters, copies), "".join(letters) + (copies or ""))
