"""A mix of sources in given proportions, by thresholds on a hash of each document.

A source's documents come in the order of a hash, which nobody sorts by: the
words of each bucket of hashes are summed, and where their running sum passes
what the source may give, only that bucket's documents are summed again, by
the next bits, until a bucket holds one document.  What lies below the threshold is in.
A source that gives more than it has gives all of its documents, and those
below a second threshold once more: thresholds are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .audit import WORD
from .frames import dropped, named, spread_join, written

#: Bits of a key, and how many of them one pass looks at; keys are positive longs.
KEY_BITS, STEP = 60, 10
LEVELS = KEY_BITS // STEP


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def key(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts as text, nulls as empty."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes(source, source_size), a row a source, with target: `share` of all sizes, dealt by weight.

    Sources have the weights in turn by code point, null last.  None has more
    than `most` times its size; what it can't take goes to the others by weight.
    Ordered by the level at which they are full, the full ones are a prefix, so
    one running sum tells the level of the rest.
    """
    if not 0 <= share <= most or not weights or min(weights) <= 0:
        raise ValueError("weights are above 0, and share is between 0 and most")
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # a row a source
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), F.pmod(at, F.lit(len(weights))) + 1)
    placed = sizes.withColumn("w", w).withColumn("cap", most * F.col("source_size"))
    upto = Window.orderBy("fill", F.col("source").asc_nulls_last())
    filled = placed.withColumn("fill", F.col("cap") / F.col("w"))
    every = Window.partitionBy()
    sums = filled.withColumns({
        "budget": share * F.sum("source_size").over(every), "all_w": F.sum("w").over(every), "cap_to": F.sum("cap").over(upto.rowsBetween(Window.unboundedPreceding, 0)), "w_to": F.sum("w").over(upto.rowsBetween(Window.unboundedPreceding, 0)),
    })
    # a source is full if, with those before it and itself full, the rest's level isn't below its own
    before_cap, before_w = F.col("cap_to") - F.col("cap"), F.col("w_to") - F.col("w")
    full = (F.col("budget") - before_cap) >= F.col("fill") * (F.col("all_w") - before_w)
    marked = sums.withColumn("full", full)
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    return marked.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * left / rest).alias("target"))


def _named(source: Column) -> Column:
    """A source as a key that isn't null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _upto(level: int) -> tuple[str, int]:
    """The key that a level looks at, and how many of its low bits it doesn't."""
    return ("k", KEY_BITS - STEP * (level + 1)) if level < LEVELS else ("k2", KEY_BITS - STEP * (level - LEVELS + 1))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, repeats, taken, and carry) of docs(doc_id, text, source), a row a row.

    `size` counts words; a null text has none.  `repeats` says how often the
    document is in the mix, at most `most` times rounded up; `taken` is that many
    times its size.  A source's sum of taken is nearer to its target than half
    its largest document, for the document at its threshold is in or out as is nearer.
    A document of no words is in no mix.  An empty table gives no rows.

    Order is by a hash of doc_id and text, so reruns agree, however the rows are
    dealt; repeated rows come one after the other, in no order, and are alike
    in all columns but carried ones.  Sources and null are joined as keys of
    their own; no window and no task holds a source's documents.  Columns of
    docs other than those named aren't read.
    """
    kept = [c for c in dict.fromkeys(carry) if c not in ("doc_id", "size", "source_size", "target", "repeats", "taken")]
    held = F.struct(F.col("doc_id"), *(named(c) for c in kept)).alias("held")
    row = docs.select(held, F.col("source"), _named(F.col("source")).alias("s"), words(F.col("text")).alias("size"), key(F.col("doc_id"), F.col("text")).alias("k"), F.monotonically_increasing_id().alias("n"))
    base = written(row.withColumn("k2", F.shiftrightunsigned(F.xxhash64("k", "n"), 64 - KEY_BITS)).drop("n"))
    goal = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = written(goal.select(_named(F.col("source")).alias("s"), "source_size", "target", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("need"), F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2")))
    inside, used = base.where("size > 0").select("s", "size", "k", "k2"), []
    for level in range(2 * LEVELS):
        of, low = _upto(level)
        bucket = F.shiftright(of, low)
        histogram = inside.groupBy("s", bucket.alias("b")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        upto = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most 2**STEP rows a source
        summed = histogram.withColumn("under", F.coalesce(F.sum("words").over(upto), F.lit(0)))
        edge = summed.join(state.select("s", "need"), "s").where("under <= need").groupBy("s").agg(F.max(F.struct("b", "under", "words", "rows")).alias("e"))
        place = F.shiftleft("e.b", low)
        moved = {"need": F.col("need") - F.coalesce(F.col("e.under"), F.lit(0)), "p1": F.coalesce(place if of == "k" else F.col("p1"), F.col("p1")), "p2": F.coalesce(place if of == "k2" else F.col("p2"), F.col("p2"))}
        used.append(state)
        state = written(state.select("s", "source_size", "target", "whole", "need", "p1", "p2").join(edge, "s", "left").withColumns(moved).select("s", "source_size", "target", "whole", "need", "p1", "p2", F.col("e.rows").alias("rows"), F.col("e.words").alias("words")))
        if state.where("rows > 1").isEmpty() or level == 2 * LEVELS - 1:
            break
        # of each source only the bucket that its threshold lies in goes on
        mine = state.where("rows > 0").select("s", *([F.shiftright("p1", low).alias("at")] if of == "k" else ["p1", F.shiftright("p2", low).alias("at")]))
        next_ = spread_join(inside, mine, ["s"], ["k", "k2"], few=True).where(bucket == F.col("at")).where(F.lit(True) if of == "k" else F.col("k") == F.col("p1"))
        inside = written(next_.select("s", "size", "k", "k2"))
        used.append(inside)
    of, low = _upto(level)
    place = lambda a, b: F.shiftright(a, low) if of == "k" else F.struct(F.col(a).alias("a"), F.shiftright(b, low).alias("b"))
    here, edge = place("k", "k2"), place("p1", "p2")
    last = 2 * F.col("need") >= F.col("words")  # nearer with the document at the threshold than without
    taken_in = F.coalesce((here < edge) | ((here == edge) & last), F.lit(False))
    goals = state.select("s", "source_size", "target", "whole", "need", "words", "p1", "p2")
    out = spread_join(base, goals, ["s"], ["k", "k2"], "left", few=True).withColumn("repeats", F.when(F.col("size") > 0, F.col("whole") + taken_in.cast("int")).otherwise(0))
    dropped(*used)
    return out.select(F.col("held.doc_id").alias("doc_id"), "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"), *(named(c, "held") for c in kept))
