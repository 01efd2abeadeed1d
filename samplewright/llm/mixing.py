"""Mixing sources to target weights by nested hash thresholds.

Each row has a hash below 2**60. A histogram of sizes by source and hash bucket shows
the bucket in which a source's budget ends; only that bucket is counted again, by the
next 12 bits, until it is one hash. A row is taken if its hash lies below the threshold
found: a filter, no sort. A larger budget takes a superset of a smaller one's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.llm.shared import written

BITS, LEVEL_BITS = 60, 12
#: A source's rows meet its budget in so many parts, by the last bits of their hashes, so that one large source is no single task's.
PARTS = 32
#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a whole text as long; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(key: Column, text: Column) -> Column:
    """60 bits of md5 of key and text: alike in every run and on every cluster."""
    whole = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, BITS // 4), 16, 10).cast("long")


def weigh_in_turn(sources: DataFrame, turn: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """`sources` (source, source_size) with `weight`: the turn's values, repeating, by code point, null last.

    The window has one row for each source, which the caller has aggregated already.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in turn]), F.pmod(place - 1, F.lit(len(turn))).cast("int") + 1))


def targets(weighed: DataFrame, most: int = 3) -> DataFrame:
    """`weighed` (source, source_size, weight) with `target`: the total shared by weight, none above `most` sizes.

    The excess of capped sources goes to the others by weight until none is above. The
    end of that is one level L with target = min(cap, L * weight), and L is the largest
    of the levels that arise when sources are capped in the order of cap / weight.
    """
    cap = F.col("source_size") * most
    order = Window.orderBy(F.col("_ratio"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    solved = weighed.withColumn("_cap", cap).withColumn("_ratio", cap.cast("double") / F.col("weight").cast("double")).withColumn("_level", left.cast("double") / weights.cast("double"))
    level = F.max("_level").over(whole)
    return solved.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("weight").cast("double") * level)).drop("_cap", "_ratio", "_level")


def _spread(per_source: DataFrame) -> DataFrame:
    """Each source's row once for each part."""
    return per_source.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))


def _of_source(name: str) -> Column:
    return F.col("source").eqNullSafe(F.col(name)) & (F.col("rank").bitwiseAND(F.lit(PARTS - 1)) == F.col("_part"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source of `budgets` (source, budget): `cut`; rows of `rows` (source, size, rank) with rank < cut make up the budget.

    The rows of the last hash (one row, or equal rows) are taken whole if that comes
    nearer to the budget, and left out whole if not.
    """
    at = budgets.where("budget > 0").select(F.col("source").alias("_source"), "budget", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_before"))
    for shift in range(BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("rank", shift)
        inside = _spread(at).join(rows, _of_source("_source") & (F.shiftright("rank", shift + LEVEL_BITS) == F.col("_prefix")))
        counted = inside.groupBy("_source", "budget", "_before", bucket.alias("_bucket")).agg(F.sum("size").alias("_size"))
        # at most 2**12 rows for each source
        running = F.sum("_size").over(Window.partitionBy("_source", "budget").orderBy("_bucket"))
        ends = counted.withColumn("_after", F.col("_before") + running).where((F.col("_after") > F.col("budget")) & (F.col("_after") - F.col("_size") <= F.col("budget")))
        at = ends.select("_source", "budget", F.col("_bucket").alias("_prefix"), (F.col("_after") - F.col("_size")).alias("_before"), "_after")
        if shift:
            at = at.drop("_after")
    nearer = F.col("_after") - F.col("budget") < F.col("budget") - F.col("_before")
    return at.select(F.col("_source"), (F.col("_prefix") + F.when(nearer, 1).otherwise(0)).alias("cut"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, most: int = 3) -> DataFrame:
    """One row for each document: key, source, size, source_size, target, taken, times, rank.

    `weights` (source, weight) gives each source's weight; sources that it doesn't name
    weigh nothing; without it the weights 5, 2, 1 repeat over the sources in order. The
    sources share as many words as there are. A source with target T and size S takes
    each of its rows T // S times and makes up the rest by the hash threshold, so no row
    is taken more than `most` times. Null sources are one source; null texts have size
    0 and take 0; equal rows are taken alike, and so are rows of equal hash. Texts are counted
    and hashed whole, whatever their length. Columns other than key, text and source aren't
    read. An empty table gives no rows.
    """
    rows = written(docs.select(F.col(key).alias("_key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), row_hash(F.col(key), F.col(text)).alias("rank")), "mix-rows")
    taken = _taken(rows, plan_of(rows, weights, most))
    return taken.select(F.col("_key").alias(key), "source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "rank")


def plan_of(rows: DataFrame, weights: DataFrame | None, most: int) -> DataFrame:
    """One row for each source of `rows` (source, size, rank): its size and target, whole rounds, and the last round's cut."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighed = weigh_in_turn(sizes)
    else:
        given = weights.select(F.col("source").alias("_given"), "weight").dropDuplicates(["_given"])
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_given")), "left").drop("_given").where("weight > 0")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    share = written(targets(weighed, most).withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    cuts = thresholds(rows, share.select("source", "budget"))
    plan = share.select(F.col("source").alias("_of"), "source_size", "target", "whole").join(cuts, F.col("_of").eqNullSafe(F.col("_source")), "left")
    return plan.select("_of", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` with their source's plan and `times`."""
    times = F.col("whole") + F.when(F.col("rank") < F.col("cut"), 1).otherwise(0)
    planned = rows.join(_spread(plan), _of_source("_of"), "left").withColumn("times", F.coalesce(times, F.lit(0)).cast("long"))
    return planned.withColumn("source_size", F.coalesce("source_size", F.lit(0))).withColumn("target", F.coalesce("target", F.lit(0.0)))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, most: int = 3) -> DataFrame:
    """`docs` as the mix takes them: each row as many times as `mix` says, from none to `most`.

    The thresholds are found on slim rows; then the documents themselves are filtered by
    the same hash, with no shuffle of their texts where the plan is small. All columns
    stay as they are, whatever their names. Nulls, empty texts and equal rows as in `mix`.
    """
    rows = written(docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), row_hash(F.col(key), F.col(text)).alias("rank")), "mix-rows")
    plan = written(plan_of(rows, weights, most), "mix-plan")
    whole = docs.select(F.struct("*").alias("_row"), F.col(source).alias("source"), row_hash(F.col(key), F.col(text)).alias("rank"))
    return _taken(whole, plan).where("times > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("_row.*")
