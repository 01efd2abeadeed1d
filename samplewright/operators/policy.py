"""Resources and retries of tasks, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.functions import text as X

GB, HOUR = 1 << 30, 3600
# Exit codes after which a task is tried again.
RETRY_CODES = (143, 137, 104, 134, 139)
# Label, CPUs, GB, hours, whether CPUs grow with attempts; null keeps the default.
LABELS = [
    ("default", 1, 6, 4, True),
    ("process_single", 1, 6, 4, False),
    ("process_low", 2, 12, 4, True),
    ("process_medium", 6, 36, 8, True),
    ("process_high", 12, 72, 16, True),
    ("process_long", None, None, 20, True),
    ("process_high_memory", None, 200, None, True),
]


def labels(spark: SparkSession) -> DataFrame:
    """label, cpus, mem_bytes, time_s, scale_cpus; what a label leaves open is the default's."""
    default = LABELS[0]
    rows = [(name, *(v if v is not None else d for v, d in zip(rest[:3], default[1:4], strict=True)), rest[3]) for name, *rest in LABELS]
    return spark.createDataFrame([(n, c, m * GB, t * HOUR, s) for n, c, m, t, s in rows], "label string, cpus long, mem_bytes long, time_s long, scale_cpus boolean")


def requested(tasks: DataFrame, label: str, attempt: Column, limits: DataFrame, max_cpus: str = "16", max_memory: str = "128.GB", max_time: str = "240.h") -> DataFrame:
    """`tasks` with cpus, mem_bytes and time_s: the label's, times the attempt, under the caps.

    An unknown or null label is the default; an invalid cap is no cap. Labels meet tasks by
    a join that Spark broadcasts while they are small; only the default's row always is.
    """
    asked = ("cpus", "mem_bytes", "time_s", "scale_cpus")
    known = limits.select(F.col("label").alias("_label"), F.struct(*asked).alias("_own"))
    default = limits.where("label = 'default'").limit(1).agg(F.first(F.struct(*asked)).alias("_default"))
    rows = tasks.join(known, F.col(label) == F.col("_label"), "left").join(F.broadcast(default)).withColumn("_try", attempt)
    rows = rows.withColumns({f"_{c}": F.coalesce("_own", "_default")[c] for c in asked})
    rows = rows.withColumn("cpus", X.capped(F.when(F.col("_scale_cpus"), F.col("_cpus") * F.col("_try")).otherwise(F.col("_cpus")), F.lit(max_cpus).try_cast("long")))
    rows = rows.withColumn("mem_bytes", X.capped(F.col("_mem_bytes") * F.col("_try"), X.memory_bytes(F.lit(max_memory))))
    rows = rows.withColumn("time_s", X.capped(F.col("_time_s") * F.col("_try"), X.duration_seconds(F.lit(max_time))))
    return rows.drop("_own", "_default", "_label", "_cpus", "_mem_bytes", "_time_s", "_scale_cpus", "_try")


def decision(exit_code: Column, attempt: Column, strategy: Column | None = None, max_retries: Column | None = None) -> Column:
    """What follows a task: done, retry, ignore or finish. Labels may ask for retry or ignore whatever the code."""
    strategy = F.lit("default") if strategy is None else strategy
    allowed = F.lit(1) if max_retries is None else max_retries
    again = ((strategy == "retry") | exit_code.isin(*RETRY_CODES)) & (attempt <= allowed)
    return F.when(exit_code == 0, "done").when(strategy == "ignore", "ignore").when(again, "retry").otherwise("finish")
