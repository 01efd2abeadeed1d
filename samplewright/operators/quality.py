"""Quality of reads: counts, qualities, composition, adapters, repeats.

Reads are rows of a sample, a sequence and, where qualities are asked for, an array of
per-base qualities. Positions count from 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: More adapters than that are no panel: they'd be broadcast against every read.
MOST_ADAPTERS = 10_000
#: Positions that are counted together, and how many such blocks a task keeps before it passes them on.
BLOCK = 4096
MOST_BLOCKS = 256


def phred(quality: Column, offset: int = 33) -> Column:
    """A quality string as an array of scores."""
    return F.transform(F.split(quality, ""), lambda c: F.ascii(c) - offset)


def counts(reads: DataFrame, by: str) -> DataFrame:
    return reads.groupBy(by).agg(F.count(F.lit(1)).alias("n_reads"))


def mean_histogram(reads: DataFrame, by: str, scores: str, width: float = 1.0) -> DataFrame:
    """by, bin, n_reads: how many reads have a mean score from bin to bin + width. Reads without scores don't count."""
    q = F.col(scores)
    mean = F.aggregate(q, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(q)
    binned = reads.where(F.size(q) > 0).select(by, (F.floor(mean / width) * width).cast("double").alias("bin"))
    return binned.groupBy(by, "bin").agg(F.count(F.lit(1)).alias("n_reads"))


def by_position(reads: DataFrame, by: str, scores: str) -> DataFrame:
    """by, pos, mean, least and greatest score at each position; the explosion is summed before any shuffle."""
    each = reads.select(by, F.posexplode(scores).alias("at", "q"))
    return each.groupBy(by, (F.col("at") + 1).alias("pos")).agg(F.avg(F.col("q").cast("double")).alias("mean_q"), F.min("q").alias("min_q"), F.max("q").alias("max_q"))


def composition(reads: DataFrame, by: str, seq: str, letters: tuple[str, ...] = ("A", "C", "G", "T")) -> DataFrame:
    """by, pos, n and the number of reads with each letter there, in either case (`n_<letter>`).

    A task counts whole blocks of positions of a group before anything is shuffled, so a
    character is never a row. Null sequences count nowhere.
    """
    codes = [(ord(x.upper()), ord(x.lower())) for x in letters]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, np.ndarray] = {}

        def given() -> pa.RecordBatch:
            groups, blocks = ([k[i] for k in kept] for i in (0, 1))
            sums = [v[:, : v[0].argmin() if v[0].min() == 0 else BLOCK] for v in kept.values()]
            columns = [pa.array([v[i] for v in sums], pa.list_(pa.int64())) for i in range(len(codes) + 1)]
            out = pa.RecordBatch.from_arrays([pa.array(groups, kind), pa.array(blocks, pa.int64()), *columns], names=["_by", "_block", "n", *names])
            kept.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("_by").type
            for group, text in zip(batch.column("_by").to_pylist(), batch.column("_s").to_pylist(), strict=True):
                points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
                for block, at in enumerate(range(0, points.size, BLOCK)):
                    part = points[at : at + BLOCK]
                    sums = kept.setdefault((group, block), np.zeros((len(codes) + 1, BLOCK), np.int64))
                    sums[0, : part.size] += 1
                    for row, (upper, lower) in enumerate(codes, 1):
                        sums[row, : part.size] += (part == upper) | (part == lower)
                    if len(kept) >= MOST_BLOCKS:
                        yield given()
        if kept:
            yield given()

    names = [f"n_{x}" for x in letters]
    slim = reads.select(F.col(by).alias("_by"), F.col(seq).alias("_s"))
    lists = ", ".join(f"{c} array<long>" for c in ["n", *names])
    parts = slim.mapInArrow(counted, f"_by {slim.schema['_by'].dataType.simpleString()}, _block long, {lists}")
    each = parts.select("_by", "_block", F.posexplode(F.arrays_zip("n", *names)).alias("_at", "_c"))
    rows = each.groupBy("_by", (F.col("_block") * BLOCK + F.col("_at") + 1).cast("int").alias("pos"))
    return rows.agg(*[F.sum(f"_c.{c}").alias(c) for c in ["n", *names]]).withColumnRenamed("_by", by)


def adapter_content(reads: DataFrame, by: str, seq: str, panel: DataFrame, adapter_id: str, adapter: str) -> DataFrame:
    """by, adapter_id, pos, n_new, n_upto, share: reads that hold the adapter from pos on, or before, of the sample's.

    The panel's size is checked, then it is broadcast; only reads that hold one go on.
    """
    if (n := panel.limit(MOST_ADAPTERS + 1).count()) > MOST_ADAPTERS:
        raise ValueError(f"a panel of {n} adapters or more")
    known = panel.select(F.col(adapter_id).alias("adapter_id"), F.col(adapter).alias("_a")).where(F.length("_a") > 0)
    hits = reads.select(by, F.col(seq).alias("_s")).join(F.broadcast(known), F.contains("_s", F.col("_a")))
    starts = hits.groupBy(by, "adapter_id", F.instr("_s", F.col("_a")).alias("pos")).agg(F.count(F.lit(1)).alias("n_new"))
    upto = F.sum("n_new").over(Window.partitionBy(by, "adapter_id").orderBy("pos"))
    totals = counts(reads, by)
    return starts.withColumn("n_upto", upto).join(totals, by).select(by, "adapter_id", "pos", "n_new", "n_upto", (F.col("n_upto") / F.col("n_reads")).alias("share"))


def overrepresented(reads: DataFrame, seq: str, threshold: float = 0.001) -> DataFrame:
    """Hash, count and share of sequences over a share of all reads; sequences meet by hash, 16 bytes each, not by text."""
    total = reads.agg(F.count(F.lit(1)).alias("_total"))
    seen = reads.groupBy(F.md5(F.col(seq)).alias("seq_md5")).agg(F.count(F.lit(1)).alias("n_reads"), F.min(F.length(seq)).alias("length"))
    return seen.join(F.broadcast(total)).withColumn("share", F.col("n_reads") / F.col("_total")).where(F.col("share") > threshold).drop("_total")
