"""Sharding by jump consistent hashing: stable keys to shards without a ring table.

The jump hash of Lamping and Veach: a generator seeded by the key names, in rising
order, the shard counts at which the key would move; the last one below `n` is its
shard. So with one more shard, rows move into the new shard only, about 1 of `n + 1`.

Everything is a DataFrame expression. Spark's ANSI mode rejects 64-bit overflow, so the
generator's product modulo 2**64 is put together from 16- and 32-bit parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.llm.shared import written

# The multiplier of the published generator, in two halves.
LCG = 2862933555777941757
LCG_HIGH, LCG_LOW = LCG >> 32, LCG & 0xFFFFFFFF

M32 = 0xFFFFFFFF
M16 = 0xFFFF
#: Steps that are unrolled before the rare rest; the expected number is about ln(n).
COMMON_STEPS = 64


def key_hash(key: Column) -> Column:
    """60 bits of md5 of the key as text, as long; null hashes as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _low32(u: Column, v: int) -> Column:
    """u * v modulo 2**32, for u and v below 2**32."""
    high, low = F.shiftrightunsigned(u, 16), u.bitwiseAND(F.lit(M16))
    return (F.shiftleft((high * v).bitwiseAND(F.lit(M16)), 16) + (low * v).bitwiseAND(F.lit(M32))).bitwiseAND(F.lit(M32))


def _next(key: Column) -> Column:
    """key * LCG + 1 modulo 2**64, on the bits of a long."""
    high, low = F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(M32))
    upper, lower = F.shiftrightunsigned(low, 16) * LCG_LOW, low.bitwiseAND(F.lit(M16)) * LCG_LOW
    total = lower.bitwiseAND(F.lit(M32)) + F.shiftleft(upper, 16).bitwiseAND(F.lit(M32)) + 1
    carry = F.shiftrightunsigned(total, 32) + F.shiftrightunsigned(lower, 32) + F.shiftrightunsigned(upper, 16)
    top = (carry + _low32(high, LCG_LOW) + _low32(low, LCG_HIGH)).bitwiseAND(F.lit(M32))
    return F.shiftleft(top, 32).bitwiseOR(total.bitwiseAND(F.lit(M32)))


def jump_hash(key: Column, n: int) -> Column:
    """The shard, 0 to n - 1, of a long key that has been hashed already."""
    if n < 1:
        raise ValueError("a key needs one shard at least")

    def step(state: Column, _: Column) -> Column:
        # `key` is one product ahead; bits 33 to 63 of it are the draw
        draw = F.shiftrightunsigned(state["key"], 33) + 1
        follow = F.floor((state["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double"))).cast("long")
        return F.when(state["next"] < n, F.struct(_next(state["key"]).alias("key"), state["next"].alias("shard"), follow.alias("next"))).otherwise(state)

    zero = F.lit(0).cast("long")
    start = F.struct(_next(key).alias("key"), F.lit(-1).cast("long").alias("shard"), zero.alias("next"))
    few = F.reduce(F.sequence(F.lit(1), F.lit(min(n, COMMON_STEPS))), start, step)
    if n <= COMMON_STEPS:
        return few["shard"].cast("int")
    rest = F.reduce(F.sequence(F.lit(1), F.lit(n)), few, step)
    return F.when(few["next"] >= n, few["shard"]).otherwise(rest["shard"]).cast("int")


def assign_shards(df: DataFrame, n: int, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """`df` with the column `shard`; a narrow operation, without a shuffle.

    Null keys hash as the empty text and so share one shard; repeated keys share theirs;
    a column already named `shard` is replaced. An empty table stays empty.
    """
    return df.withColumn(shard, jump_hash(key_hash(F.col(key)), n))


def number_slots(df: DataFrame, shard: str, by: list[str], order: str, buckets: int = 4096) -> DataFrame:
    """`df` (slim rows) with `slot`: 0, 1, 2, ... in each shard, in the order of (`order`, *by).

    `order` is a hash below 2**60. A shard's rows are cut into `buckets` ranges of that
    hash; each is numbered by itself and moved on by the rows in the ranges before it,
    so no task sees a whole shard. Equal rows are counted where they are read, so that a
    repeated row is one row for each input partition, whatever its number.
    """
    range_of = F.floor(F.col(order) / F.lit((1 << 60) // buckets)).cast("int")
    counted = df.withColumn("_part", F.spark_partition_id()).groupBy(*df.columns, "_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_range", range_of)
    counted = written(counted, "shard-rows")
    # at most shards x buckets rows
    before = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy(shard, "_range").agg(F.sum("_n").alias("_rows")).withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    inside = Window.partitionBy(shard, "_range").orderBy(order, *by, "_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_start", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(offsets, [shard, "_range"])
    # a row stands for at most the rows of one input partition
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_copy")
    return placed.select(*df.columns, "_offset", "_start", copies).withColumn("slot", F.col("_offset") + F.col("_start") + F.col("_copy")).drop("_offset", "_start", "_copy")


def shard_table(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One slim row for each document: key, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text and 1 (null and empty texts: 1); text_crc32: unsigned
    CRC of these bytes (null: 0, as of none). grown_shard: the shard among `n + 1`.
    Repeated rows each get a slot; null keys are one key. Texts are measured whole, whatever
    their length; columns other than key and text aren't read. An empty table gives none.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = key_hash(F.col(key))
    slim = docs.select(F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), jump_hash(hashed, n).alias("shard"), jump_hash(hashed, n + 1).alias("grown_shard"), hashed.alias("_hash"))
    return number_slots(slim, "shard", [key, "size", "text_crc32", "grown_shard"], "_hash").drop("_hash").withColumn("law", F.lit("key"))


def write_shards(docs: DataFrame, path: str, n: int, key: str = "doc_id", shard: str = "shard") -> None:
    """Whole documents as Parquet, one folder for each shard; each task writes its own files."""
    assign_shards(docs, n, key, shard).write.partitionBy(shard).parquet(path)
