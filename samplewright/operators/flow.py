"""Dataflow combinators over bounded tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def value(spark: SparkSession, name: str, x: object) -> DataFrame:
    """One row of one value."""
    return spark.range(1).select(F.lit(x).alias(name))


def optional(df: DataFrame | None, spark: SparkSession, schema: str) -> DataFrame:
    """`df`, or an empty table where there is none."""
    return empty(spark, schema) if df is None else df


def mix(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, by column names."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def unique(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Of rows equal in `by` the first by `order`; one aggregation, combined before the shuffle."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*by, "_r.*")


def first(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def collected(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """`items`: the group's values, sorted; for groups that fit a row."""
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(column)).alias("items"))


def listed(df: DataFrame, column: str) -> DataFrame:
    """One row with all values, sorted; an empty list if there are none. For report inputs, which are few: they must fit a row."""
    return df.agg(F.sort_array(F.collect_list(column)).alias("items"))


def if_empty(df: DataFrame, default: DataFrame) -> DataFrame:
    """`df`, or `default` if `df` has no rows; decided in one plan."""
    none = df.limit(1).agg((F.count(F.lit(1)) == 0).alias("_none"))
    return df.unionByName(default.join(F.broadcast(none), F.col("_none")).drop("_none"))


def collected_text(df: DataFrame, column: str, order: list[str], by: list[str], sep: str = "\n") -> DataFrame:
    """`body`: the group's texts in order, joined; the content of a collected file.

    For groups that fit a row, 2 GB at most; `render.write_collected` writes ordered files of any size.
    """
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(column).alias("_text"))))
    return df.groupBy(*by).agg(rows.alias("_rows")).select(*by, F.array_join(F.transform("_rows", lambda r: r["_text"]), sep).alias("body"))


def guarded(df: DataFrame, when: Column) -> DataFrame:
    """Rows whose guard is unset or true."""
    return df.where(when.isNull() | when)


def stub(df: DataFrame) -> DataFrame:
    """The same columns without rows, for a dry run."""
    return df.limit(0)


def project(df: DataFrame, element: str) -> DataFrame:
    """One element of a tuple table, the others dropped."""
    return df.select(element)
