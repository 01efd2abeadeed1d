"""Software versions of processes: collation, consistency, tables.

Long form: process, tool, version. A module is the last `:` part of a process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions import text as X


class VersionConflict(ValueError):
    """Two processes of one module report different versions."""


def by_process(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """process, module and `versions` ("tool=version" sorted by tool); of repeated (process, tool) the last by `order`."""
    last = rows.groupBy("process", "tool").agg(F.max_by("version", order).alias("version"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("tool", "version"))), lambda r: F.concat(r["tool"], F.lit("="), r["version"]))
    return last.groupBy("process").agg(F.array_join(listed, ";").alias("versions")).select("process", X.last_part(F.col("process"), ":").alias("module"), "versions")


def conflicts(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """module and n_versions of modules whose processes disagree."""
    return by_process(rows, order).groupBy("module").agg(F.count_distinct("versions").alias("n_versions")).where("n_versions > 1")


def by_module(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """module, tool, version, once each, of modules whose processes agree."""
    last = rows.groupBy("process", "tool").agg(F.max_by("version", order).alias("version"))
    bad = conflicts(rows, order).select(F.col("module").alias("_bad"))
    flat = last.select(X.last_part(F.col("process"), ":").alias("module"), "tool", "version").distinct()
    return flat.join(bad, F.col("module") == F.col("_bad"), "left_anti")


def check(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    if bad := [r["module"] for r in conflicts(rows, order).orderBy("module").limit(5).collect()]:
        raise VersionConflict(f"Versions differ between processes of {', '.join(bad)}")
    return by_module(rows, order)


def first_row_labels(rows: DataFrame, group: str, item: str) -> DataFrame:
    """`rows` with `label`: the group on its first row by item, else empty; and `row`, the row's number in it."""
    order = Window.partitionBy(group).orderBy(item)
    return rows.withColumn("row", F.row_number().over(order)).withColumn("label", F.when(F.col("row") == 1, F.col(group)).otherwise(""))


def table_rows(rows: DataFrame, group: str, item: str, value: str) -> DataFrame:
    """group, row and the HTML table row of each, escaped."""
    cells = [X.escaped(F.col(c).cast("string")) for c in ("label", item, value)]
    html = F.concat(F.lit("<tr><td><samp>"), cells[0], F.lit("</samp></td><td><samp>"), cells[1], F.lit("</samp></td><td><samp>"), cells[2], F.lit("</samp></td></tr>"))
    return first_row_labels(rows, group, item).select(group, "row", html.alias("html"))


def order_breaks(rows: DataFrame, position: str, required: list[str], name: str) -> DataFrame:
    """Neighbours in the required order that aren't present in that order; a missing one counts as place -1.

    A missing successor stands before everything and a missing predecessor before what is there.
    """
    spark = rows.sparkSession
    wanted = spark.createDataFrame(list(enumerate(required)), "rank int, _name string")
    have = rows.groupBy(name).agg(F.min(position).alias("_at"))
    placed = wanted.join(have, F.col("_name") == F.col(name), "left").select("rank", F.col("_name").alias("name"), F.coalesce("_at", F.lit(-1)).cast("long").alias("place"))
    after = Window.orderBy("rank")  # the required names, a handful
    pairs = placed.select("name", "place", F.lead("name").over(after).alias("next_name"), F.lead("place").over(after).alias("next_place"))
    return pairs.where("next_name is not null and not (place < next_place)")
