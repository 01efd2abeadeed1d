"""Keyed lookups: catalogues, overlays, existence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def attribute(df: DataFrame, key: str, catalogue: DataFrame, name: str, attr: str) -> DataFrame:
    """`df` with the catalogue's attribute for its key, exact in case; null for an unknown key.

    `catalogue`: (key, attr, value). Spark broadcasts it while it is small.
    """
    wanted = catalogue.where(F.col("attr") == attr).select(F.col("key").alias("_key"), F.col("value").alias(name))
    return df.join(wanted, F.col(key) == F.col("_key"), "left").drop("_key")


def unknown_keys(df: DataFrame, key: str, catalogue: DataFrame) -> DataFrame:
    """Keys that the catalogue lacks, once each, with the keys that it has, sorted and joined."""
    known = catalogue.select(F.col("key").alias("_key")).distinct()
    missing = df.where(F.col(key).isNotNull()).select(key).distinct().join(known, F.col(key) == F.col("_key"), "left_anti")
    choices = known.agg(F.array_join(F.sort_array(F.collect_list("_key")), ", ").alias("available"))
    return missing.join(F.broadcast(choices))


def present(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    return df.join(other.select(F.col(other_key).alias("_there")).distinct(), F.col(key) == F.col("_there"), "left_semi")


def absent(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    return df.join(other.select(F.col(other_key).alias("_there")).distinct(), F.col(key) == F.col("_there"), "left_anti")


def overlay(*layers: DataFrame) -> DataFrame:
    """(name, value) of all layers; a later layer's value wins. One aggregation over the union."""
    ranked = None
    for n, layer in enumerate(layers):
        rows = layer.select("name", "value").withColumn("_layer", F.lit(n))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    return ranked.groupBy("name").agg(F.max_by("value", "_layer").alias("value"))


def leaves(errors: Column, kind: T.ArrayType) -> Column:
    """The leaf messages of nested errors, in order, at any depth that the column's type has.

    kind: the type of `errors`, an array of struct<message, causes: the same again>. An
    error with no or null causes is a leaf itself; null errors give null.
    """
    inner = next((f.dataType for f in kind.elementType.fields if f.name == "causes"), None)
    if inner is None:
        return F.transform(errors, lambda e: e["message"])
    return F.flatten(F.transform(errors, lambda e: F.when(F.coalesce(F.size(e["causes"]), F.lit(0)) > 0, leaves(e["causes"], inner)).otherwise(F.array(e["message"]))))
