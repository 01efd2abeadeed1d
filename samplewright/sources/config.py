"""Configuration and version documents, and whether files exist."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.operators import params
from samplewright.sources.sheet import whole_text


def read_schema(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-Schema file as schema rows; one that can't be parsed gives none."""
    try:
        document = json.loads(whole_text(spark, path))
    except ValueError:
        document = {}
    return params.from_schema_json(spark, document)


def parse_versions(text: str) -> list[tuple[str, str, str]]:
    """(process, tool, version) of a two-level YAML mapping; every scalar is text.

    Versions files hold nothing but quoted or plain keys and scalars on two levels, so
    that much of YAML is read here; anything else is an error.
    """
    rows, process = [], None
    for n, line in enumerate(text.splitlines(), 1):
        if not line.strip() or line.lstrip().startswith("#") or line.strip() == "---":
            continue
        key, colon, value = line.strip().partition(": ") if ": " in line else (line.strip().rstrip(":"), line.rstrip()[-1:], "")
        if colon.strip() != ":":
            raise ValueError(f"line {n} is no mapping entry: {line!r}")
        key, value = (x.strip().strip("\"'") for x in (key, value))
        if not line[0].isspace():
            process = key
        elif process is None:
            raise ValueError(f"line {n} belongs to no process")
        else:
            rows.append((process, key, value))
    return rows


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions files below a path, parsed on the executors: process, tool, version, ordinal.

    Files of the same text count once; ordinal orders files by name, then lines.
    """
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    once = files.groupBy("value").agg(F.min("file").alias("file"))

    def parsed(batches: Iterable):
        import pandas as pd

        for batch in batches:
            rows = [(file, n, *r) for file, text in zip(batch["file"], batch["value"], strict=True) for n, r in enumerate(parse_versions(text))]
            yield pd.DataFrame(rows, columns=["file", "n", "process", "tool", "version"])

    rows = once.mapInPandas(parsed, "file string, n long, process string, tool string, version string")
    return rows.select("process", "tool", "version", F.struct("file", "n").alias("ordinal"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Hadoop's file systems know the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def require(spark: SparkSession, *paths: str | None) -> None:
    """FileNotFoundError for the first given path that doesn't exist."""
    for path in paths:
        if path and not exists(spark, path):
            raise FileNotFoundError(path)


def whole_path(path: Column | str, folder: str = "") -> Column:
    """A path as the listings give it, but without its scheme and repeated slashes; a relative one is below `folder`."""
    path = F.col(path) if isinstance(path, str) else path
    absolute = F.regexp_like(path, F.lit(r"^([A-Za-z][A-Za-z0-9+.-]*:/|/)"))
    placed = F.when(absolute, path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path)) if folder else path
    plain = F.regexp_replace(placed, r"^[A-Za-z][A-Za-z0-9+.-]*:(?=/)", "")
    return F.regexp_replace(F.regexp_replace(plain, r"/(\./)+", "/"), r"/{2,}", "/")


def missing_files(rows: DataFrame, column: str, folder: str) -> DataFrame:
    """Rows whose file isn't in the folder or below it, by whole path; relative paths are below the folder.

    The listing is Spark's and reads no contents. Null paths count as missing.
    """
    listed = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return rows.join(listed.select(whole_path(F.col("path")).alias("_there")), whole_path(F.col(column), folder) == F.col("_there"), "left_anti")
