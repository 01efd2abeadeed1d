"""Tables in the folder that the driver and all executors share, and joins of hot keys.

A lineage is cut by writing Parquet under ``spark.checkpoint.dir`` and reading it
again: such files outlive any executor. The setting is read from the session; a
local folder is taken only where it is unset and the master is local, as in tests.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI, without a slash at its end."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        place = known.get() if known.isDefined() else None
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="samplewright-")
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


def _nullable(kind):
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    return kind


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder, read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = _nullable(df.schema)
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(schema).parquet(path)


def staged(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `make` returns as a table in the shared folder; the tables that it wrote on the way are deleted."""
    since = len(_WRITTEN)
    df = written(make(), name)
    last = _WRITTEN.pop()
    drop_written(since)
    _WRITTEN.append(last)
    return df


def drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def drop_written(since: int = 0) -> None:
    """Delete what `written` has made, all or from its so-manieth table on; results that still read it can't be used afterwards."""
    while len(_WRITTEN) > since:
        spark, path = _WRITTEN.pop()
        if spark.sparkContext._jsc is not None:
            try:
                drop(spark, path)
            except Exception:  # the JVM may have gone first
                return


#: Keys that hold over a so-manieth of all rows are hot: there can't be more of them than that.
HOT_KEYS = 10_000


def join_hot(rows: DataFrame, per_key: DataFrame, on: list[str], count: str) -> DataFrame:
    """`rows` inner-joined with one row for each key, which says in `count` how many rows have the key.

    Hot keys, HOT_KEYS at most, are broadcast, so that none is a single task's; the rest
    meets by shuffle. Both tables are read twice and should be written ones; `count` is
    dropped.
    """
    total = rows.count()
    is_hot = F.col(count) * HOT_KEYS > total
    hot, cold = per_key.where(is_hot).drop(count), per_key.where(~is_hot).drop(count)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))
