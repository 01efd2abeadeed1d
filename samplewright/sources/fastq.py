"""FASTQ files as rows, one for each read; `file` is the whole path.

Four lines are a record: a quality line may begin with `@`, so records can't be found
from the middle of a file, and gz can't be split. One partition reads one file, as a
stream; use `repartition` behind the scan where files are few and large.

* `scan_lines` takes any path that Hadoop knows, object stores too, and streams gz of any size.
* `spark.read.format("fastq").load(path)`, after `register`, streams files of a folder that
  each machine has mounted.
* `scan_table` parses contents that Spark has read whole (`binaryFile`, 2 GB at most).
"""

from __future__ import annotations

import glob
import gzip
import io
import os
from collections.abc import Iterator
from itertools import batched, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from samplewright.sources.config import whole_path

SCHEMA = "file string, read_idx long, read_id string, seq string, qual string"
_ARROW = pa.schema([("file", pa.string()), ("read_idx", pa.int64()), ("read_id", pa.string()), ("seq", pa.string()), ("qual", pa.string())])
#: Records of an Arrow batch.
TOGETHER = 4096


class FastqError(ValueError):
    """A file breaks the format."""


def records(lines: Iterator[str], name: str) -> Iterator[tuple[str, int, str, str, str]]:
    """(name, number from 0, id without @, sequence, qualities) of each four lines."""
    n = 0
    for head in lines:
        head = head.rstrip("\r\n")
        if not head:
            continue
        seq, plus, qual = ((next(lines, None) or "").rstrip("\r\n") for _ in range(3))
        if not head.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
            raise FastqError(f"{name}: record {n} is no FASTQ record")
        yield name, n, head[1:], seq, qual
        n += 1


def in_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    for some in batched(rows, TOGETHER):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), _ARROW, strict=True)], schema=_ARROW)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        found = [self.path]
        if os.path.isdir(self.path):
            found = [p for end in ("*.fq.gz", "*.fastq.gz", "*.fq", "*.fastq") for p in glob.glob(os.path.join(self.path, end))]
        elif any(c in self.path for c in "*?["):
            found = glob.glob(self.path)
        return [_File(p) for p in sorted(found)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        opened = gzip.open if partition.path.endswith(".gz") else open
        with opened(partition.path, "rt", encoding="ascii", errors="replace") as lines:
            yield from in_batches(records(iter(lines), os.path.abspath(partition.path)))


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """The reads of the files at a path, folder or pattern, streamed by Spark's text reader.

    A file that isn't compressed and is larger than `spark.sql.files.maxPartitionBytes`
    would be read in pieces: that is a FastqError.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True))

        def rows() -> Iterator[tuple]:
            for (name, start), own in groupby(lines, key=lambda row: row[:2]):
                if start:
                    raise FastqError(f"{name} is read in pieces; compress it or raise spark.sql.files.maxPartitionBytes")
                yield from records((line for _, _, line in own), name)

        yield from in_batches(rows())

    lines = spark.read.text(path).select(whole_path("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    return lines.mapInArrow(parsed, SCHEMA)


def scan_table(files: DataFrame) -> DataFrame:
    """The reads of files that Spark has read itself (`binaryFile`: path, content), unpacked as a stream."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                body = io.BytesIO(content)
                packed = gzip.open(body) if path.endswith(".gz") else body
                lines = io.TextIOWrapper(packed, "ascii", "replace")
                yield from in_batches(records(iter(lines), path))

    return files.select(whole_path("path").alias("path"), "content").mapInArrow(parsed, SCHEMA)


def with_mates(tuples: DataFrame, reads: DataFrame, folder: str = "") -> DataFrame:
    """Reads with the sample and mate of their file, from `mate_keys` rows (sample, mate, name, path), by whole path.

    Relative paths of the tuples are below `folder`.
    """
    keys = tuples.select("sample", "mate", whole_path("path", folder).alias("_file"))
    return reads.join(keys, whole_path("file") == F.col("_file")).drop("_file")
