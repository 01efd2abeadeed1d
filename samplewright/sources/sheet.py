"""Reading and writing sample sheets.

A sheet is a small text file whose row order matters, so the driver reads it through
Spark's file readers (any path that Spark can open) and numbers the rows itself.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.operators.sheet import Sheet, SheetError, check, missing_columns

#: A sheet larger than that is no sheet.
MOST_BYTES = 256 << 20


def whole_text(spark: SparkSession, path: str) -> str:
    """A small file's text, UTF-8; the size is checked before the content is read."""
    files = spark.read.format("binaryFile").load(path)
    sizes = files.select("path", "length").take(2)
    if len(sizes) != 1 or sizes[0]["length"] > MOST_BYTES:
        raise SheetError(f"{path} must be one file of at most {MOST_BYTES} bytes")
    return bytes(files.select("content").first()["content"]).decode("utf-8-sig")


def peek(text: str, lines: int = 10) -> str:
    return "".join(text.splitlines(keepends=True)[:lines])


def sniffed(text: str) -> tuple[str, bool]:
    """The delimiter, and whether the first line looks like a header; a comma where it can't be told."""
    sniffer, head = csv.Sniffer(), peek(text)
    try:
        delimiter = sniffer.sniff(head, delimiters=",\t;|").delimiter
    except csv.Error:
        delimiter = ","
    try:
        return delimiter, sniffer.has_header(head)
    except csv.Error:
        return delimiter, False


def read_sheet(spark: SparkSession, path: str, sheet: Sheet = Sheet()) -> DataFrame:
    """All columns as text with `line`: the row's place and 2, blank lines not counted.

    The header is right if it has the required columns, whatever the sniffer thinks.
    Short and long rows are an error that names the line.
    """
    text = whole_text(spark, path)
    rows = [r for r in csv.reader(io.StringIO(text), delimiter=sniffed(text)[0]) if r]
    if not rows:
        raise SheetError("The sheet is empty.")
    header = rows[0]
    schema = ", ".join(f"`{c}` string" for c in header) + f", `{sheet.line}` long"
    body = []
    for n, row in enumerate(rows[1:]):
        if len(row) != len(header):
            raise SheetError(f"The row has {len(row)} cells, not {len(header)}. On line {n + 2}.")
        body.append((*row, n + 2))
    out = spark.createDataFrame(body, schema)
    if missing := missing_columns(out, (sheet.sample, sheet.first, sheet.second)):
        raise SheetError(f"The sheet must contain these columns: {', '.join(missing)}.")
    return out


def write_sheet(rows: DataFrame, path: str, sheet: Sheet = Sheet()) -> None:
    """A validated sheet as one CSV file with header, in line order; booleans as True and False."""
    columns = [c for c in rows.columns if c not in (sheet.line, "run_idx")]
    flag = F.when(F.col(sheet.single), "True").otherwise("False").alias(sheet.single)
    ordered = rows.orderBy(sheet.line).select(*[flag if c == sheet.single else F.col(c) for c in columns])
    ordered.coalesce(1).write.option("header", True).option("emptyValue", "").csv(path)


def split_csv(spark: SparkSession, path: str) -> DataFrame:
    """A written sheet as rows of text; empty cells stay empty."""
    rows = spark.read.option("header", True).option("emptyValue", "").option("nullValue", "\x00").csv(path)
    return rows.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])


def check_sheet(spark: SparkSession, source: str, target: str, sheet: Sheet = Sheet()) -> DataFrame:
    """Read, check and write a sheet; the validated rows."""
    rows = check(read_sheet(spark, source, sheet), sheet)
    write_sheet(rows, target, sheet)
    return rows
