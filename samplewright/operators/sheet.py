"""Sample sheets: row rules, uniqueness, run numbers and nested read tuples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions import text as X


class SheetError(ValueError):
    """A sheet breaks a rule."""


@dataclass(frozen=True)
class Sheet:
    """The columns of a sheet, and what its files must end with.

    `line` orders the rows; rows of a DataFrame have no order of their own.
    """

    sample: str = "sample"
    first: str = "fastq_1"
    second: str = "fastq_2"
    single: str = "single_end"
    line: str = "line_no"
    suffixes: tuple[str, ...] = (".fq.gz", ".fastq.gz")


def missing_columns(df: DataFrame, required: tuple[str, ...] = ("sample", "fastq_1", "fastq_2")) -> list[str]:
    return [c for c in required if c not in df.columns]


def normalised(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """Null cells of the sheet's own columns as empty texts."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (sheet.sample, sheet.first, sheet.second)})


def rule_error(sheet: Sheet = Sheet()) -> Column:
    """The first rule that a row breaks, or null: sample, first file, second file, pair."""
    sample, first, second = F.col(sheet.sample), F.col(sheet.first), F.col(sheet.second)
    paired = (first != "") & (second != "")
    return (
        F.when(sample == "", "EMPTY_SAMPLE")
        .when(first == "", "EMPTY_FIRST")
        .when(~X.has_suffix(first, sheet.suffixes), "BAD_FIRST")
        .when((second != "") & ~X.has_suffix(second, sheet.suffixes), "BAD_SECOND")
        .when(paired & (X.last_suffixes(first) != X.last_suffixes(second)), "PAIR_MISMATCH")
    )


def error_message(code: Column, sheet: Sheet = Sheet()) -> Column:
    wanted = ", ".join(sheet.suffixes)
    bad = lambda c: F.concat(F.lit("The file has an unrecognized extension: "), F.col(c), F.lit(f"; it should be one of: {wanted}"))
    return (
        F.when(code == "EMPTY_SAMPLE", "A sample is required.")
        .when(code == "EMPTY_FIRST", "At least the first file is required.")
        .when(code == "BAD_FIRST", bad(sheet.first))
        .when(code == "BAD_SECOND", bad(sheet.second))
        .when(code == "PAIR_MISMATCH", "Files of a pair must have the same extensions.")
    )


def row_errors(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """line, code and message of each row that breaks a rule."""
    code = rule_error(sheet)
    return normalised(df, sheet).withColumn("code", code).where("code is not null").select(F.col(sheet.line), "code", error_message(F.col("code"), sheet).alias("message"))


def first_error(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """The error of the first line that has one; no row if none has."""
    errors = row_errors(df, sheet)
    return errors.agg(F.min_by(F.struct(*errors.columns), sheet.line).alias("e")).where("e is not null").select("e.*")


def single_end(sheet: Sheet = Sheet()) -> Column:
    return ~((F.col(sheet.first) != "") & (F.col(sheet.second) != ""))


def repeated_keys(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """Sample (with underscores) and first file of rows that share both, their number and first line."""
    keyed = normalised(df, sheet).withColumn(sheet.sample, X.underscored(F.col(sheet.sample)))
    return keyed.groupBy(sheet.sample, sheet.first).agg(F.count(F.lit(1)).alias("n_rows"), F.min(sheet.line).alias("first_line")).where("n_rows > 1")


def numbered_runs(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """run_idx: the row's number among those of its sample, in line order; the sample gets `_T<run_idx>`."""
    order = Window.partitionBy(sheet.sample).orderBy(sheet.line)
    return df.withColumn("run_idx", F.row_number().over(order)).withColumn(sheet.sample, F.concat(F.col(sheet.sample), F.lit("_T"), F.col("run_idx")))


def validated(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """The rows that break no rule, in the order of columns of the written sheet.

    sample (with underscores and run number), single_end, the files, other columns,
    line, run_idx. A column already named single_end is replaced.
    """
    own = (sheet.sample, sheet.single, sheet.first, sheet.second, sheet.line)
    extras = [c for c in df.columns if c not in own]
    good = normalised(df, sheet).where(rule_error(sheet).isNull())
    good = good.withColumn(sheet.sample, X.underscored(F.col(sheet.sample))).withColumn(sheet.single, single_end(sheet))
    return numbered_runs(good, sheet).select(sheet.sample, sheet.single, sheet.first, sheet.second, *extras, sheet.line, "run_idx")


def check(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """`validated`, or SheetError for missing columns, the first broken rule, or repeated keys."""
    if missing := missing_columns(df, (sheet.sample, sheet.first, sheet.second)):
        raise SheetError(f"The sheet must contain these columns: {', '.join(missing)}.")
    for e in first_error(df, sheet).collect():
        raise SheetError(f"{e['message']} On line {e[sheet.line]}.")
    if repeated := repeated_keys(df, sheet).orderBy("first_line").take(5):
        raise SheetError("Sample and first file must be unique: " + "; ".join(f"{r[0]}, {r[1]} (line {r['first_line']})" for r in repeated))
    return validated(df, sheet)


def read_tuples(df: DataFrame, sheet: Sheet = Sheet()) -> DataFrame:
    """meta {id, single_end} and reads, one or two files, of each validated row."""
    single = X.as_bool(F.col(sheet.single).cast("string"))
    reads = F.when(single, F.array(sheet.first)).otherwise(F.array(sheet.first, sheet.second))
    return df.select(F.struct(F.col(sheet.sample).alias("id"), single.alias("single_end")).alias("meta"), reads.alias("reads"))


def mate_keys(tuples: DataFrame) -> DataFrame:
    """One row for each file of a tuple: sample, mate (0 if single, else 1 and 2), name and path."""
    rows = tuples.select(F.col("meta.id").alias("sample"), F.col("meta.single_end").alias("single"), F.posexplode("reads").alias("at", "path"))
    mate = F.when(F.col("single"), 0).otherwise(F.col("at") + 1)
    return rows.select("sample", mate.alias("mate"), F.when(F.col("single"), F.col("sample")).otherwise(F.concat("sample", F.lit("_"), mate)).alias("name"), "path")
