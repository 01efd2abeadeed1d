"""Sheet rules over the event log: each event is a row of an ordered sheet.

user -> sample (with a space to replace), event type -> what kind of files it names.
Clicks have a pair, views a single file, the others break one rule each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.functions import text as X
from samplewright.operators import sheet as S
from samplewright.plans.base import query, table

_FIRST = "CASE pmod(event_id, 50) WHEN 7 THEN '' WHEN 8 THEN concat('run ', event_id, '.bam') ELSE concat('run ', event_id, '_1.', CASE pmod(event_id, 3) WHEN 0 THEN 'fq.gz' ELSE 'fastq.gz' END) END"
_SECOND = "CASE WHEN pmod(event_id, 50) = 9 THEN 'mate.txt' WHEN pmod(event_id, 50) = 10 THEN concat('run ', event_id, '_2.', CASE pmod(event_id, 3) WHEN 0 THEN 'fastq.gz' ELSE 'fq.gz' END) WHEN pmod(event_id, 2) = 0 THEN concat('run ', event_id, '_2.', CASE pmod(event_id, 3) WHEN 0 THEN 'fq.gz' ELSE 'fastq.gz' END) ELSE '' END"
_SAMPLE = "CASE WHEN pmod(event_id, 50) = 6 THEN '' ELSE concat('user ', user_id) END"

_EVENT_SHEET = f"""sheet AS (
  SELECT {_SAMPLE} AS sample, {_FIRST} AS fastq_1, {_SECOND} AS fastq_2, event_type, event_id + 2 AS line_no FROM events
)""".replace("pmod(event_id, 50)", "(event_id % 50)").replace("pmod(event_id, 3)", "(event_id % 3)").replace("pmod(event_id, 2)", "(event_id % 2)")

_CODE = """CASE WHEN sample = '' THEN 'EMPTY_SAMPLE' WHEN fastq_1 = '' THEN 'EMPTY_FIRST'
    WHEN NOT (suffix(fastq_1, '.fq.gz') OR suffix(fastq_1, '.fastq.gz')) THEN 'BAD_FIRST'
    WHEN fastq_2 <> '' AND NOT (suffix(fastq_2, '.fq.gz') OR suffix(fastq_2, '.fastq.gz')) THEN 'BAD_SECOND'
    WHEN fastq_2 <> '' AND regexp_extract(fastq_1, '(\\.[^.]+\\.[^.]+)$', 1) <> regexp_extract(fastq_2, '(\\.[^.]+\\.[^.]+)$', 1) THEN 'PAIR_MISMATCH' END"""
_MESSAGE = """CASE code WHEN 'EMPTY_SAMPLE' THEN 'A sample is required.' WHEN 'EMPTY_FIRST' THEN 'At least the first file is required.'
    WHEN 'BAD_FIRST' THEN 'The file has an unrecognized extension: ' || fastq_1 || '; it should be one of: .fq.gz, .fastq.gz'
    WHEN 'BAD_SECOND' THEN 'The file has an unrecognized extension: ' || fastq_2 || '; it should be one of: .fq.gz, .fastq.gz'
    WHEN 'PAIR_MISMATCH' THEN 'Files of a pair must have the same extensions.' END"""


def event_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.expr(_SAMPLE).alias("sample"), F.expr(_FIRST).alias("fastq_1"), F.expr(_SECOND).alias("fastq_2"), "event_type", (F.col("event_id") + 2).alias("line_no"))


@query(f"""WITH {_EVENT_SHEET}, good AS (
  SELECT replace(sample, ' ', '_') AS sample, fastq_1, fastq_2, event_type, line_no, {_CODE} AS code FROM sheet
), numbered AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY line_no) AS run_idx FROM good WHERE code IS NULL)
SELECT sample || '_T' || run_idx AS sample, NOT (fastq_1 <> '' AND fastq_2 <> '') AS single_end, fastq_1, fastq_2, event_type, line_no, run_idx::INTEGER AS run_idx FROM numbered""")
def sheet_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.validated(event_sheet(spark, sf_dir))


@query(f"WITH {_EVENT_SHEET}, coded AS (SELECT *, {_CODE} AS code FROM sheet) SELECT line_no, code, {_MESSAGE} AS message FROM coded WHERE code IS NOT NULL")
def row_rule_first_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.row_errors(event_sheet(spark, sf_dir))


@query(f"WITH {_EVENT_SHEET}, coded AS (SELECT *, {_CODE} AS code FROM sheet) SELECT line_no, code, {_MESSAGE} AS message FROM coded WHERE code IS NOT NULL ORDER BY line_no LIMIT 1")
def first_error_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_error(event_sheet(spark, sf_dir))


@query(f"WITH {_EVENT_SHEET} SELECT replace(sample, ' ', '_') AS sample, count(*) AS n FROM sheet GROUP BY ALL")
def sanitize_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_sheet(spark, sf_dir).groupBy(X.underscored(F.col("sample")).alias("sample")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_EVENT_SHEET} SELECT line_no, NOT (fastq_1 <> '' AND fastq_2 <> '') AS single_end FROM sheet")
def derive_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_sheet(spark, sf_dir).select("line_no", S.single_end().alias("single_end"))


@query("SELECT page_id, url, suffix(url, '.html') OR suffix(url, '/') AS fits FROM pages")
def suffix_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", X.has_suffix(F.col("url"), (".html", "/")).alias("fits"))


def _suffixes_sql(path: str) -> str:
    name = f"regexp_replace(rtrim({path}, '/'), '^.*/', '')"
    parts = f"string_split(ltrim({name}, '.'), '.')"
    return f"CASE WHEN suffix({name}, '.') THEN '' ELSE coalesce('.' || nullif(array_to_string({parts}[greatest(2, len({parts}) - 1):], '.'), ''), '') END"


@query(f"""WITH {_EVENT_SHEET} SELECT line_no, {_suffixes_sql("fastq_1")} AS suffix_1, {_suffixes_sql("fastq_2")} AS suffix_2 FROM sheet""")
def pair_suffix_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_sheet(spark, sf_dir).select("line_no", X.last_suffixes(F.col("fastq_1")).alias("suffix_1"), X.last_suffixes(F.col("fastq_2")).alias("suffix_2"))


@query("SELECT name, false AS present FROM (VALUES ('sample'), ('fastq_1'), ('fastq_2')) t(name) UNION ALL SELECT 'event_id', true")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = S.missing_columns(table(spark, sf_dir, "events"), ("sample", "fastq_1", "fastq_2", "event_id"))
    return spark.createDataFrame([(c, c not in missing) for c in ("sample", "fastq_1", "fastq_2", "event_id")], "name string, present boolean")


@query("SELECT event_id, user_id || '_T' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS sample, (row_number() OVER (PARTITION BY user_id ORDER BY event_id))::INTEGER AS run_idx FROM events")
def occurrence_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sample"), F.col("event_id").alias("line_no"))
    return S.numbered_runs(rows).select(F.col("line_no").alias("event_id"), "sample", "run_idx")


@query("SELECT l_orderkey::VARCHAR AS sample, l_linenumber::VARCHAR AS fastq_1, count(*) AS n_rows, min(l_partkey) AS first_line FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_key_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("fastq_1"), F.lit("").alias("fastq_2"), F.col("l_partkey").alias("line_no"))
    return S.repeated_keys(rows)


_TUPLES = f"""WITH {_EVENT_SHEET}, good AS (SELECT *, {_CODE} AS code, NOT (fastq_1 <> '' AND fastq_2 <> '') AS single FROM sheet)"""


@query(_TUPLES + " SELECT replace(sample, ' ', '_') AS id, single AS single_end, CASE WHEN single THEN [fastq_1] ELSE [fastq_1, fastq_2] END AS reads FROM good WHERE code IS NULL")
def tuple_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_tuples(spark, sf_dir).select("meta.id", "meta.single_end", "reads")


def event_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = event_sheet(spark, sf_dir).where(S.rule_error().isNull()).withColumn("sample", X.underscored(F.col("sample")))
    return S.read_tuples(good.withColumn("single_end", F.when(S.single_end(), "True").otherwise("False")))


@query(_TUPLES + """ SELECT replace(sample, ' ', '_') AS sample, (CASE WHEN single THEN 0 ELSE n END)::INTEGER AS mate,
  replace(sample, ' ', '_') || CASE WHEN single THEN '' ELSE '_' || n END AS name, CASE n WHEN 1 THEN fastq_1 ELSE fastq_2 END AS path
  FROM good, (VALUES (1), (2)) t(n) WHERE code IS NULL AND (n = 1 OR NOT single)""")
def mate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mate_keys(event_tuples(spark, sf_dir))


@query("SELECT event_type, event_type IN ('click', 'view', 'purchase') AS fits, count(*) AS n FROM events GROUP BY ALL")
def enum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = F.array(*[F.lit(x) for x in ("click", "view", "purchase")])
    return table(spark, sf_dir, "events").groupBy("event_type", F.array_contains(allowed, F.col("event_type")).alias("fits")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, regexp_full_match(url, 'https?://[a-z0-9.-]+/[a-z]{2}/[0-9]+(\\.html)?') AS fits FROM pages")
def required_pattern_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.rlike("url", F.lit(r"^https?://[a-z0-9.-]+/[a-z]{2}/[0-9]+(\.html)?$")).alias("fits"))


@query("SELECT doc_id, quality, toxic, (quality IN (0, 1)) AND (toxic IN (0, 1)) AS all_of, regexp_matches(doc_id::VARCHAR, '^[0-9]+5$') OR length(doc_id::VARCHAR) <= 2 AS any_of FROM labels")
def all_of_any_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", (F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1)).alias("all_of"), (F.rlike(text, F.lit("^[0-9]+5$")) | (F.length(text) <= 2)).alias("any_of"))
