"""Parameter rules: events give runs of one parameter each; their properties are the values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.functions import text as X
from samplewright.operators import params as P
from samplewright.plans.base import query, table

# A parameter set that breaks most rules, in order.
RUN = [
    ("input", "samples.tsv"), ("outdir", ""), ("email", "nobody"), ("genome", "GRCh37"), ("fasta", "genome.fasta.gz"), ("max_cpus", "many"),
    ("max_memory", "64.GB"), ("max_time", "2 weeks"), ("publish_dir_mode", "teleport"), ("plaintext_email", "perhaps"), ("validate_params", "true"),
    ("tracedir", "out/pipeline_info"), ("custom_config_version", "master"), ("resume", "true"), ("max-cpus", "3"), ("Extra-Param", "1"), ("extraparam", "2"),
    ("genomes", "x"), ("help", "false"), ("hook_url", "0"),
]


def run_params(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, v, k) for k, (n, v) in enumerate(RUN)], "name string, value string, ordinal int")


def _quoted(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, list):
        return "[" + ", ".join(map(_quoted, x)) + "]"
    return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(_quoted, r)) + ")" for r in rows) + ")"


class _Rows:
    """Catches the rows of `standard_schema` for the SQL."""

    def createDataFrame(self, rows: list[tuple], _: str) -> list[tuple]:  # noqa: N802
        return rows


_SCHEMA_ROWS = P.standard_schema(_Rows())
_WITH = "WITH " + _values("params", "name, value, ordinal", [(n, v, k) for k, (n, v) in enumerate(RUN)]) + ", " + _values("rules", "grp, name, type, pattern, choices, default_value, hidden, required, ordinal, description", _SCHEMA_ROWS)
_GIVEN = ", given AS (SELECT * FROM params WHERE value IS NOT NULL AND value NOT IN ('', 'false', '0'))"


@query(_WITH + " SELECT p.name, p.value, r.grp, r.type FROM params p JOIN rules r ON p.name = r.name")
def params_schema_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_params(spark).select("name", "value").join(P.standard_schema(spark).select("name", "grp", "type"), "name")


@query(_WITH + " SELECT name FROM params WHERE name IN (" + ", ".join(f"'{x}'" for x in P.RESERVED) + ")")
def reserved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.reserved(run_params(spark))


@query(_WITH + """, unknown AS (SELECT p.*, lower(replace(p.name, '-', '')) AS k FROM params p WHERE p.name NOT IN (SELECT name FROM rules) AND p.name NOT IN ('genomes', 'schema_ignore_params'))
SELECT name, value, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ordinal) AS n FROM unknown WHERE NOT (contains(name, '-') AND k IN (SELECT lower(replace(name, '-', '')) FROM rules))) WHERE n = 1""")
def unexpected_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.unexpected(run_params(spark), P.standard_schema(spark), "genomes")


@query("SELECT k, name, ordinal FROM (SELECT lower(replace(name, '-', '')) AS k, name, ordinal, row_number() OVER (PARTITION BY lower(replace(name, '-', '')) ORDER BY ordinal) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE left(event_type, 2) || '-' || substr(event_type, 3) END AS name, event_id AS ordinal FROM events)) WHERE n = 1")
def casefold_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.concat(F.substring("event_type", 1, 2), F.lit("-"), F.substring("event_type", 3, 99)))
    rows = table(spark, sf_dir, "events").select(name.alias("name"), F.col("event_id").alias("ordinal"))
    return rows.groupBy(P.folded(F.col("name")).alias("k")).agg(F.min_by("name", "ordinal").alias("name"), F.min("ordinal").alias("ordinal"))


@query(_WITH + _GIVEN + " SELECT name FROM given")
def falsy_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.given(run_params(spark)).select("name")


@query(_WITH + _GIVEN + " SELECT name FROM rules WHERE required AND name NOT IN (SELECT name FROM given)")
def required_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.missing(run_params(spark), P.standard_schema(spark))


@query(_WITH + _GIVEN + """, checked AS (SELECT g.name, g.value, r.type, r.pattern, r.choices FROM given g JOIN rules r ON g.name = r.name)
SELECT name, 'required' AS rule, '* Missing required parameter: --' || name AS message FROM rules WHERE required AND name NOT IN (SELECT name FROM given)
UNION ALL SELECT name, 'type', '* --' || name || ': expected type: ' || type || ' (' || value || ')' FROM checked
  WHERE (type = 'boolean' AND lower(value) NOT IN ('true', 'false')) OR (type = 'integer' AND NOT regexp_matches(value, '^-?[0-9]+$'))
UNION ALL SELECT name, 'pattern', '* --' || name || ': does not match pattern (' || value || ')' FROM checked WHERE pattern IS NOT NULL AND NOT regexp_matches(value, pattern)
UNION ALL SELECT name, 'enum', '* --' || name || ': ''' || value || ''' is not a valid choice (Available choices (5 of ' || len(choices) || '): ' || array_to_string(choices[1:5], ', ') || ', ... )'
  FROM checked WHERE choices IS NOT NULL AND NOT list_contains(choices, value)""")
def parameter_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.errors(run_params(spark), P.standard_schema(spark))


@query(_WITH + " SELECT name FROM rules WHERE name NOT IN ('outdir', 'fasta')")
def ignored_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.without_ignored(P.standard_schema(spark), "outdir,fasta").select("name")


@query(_WITH + """ SELECT r.grp, p.name, p.value, r.ordinal FROM params p JOIN rules r ON p.name = r.name
WHERE CASE WHEN r.default_value IS NOT NULL THEN p.value <> replace(r.default_value, '${params.outdir}', 'out') ELSE p.value NOT IN ('', 'false') END""")
def default_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.changed(run_params(spark), P.standard_schema(spark), "out")


@query(_WITH + " SELECT grp, count(*) AS n_params, count(*) FILTER (WHERE hidden) AS n_hidden, count(*) FILTER (WHERE NOT hidden) AS n_shown FROM rules GROUP BY grp HAVING count(*) FILTER (WHERE NOT hidden) > 0")
def hidden_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.group_counts(P.standard_schema(spark))


@query(_WITH + """ SELECT ordinal, grp, '  --' || rpad(name, (SELECT max(length(name)) + 1 FROM rules)::INTEGER, ' ') || rpad('[' || type || ']', greatest(10, length(type) + 2)::INTEGER, ' ')
  || coalesce(description, '') || CASE WHEN default_value IS NULL THEN '' ELSE ' [default: ' || default_value || ']' END AS line FROM rules WHERE NOT hidden""")
def help_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.help_lines(P.standard_schema(spark))


@query("SELECT p_partkey, p_size || CASE p_partkey % 4 WHEN 0 THEN '.GB' WHEN 1 THEN ' MB' WHEN 2 THEN 'KB' ELSE ' parsecs' END AS quantity, CASE p_partkey % 4 WHEN 0 THEN p_size::BIGINT * 1073741824 WHEN 1 THEN p_size::BIGINT * 1048576 WHEN 2 THEN p_size::BIGINT * 1024 END AS bytes FROM part")
def memory_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("quantity", F.concat("p_size", F.expr("CASE p_partkey % 4 WHEN 0 THEN '.GB' WHEN 1 THEN ' MB' WHEN 2 THEN 'KB' ELSE ' parsecs' END")))
    return rows.select("p_partkey", "quantity", X.memory_bytes(F.col("quantity")).alias("bytes"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || '.h' WHEN 1 THEN p_size || 'day 3h' WHEN 2 THEN p_size || ' m' ELSE p_size || ' weeks' END AS span, CASE p_partkey % 4 WHEN 0 THEN p_size::BIGINT * 3600 WHEN 1 THEN p_size::BIGINT * 86400 + 10800 WHEN 2 THEN p_size::BIGINT * 60 END AS seconds FROM part")
def duration_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat(p_size, '.h') WHEN 1 THEN concat(p_size, 'day 3h') WHEN 2 THEN concat(p_size, ' m') ELSE concat(p_size, ' weeks') END")
    return table(spark, sf_dir, "part").select("p_partkey", span.alias("span"), X.duration_seconds(span).alias("seconds"))


@query("SELECT p_partkey, regexp_replace(p_size || 'd 4d', 'd', 'day') AS span FROM part")
def unit_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.days_spelled(F.concat("p_size", F.lit("d 4d"))).alias("span"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS value, regexp_matches(json_extract_string(props, '$.k'), '^-?[0-9]+$') AS is_integer, coalesce(json_extract_string(props, '$.k') IN ('', 'false', '0'), true) AS unset FROM events")
def type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"), P.type_fits(F.lit("integer"), value).alias("is_integer"), X.is_unset(value).alias("unset"))
