"""Run parameters as rows (name, value) against a schema as rows.

A schema row has grp, name, type (string, boolean, integer), pattern, choices (array),
default_value, hidden, required, ordinal, description. Rule results are rows, not exceptions; `check`
raises on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.functions import text as X

SCHEMA = "grp string, name string, type string, pattern string, choices array<string>, default_value string, hidden boolean, required boolean, ordinal int, description string"

# Options of the workflow runner, which no parameter may be named after.
RESERVED = (
    "bg", "c", "C", "config", "d", "D", "dockerize", "h", "log", "q", "quiet", "syslog", "v", "ansi", "ansi-log",
    "bucket-dir", "cache", "dsl2", "dump-channels", "dump-hashes", "E", "entry", "latest", "lib", "main-script", "N",
    "name", "offline", "params-file", "pi", "plugins", "poll-interval", "pool-size", "profile", "ps", "qs",
    "queue-size", "r", "resume", "revision", "stdin", "stub", "stub-run", "test", "w", "with-charliecloud",
    "with-conda", "with-dag", "with-docker", "with-mpi", "with-notification", "with-podman", "with-report",
    "with-singularity", "with-timeline", "with-tower", "with-trace", "with-weblog", "without-docker", "without-podman",
    "work-dir",
)

# Patterns of typed parameters.
PATTERNS = {
    "csv": r"^\S+\.csv$",
    "email": r"^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$",
    "fasta": r"^\S+\.fn?a(sta)?(\.gz)?$",
    "memory": r"^\d+(\.\d+)?\.?\s*(K|M|G|T)?B$",
    "time": r"^(\d+\.?\s*(s|m|h|day)\s*)+$",
}
PUBLISH_MODES = ["symlink", "rellink", "link", "copy", "copyNoFollow", "move"]


DESCRIPTIONS = {
    "input": "Table of the samples, as CSV.",
    "outdir": "Folder for all results; an absolute path on cloud storage.",
    "email": "Address that gets a summary when the run ends.",
    "multiqc_title": "Heading and file name of the joint report.",
    "genome": "Key of a genome in the catalogue.",
    "fasta": "Genome sequence, where no catalogue key is given.",
    "igenomes_base": "Folder that the catalogue's paths begin with.",
    "igenomes_ignore": "Leaves the catalogue out.",
    "custom_config_version": "Revision of the shared configurations.",
    "custom_config_base": "Folder of the shared configurations.",
    "config_profile_name": "Name of the site's configuration.",
    "config_profile_description": "What the site's configuration is for.",
    "config_profile_contact": "Whom to ask about the site's configuration.",
    "config_profile_url": "Page about the site's configuration.",
    "max_cpus": "Most processors that one task may ask for.",
    "max_memory": "Most memory that one task may ask for, as 8.GB.",
    "max_time": "Longest time that one task may ask for, as 2.h.",
    "help": "Prints this text.",
    "version": "Prints the version.",
    "publish_dir_mode": "How results get to the output folder.",
    "email_on_fail": "Address that is told of failures only.",
    "plaintext_email": "Mails as plain text, without HTML.",
    "max_multiqc_email_size": "Largest report that is attached to a mail.",
    "monochrome_logs": "No colours in the log.",
    "hook_url": "Address of a chat's incoming messages.",
    "multiqc_config": "Further settings of the joint report.",
    "multiqc_logo": "Picture for the joint report.",
    "multiqc_methods_description": "Methods section of the joint report, as YAML.",
    "tracedir": "Folder for traces of the run.",
    "validate_params": "Checks parameters against this schema first.",
    "show_hidden_params": "Shows every parameter in the help.",
    "enable_conda": "Takes software from package channels.",
}


class ParameterError(ValueError):
    """Parameters break the schema."""


def standard_schema(spark: SparkSession) -> DataFrame:
    """The schema of a run: input and output, reference, limits and reports."""
    rows, p = [], PATTERNS

    def add(grp: str, name: str, kind: str = "string", pattern: str | None = None, choices: list | None = None, default: str | None = None, hidden: bool = True, required: bool = False) -> None:
        rows.append((grp, name, kind, pattern, choices, default, hidden, required, len(rows), DESCRIPTIONS[name]))

    add("Input/output options", "input", pattern=p["csv"], hidden=False, required=True)
    add("Input/output options", "outdir", hidden=False, required=True)
    add("Input/output options", "email", pattern=p["email"], hidden=False)
    add("Input/output options", "multiqc_title", hidden=False)
    add("Reference genome options", "genome", hidden=False)
    add("Reference genome options", "fasta", pattern=p["fasta"], hidden=False)
    add("Reference genome options", "igenomes_base")
    add("Reference genome options", "igenomes_ignore", "boolean")
    add("Institutional config options", "custom_config_version", default="master")
    for name in ("custom_config_base", "config_profile_name", "config_profile_description", "config_profile_contact", "config_profile_url"):
        add("Institutional config options", name)
    add("Max job request options", "max_cpus", "integer", default="16")
    add("Max job request options", "max_memory", pattern=p["memory"], default="128.GB")
    add("Max job request options", "max_time", pattern=p["time"], default="240.h")
    for name in ("help", "version"):
        add("Generic options", name, "boolean")
    add("Generic options", "publish_dir_mode", choices=PUBLISH_MODES, default="copy")
    add("Generic options", "email_on_fail", pattern=p["email"])
    add("Generic options", "plaintext_email", "boolean")
    add("Generic options", "max_multiqc_email_size", pattern=p["memory"], default="25.MB")
    add("Generic options", "monochrome_logs", "boolean")
    for name in ("hook_url", "multiqc_config", "multiqc_logo"):
        add("Generic options", name)
    add("Generic options", "multiqc_methods_description", hidden=False)
    add("Generic options", "tracedir", default="${params.outdir}/pipeline_info")
    add("Generic options", "validate_params", "boolean", default="true")
    for name in ("show_hidden_params", "enable_conda"):
        add("Generic options", name, "boolean")
    return spark.createDataFrame(rows, SCHEMA)


def folded(c: Column) -> Column:
    """Names that differ in case and hyphens only are twins."""
    return F.lower(F.replace(c, F.lit("-"), F.lit("")))


def reserved(params: DataFrame) -> DataFrame:
    return params.where(F.col("name").isin(*RESERVED)).select("name")


def without_ignored(schema: DataFrame, ignored: str) -> DataFrame:
    """The schema without the names of a comma-separated list, required ones included."""
    return schema.where(~F.array_contains(F.split(F.lit(ignored), ","), F.col("name")))


def unexpected(params: DataFrame, schema: DataFrame, ignored: str = "") -> DataFrame:
    """Parameters unknown to the schema, in order: ignored names, names with a hyphen whose twin is known,
    and later twins of an unexpected name aside. `params` has an `ordinal`."""
    names = schema.select(F.col("name").alias("_n"))
    unknown = params.join(names, F.col("name") == F.col("_n"), "left_anti").where(~F.array_contains(F.split(F.lit(ignored + ",schema_ignore_params"), ","), F.col("name")))
    twins = schema.select(folded(F.col("name")).alias("_f")).distinct()
    keyed = unknown.withColumn("_key", folded(F.col("name"))).join(twins, F.col("_key") == F.col("_f"), "left")
    keyed = keyed.where(~(F.contains("name", F.lit("-")) & F.col("_f").isNotNull()))
    return keyed.groupBy("_key").agg(F.min_by(F.struct("name", "value", "ordinal"), "ordinal").alias("r")).select("r.*")


def given(params: DataFrame) -> DataFrame:
    """Parameters that are set; null, empty, false and 0 count as unset."""
    return params.where(~X.is_unset(F.col("value")))


def missing(params: DataFrame, schema: DataFrame) -> DataFrame:
    """Required names that aren't given."""
    have = given(params).select(F.col("name").alias("_n"))
    return schema.where("required").join(have, F.col("name") == F.col("_n"), "left_anti").select("name")


def type_fits(kind: Column, value: Column) -> Column:
    """Whether a value's text fits boolean, integer or number; any text is a string."""
    return F.when(kind == "boolean", F.lower(value).isin("true", "false")).when(kind == "integer", F.rlike(value, F.lit(r"^-?\d+$"))).when(kind == "number", F.rlike(value, F.lit(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"))).otherwise(True)


def choice_text(choices: Column, most: int = 5) -> Column:
    """The first choices; how many of how many, where there are more."""
    listed = F.array_join(F.slice(choices, 1, most), ", ")
    return F.when(F.size(choices) > most, F.concat(F.lit(f" ({most} of "), F.size(choices), F.lit("): "), listed, F.lit(", ... )"))).otherwise(F.concat(F.lit(": "), listed, F.lit(")")))


def errors(params: DataFrame, schema: DataFrame) -> DataFrame:
    """name, rule (required, type, pattern, enum) and message of every rule that is broken."""
    rules = schema.select("name", "type", "pattern", "choices")
    rows = given(params).select("name", "value").join(rules, "name")
    value = F.col("value")
    bad_type = ~type_fits(F.col("type"), value)
    bad_pattern = F.col("pattern").isNotNull() & ~F.coalesce(F.regexp_like(value, F.col("pattern")), F.lit(True))
    bad_choice = F.col("choices").isNotNull() & ~F.array_contains("choices", value)
    start = F.concat(F.lit("* --"), F.col("name"), F.lit(": "))
    found = rows.select(
        "name",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(bad_type, F.struct(F.lit("type").alias("rule"), F.concat(start, F.lit("expected type: "), F.col("type"), F.lit(" ("), value, F.lit(")")).alias("message"))),
                    F.when(bad_pattern, F.struct(F.lit("pattern").alias("rule"), F.concat(start, F.lit("does not match pattern ("), value, F.lit(")")).alias("message"))),
                    F.when(bad_choice, F.struct(F.lit("enum").alias("rule"), F.concat(start, F.lit("'"), value, F.lit("' is not a valid choice (Available choices"), choice_text(F.col("choices"))).alias("message"))),
                )
            )
        ).alias("e"),
    ).select("name", "e.*")
    absent = missing(params, schema).select("name", F.lit("required").alias("rule"), F.concat(F.lit("* Missing required parameter: --"), F.col("name")).alias("message"))
    return absent.unionByName(found)


def check(params: DataFrame, schema: DataFrame, ignored: str = "") -> DataFrame:
    """Unexpected parameters, as warnings; ParameterError with every error otherwise."""
    found = errors(params, without_ignored(schema, ignored)).orderBy("name", "rule").collect()
    named = [f"* --{r['name']} is an option of the runner" for r in reserved(params).orderBy("name").collect()]
    if found or named:
        raise ParameterError("\n".join([*named, *(r["message"] for r in found)]))
    return unexpected(params, schema, ignored)


def changed(params: DataFrame, schema: DataFrame, outdir: str = "") -> DataFrame:
    """grp, name, value, ordinal of parameters that differ from their default, or have none and are set.

    A default that holds $projectDir equals any value that contains the rest of it; one
    that holds ${params.outdir} is read with the output folder. Unset, where there is no
    default: null, empty or false (0 counts as set).
    """
    rows = params.select("name", "value").join(schema.select("grp", "name", "type", "default_value", "ordinal"), "name")
    default, value = F.col("default_value"), F.col("value")
    is_text = F.col("type") == "string"
    rest = F.replace(F.replace(default, F.lit("$projectDir"), F.lit("")), F.lit("${projectDir}"), F.lit(""))
    relative = is_text & (F.contains(default, F.lit("$projectDir")) | F.contains(default, F.lit("${projectDir}"))) & F.contains(value, rest)
    filled = F.replace(F.replace(default, F.lit("$params.outdir"), F.lit(outdir)), F.lit("${params.outdir}"), F.lit(outdir))
    same = relative | (is_text & (filled == value)) | default.eqNullSafe(value)
    unset = value.isNull() | value.isin("", "false")
    keep = F.when(default.isNotNull(), ~F.coalesce(same, F.lit(False))).otherwise(~unset)
    return rows.where(keep).select("grp", "name", "value", "ordinal")


def visible(schema: DataFrame, show_hidden: bool = False) -> DataFrame:
    return schema if show_hidden else schema.where(~F.col("hidden"))


def group_counts(schema: DataFrame) -> DataFrame:
    """grp, n_params, n_hidden, n_shown of groups with something to show."""
    return schema.groupBy("grp").agg(F.count(F.lit(1)).alias("n_params"), F.count_if("hidden").alias("n_hidden"), F.count_if(~F.col("hidden")).alias("n_shown")).where("n_shown > 0")


def help_lines(schema: DataFrame, width: int = 160, show_hidden: bool = False) -> DataFrame:
    """ordinal, grp and line of the help text: names padded to the longest, descriptions wrapped."""
    longest = schema.agg((F.max(F.length("name")) + 1).alias("_w"))
    rows = visible(schema, show_hidden).join(F.broadcast(longest))
    described = F.concat(F.lit("["), F.col("type"), F.lit("]"))
    note = F.when(F.col("default_value").isNotNull(), F.concat(F.lit(" [default: "), F.col("default_value"), F.lit("]"))).otherwise("")
    text = X.wrapped(F.concat(F.coalesce(F.col("description"), F.lit("")), note), width)
    return rows.select("ordinal", "grp", F.concat(F.lit("  --"), X.pad_right(F.col("name"), F.col("_w")), X.pad_right(described, 10), text).alias("line"))


def from_schema_json(spark: SparkSession, document: dict) -> DataFrame:
    """A JSON-Schema document (definitions of groups of properties, and loose properties) as schema rows."""
    rows = []
    groups = [(g.get("title", key), g.get("properties", {}), g.get("required", [])) for key, g in document.get("definitions", {}).items()]
    groups.append(("Other parameters", document.get("properties", {}), document.get("required", [])))
    for title, properties, required in groups:
        for name, p in properties.items():
            default = p.get("default")
            text = None if default is None else str(default).lower() if isinstance(default, bool) else str(default)
            choices = [str(c) for c in p["enum"]] if "enum" in p else None
            rows.append((title, name, p.get("type", "string"), p.get("pattern"), choices, text, bool(p.get("hidden")), name in required, len(rows), p.get("description")))
    return spark.createDataFrame(rows, SCHEMA)
