"""Versions, policies and reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.functions import text as X
from samplewright.operators import policy, render, report
from samplewright.operators import versions as V
from samplewright.plans.base import query, table

#: Parts stand for version rows: brand in a workflow -> process, type -> tool, size -> version.
_VERSIONS = """v AS (SELECT 'MAIN:' || p_brand AS process, p_type AS tool, (CASE WHEN p_brand LIKE '%1' THEN p_size ELSE length(p_type) END)::VARCHAR AS version, p_partkey AS ordinal FROM part
  UNION ALL SELECT 'SUB:' || p_brand, p_type, (CASE WHEN p_brand LIKE '%1' THEN p_size + 1 ELSE length(p_type) END)::VARCHAR, p_partkey FROM part)"""
_LAST = "l AS (SELECT process, tool, arg_max(version, ordinal) AS version FROM v GROUP BY process, tool)"
_SETS = "s AS (SELECT process, split_part(process, ':', -1) AS module, string_agg(tool || '=' || version, ';' ORDER BY tool) AS versions FROM l GROUP BY process)"


def version_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")

    def rows(workflow: str, more: int) -> DataFrame:
        version = F.when(F.col("p_brand").like("%1"), F.col("p_size") + more).otherwise(F.length("p_type")).cast("string")
        return part.select(F.concat(F.lit(workflow + ":"), "p_brand").alias("process"), F.col("p_type").alias("tool"), version.alias("version"), F.col("p_partkey").alias("ordinal"))

    return rows("MAIN", 0).unionByName(rows("SUB", 1))


@query(f"WITH {_VERSIONS}, {_LAST}, {_SETS} SELECT module, count(DISTINCT versions) AS n_versions FROM s GROUP BY module HAVING count(DISTINCT versions) > 1")
def version_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.conflicts(version_rows(spark, sf_dir))


@query(f"WITH {_VERSIONS}, {_LAST}, {_SETS}, bad AS (SELECT module FROM s GROUP BY module HAVING count(DISTINCT versions) > 1) SELECT DISTINCT split_part(process, ':', -1) AS module, tool, version FROM l WHERE split_part(process, ':', -1) NOT IN (SELECT module FROM bad)")
def version_by_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.by_module(version_rows(spark, sf_dir))


@query(f"WITH {_VERSIONS}, {_LAST}, {_SETS} SELECT process, module, versions FROM s")
def version_by_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.by_process(version_rows(spark, sf_dir))


_NATIONS = "SELECT r_name, n_name, n_nationkey, (row_number() OVER (PARTITION BY r_name ORDER BY n_name))::INTEGER AS row FROM nation JOIN region ON n_regionkey = r_regionkey"


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", "n_nationkey")


@query(f"SELECT *, CASE WHEN row = 1 THEN r_name ELSE '' END AS label FROM ({_NATIONS})")
def first_row_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.first_row_labels(_nations(spark, sf_dir), "r_name", "n_name")


@query(f"SELECT r_name, row, '<tr><td><samp>' || CASE WHEN row = 1 THEN r_name ELSE '' END || '</samp></td><td><samp>' || n_name || '</samp></td><td><samp>' || n_nationkey || '</samp></td></tr>' AS html FROM ({_NATIONS})")
def versions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table_rows(_nations(spark, sf_dir), "r_name", "n_name", "n_nationkey")


_WANTED = ["EUROPE", "ASIA", "AFRICA", "NOWHERE"]


@query("""WITH w(rank, name) AS (VALUES (0, 'EUROPE'), (1, 'ASIA'), (2, 'AFRICA'), (3, 'NOWHERE')), p AS (SELECT rank, name, coalesce(r_regionkey, -1)::BIGINT AS place FROM w LEFT JOIN region ON name = r_name),
q AS (SELECT name, place, lead(name) OVER (ORDER BY rank) AS next_name, lead(place) OVER (ORDER BY rank) AS next_place FROM p) SELECT * FROM q WHERE next_name IS NOT NULL AND NOT place < next_place""")
def adjacent_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.order_breaks(table(spark, sf_dir, "region"), "r_regionkey", _WANTED, "r_name")


@query("SELECT r_name AS section, CASE r_name WHEN 'ASIA' THEN -1000 WHEN 'EUROPE' THEN -1001 ELSE 0 END AS order_no FROM region")
def ordered_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.createDataFrame([("ASIA", -1000), ("EUROPE", -1001)], "section string, order_no int")
    return report.ordered_sections(table(spark, sf_dir, "region").select(F.col("r_name").alias("section")), orders).orderBy("order_no", "section")


_LABEL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'process_high' WHEN '2-HIGH' THEN 'process_medium' WHEN '3-MEDIUM' THEN 'process_single' WHEN '4-NOT SPECIFIED' THEN 'process_high_memory' ELSE 'nothing' END"


@query(f"""WITH t AS (SELECT o_orderkey, {_LABEL} AS label, (o_orderkey % 3 + 1)::INTEGER AS attempt FROM orders),
w(label, cpus, gb, h, grows) AS (VALUES ('process_high', 12, 72, 16, true), ('process_medium', 6, 36, 8, true), ('process_single', 1, 6, 4, false), ('process_high_memory', 1, 200, 4, true), ('nothing', 1, 6, 4, true))
SELECT o_orderkey, t.label, attempt, least(CASE WHEN grows THEN cpus * attempt ELSE cpus END, 16)::BIGINT AS cpus, least(gb * attempt, 128)::BIGINT * 1073741824 AS mem_bytes, (h * attempt)::BIGINT * 3600 AS time_s FROM t JOIN w ON t.label = w.label""")
def resource_cap_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_LABEL).alias("label"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("attempt"))
    return policy.requested(tasks, "label", F.col("attempt"), policy.labels(spark))


@query("""SELECT l_orderkey, l_linenumber, code, attempt, CASE WHEN code = 0 THEN 'done' WHEN strategy = 'ignore' THEN 'ignore' WHEN (strategy = 'retry' OR code IN (143, 137, 104, 134, 139)) AND attempt <= CASE strategy WHEN 'retry' THEN 2 ELSE 1 END THEN 'retry' ELSE 'finish' END AS next, count(*) AS n
FROM (SELECT l_orderkey, l_linenumber, CASE l_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 137 WHEN 2 THEN 1 ELSE 143 END AS code, (l_linenumber % 3 + 1)::INTEGER AS attempt, CASE l_returnflag WHEN 'A' THEN 'ignore' WHEN 'R' THEN 'retry' ELSE 'default' END AS strategy FROM lineitem) GROUP BY ALL""")
def retry_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr("CASE l_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 137 WHEN 2 THEN 1 ELSE 143 END").alias("code"), (F.col("l_linenumber") % 3 + 1).alias("attempt"), F.expr("CASE l_returnflag WHEN 'A' THEN 'ignore' WHEN 'R' THEN 'retry' ELSE 'default' END").alias("strategy"))
    retries = F.when(F.col("strategy") == "retry", 2).otherwise(1)
    decided = rows.withColumn("next", policy.decision(F.col("code"), F.col("attempt"), F.col("strategy"), retries))
    return decided.groupBy("l_orderkey", "l_linenumber", "code", "attempt", "next").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source, sum(n_chars) FILTER (WHERE lang = 'en')::BIGINT AS en, sum(n_chars) FILTER (WHERE lang = 'de')::BIGINT AS de, sum(n_chars) FILTER (WHERE lang = 'fr')::BIGINT AS fr, sum(n_chars) FILTER (WHERE lang = 'es')::BIGINT AS es FROM documents GROUP BY source")
def report_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.pivoted(table(spark, sf_dir, "documents"), "source", "lang", "n_chars", ["en", "de", "fr", "es"])


@query("SELECT r_name, '<p><b>' || r_name || '</b></p><dl>' || string_agg('<dt>' || n_name || '</dt><dd><samp>' || n_nationkey || '</samp></dd>', '' ORDER BY n_nationkey) || '</dl>' AS html FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def definition_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nations(spark, sf_dir).withColumn("value", F.col("n_nationkey").cast("string"))
    return report.definition_list(rows, "r_name", "n_name", "value", "n_nationkey")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'out/pipeline_info' ELSE 'out/' || lower(split_part(split_part('A:' || upper(replace(p_type, ' ', '_')), ':', -1), '_', 1)) END AS folder FROM part")
def publish_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    process = F.concat(F.lit("A:"), F.upper(X.underscored(F.col("p_type"))))
    return table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, "out/pipeline_info").otherwise(X.publish_folder(process, "out")).alias("folder"))


@query("SELECT page_id, 'run --a 1 --b ' || url AS command FROM pages")
def redact_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    command = F.concat(F.lit("run --a 1 --hook_url "), "url", F.lit(" --b "), "url")
    return table(spark, sf_dir, "pages").select("page_id", X.without_option(command, "--hook_url").alias("command"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'v' || p_size WHEN p_size % 3 = 1 THEN 'v1.' || p_size ELSE '' END || '-g' || substr(md5(p_name), 1, 7) AS tag FROM part")
def short_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("v"), "p_size")).when(F.col("p_size") % 3 == 1, F.concat(F.lit("1."), "p_size")).otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", X.version_tag(version, F.md5("p_name")).alias("tag"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'a@x.org' WHEN o_orderstatus = 'F' THEN 'b@x.org' END AS recipient, CASE WHEN o_orderstatus <> 'F' AND o_custkey % 5 = 0 THEN 'run finished' WHEN o_orderstatus <> 'F' THEN 'run finished, some tasks failed and were ignored' ELSE 'run failed' END AS summary,
CASE WHEN o_custkey % 3 = 0 THEN o_totalprice <= 100000 ELSE o_totalprice < 100000 END AS attached, CASE WHEN o_custkey % 7 = 0 THEN 'slack' ELSE 'card' END AS payload FROM orders""")
def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, success = F.col("o_custkey"), F.col("o_orderstatus") != "F"
    email = F.when(c % 2 == 0, "a@x.org").otherwise("")
    url = F.when(c % 7 == 0, "https://hooks.slack.com/x").otherwise("https://x.org/hook")
    return table(spark, sf_dir, "orders").select("o_orderkey", report.recipient(email, F.lit("b@x.org"), success).alias("recipient"), report.completion(success, F.when(c % 5 == 0, 0).otherwise(1)).alias("summary"), report.attaches(F.col("o_totalprice"), F.lit(100000), c % 3 == 0).alias("attached"), report.payload_kind(url).alias("payload"))


@query("SELECT o_orderstatus, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_ignored FROM orders GROUP BY o_orderstatus")
def ignored_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count_if(F.col("o_orderpriority") == "5-LOW").alias("n_ignored"))


@query("SELECT item_id, rtrim(regexp_replace(base64(encode(text)), '(.{76})', '\\1' || chr(10), 'g'), chr(10)) AS body FROM benchmark")
def base64_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", X.base64_lines(F.col("text")).alias("body"))


@query("SELECT c_custkey, 'nation: ' || c_nationkey || chr(10) || 'segment: ' || c_mktsegment AS body FROM customer")
def map_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.map_lines(entries).alias("body"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS stamp FROM events")
def date_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd_HH-mm-ss").alias("stamp"))


@query("SELECT p_partkey, p_brand || ' ' AS brand, regexp_replace('FastQC v' || p_size, '^FastQC v', '') AS version, CASE WHEN length(p_name) < 30 THEN rpad(p_name, 30, ' ') ELSE p_name END AS padded FROM part")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = X.replace_first(F.concat(F.lit("FastQC v"), "p_size"), "^FastQC v", "")
    return table(spark, sf_dir, "part").select("p_partkey", X.pad_right(F.col("p_brand"), F.length("p_brand") + 1).alias("brand"), version.alias("version"), X.pad_right(F.col("p_name"), 30).alias("padded"))


@query("""WITH RECURSIVE w AS (SELECT item_id, text, string_split(text, ' ') AS words, 1 AS k, ''::VARCHAR AS body, ''::VARCHAR AS line FROM benchmark WHERE length(text) > 60
UNION ALL SELECT item_id, text, words, k + 1, CASE WHEN length(line) + length(words[k]) <= 60 THEN body ELSE body || line || chr(10) END, CASE WHEN length(line) + length(words[k]) <= 60 THEN line || words[k] || ' ' ELSE words[k] || ' ' END FROM w WHERE k <= len(words))
SELECT item_id, body || line AS wrapped FROM w WHERE k = len(words) + 1 UNION ALL SELECT item_id, text FROM benchmark WHERE length(text) <= 60""")
def help_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", X.wrapped(F.col("text"), 60).alias("wrapped"))


@query("SELECT page_id, CASE WHEN contains(url, 'blog') THEN contains(url, 'https:') ELSE true END AS cloud_ok, (NOT contains(url, 'blog')) AND (page_id % 3) <= 1 AS config_warning FROM pages")
def profile_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cloud = F.contains("url", F.lit("blog"))
    return table(spark, sf_dir, "pages").select("page_id", (~cloud | F.contains("url", F.lit("https:"))).alias("cloud_ok"), (~cloud & (F.col("page_id") % 3 <= 1)).alias("config_warning"))


def _yaml_sql(name: str) -> str:
    return f"CASE WHEN regexp_matches({name}, '^[A-Za-z_][A-Za-z0-9_./+-]*$') THEN {name} ELSE chr(39) || {name} || chr(39) END"


@query(f"""WITH named AS (SELECT {_yaml_sql("r_name")} AS r_name, n_name, {_yaml_sql("n_name")} AS tool, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT r_name, r_name || ':' || chr(10) || string_agg('  ' || tool || ': ' || chr(39) || n_nationkey || chr(39), chr(10) ORDER BY n_name) AS body FROM named GROUP BY r_name""")
def version_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nations(spark, sf_dir).withColumn("version", F.col("n_nationkey").cast("string"))
    return render.version_documents(rows, "r_name", "n_name", "version").withColumn("r_name", render.yaml_scalar(F.col("r_name")))


@query(f"""SELECT r_name, '<tbody>' || string_agg('<tr><td><samp>' || CASE WHEN row = 1 THEN r_name ELSE '' END || '</samp></td><td><samp>' || n_name || '</samp></td><td><samp>' || n_nationkey || '</samp></td></tr>', '' ORDER BY row) || '</tbody>' AS body FROM ({_NATIONS}) GROUP BY r_name""")
def version_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.version_section(V.table_rows(_nations(spark, sf_dir), "r_name", "n_name", "n_nationkey"), "r_name", "html")


@query("""SELECT o_orderkey, 'Order ' || o_orderkey || chr(10) || chr(10) || o_orderstatus || chr(10) || chr(10) || 'customer: ' || o_custkey || chr(10) || 'priority: ' || o_orderpriority || chr(10) AS text,
'<h1>Order ' || o_orderkey || '</h1><p>' || o_orderstatus || '</p><table><tr><th>customer</th><td>' || o_custkey || '</td></tr><tr><th>priority</th><td>' || o_orderpriority || '</td></tr></table>' AS html FROM orders""")
def mail_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = F.create_map(F.lit("priority"), F.col("o_orderpriority"), F.lit("customer"), F.col("o_custkey").cast("string"))
    mail = render.mail(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")), F.col("o_orderstatus"), facts)
    return table(spark, sf_dir, "orders").select("o_orderkey", mail.alias("m")).select("o_orderkey", "m.text", "m.html")


@query("SELECT c_custkey, 'Dear ' || c_name || ', nation ' || c_nationkey || '.' AS letter FROM customer")
def template_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = render.filled("Dear {{name}}, nation {{ nation }}.", name=F.col("c_name"), nation=F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", letter.alias("letter"))
