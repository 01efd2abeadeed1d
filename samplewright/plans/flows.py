"""Dataflow combinators and lookups over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.functions import text as X
from samplewright.operators import flow, lookup
from samplewright.plans.base import query, table
from samplewright.sources import catalogue

BASE = "refs"


@query("SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def mix_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return flow.mix(a, b)


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY md5(text)")
def unique_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("text_md5"), "doc_id", "source")
    return flow.unique(docs, ["text_md5"], "doc_id")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1")
def first_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.first(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS items FROM orders GROUP BY o_custkey")
def collect_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.collected(table(spark, sf_dir, "orders"), "o_orderkey", ["o_custkey"])


@query("SELECT list(r_name ORDER BY r_name) AS items FROM region UNION ALL SELECT []::VARCHAR[]")
def to_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    return flow.listed(regions, "r_name").union(flow.listed(regions.where("r_name = 'nowhere'"), "r_name"))


@query("SELECT n_name AS name FROM nation WHERE n_name LIKE 'Z%' UNION ALL SELECT r_name FROM region WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_name LIKE 'Z%')")
def if_empty_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = table(spark, sf_dir, "nation").where("n_name LIKE 'Z%'").select(F.col("n_name").alias("name"))
    return flow.if_empty(none, table(spark, sf_dir, "region").select(F.col("r_name").alias("name")))


@query("SELECT n_regionkey, string_agg(n_name, chr(10) ORDER BY n_nationkey) AS body FROM nation GROUP BY n_regionkey")
def collect_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.collected_text(table(spark, sf_dir, "nation"), "n_name", ["n_nationkey"], ["n_regionkey"])


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.quality = 1")
def guard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return flow.guarded(rows, F.col("quality") == 1)


@query("SELECT doc_id, lang FROM documents WHERE false")
def stub_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.stub(table(spark, sf_dir, "documents").select("doc_id", "lang"))


@query("SELECT 'given' AS origin, r_name AS name FROM region UNION ALL SELECT 'constant', 'x'")
def constant_optional_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "origin string, name string"
    given = flow.optional(table(spark, sf_dir, "region").select(F.lit("given").alias("origin"), F.col("r_name").alias("name")), spark, name)
    constant = flow.value(spark, "name", "x").withColumn("origin", F.lit("constant"))
    return flow.mix(given, constant, flow.optional(None, spark, name))


@query("SELECT embedding AS reads FROM embeddings")
def tuple_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.struct("vec_id").alias("meta"), F.col("embedding").alias("reads"))
    return flow.project(rows, "reads")


@query("""SELECT s.s_suppkey, r.r_name AS region FROM supplier s LEFT JOIN (
  SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) r
  ON r.n_nationkey = CASE WHEN s.s_suppkey % 10 = 0 THEN s.s_nationkey + 1000 ELSE s.s_nationkey END""")
def catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    known = nations.select(F.col("n_nationkey").alias("key"), F.lit("region").alias("attr"), F.col("r_name").alias("value"))
    # every tenth supplier asks for a key that the catalogue lacks
    asked = F.when(F.col("s_suppkey") % 10 == 0, F.col("s_nationkey") + 1000).otherwise(F.col("s_nationkey"))
    return lookup.attribute(table(spark, sf_dir, "supplier").select("s_suppkey", asked.alias("asked")), "asked", known, "region", "region").select("s_suppkey", "region")


def _genome_sql() -> str:
    rows = ", ".join("(" + ", ".join("'" + x + "'" for x in r) + ")" for r in catalogue.entries(BASE, "assets"))
    return f"WITH cat(key, attr, value) AS (VALUES {rows})"


#: Nations stand for genome keys: the n-th nation asks for the n-th genome in order, and every fifth for an unknown one.
_ASKED = ", asked AS (SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 4 THEN lower(k) || '?' ELSE k END AS genome FROM nation JOIN (SELECT key AS k, row_number() OVER (ORDER BY key) - 1 AS n FROM (SELECT DISTINCT key FROM cat)) ON n = n_nationkey)"


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sorted(g[2] for g in catalogue.GENOMES)
    known = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("n_nationkey").cast("int") + 1)
    key = F.when(F.col("n_nationkey") % 5 == 4, F.concat(F.lower(known), F.lit("?"))).otherwise(known)
    return table(spark, sf_dir, "nation").select("n_nationkey", key.alias("genome"))


@query(_genome_sql() + _ASKED + " SELECT n_nationkey, genome, f.value AS fasta, m.value AS mito_name FROM asked LEFT JOIN cat f ON genome = f.key AND f.attr = 'fasta' LEFT JOIN cat m ON genome = m.key AND m.attr = 'mito_name'")
def genome_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = catalogue.genomes(spark, BASE)
    return lookup.attribute(lookup.attribute(_asked(spark, sf_dir), "genome", known, "fasta", "fasta"), "genome", known, "mito_name", "mito_name")


@query(_genome_sql() + _ASKED + " SELECT DISTINCT genome, (SELECT string_agg(key, ', ' ORDER BY key) FROM (SELECT DISTINCT key FROM cat)) AS available FROM asked WHERE genome NOT IN (SELECT key FROM cat)")
def genome_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.unknown_keys(_asked(spark, sf_dir), "genome", catalogue.genomes(spark, BASE))


@query(_genome_sql() + " SELECT attr, count(*) AS n FROM cat GROUP BY attr UNION ALL SELECT 'ignored', 0")
def catalogue_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ignored = catalogue.genomes(spark, BASE, ignore=True).agg(F.count(F.lit(1)).alias("n")).select(F.lit("ignored").alias("attr"), "n")
    return catalogue.genomes(spark, BASE).groupBy("attr").agg(F.count(F.lit(1)).alias("n")).unionByName(ignored)


@query(_genome_sql() + _ASKED + " SELECT n_nationkey, genome FROM asked LEFT JOIN cat f ON genome = f.key AND f.attr = 'gtf' WHERE f.value IS NULL")
def required_attribute_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.attribute(_asked(spark, sf_dir), "genome", catalogue.genomes(spark, BASE), "gtf", "gtf").where("gtf is null").select("n_nationkey", "genome")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def exists_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.present(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def exists_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.absent(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT coalesce(a.name, b.name) AS name, coalesce(b.value, a.value) AS value FROM (SELECT c_name AS name, c_mktsegment AS value FROM customer) a FULL JOIN (SELECT c_name AS name, 'vip' AS value FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT s_name, 'supplier' FROM supplier) b ON a.name = b.name")
def map_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    base = customers.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("value"))
    vip = customers.where("c_acctbal > 5000").select(F.col("c_name").alias("name"), F.lit("vip").alias("value"))
    return lookup.overlay(base, vip, table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("value")))


@query("SELECT conv_id, turn, [role || ':' || (length(text) % 5), role || ' ' || turn] AS messages FROM conversations")
def error_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message is an error with a chain of up to four causes, beside one without any."""
    kind, made = "struct<message:string>", F.struct(F.concat("role", F.lit(":4")).alias("message"))
    depth = F.length("text") % 5
    for level in (3, 2, 1, 0):
        causes = F.when(depth > level, F.array(made)).otherwise(F.array().cast(f"array<{kind}>"))
        made, kind = F.struct(F.concat("role", F.lit(f":{level}")).alias("message"), causes.alias("causes")), f"struct<message:string,causes:array<{kind}>>"
    plain = F.struct(F.concat("role", F.lit(" "), "turn").alias("message"), F.array().cast(kind.removeprefix("struct<message:string,causes:").removesuffix(">")).alias("causes"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array(made, plain).alias("errors"))
    return rows.select("conv_id", "turn", lookup.leaves(F.col("errors"), rows.schema["errors"].dataType).alias("messages"))


@query("SELECT p_brand, [t for t in ['a', 'b', 'c'] if NOT list_contains(list(DISTINCT lower(left(p_type, 1))), t)] AS missing FROM part GROUP BY p_brand")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = F.collect_set(F.lower(F.substring("p_type", 1, 1)))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_except(F.array(F.lit("a"), F.lit("b"), F.lit("c")), have).alias("missing"))


@query("SELECT page_id, split_part(url, '/', -1) AS last, lower(split_part(split_part(url, '://', 2), '.', 1)) AS first FROM pages")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.split_part("url", F.lit("://"), F.lit(2))
    return table(spark, sf_dir, "pages").select("page_id", X.last_part(F.col("url"), "/").alias("last"), F.lower(X.first_part(rest, ".")).alias("first"))
