"""Quality metrics: documents are reads of their source; embeddings are qualities of their label."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.operators import quality as Q
from samplewright.operators import render
from samplewright.plans.base import query, table
from samplewright.sources import fastq


@query("SELECT source, count(*) AS n_reads FROM documents GROUP BY source")
def seq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.counts(table(spark, sf_dir, "documents"), "source")


@query("SELECT label, floor((list_reduce([x::DOUBLE for x in embedding], lambda a, x: a + x, 0.0::DOUBLE) / len(embedding)) / 0.01::DOUBLE) * 0.01::DOUBLE AS bin, count(*) AS n_reads FROM embeddings GROUP BY ALL")
def per_read_mean_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.mean_histogram(table(spark, sf_dir, "embeddings"), "label", "embedding", 0.01)


@query("SELECT label, pos::INTEGER AS pos, round(avg(q::DOUBLE), 9) AS mean_q, min(q) AS min_q, max(q) AS max_q FROM (SELECT label, unnest(embedding) AS q, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos")
def mean_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Q.by_position(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return rows.withColumn("mean_q", F.round("mean_q", 9))


@query("""SELECT lang, pos::INTEGER AS pos, count(*) AS n, count(*) FILTER (WHERE b IN ('A', 'a')) AS n_A, count(*) FILTER (WHERE b IN ('C', 'c')) AS n_C, count(*) FILTER (WHERE b IN ('G', 'g')) AS n_G, count(*) FILTER (WHERE b IN ('T', 't')) AS n_T
FROM (SELECT lang, unnest(string_split(text, '')) AS b, generate_subscripts(string_split(text, ''), 1) AS pos FROM documents) GROUP BY lang, pos""")
def base_content_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.composition(table(spark, sf_dir, "documents"), "lang", "text")


@query("""WITH starts AS (SELECT d.source, b.item_id AS adapter_id, instr(d.text, b.text)::INTEGER AS pos, count(*) AS n_new FROM documents d JOIN benchmark b ON contains(d.text, b.text) AND length(b.text) > 0 GROUP BY ALL),
upto AS (SELECT *, (sum(n_new) OVER (PARTITION BY source, adapter_id ORDER BY pos))::BIGINT AS n_upto FROM starts)
SELECT u.source, adapter_id, pos, n_new, n_upto, n_upto / n::DOUBLE AS share FROM upto u JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) t ON u.source = t.source""")
def adapter_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.adapter_content(table(spark, sf_dir, "documents"), "source", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


@query("SELECT md5(text) AS seq_md5, count(*) AS n_reads, min(length(text))::INTEGER AS length, count(*) / (SELECT count(*) FROM documents)::DOUBLE AS share FROM documents GROUP BY md5(text) HAVING count(*) / (SELECT count(*) FROM documents)::DOUBLE > 0.001::DOUBLE")
def overrepresented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.overrepresented(table(spark, sf_dir, "documents"), "text")


@query("SELECT item_id::VARCHAR AS read_id, (item_id % 2)::INTEGER AS mate, length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::INTEGER AS n_bases, 40.0::DOUBLE AS mean_q FROM benchmark")
def fastq_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as two FASTQ files in the shared folder, scanned again, with mates and mean qualities."""
    shared = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    folder = f"{shared}/fastq-{uuid.uuid4().hex}"
    letters = F.regexp_replace("text", "[^A-Za-z]", "")
    record = F.concat(F.lit("@"), F.col("item_id").cast("string"), F.lit("\n"), letters, F.lit("\n+\n"), F.repeat(F.lit("I"), F.length(letters)))
    table(spark, sf_dir, "benchmark").select(record.alias("value"), (F.col("item_id") % 2).cast("int").alias("mate")).write.partitionBy("mate").option("compression", "gzip").text(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder)
    reads = fastq.scan_table(files.withColumn("path", F.concat(F.regexp_extract("path", r"mate=(\d+)", 1), F.lit(".fastq.gz"))))
    scores = Q.phred(F.col("qual"))
    mean = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(scores)
    return reads.select("read_id", F.regexp_extract("file", r"^(\d)", 1).cast("int").alias("mate"), F.length("seq").alias("n_bases"), mean.alias("mean_q"))


@query("""SELECT source AS sample, 'reads' AS metric, NULL::DOUBLE AS at, count(*)::DOUBLE AS value FROM documents GROUP BY source
UNION ALL SELECT label::VARCHAR, 'mean_score', pos::DOUBLE, round(avg(q::DOUBLE), 9) FROM (SELECT label, unnest(embedding) AS q, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos""")
def qc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = Q.by_position(table(spark, sf_dir, "embeddings"), "label", "embedding").withColumn("mean_q", F.round("mean_q", 9))
    return render.long_metrics((Q.counts(table(spark, sf_dir, "documents"), "source"), "source", "reads", None, "n_reads"), (scores, "label", "mean_score", "pos", "mean_q"))
