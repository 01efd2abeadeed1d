from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from samplewright.functions import text as X
from samplewright.operators import flow, lookup, params, policy, quality, report, versions
from samplewright.sources import catalogue, config
from samplewright.streaming.windows import tumbling


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "size"), [("128.GB", 128 << 30), ("1.5 MB", 3 << 19), ("12B", 12), ("7KB", 7168), ("2 TB", 2 << 40), ("x", None), ("", None), ("5", None)])
def test_memory(spark, text, size):
    assert one(spark, X.memory_bytes(F.lit(text))) == size


@pytest.mark.parametrize(("text", "seconds"), [("240.h", 864000), ("1day 2h", 93600), ("30 m", 1800), ("5d", 432000), ("2 weeks", None), ("", None)])
def test_duration(spark, text, seconds):
    assert one(spark, X.duration_seconds(F.lit(text))) == seconds


def test_caps(spark):
    assert one(spark, X.capped(F.lit(5), F.lit(None).cast("int"))) == 5
    assert one(spark, X.capped(F.lit(5), F.lit(3))) == 3


def test_text(spark):
    assert one(spark, X.replace_first(F.lit("a--b--c"), "--", "+")) == "a+b--c"
    assert one(spark, X.days_spelled(F.lit("2d 3d"))) == "2day 3d"
    assert one(spark, X.pad_right(F.lit("long name"), 4)) == "long name"
    assert one(spark, X.version_tag(F.lit("1.0"), F.lit("abcdef0123"))) == "v1.0-gabcdef0"
    assert one(spark, X.version_tag(F.lit("v1"), F.lit(None).cast("string"))) == "v1"
    assert one(spark, X.without_option(F.lit("run --hook_url http://x --y"), "--hook_url")) == "run --y"
    assert one(spark, X.escaped(F.lit("<a & 'b'>"))) == "&lt;a &amp; 'b'&gt;"
    assert one(spark, X.wrapped(F.lit("aa bb cc"), 5, 2)) == "aa bb \n  cc "
    assert [one(spark, X.as_bool(F.lit(x))) for x in ("True", " y ", "0", "")] == [True, True, False, False]
    assert one(spark, X.publish_folder(F.lit("MAIN:SUB:FASTQC_X"), "out")) == "out/fastqc"
    codes = X.terminal_codes()
    assert codes["bipurple"] == "\033[1;95m" and len(codes) == 47 and set(X.terminal_codes(True).values()) == {""}


def test_flow(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([("y", 2), ("z", 3)], "v string, k int")
    assert flow.mix(a, b).count() == 3
    assert flow.if_empty(a.limit(0), a).count() == 1 and flow.if_empty(flow.mix(a, b), a).count() == 3
    twice = flow.unique(flow.mix(a, a, b), ["v"], "k")
    assert twice.count() == flow.unique(twice, ["v"], "k").count() == 3
    assert flow.listed(a.limit(0), "v").first()["items"] == []
    assert flow.guarded(a.withColumn("g", F.lit(None).cast("boolean")), F.col("g")).count() == 1
    assert flow.stub(a).columns == a.columns and flow.stub(a).count() == 0


def test_catalogue(spark):
    known = catalogue.genomes(spark, "s3a://refs")
    counts = {r["attr"]: r["count"] for r in known.groupBy("attr").count().collect()}
    assert counts == {"fasta": 38, "bwa": 38, "bowtie2": 38, "star": 38, "bismark": 38, "gtf": 37, "bed12": 37, "mito_name": 34, "readme": 23, "macs_gsize": 14, "blacklist": 6}
    asked = spark.createDataFrame([("equCab2",), ("EquCab2",), ("none",)], "g string")
    rows = {r["g"]: r["mito"] for r in lookup.attribute(asked, "g", known, "mito", "mito_name").collect()}
    assert rows == {"equCab2": "chrM", "EquCab2": "MT", "none": None}
    assert [r["g"] for r in lookup.unknown_keys(asked, "g", known).collect()] == ["none"]
    assert catalogue.genomes(spark, "x", ignore=True).count() == 0


def test_overlay_last_wins(spark):
    layers = [spark.createDataFrame(r, "name string, value string") for r in ([("a", "1"), ("b", "1")], [("b", "2")], [("c", None)])]
    assert {r["name"]: r["value"] for r in lookup.overlay(*layers).collect()} == {"a": "1", "b": "2", "c": None}


def test_parameters(spark):
    schema = params.standard_schema(spark)
    make = lambda rows: spark.createDataFrame([(n, v, k) for k, (n, v) in enumerate(rows)], "name string, value string, ordinal int")
    good = make([("input", "a.csv"), ("outdir", "out"), ("max_cpus", "4"), ("out-dir", "out"), ("Odd", "1"), ("o-dd", "2")])
    assert [r["name"] for r in params.check(good, schema).collect()] == ["Odd"]
    assert sorted(r["name"] for r in params.changed(good, schema).collect()) == ["input", "max_cpus", "outdir"]
    with pytest.raises(params.ParameterError, match="(?s)resume.*Missing required parameter: --outdir"):
        params.check(make([("input", "a.csv"), ("outdir", ""), ("resume", "x")]), schema)
    assert len(params.RESERVED) == 61


def test_schema_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps({"definitions": {"g": {"title": "G", "required": ["a"], "properties": {"a": {"type": "string", "enum": ["x", "y"]}, "b": {"type": "boolean", "default": True, "hidden": True}}}}, "properties": {"c": {"type": "integer"}}}))
    rows = config.read_schema(spark, f"file://{path}").orderBy("ordinal").collect()
    assert [(r["grp"], r["name"], r["default_value"], r["required"]) for r in rows] == [("G", "a", None, True), ("G", "b", "true", False), ("Other parameters", "c", None, False)]
    path.write_text("no json")
    assert config.read_schema(spark, f"file://{path}").count() == 0


def test_versions(spark, tmp_path):
    (tmp_path / "a.yml").write_text('"X:FASTQC":\n    fastqc: 0.11.9\n"Y:FASTQC":\n    fastqc: 0.11.9\n"X:CHECK":\n  python: 3.8.3\n')
    (tmp_path / "b.yml").write_text((tmp_path / "a.yml").read_text())
    rows = config.read_versions(spark, f"file://{tmp_path}")
    assert rows.count() == 3
    assert sorted((r["module"], r["tool"], r["version"]) for r in versions.check(rows).collect()) == [("CHECK", "python", "3.8.3"), ("FASTQC", "fastqc", "0.11.9")]
    (tmp_path / "c.yml").write_text("Z:FASTQC:\n  fastqc: 0.12\n")
    with pytest.raises(versions.VersionConflict, match="FASTQC"):
        versions.check(config.read_versions(spark, f"file://{tmp_path}"))


def test_policy(spark):
    tasks = spark.createDataFrame([("process_high", 2), ("process_single", 3), ("process_long", 1), (None, 30)], "label string, attempt int")
    rows = {r["label"]: r for r in policy.requested(tasks, "label", F.col("attempt"), policy.labels(spark), max_cpus="16").collect()}
    assert (rows["process_high"]["cpus"], rows["process_high"]["mem_bytes"] >> 30, rows["process_high"]["time_s"] // 3600) == (16, 128, 32)
    assert rows["process_single"]["cpus"] == 1 and rows["process_long"]["time_s"] == 72000 and rows[None]["mem_bytes"] >> 30 == 128
    loose = {r["label"]: r for r in policy.requested(tasks, "label", F.col("attempt"), policy.labels(spark), max_cpus="many", max_memory="lots").collect()}
    assert loose["process_high"]["cpus"] == 24 and loose[None]["mem_bytes"] >> 30 == 180
    decide = lambda code, attempt, **k: one(spark, policy.decision(F.lit(code), F.lit(attempt), **k))
    assert [decide(0, 1), decide(137, 1), decide(137, 2), decide(1, 1), decide(1, 2, strategy=F.lit("retry"), max_retries=F.lit(2)), decide(1, 1, strategy=F.lit("ignore"))] == ["done", "retry", "finish", "finish", "retry", "ignore"]


def test_quality(spark):
    reads = spark.createDataFrame([("s", "ACGTA", "IIIII"), ("s", "acg", "!!!"), ("t", "", "")], "sample string, seq string, qual string").withColumn("q", quality.phred(F.col("qual")))
    pos = {(r["sample"], r["pos"]): r for r in quality.by_position(reads.where("qual <> ''"), "sample", "q").collect()}
    assert pos["s", 1]["mean_q"] == 20 and pos["s", 5]["max_q"] == 40
    content = {(r["sample"], r["pos"]): r for r in quality.composition(reads, "sample", "seq").collect()}
    assert content["s", 1]["n_A"] == 2 and content["s", 4]["n_T"] == 1
    panel = spark.createDataFrame([(1, "GTA"), (2, "")], "id int, a string")
    assert [(r["sample"], r["pos"], r["share"]) for r in quality.adapter_content(reads, "sample", "seq", panel, "id", "a").collect()] == [("s", 3, 0.5)]


def test_order_breaks(spark):
    have = spark.createDataFrame([("conda-forge", 0), ("defaults", 1)], "channel string, place int")
    assert [(r["name"], r["next_name"]) for r in versions.order_breaks(have, "place", ["conda-forge", "bioconda", "defaults"], "channel").collect()] == [("conda-forge", "bioconda")]


def test_payloads():
    for kind in ("slack", "card"):
        text = report.payload(kind, "run", "v1", False, "cmd", {"hook_url": "secret", "input": "x"}, "boom")
        assert json.loads(text) and "secret" not in text and "boom" in text


def test_windows_stream_as_in_batch(spark, tmp_path):
    rows = spark.sql("SELECT id, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id * 7 AS INT), 0) AS ts, CAST(id % 2 AS STRING) AS kind, CAST(id AS DOUBLE) AS value FROM range(60)")
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in")
    query = tumbling(stream, "ts", "1 hour", "kind", "value", late="10 minutes").writeStream.outputMode("complete").format("memory").queryName("windows").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(str, spark.table("windows").collect())) == sorted(map(str, tumbling(rows, "ts", "1 hour", "kind", "value").collect()))
