"""The command line and the documents that are written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from samplewright.__main__ import main
from samplewright.operators import lookup, render


def test_exit_codes(spark, tmp_path, capsys):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("sample,fastq_1,fastq_2\na,x_1.fq.gz,x_2.fq.gz\n")
    bad.write_text("sample,fastq_1,fastq_2\n,x_1.fq.gz,\n")
    assert main(["check", f"file://{good}", f"file://{tmp_path}/out"], spark) == 0
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out").first()["sample"] == "a_T1"
    assert main(["check", f"file://{bad}", f"file://{tmp_path}/out2"], spark) == 1
    assert main(["check", f"file://{tmp_path}/none.csv", f"file://{tmp_path}/out3"], spark) == 2
    assert main(["parameters"], spark) == 0
    assert "Table of the samples" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["-l", "LOUD", "version"], spark)


def test_documents_are_written_in_order(spark, tmp_path):
    rows = spark.range(100).select((99 - F.col("id")).alias("n"), F.concat(F.lit("line "), 99 - F.col("id")).alias("t"), (F.col("id") % 3).alias("g"))
    render.write_document(rows, "t", ["n"], f"file://{tmp_path}/one")
    assert [r["value"] for r in spark.read.text(f"file://{tmp_path}/one").collect()] == [f"line {k}" for k in range(100)]
    render.write_collected(rows, "t", ["n"], f"file://{tmp_path}/by", by="g")
    got = spark.read.text(f"file://{tmp_path}/by").where("g = 0").collect()
    assert [r["value"] for r in got] == [f"line {k}" for k in range(100) if (99 - k) % 3 == 0]
    metrics = render.long_metrics((rows, "t", "m", None, "n"), (rows, "t", "p", "g", "n"))
    render.write_metrics(metrics, f"file://{tmp_path}/metrics")
    assert spark.read.parquet(f"file://{tmp_path}/metrics").groupBy("metric").count().count() == 2


def test_templates(spark):
    row = spark.range(1).select(render.filled("a {{x}} b {{ y }}", x=F.lit("1"), y=F.lit(None)).alias("t"), render.yaml_scalar(F.lit("it's")).alias("q"), render.yaml_scalar(F.lit("True")).alias("b")).first()
    assert tuple(row) == ("a 1 b ", "'it''s'", "'True'")
    with pytest.raises(ValueError, match="y"):
        render.filled("{{y}}", x=F.lit(1))


def test_leaves_at_any_depth(spark):
    kind = "message string"
    for _ in range(4):
        kind = f"message string, causes array<struct<{kind}>>"
    tree = ("a", [("b", []), ("c", [("d", [("e", [("f",), ("g",)])]), ("h", None)])])
    df = spark.createDataFrame([([tree, ("i", [])],), ([],), (None,)], f"errors array<struct<{kind}>>")
    rows = df.select(lookup.leaves(F.col("errors"), df.schema["errors"].dataType).alias("m")).collect()
    assert [r["m"] for r in rows] == [["b", "f", "g", "h", "i"], [], None]
