from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samplewright.functions import text as X
from samplewright.operators import sheet as S
from samplewright.sources import fastq
from samplewright.sources import sheet as reader

HEAD = "sample,fastq_1,fastq_2"


def write(tmp_path, *lines, name="sheet.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return f"file://{path}"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, k + 2) for k, r in enumerate(rows)], "sample string, fastq_1 string, fastq_2 string, line_no long")


@pytest.mark.parametrize(
    ("row", "code"),
    [
        (("s", "a.fq.gz", ""), None),
        (("s", "a.fastq.gz", None), None),
        (("s", "a 1.fastq.gz", "b.fastq.gz"), None),
        ((" ", "a.fq.gz", ""), None),
        (("", "a.fq.gz", ""), "EMPTY_SAMPLE"),
        ((None, "", ""), "EMPTY_SAMPLE"),
        (("s", "", "b.fq.gz"), "EMPTY_FIRST"),
        (("s", "a.fq", ""), "BAD_FIRST"),
        (("s", "a.FQ.GZ", "b.txt"), "BAD_FIRST"),
        (("s", "a.fq.gz", "b.bam"), "BAD_SECOND"),
        (("s", "a.fq.gz", "b.fastq.gz"), "PAIR_MISMATCH"),
        (("s", "x.1.fq.gz", "y.2.fq.gz"), None),
    ],
)
def test_each_rule(spark, row, code):
    found = S.row_errors(rows_of(spark, [("ok", "z.fq.gz", ""), row])).collect()
    assert [(r["line_no"], r["code"]) for r in found] == ([(3, code)] if code else [])


def test_first_error_and_repeats(spark):
    df = rows_of(spark, [("A B", "a.fq.gz", ""), ("A_B", "a.fq.gz", "b.fq.gz"), ("", "a.fq.gz", ""), ("s", "", "")])
    assert S.first_error(df).first()["line_no"] == 4
    with pytest.raises(S.SheetError, match="On line 4"):
        S.check(df)
    with pytest.raises(S.SheetError, match="A_B, a.fq.gz"):
        S.check(df.where("line_no < 4"))
    with pytest.raises(S.SheetError, match="fastq_2"):
        S.check(df.drop("fastq_2"))


def test_columns_runs_and_tuples(spark):
    df = rows_of(spark, [("a b", "r1.fq.gz", "r2.fq.gz"), ("c", "r3.fq.gz", ""), ("a b", "r4.fq.gz", "")]).withColumn("strand", F.lit("x")).withColumn("single_end", F.lit("old"))
    out = S.check(df)
    assert out.columns == ["sample", "single_end", "fastq_1", "fastq_2", "strand", "line_no", "run_idx"]
    assert [(r["sample"], r["single_end"]) for r in out.orderBy("line_no").collect()] == [("a_b_T1", False), ("c_T1", True), ("a_b_T2", True)]
    tuples = S.read_tuples(out)
    assert sorted((r["meta"]["id"], len(r["reads"])) for r in tuples.collect()) == [("a_b_T1", 2), ("a_b_T2", 1), ("c_T1", 1)]
    assert sorted((r["name"], r["mate"]) for r in S.mate_keys(tuples).collect()) == [("a_b_T1_1", 1), ("a_b_T1_2", 2), ("a_b_T2", 0), ("c_T1", 0)]


def test_read_check_write(spark, tmp_path):
    source = write(tmp_path, "sample\tfastq_1\tfastq_2\tnote", "s 1\ta.fq.gz\tb.fq.gz\tx,y", "", "s 2\tc.fq.gz\t\t", name="sheet.tsv")
    reader.check_sheet(spark, source, f"file://{tmp_path}/out")
    back = reader.split_csv(spark, f"file://{tmp_path}/out")
    assert back.columns == ["sample", "single_end", "fastq_1", "fastq_2", "note"]
    assert [tuple(r) for r in back.collect()] == [("s_1_T1", "False", "a.fq.gz", "b.fq.gz", "x,y"), ("s_2_T1", "True", "c.fq.gz", "", "")]
    assert [r["meta"]["single_end"] for r in S.read_tuples(back).collect()] == [False, True]


@pytest.mark.parametrize(("lines", "says"), [((HEAD, "a,b.fq.gz"), "line 2"), ((HEAD, "a,b.fq.gz,,d"), "line 2"), (("sample,fastq_1", "a,b.fq.gz"), "fastq_2"), (("",), "empty")])
def test_malformed_sheets(spark, tmp_path, lines, says):
    with pytest.raises(S.SheetError, match=says):
        reader.read_sheet(spark, write(tmp_path, *lines))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["a", "a_T1", "b", "a_T1_T1"]), min_size=1, max_size=12))
def test_numbered_names_are_unique(spark, names):
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "sample string, line_no long")
    got = [r["sample"] for r in S.numbered_runs(df).collect()]
    assert len(set(got)) == len(names)


def test_fastq_source(spark, tmp_path):
    import gzip

    body = "@r1 x\nACGT\n+\n@III\n\n@r2\nTT\n+r2\n!~\n"
    with gzip.open(tmp_path / "reads_1.fastq.gz", "wt") as f:
        f.write(body)
    (tmp_path / "reads_2.fq").write_text("@r3\nA\n+\nI\n")
    fastq.register(spark)
    rows = spark.read.format("fastq").load(str(tmp_path)).orderBy("file", "read_idx").collect()
    assert [(r["file"].removeprefix(f"{tmp_path}/"), r["read_idx"], r["read_id"], r["seq"], r["qual"]) for r in rows] == [("reads_1.fastq.gz", 0, "r1 x", "ACGT", "@III"), ("reads_1.fastq.gz", 1, "r2", "TT", "!~"), ("reads_2.fq", 0, "r3", "A", "I")]
    table = fastq.scan_table(spark.read.format("binaryFile").load(f"file://{tmp_path}/reads_1.fastq.gz"))
    assert table.count() == 2
    assert sorted(map(tuple, fastq.scan_lines(spark, f"file://{tmp_path}").collect())) == sorted(map(tuple, rows))
    with pytest.raises(fastq.FastqError):
        list(fastq.records(iter(["@r\n", "ACG\n", "+\n", "II\n"]), "x"))


def test_equal_names_in_two_folders(spark, tmp_path):
    """Two lanes with one file name are two files, whether they are looked for or joined with their reads."""
    import gzip

    from samplewright.sources import config

    for lane in "ab":
        (tmp_path / lane).mkdir()
        with gzip.open(tmp_path / lane / "x.fq.gz", "wt") as f:
            f.write("".join(f"@{lane}{k}\nAC\n+\nII\n" for k in range(5000)))
    wanted = spark.createDataFrame([("a/x.fq.gz",), ("c/x.fq.gz",), (f"file://{tmp_path}/b//x.fq.gz",), (f"{tmp_path}/x.fq.gz",), (None,)], "f string")
    assert sorted(str(r["f"]) for r in config.missing_files(wanted, "f", f"file://{tmp_path}").collect()) == sorted([f"{tmp_path}/x.fq.gz", "None", "c/x.fq.gz"])
    keys = spark.createDataFrame([("one", 0, "one", "a/x.fq.gz"), ("two", 0, "two", f"{tmp_path}/b/x.fq.gz")], "sample string, mate int, name string, path string")
    reads = fastq.with_mates(keys, fastq.scan_lines(spark, f"file://{tmp_path}/*/x.fq.gz"), str(tmp_path))
    assert sorted((r["sample"], r["n"]) for r in reads.groupBy("sample", F.substring("read_id", 1, 1).alias("l")).agg(F.count("*").alias("n")).collect()) == [("one", 5000), ("two", 5000)]


def test_suffixes_as_paths_have_them(spark):
    from pathlib import PurePosixPath

    paths = ["a.fq.gz", "d.x/a.fastq.gz", ".hidden.gz", "noext", "a.", "x.y.z.fq.gz", "..a.b", "dir/.fq.gz", "a..gz"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", X.last_suffixes(F.col("p")).alias("s")).collect()
    for r in rows:
        assert r["s"] == "".join(PurePosixPath(r["p"]).suffixes[-2:]), r["p"]
