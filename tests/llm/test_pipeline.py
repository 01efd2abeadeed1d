from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from samplewright.llm import mixing, neighbours, queries, spm

sys.path.insert(0, str(Path(__file__).parent))
from test_row_operators import brute_near  # noqa: E402
from test_text_operators import brute_lines  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def odd(spark):
    """The documents with nulls in every column, empty and repeated rows, near copies and columns of clashing names."""
    words = [f"word{k}" for k in range(120)]
    passage = "\n".join(" ".join(words[k : k + 12]) for k in range(0, 120, 12))
    changed = " ".join(["other", *words[1:]])
    rows = [(1001, None, "en", "a", 0), (1002, "", None, None, None), (None, "no key at all", "en", "a", 13), (None, None, None, None, None)]
    rows += [(1003, passage, "en", "b", len(passage)), (1004, "begin here\n" + passage + "\nend here", "en", None, 0), (1004, "begin here\n" + passage + "\nend here", "en", None, 0)]
    rows += [(1005, " ".join(words), "en", "b", 0), (1006, changed, "en", "b", 0), (None, changed + " more", "en", "b", 0), (1007, "x" * 200_000, "xx", "b", 200_000)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    more = spark.createDataFrame(rows, docs.schema)
    return docs.union(more).select("*", *(F.lit(k).alias(n) for k, n in enumerate(["score", "predicted", "n_deleted", "times", "key", "text_hash", "_key", "node"])))


def values(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def test_classifier_stage_keeps_what_it_predicts(spark, odd):
    rows = values(STAGES["quality classifier"](spark, odd, SF))
    scored = neighbours.score_texts(odd.select("doc_id", "text"), queries.quality_labels(spark, SF)).collect()
    assert Counter(r[0] for r in rows) == Counter(r["doc_id"] for r in scored if r["score"] >= 0.7)
    assert not Counter(rows) - Counter(values(odd))


def test_line_stage_by_brute_force(spark, odd):
    rows = values(STAGES["line dedup"](spark, odd, SF))
    given = [(r[0], r[1]) for r in values(odd) if r[0] is not None and r[1] is not None]
    want = brute_lines(sorted(set(given)))
    copies = Counter(k for k, _ in given)
    left = {k: t for k, t in want.items() if t.split() or dict(given)[k] == t}
    assert Counter((r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None) == Counter({(k, t): copies[k] for k, t in left.items()})
    assert sum(r[1] is None for r in rows) == 2 and sum(r[0] is None for r in rows) == 3


def test_near_stage_by_brute_force(spark, odd):
    rows = values(STAGES["near-dedup"](spark, odd, SF))
    # null keys stand last
    given = {(10**9 if r[0] is None else r[0], r[1]) for r in values(odd)}
    nodes = brute_near([(k, t) for k, (_, t) in enumerate(sorted(given, key=lambda x: (x[0], x[1] or "")))], 5)
    ordered = sorted(given, key=lambda x: (x[0], x[1] or ""))
    want = Counter(ordered[k] for k, (_, label) in nodes.items() if k == label)
    assert Counter((10**9 if r[0] is None else r[0], r[1]) for r in rows) == want


def test_mixing_stage_repeats_what_the_mix_takes(spark, odd):
    rows = Counter(values(STAGES["mixing"](spark, odd, SF)))
    taken = mixing.mix(odd.select(*COLUMNS)).collect()
    assert sum(rows.values()) == sum(r["times"] for r in taken)
    size = {s: sum(len((r[1] or "").encode().split()) for r in values(odd) if r[3] == s) for s in {r[3] for r in values(odd)}}
    for source, total in size.items():
        target = next(r["target"] for r in taken if r["source"] == source)
        got = sum(n * len((r[1] or "").encode().split()) for r, n in rows.items() if r[3] == source)
        longest = max(len((r[1] or "").encode().split()) for r in values(odd) if r[3] == source)
        assert abs(got - target) <= longest and got <= 3 * total


def test_encoding_stage_returns_the_texts(spark, odd):
    coded = STAGES["SentencePiece encoding"](spark, odd, SF)
    assert all(r["round_trip"] for r in coded.collect())
    back = spm.decode_ids(coded, queries.PIECE_MODEL).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((r[0], r[1]) for r in values(odd))


def test_stages_in_order(spark):
    docs = queries.table(spark, SF, "documents")
    seen = {}
    for name, stage in pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != pipeline.STAGES[-1][0]:
            assert after.columns == COLUMNS
        after = spark.createDataFrame(after.collect(), after.schema)
        seen[name] = (docs, after)
        docs = after
    good = {r["doc_id"]: r for r in seen["quality classifier"][1].collect()}
    bad = {r["doc_id"] for r in queries.table(spark, SF, "labels").where("quality = 0").collect()}
    assert len(bad & set(good)) <= 0.2 * len(bad)
    before, after = seen["line dedup"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert all(set(r["text"].split("\n")) <= set(texts[r["doc_id"]].split("\n")) and r["n_chars"] == len(r["text"]) for r in after.collect())
    before, after = seen["near-dedup"]
    assert {r["doc_id"] for r in after.collect()} <= {r["doc_id"] for r in before.collect()}
    mixed = seen["mixing"][1].collect()
    tokens = seen["SentencePiece encoding"][1].collect()
    assert sorted(r["doc_id"] for r in mixed) == sorted(r["doc_id"] for r in tokens)
    assert all(r["round_trip"] for r in tokens)


def test_run_is_the_stages(spark):
    rows = pipeline.run(spark, SF).collect()
    again = pipeline.run(spark, SF).collect()
    assert rows and sorted(map(str, rows)) == sorted(map(str, again))


def test_stages_of_an_empty_table(spark):
    docs = queries.table(spark, SF, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
