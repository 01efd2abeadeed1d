"""Recall of the fertility bands on labelled junk that the base rules pass, and on marked-up real text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from samplewright.llm import licenses, queries

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def judged(spark):
    rows = queries.op6_fertility(spark, SF).where("not base_failed").join(queries.table(spark, SF, "labels"), "doc_id").where(queries.held_out())
    return {r["quality"]: (r["n"], r["kept"]) for r in rows.groupBy("quality").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}


def test_held_out_junk_is_rejected_and_clean_text_kept(judged):
    (clean, clean_kept), (junk, junk_kept) = judged[1], judged[0]
    assert clean > 500 and clean_kept >= 0.98 * clean
    assert junk > 50 and junk_kept <= 0.1 * junk


def test_statistics_and_verdicts_by_brute_force(spark):
    """Every document of sf0.01, token by token, with both vocabularies."""
    import base64
    import math
    from collections import Counter

    import sentencepiece
    import tiktoken

    from samplewright.llm import fertility

    pieces = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.MULTI_RANKS, "rb"))}
    multi = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    lone = {i for t, i in ranks.items() if len(t) == 1 and t[0] >= 0x80}
    docs = {r["doc_id"]: r for r in queries.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = queries.op6_fertility(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        doc = docs[r["doc_id"]]
        words = [w.decode() for w in (doc["text"] or "").encode().split()]
        chars, fits = sum(map(len, words)), []
        for number, (cut, single, bands) in enumerate([(lambda w: pieces.encode(w), pieces.is_byte, fertility.BANDS), (lambda w: multi.encode_ordinary(" " + w), lone.__contains__, fertility.MULTI_BANDS)]):
            tokens = [t for w in words for t in cut(w)]
            n = len(tokens)
            entropy = -sum(c / n * math.log2(c / n) for c in Counter(tokens).values()) if n else 0.0
            stats = (n, chars / n if n else 0.0, sum(map(single, tokens)) / n if n else 0.0, entropy / math.log2(n) if n > 1 else 0.0)
            if number == 0:
                assert r["n_tokens"] == n and (r["chars_per_token"], r["byte_share"], r["token_spread"]) == pytest.approx(stats[1:])
            else:
                assert r["more_chars_per_token"] == pytest.approx([stats[1]])
            fits.append(fertility.within(bands.get(doc["lang"], fertility.OPEN), *stats))
        assert r["kept"] == (not r["base_failed"] and all(fits))


def test_marked_up_real_text(spark, tmp_path):
    words = licenses.full_texts()["GPL-3.0 text"].split()
    docs = []
    for size in (30, 100, 300, 1000):
        part = words[1000 : 1000 + size]
        docs += [(f"clean {size}", " ".join(part)), (f"### {size}", " ".join(w + "###" for w in part)), (f"| {size}", " | ".join(part))]
    spark.createDataFrame([(n, t, "en") for n, t in docs], "doc_id string, text string, lang string").write.parquet(f"file://{tmp_path}/documents.parquet")
    kept = {r["doc_id"]: r["kept"] for r in queries.op6_fertility(spark, f"file://{tmp_path}").collect()}
    assert kept == {n: n.startswith("clean") for n, _ in docs}
