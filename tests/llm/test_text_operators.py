from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplewright.llm import fertility, licenses, linededup, neighbours, queries, spm, words

MODEL = queries.PIECE_MODEL
ODD = [
    (1, "plain text with some words in it and a few more to reach ten", "en"),
    (1, "plain text with some words in it and a few more to reach ten", "en"),
    (2, None, "en"),
    (3, "", "en"),
    (4, " \t\n ", None),
    (5, "a  b\n\tc ▁x 日本語 naïve 😀\x1c z", "xx"),
    (6, "word " * 40_000, "en"),
    (7, "x" * 400_000, "en"),
    (None, "no key here but text", "de"),
]


@pytest.fixture(scope="module")
def odd(spark):
    # columns that clash with names inside the operators
    rows = [(*r, k, "k") for k, r in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, key string")


def words_of(text):
    return (text or "").encode().split()


def test_word_hashes_follow_words():
    text = ("Hello  wörld\tfoo \x1cbar Hello " * 20_000 + "y" * 300_000 + " end").encode()
    hashes = words.word_hashes(text)
    assert len(hashes) == len(text.split())
    seen = {}
    assert all(seen.setdefault(w, h) == h for w, h in zip(text.split(), hashes.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)
    assert words.word_hashes(b"ABC z", True).tolist() == words.word_hashes(b"abc z").tolist()
    assert words.word_hashes(b"").size == 0


def test_base_counts_by_brute_force(spark, odd):
    rows = fertility.judge_texts(odd, MODEL).collect()
    assert len(rows) == len(ODD)
    by = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in rows}
    for key, text, _ in ODD:
        body = text or ""
        w = words_of(text)
        chars = sum(len(x.decode()) for x in w)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in body.split("\n") if x.encode().split()]
        r = by[(key, len(w), chars)]
        assert r["n_repeat_words"] == len(covered)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in body)
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_fertility_counts_tokens_of_words(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "the quick brown fox jumps over the lazy dog while the sun shines"
    row = fertility.judge_texts(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), MODEL).first()
    tokens = [t for w in text.split() for t in model.encode(w)]
    counts = Counter(tokens)
    entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in counts.values())
    assert row["n_tokens"] == len(tokens)
    assert row["chars_per_token"] == pytest.approx(len(text.replace(" ", "")) / len(tokens))
    assert row["token_spread"] == pytest.approx(entropy / math.log2(len(tokens)))
    assert row["kept"]


def test_fertility_rejects_marked_up_text(spark):
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = fertility.judge_texts(clean, MODEL).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in rows}
    assert kept[1] > 0.95 and kept[0] < 0.5


def test_encoding_round_trip(spark, odd):
    rows = spm.encode_texts(odd, MODEL).collect()
    assert len(rows) == len(ODD) and all(r["round_trip"] for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["ids"] is None and by[3]["ids"] == [] and by[2]["n_tokens"] == 0
    decoded = {r["doc_id"]: r["text"] for r in spm.decode_ids(spm.encode_texts(odd, MODEL), MODEL).collect()}
    assert decoded == {k: t for k, t, _ in ODD}


def test_long_words_and_odd_ids(spark, monkeypatch):
    """A word of a million characters, and ids that no text gives."""
    text = "xyz" * 350_000 + "é end"
    rows = spm.encode_texts(spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string"), MODEL)
    assert all(r["round_trip"] for r in rows.collect())
    size = len(spm.Vocabulary(MODEL).piece_bytes)
    odd = spark.createDataFrame([(1, [-1, -2]), (2, [300, None]), (3, [size]), (4, []), (5, None)], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in spm.decode_ids(odd, MODEL).collect()} == {1: None, 2: None, 3: None, 4: "", 5: None}
    words = sorted(spm.MARK + w for w in ("hello", "help", "xyzxyz", "é"))
    plain = spm.Vocabulary(MODEL).encode_sorted(words)
    monkeypatch.setattr(spm, "LONG_WORD", 3)
    assert spm.Vocabulary(MODEL).encode_sorted(words) == plain
    assert all(r["round_trip"] for r in spm.encode_texts(rows.select("doc_id", F.lit("hello help é xyz  a").alias("text")), MODEL).collect())


def brute_viterbi(vocabulary, word):
    """Best total score over all ways to cut a word."""
    best = [0] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        single = False
        for start in range(end):
            hit = vocabulary.ends.get(word[start:end])
            if hit:
                single = single or start == end - 1
                best[end] = max(best[end], best[start] + hit[0])
        if not single:
            best[end] = max(best[end], best[end - 1] + vocabulary.unknown)
    return best[-1]


def test_shared_prefixes_give_the_best_score():
    vocabulary = spm.Vocabulary(MODEL)
    rng = random.Random(1)
    pieces = [p for p, hit in vocabulary.ends.items() if hit and len(p) < 6]
    given = sorted({spm.MARK + "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))).replace(spm.MARK, "") for _ in range(300)} | {spm.MARK, spm.MARK + "日😀本"})
    score = {i: s for hit in vocabulary.ends.values() if hit for s, i in [hit]}
    for word, ids in zip(given, vocabulary.encode_sorted(given), strict=True):
        unknown = [c for c in word if not vocabulary.ends.get(c)]
        if not unknown:
            assert sum(score[i] for i in ids) == brute_viterbi(vocabulary, word)
        assert vocabulary.decode(ids) == word[1:].encode()


def test_stored_scores_agree_with_the_library():
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = pb.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.model_type = 1  # unigram, over the same pieces
    rank = 0
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = -math.log(rank + 10)
            rank += 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    given = sorted({spm.MARK + w for w in "thinking about subword units; Größe, éléphant 12345 and_so-on".split(" ")})
    assert [library.encode(w[1:]) for w in given] == spm.Vocabulary(MODEL).encode_sorted(given)


def test_license_windows_find_what_brute_force_finds(spark):
    rng = random.Random(2)
    filler = [f"w{k}" for k in range(200)]
    docs = []
    for k in range(120):
        body = [rng.choice(filler) for _ in range(rng.randint(0, 300))]
        for name in rng.sample(list(licenses.NOTICES), rng.randint(0, 3)):
            notice = licenses.NOTICES[name].split()
            for _ in range(rng.randint(0, 2)):
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = notice
        docs.append((k, " ".join(body)))
    docs += [(900, None), (901, ""), (902, "Released"), (None, "Released under the MIT License.")]
    found = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    expected = set()
    for key, text in docs:
        own = [w.lower() for w in (text or "").split()]
        for name, notice in licenses.NOTICES.items():
            n = [w.lower() for w in notice.split()]
            wanted = {tuple(n[i : i + 5]) for i in range(len(n) - 4)}
            width = len(wanted) + len(wanted) // 4
            runs = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
            if any(len(wanted & set(runs[i : i + width])) >= 0.8 * len(wanted) for i in range(max(1, len(runs) - width + 1))):
                expected.add((key, name))
    assert found <= expected
    # windows stand a step apart: a place may hold 80 % only in a window between two of them
    assert len(expected - found) <= 0.02 * len(expected)


def brute_lines(docs, limit=50):
    windows, gone = [], {i: set() for i, _ in docs}
    for i, text in sorted(docs):
        rows = [(p, x, len(x.encode().split())) for p, x in enumerate(text.split("\n")) if x.encode().split()]
        for kind, step in (("ahead", 1), ("behind", -1)):
            for a in range(len(rows)):
                total, b = 0, a
                while 0 <= b < len(rows):
                    total += rows[b][2]
                    if total >= limit:
                        low, high = min(a, b), max(a, b)
                        windows.append((i, rows[low][0], rows[high][0], (kind, *(r[1] for r in rows[low : high + 1]))))
                        break
                    b += step
    first = {}
    for w in sorted(windows, key=lambda w: w[:3]):
        first.setdefault(w[3], w)
    for i, low, high, content in windows:
        f = first[content]
        if f[:3] != (i, low, high):
            gone[i] |= set(range(max(low, f[2] + 1) if f[0] == i else low, high + 1))
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) for i, t in docs}


def test_repeated_runs_by_brute_force(spark):
    rng = random.Random(4)
    passages = [[" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 5))] for _ in range(12)]
    docs = []
    for k in range(60):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(passages) if rng.random() < 0.6 else [f"only here {k} " + " ".join(str(rng.random()) for _ in range(20)), ""]
        docs.append((k, "\n".join(lines)))
    rows = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows == brute_lines(docs)


def test_line_dedup_of_odd_tables(spark, odd):
    rows = linededup.dedup_lines(odd).collect()
    assert len(rows) == len(ODD) and {"score", "key", "n_deleted"} <= set(rows[0].asDict())
    assert all(r["text"] == t for r, t in zip(sorted(rows, key=lambda r: r["score"]), [t for _, t, _ in ODD], strict=True))
    assert linededup.dedup_lines(odd.limit(0)).count() == 0
    copies = spark.createDataFrame([(2, "w " * 60), (2, "w " * 60), (1, "w " * 60)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_deleted"]) for r in linededup.dedup_lines(copies).collect()) == [(1, 0), (2, 1), (2, 1)]


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op5_neighbours(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert [r["held_out"] for r in rows] == [zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_votes_by_brute_force(spark):
    """Each document's vote, from plain cosines with all labelled vectors of the space, one text at a time."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    labels = queries.quality_labels(spark, "/root/testdata/sf0.01")
    space = neighbours.Space()
    model = neighbours.fitted(docs, labels, space, "doc_id", "text")
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    kept = sorted(r["doc_id"] for r in labels.collect())
    marked = {r["doc_id"]: r["label"] for r in labels.collect()}
    assert model.labels.tolist() == [marked[k] for k in kept]

    def vector(text):
        row = neighbours.raw_features([text], space.terms)[0].astype(float) * model.idf
        parts = [row[: space.terms], row[space.terms :]]
        parts = [p / max(np.linalg.norm(p), 1e-12) for p in parts]
        v = np.concatenate([parts[0], space.classes * parts[1]]) @ model.axes
        return v / max(np.linalg.norm(v), 1e-12)

    known = [vector(texts[k]) for k in kept]
    rows = {r["doc_id"]: r for r in neighbours.score_texts(docs, labels).collect()}
    assert set(rows) == set(texts)
    for key in sorted(texts)[::3]:
        v = vector(texts[key])
        best = sorted(((round(float(v @ u), 9), -i) for i, u in enumerate(known)), reverse=True)[: space.k]
        weights = [max(c, 0) ** space.power for c, _ in best]
        want = sum(w * marked[kept[-i]] for w, (_, i) in zip(weights, best, strict=True)) / sum(weights)
        assert rows[key]["score"] == pytest.approx(want, abs=1e-6)


def test_classifier_of_odd_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (7, 0), (None, 1), (99, 1)], "doc_id long, label int")
    rows = neighbours.score_texts(odd, labels).collect()
    assert len(rows) == len(ODD)
    assert all(r["score"] == pytest.approx(1 / 3) for r in rows if r["doc_id"] in (2, 3))
    assert {r["score"] for r in neighbours.score_texts(odd, labels.limit(0)).collect()} == {1.0}
    assert neighbours.score_texts(odd.limit(0), labels).count() == 0


def test_text_operators_of_empty_tables(odd):
    none = odd.limit(0)
    assert fertility.judge_texts(none, MODEL).count() == spm.encode_texts(none, MODEL).count() == licenses.scan_licenses(none).count() == 0
