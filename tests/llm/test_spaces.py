"""Whole texts with runs of spaces, against the library and by score."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from samplewright.llm import queries, spm

MODEL = queries.PIECE_MODEL
CODE = "def f(x):\n    if x  >  1:\n        return   x\n\n                            # far in\n"
TEXTS = [
    CODE,
    "a   b",
    " a",
    "a ",
    "  ",
    " ",
    "   two    four     five " + " " * 40 + "x",
    "name      count   share\nalpha         12    0.5\nbeta           7    0.25",
    "thinking  about subword   units",
]


@pytest.fixture(scope="module")
def library():
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
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def score(vocabulary, ids):
    by_id = {i: s for hit in vocabulary.ends.values() if hit for s, i in [hit]}
    return sum(by_id.get(i, 0) for i in ids)


def test_runs_of_spaces_as_the_library_encodes_them(library):
    encoder = spm.Encoder(MODEL, "rank")
    rng = random.Random(5)
    words = CODE.split() + "some plain words of a table 12 0.5".split()
    texts = TEXTS + ["".join(" " * rng.randint(0, 20) + rng.choice(words) for _ in range(30)) for _ in range(100)]
    same = 0
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        ids, theirs = np.frombuffer(packed, np.int32).tolist(), library.encode(text)
        # where the library takes another path, it is a tie up to its 32-bit scores
        assert score(encoder.vocabulary, ids) >= score(encoder.vocabulary, theirs)
        assert score(encoder.vocabulary, ids) - score(encoder.vocabulary, theirs) < 100
        assert encoder.vocabulary.decode(ids) == text.encode()
        same += ids == theirs
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(TEXTS)] == [library.encode(x) for x in TEXTS]
    print("whole texts with the library's ids:", same, "of", len(texts))


def test_round_trip_of_spaces(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded = spm.encode_texts(docs, MODEL)
    assert all(r["round_trip"] for r in encoded.collect())
    assert {r["doc_id"]: r["text"] for r in spm.decode_ids(encoded, MODEL).collect()} == dict(enumerate(TEXTS))
