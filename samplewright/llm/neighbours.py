"""Quality classifier: nearest labelled neighbours in a latent-semantic space vote.

A text is a bag of hashed byte trigrams and of trigrams of byte classes (capital, digit,
symbol, blank, ...), weighted by tf-idf. A truncated singular value decomposition of a
bounded sample of labelled texts gives the latent space; the sample's vectors, with
their labels, are broadcast. Every text's vector is multiplied, in blocks, with all of
them: exact cosines. Its `k` nearest vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplewright.llm.arrow import as_bytes, pieces


@dataclass(frozen=True)
class Space:
    """Limits of the model: they bound what is collected for the fit and what is broadcast.

    sample: labelled texts at most; terms: hashed trigrams; dims: of the latent space;
    k: neighbours; power: of the similarity that weighs a vote; classes: the length of
    the class trigrams' part of a vector, where the byte trigrams' is 1.
    """

    sample: int = 4096
    terms: int = 4096
    dims: int = 48
    k: int = 15
    power: float = 4.0
    classes: float = 0.4


#: Classes of bytes; what is left, small letters above all, is the class 0.
_CLASSES = [
    [*range(65, 91)],  # capitals
    [*range(48, 58)],  # digits
    [*b".,;:?'\"-()"],  # usual punctuation
    [*b"!"],
    [*b"#*$%&<>=+~^_@\\/[]{}`"],  # symbols
    [*b"|"],
    [*b" \t\n\v\f\r"],
    [*range(128, 256)],
]
_CLASS_OF = np.zeros(256, np.int64)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[_members] = _k + 1
CLASS_TERMS = (len(_CLASSES) + 1) ** 3
#: Bytes of a text that are hashed at once, and texts and rows that are multiplied at once.
_PART = 1 << 18
_BLOCK = 128
#: Log counts are kept as bytes, in steps of 1/24: up to a count of 40,000, rounded to 4 %.
_STEPS = 24


def _trigram_counts(text: bytes, terms: int) -> np.ndarray:
    """Counts of hashed byte trigrams, then of class trigrams."""
    counts = np.zeros(terms + CLASS_TERMS, np.int64)
    for at in range(0, len(text) - 2, _PART):
        b = np.frombuffer(text, np.uint8, min(_PART + 2, len(text) - at), at)
        c, b = _CLASS_OF[b], b.astype(np.uint32)
        key = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)
        key ^= key >> np.uint32(15)
        counts[:terms] += np.bincount((key * np.uint32(0x27D4EB2F) >> np.uint32(12)) % terms, minlength=terms)
        side = len(_CLASSES) + 1
        counts[terms:] += np.bincount((c[:-2] * side + c[1:-1]) * side + c[2:], minlength=CLASS_TERMS)
    return counts


def raw_features(texts: list[bytes], terms: int) -> np.ndarray:
    """Log counts in steps, one row for each text; zero for one of fewer than three bytes."""
    out = np.zeros((len(texts), terms + CLASS_TERMS), np.uint8)
    for k, text in enumerate(texts):
        out[k] = np.minimum(np.rint(_STEPS * np.log1p(_trigram_counts(text, terms))), 255)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model:
    """The fitted space with its labelled vectors; a few MB, whatever the corpus.

    The fit reads the sample's features, one byte each, in blocks of rows.
    """

    def __init__(self, features: np.ndarray, labels: np.ndarray, space: Space) -> None:
        self.space, self.labels = space, labels.astype(np.float64)
        self.prior = float(labels.mean()) if labels.size else 1.0
        if not labels.size:
            return
        seen = np.count_nonzero(features, axis=0)
        idf = np.log((1 + len(features)) / (1 + seen))
        self.idf = idf
        starts = range(0, len(features), _BLOCK)
        times = lambda m: np.concatenate([self._weighed(features[at : at + _BLOCK]) @ m for at in starts])
        turned = lambda m: sum(self._weighed(features[at : at + _BLOCK]).T @ m[at : at + _BLOCK] for at in starts)
        rng = np.random.default_rng(11)
        width = min(space.dims + 16, *features.shape)
        # randomised range finder with two power steps
        basis = np.linalg.qr(times(rng.standard_normal((features.shape[1], width))))[0]
        for _ in range(2):
            basis = np.linalg.qr(times(np.linalg.qr(turned(basis))[0]))[0]
        right = np.linalg.svd(turned(basis).T, full_matrices=False)[2]
        self.axes = np.ascontiguousarray(right[: space.dims].T)
        self.vectors = _unit(times(self.axes))

    def _weighed(self, features: np.ndarray) -> np.ndarray:
        """tf-idf byte trigrams of length 1, beside class trigrams of length `classes`."""
        out = features * self.idf
        terms = self.space.terms
        out[:, :terms] = _unit(out[:, :terms])
        out[:, terms:] = _unit(out[:, terms:]) * self.space.classes
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The share of label 1 among the nearest, by similarity; the sample's share for texts without features."""
        out = np.full(len(texts), self.prior)
        n = self.labels.size
        if not n:
            return out
        k = min(self.space.k, n)
        for at in range(0, len(texts), _BLOCK):
            cosines = _unit(self._weighed(raw_features(texts[at : at + _BLOCK], self.space.terms)) @ self.axes) @ self.vectors.T
            # cosines to nine places, ties to the earlier vector: one integer, so that the order is total
            order = np.rint(cosines * 1e9).astype(np.int64) * n - np.arange(n)
            near = np.argpartition(order, n - k, axis=1)[:, n - k :]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(order, near, axis=1), axis=1), axis=1)
            weights = np.maximum(np.round(np.take_along_axis(cosines, near, axis=1), 9), 0) ** self.space.power
            total = weights.sum(axis=1)
            voted = (weights * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
            out[at : at + _BLOCK] = np.where(total > 0, np.clip(voted, 0, 1), self.prior)
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, space: Space, key: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most `space.sample` labelled texts, those of least hash of the key.

    `labels` has key and label; a key of several rows counts as their mean, rounded.
    """
    rows = labels.where(F.col(key).isNotNull() & F.col("label").isNotNull()).groupBy(F.col(key).alias("_key")).agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    chosen = rows.orderBy(F.xxhash64("_key"), "_key").limit(space.sample)
    terms = space.terms

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            made = raw_features([x or b"" for x in as_bytes(piece.column("text"))], terms)
            yield pa.RecordBatch.from_arrays([piece.column("_key"), piece.column("label"), pa.array([r.tobytes() for r in made], pa.binary())], names=["_key", "label", "features"])

    # `chosen` has at most space.sample rows of two numbers
    texts = docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(chosen), F.col(key) == F.col("_key")).select("_key", "label", "text")
    one = texts.groupBy("_key").agg(F.min(F.struct(F.xxhash64("text"), "label", "text")).alias("_r")).select("_key", "_r.label", "_r.text")
    found = one.mapInArrow(featured, f"_key {one.schema['_key'].dataType.simpleString()}, label int, features binary").orderBy("_key").toArrow()
    features = np.empty((len(found), terms + CLASS_TERMS), np.uint8)
    for k, row in enumerate(found["features"]):
        features[k] = np.frombuffer(row.as_buffer(), np.uint8)
    return features, found["label"].to_numpy()


def fitted(docs: DataFrame, labels: DataFrame, space: Space, key: str, text: str) -> Model:
    return Model(*labelled_sample(docs, labels, space, key, text), space)


def score_texts(docs: DataFrame, labels: DataFrame, space: Space = Space(), key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row for each document: key, score, predicted.

    `labels` (key, label 0 or 1) are what may be learned from. score: from 0 to 1, the
    higher, the likelier label 1; predicted: 1 from `threshold` on. Null and empty texts
    get the share of label 1 in the sample, as do texts of fewer than three bytes; without
    any label every score is 1. Neighbours equally near to nine places count in the order
    of their keys, so a text's score doesn't depend on the rows beside it, and repeated
    rows score alike. A key of several labelled texts is learned from the one of least
    hash. Texts are read whole, in parts; other columns aren't read. An empty table gives
    no rows.
    """
    return predict(docs.select(key, text), labels, space, key, text, threshold).drop(text)


def predict(docs: DataFrame, labels: DataFrame, space: Space = Space(), key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """`docs` with `score` and `predicted`, as `score_texts` gives them; columns of these names are replaced."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, space, key, text))
    others = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            scores = model.value.scores([x or b"" for x in as_bytes(piece.column(text))])
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))], names=[*piece.schema.names, "score", "predicted"])

    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in others), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*[F.col(f"`{f.name}`") for f in others]).mapInArrow(scored, schema)
