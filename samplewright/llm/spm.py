"""SentencePiece encoding and decoding by a Viterbi search that common prefixes share.

A text's words, each with the marks U+2581 of all spaces before it, are encoded by
themselves: pieces hold marks at their start only, or nothing else. The distinct marked
words of a batch, sorted, are the leaves of a trie; walked depth-first, a word starts
from the forward scores of the prefix that it shares with the one before.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.arrow import pieces

MARK = "▁"
#: Stands for a literal U+2581; it can't occur in valid UTF-8.
LITERAL_MARK = "\ud800"
#: Words whose ids are kept from one piece of a batch to the next: about 200 bytes each.
CACHE_WORDS = 200_000
#: Longer words keep their forward scores packed, 16 bytes a character, and texts are decoded so many ids at once.
LONG_WORD = 1 << 16
MILLION = 1_000_000


class Vocabulary:
    """Pieces and scores of a SentencePiece model file.

    scores: "stored" takes the file's scores (log probabilities, for a unigram model);
    "rank" is for a file of merges, whose scores are ranks only: piece number r gets
    -log(r + 10), its log probability up to a constant under Zipf's law.
    Characters without a piece cost ten more than the worst piece, and become bytes.
    Scores are kept in millionths, as integers, so that sums and ties are exact.
    """

    def __init__(self, model_file: str, scores: str = "rank") -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if scores not in ("rank", "stored"):
            raise ValueError(f"unknown scores: {scores}")
        self.byte_ids, self.piece_bytes = [0] * 256, []
        found: dict[str, tuple[int, int]] = {}
        rank = 0
        for i in range(len(model)):
            piece, body = model.id_to_piece(i), b""
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], body = i, bytes([value])
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                body = piece.replace(MARK, " ").encode()
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"a piece with a space after a letter: {piece}")
                score = -math.log(rank + 10) if scores == "rank" else model.get_score(i)
                found[piece] = (round(score * MILLION), i)
                rank += 1
            self.piece_bytes.append(body)
        self.unknown = min((s for s, _ in found.values()), default=0) - 10 * MILLION
        #: every piece, and every end of one as None
        self.ends: dict[str, tuple[int, int] | None] = {p[k:]: None for p in found for k in range(1, len(p))} | found

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in (MARK if char == LITERAL_MARK else char).encode()]

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """The ids of marked words in sorted order; a tie goes to the longer last piece."""
        ends, unknown = self.ends, self.unknown
        # for each prefix of the word before: score, length and id of its last piece (-1: bytes)
        score, size, last = [0], [0], [0]
        if any(len(word) > LONG_WORD for word in words):
            score, size, last = array("q", score), array("i", size), array("i", last)
        previous, out = "", []
        for word in words:
            shared = 0
            for a, b in zip(previous, word, strict=False):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], size[shared + 1 :], last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, best_size, best_id, start, single = -math.inf, 1, -1, end - 1, False
                while start >= 0:
                    hit = ends.get(word[start:end], 0)
                    if hit == 0:
                        break
                    if hit is not None:
                        value = score[start] + hit[0]
                        single = single or start == end - 1
                        if value >= best:
                            best, best_size, best_id = value, end - start, hit[1]
                    start -= 1
                if not single and (value := score[end - 1] + unknown) > best:
                    best, best_size, best_id = value, 1, -1
                score.append(best)
                size.append(best_size)
                last.append(best_id)
            ids, end = [], len(word)
            while end:
                if last[end] >= 0:
                    ids.append(last[end])
                else:
                    ids.extend(reversed(self.bytes_of(word[end - 1])))
                end -= size[end]
            ids.reverse()
            out.append(ids)
            previous = word
        return out

    def decode(self, ids: list[int]) -> bytes | None:
        """The text's bytes; the first word's mark stands for no space. None for a null or unknown id."""
        table = self.piece_bytes
        try:
            if ids and min(ids) < 0:
                return None
            return b"".join([table[i] for i in ids])[1:]
        except (IndexError, TypeError):
            return None

    def returns(self, ids: np.ndarray, text: bytes) -> bool:
        """Whether the ids decode to the text, in parts."""
        table, at = self.piece_bytes, -1
        for start in range(0, len(ids), LONG_WORD):
            part = b"".join([table[i] for i in ids[start : start + LONG_WORD].tolist()])
            part, at = (part[1:], 0) if at < 0 else (part, at)
            if text[at : at + len(part)] != part:
                return False
            at += len(part)
        return max(at, 0) == len(text)


_UNIT = re.compile(" +[^ ]*")


def units(text: str) -> list[str]:
    """The words of a text that isn't empty, each after its spaces but the first one."""
    if "  " in text or text[0] == " ":
        return [unit[1:] for unit in _UNIT.findall(" " + text)]
    return text.split(" ")


class Encoder:
    """A vocabulary with the ids of recent words and the spaces before them, packed as 32-bit integers."""

    def __init__(self, model_file: str, scores: str) -> None:
        self.vocabulary = Vocabulary(model_file, scores)
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in words if w in self.known}
        new = sorted((len(w) > LONG_WORD, MARK + w.replace(" ", MARK)) for w in words if w not in self.known)
        for k in range(0, len(new), 10_000):  # so that lists of ids don't pile up
            some = [w for _, w in new[k : k + 10_000]]
            self.known.update((w[1:].replace(MARK, " "), np.array(ids, np.int32).tobytes()) for w, ids in zip(some, self.vocabulary.encode_sorted(some), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids; none for null and empty texts."""
        parts = [units(x.replace(MARK, LITERAL_MARK)) if x else [] for x in texts]
        self.learn(set().union(*parts))
        return [b"".join(map(self.known.__getitem__, p)) for p in parts]


@lru_cache(maxsize=1)
def _encoder(model_file: str, scores: str) -> Encoder:
    return Encoder(model_file if "/" in model_file else SparkFiles.get(model_file), scores)


def encode_texts(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", scores: str = "rank") -> DataFrame:
    """One row for each document: key, ids, n_tokens, round_trip (the ids decode to exactly the text).

    Null texts have null ids, empty ones none; both have 0 tokens and round_trip true. A
    literal U+2581 becomes its three bytes, so that every text returns exactly. Of equally
    good ways to cut a word, the one with the longer last piece is taken. Repeated rows are
    encoded alike, each a row; an empty table gives none. Texts are encoded whole; memory
    is a few times the longest, some 40 times for one without spaces. Other columns
    aren't read.
    `model_file` is a path that the executors can open, or the name of a file added with
    SparkContext.addFile.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_file, scores)
        returns = encoder.vocabulary.returns
        for piece in pieces(batches, "text"):
            texts = piece.column("text").to_pylist()
            packed = encoder.encode(texts)
            ids = np.frombuffer(b"".join(packed), np.int32)
            counts = np.array([len(x) // 4 for x in packed], np.int64)
            edges = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            whole = [not x or returns(ids[a:b], x.encode()) for x, a, b in zip(texts, edges[:-1], edges[1:], strict=True)]
            empty = pa.array([x is None for x in texts] + [False])
            offsets = pa.array(edges, pa.int32(), mask=np.asarray(empty))
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(counts), pa.array(whole)], names=["key", "ids", "n_tokens", "round_trip"])

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(encoded, f"key {slim.schema['key'].dataType.simpleString()}, ids array<int>, n_tokens long, round_trip boolean").withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, model_file: str, key: str = "doc_id", ids: str = "ids", scores: str = "rank") -> DataFrame:
    """key and text of each row of ids; null for null ids, empty for none.

    A row with a null or negative id, or one beyond the vocabulary, has a null text.
    Repeated rows are decoded alike; an empty table gives no rows; other columns aren't read.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _encoder(model_file, scores).vocabulary.decode
        for batch in batches:
            bodies = [None if x is None else decode(x) for x in batch.column("ids").to_pylist()]
            texts = [None if x is None else x.decode("utf-8", "replace") for x in bodies]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], names=["key", "text"])

    slim = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return slim.mapInArrow(decoded, f"key {slim.schema['key'].dataType.simpleString()}, text string").withColumnRenamed("key", key)
