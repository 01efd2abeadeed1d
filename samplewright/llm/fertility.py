"""Quality rules: text counts, and tokeniser fertility within bands for a language or script.

Public vocabularies cut each text's words into tokens. Natural text keeps, for its
language, to a band of characters per token, uses few byte-fallback tokens and spreads
over many tokens; mark-up, shouting and repetition don't.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.arrow import as_bytes, pieces
from samplewright.llm.words import SPACES, Piece, mixed

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Words whose tokens are kept from one piece of a batch to the next: about 50 bytes each.
CACHE_WORDS = 500_000
#: Characters of a word that a byte-level vocabulary merges at once.
LONG_WORD = 512


#: Tokens, as powers of two, at which a band gives its lower edges.
POWERS = tuple(range(5, 13))


@dataclass(frozen=True)
class Band:
    """Limits of a language or script; a text outside one of them is rejected.

    chars_per_token: code points in words for each token. byte_share: byte-fallback
    tokens of all. spread: entropy of the tokens in bits over that of as many tokens
    without repetition, log2(n). Both scatter and fall with a text's length, so a lower
    edge may be given for each of POWERS: between them it follows log2(n), beyond them
    the characters stay and the entropy in bits does. Where it is one number, texts
    under `short` tokens are held to the characters per token with a fifth of room.
    """

    chars_low: float | tuple[float, ...]
    chars_high: float
    byte_high: float
    spread_low: float | tuple[float, ...]
    short: int = 64


#: For a text of a language and script without a band: no limit.
OPEN = Band(0.0, math.inf, 1.0, 0.0)
#: By language code, then by script ("latin", "other"): what the text is taken for if its language has no band.
#: Lower edges of the four languages: the 0.5 % quantile of clean texts by their length (labelled documents of
#: sf0.1 that aren't held out), and for the spread not above 0.78, 0.775, 0.765 at the first three, as in pieces
#: of licenses, which are real English and repeat more in so few words.
BANDS: dict[str, Band] = {
    "en": Band((1.62, 1.8, 1.92, 2.01, 2.07, 2.11, 2.14, 2.17), 6.5, 0.03, (0.78, 0.775, 0.765, 0.751, 0.702, 0.653, 0.604, 0.555)),
    "de": Band((1.6, 1.79, 1.92, 2.02, 2.08, 2.13, 2.16, 2.19), 6.5, 0.03, (0.78, 0.775, 0.765, 0.73, 0.68, 0.63, 0.582, 0.533)),
    "fr": Band((1.45, 1.61, 1.71, 1.79, 1.85, 1.89, 1.9, 1.9), 6.5, 0.03, (0.78, 0.775, 0.765, 0.725, 0.675, 0.625, 0.577, 0.529)),
    "es": Band((1.46, 1.6, 1.7, 1.77, 1.82, 1.85, 1.88, 1.89), 6.5, 0.03, (0.78, 0.775, 0.765, 0.733, 0.682, 0.633, 0.586, 0.54)),
    "latin": Band(1.50, 7.0, 0.05, 0.42),
    "other": Band(0.25, 7.0, 0.95, 0.35),
}


def scaled(band: Band, chars: float) -> Band:
    """The band with its lower edges of characters per token times `chars`, for a vocabulary of larger tokens."""
    low = band.chars_low
    return replace(band, chars_low=tuple(round(x * chars, 3) for x in low) if isinstance(low, tuple) else low * chars)


#: For the byte-level vocabulary of many languages. The factors are what 99.8 % of the clean texts that the
#: edges above come from reach beyond them, rounded down to hundredths.
MULTI_BANDS: dict[str, Band] = {k: scaled(BANDS[k], x) for k, x in {"en": 1.01, "de": 1.03, "fr": 1.03, "es": 1.06}.items()}


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1
#: bytes that begin a code point and aren't white space
_LETTER = np.array([(b & 0xC0) != 0x80 and b not in SPACES for b in range(256)], np.int64)


def base_counts(piece: Piece, texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each text that need no vocabulary; see `judge_texts`."""
    runs, at = piece.shingles(WINDOW)
    with np.errstate(over="ignore"):
        own = mixed(runs + piece.doc[at].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    ordered = np.sort(own)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    steps = np.zeros(piece.hashes.size + 1, np.int64)
    if twice.size:
        found = at[twice[np.minimum(np.searchsorted(twice, own), twice.size - 1)] == own]
        steps[:-1] += np.bincount(found, minlength=steps.size - 1)
        steps -= np.bincount(found + WINDOW, minlength=steps.size)
    lines = [[x for x in text.split(b"\n") if x.strip()] for text in texts]
    return {
        "n_words": piece.words,
        "word_chars": piece.per_text(_LETTER),
        "n_symbols": piece.per_text(_SYMBOL),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": np.bincount(piece.doc[np.cumsum(steps[:-1]) > 0], minlength=piece.n),
    }


class Pieces:
    """A SentencePiece vocabulary; byte-fallback tokens are its byte pieces."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(len(self.model))])

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


class Ranks:
    """A byte-level vocabulary in a file of ranks; byte-fallback tokens are single bytes of longer characters."""

    def __init__(self, rank_file: str) -> None:
        import base64

        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # (?s).+ takes a word whole, since it is given one at a time
        self.model = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
        self.is_byte[[rank for token, rank in ranks.items() if len(token) == 1 and token[0] >= 0x80]] = True

    def encode(self, words: list[str]) -> list[list[int]]:
        # merges take time by the square of a word's length, so a long one goes in parts
        return [[t for k in range(0, len(w) + 1, LONG_WORD) for t in self.model.encode_ordinary((" " + w)[k : k + LONG_WORD])] for w in words]


class Fertility:
    """Token statistics of texts from a vocabulary, word by word.

    Each word is encoded by itself, as after a space. The tokens of up to CACHE_WORDS
    distinct words are kept, as arrays sorted by the word's hash.
    """

    def __init__(self, model_file: str) -> None:
        self.model = Ranks(model_file) if model_file.endswith(".tiktoken") else Pieces(model_file)
        self.is_byte = self.model.is_byte
        self.forget()

    def forget(self) -> None:
        self.word = np.empty(0, np.uint64)
        self.start, self.size, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def learn(self, piece: Piece) -> np.ndarray:
        """The place of each of the piece's words among the known ones, once they are known."""
        words, example, which = np.unique(piece.hashes, return_index=True, return_inverse=True)
        if self.word.size + words.size > CACHE_WORDS:
            self.forget()
        new = np.flatnonzero(~np.isin(words, self.word, assume_unique=True))
        for k in range(0, new.size, 20_000):
            some = new[k : k + 20_000]
            texts = [piece.buffer[a:b].decode("utf-8", "replace") for a, b in zip(piece.starts[example[some]], piece.ends[example[some]], strict=True)]
            tokens = self.model.encode(texts)
            size = np.fromiter(map(len, tokens), np.int64, len(tokens))
            start = self.flat.size + np.cumsum(size) - size
            self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(tokens), np.int32, int(size.sum()))))
            self.word, self.start, self.size = (np.concatenate(x) for x in ((self.word, words[some]), (self.start, start), (self.size, size)))
        if new.size:
            order = np.argsort(self.word, kind="stable")
            self.word, self.start, self.size = self.word[order], self.start[order], self.size[order]
        return np.searchsorted(self.word, words)[which]

    def measure(self, at: np.ndarray, chars: int) -> tuple[int, float, float, float]:
        """Tokens, characters per token, byte-fallback share and spread, of the words at these places."""
        size = self.size[at]
        n = int(size.sum())
        if not n:
            return 0, 0.0, 0.0, 0.0
        ends = np.cumsum(size)
        tokens = self.flat[np.arange(n) + np.repeat(self.start[at] - ends + size, size)]
        counts = np.bincount(tokens, minlength=self.is_byte.size)
        by_bytes = int(counts[self.is_byte].sum())
        counts = counts[counts > 0]
        shares = counts / n
        entropy = float(-(shares * np.log2(shares)).sum())
        return n, chars / n, by_bytes / n, entropy / math.log2(n) if n > 1 else 0.0


@lru_cache(maxsize=4)
def _fertility(model_file: str) -> Fertility:
    return Fertility(model_file)


def script_of(text: bytes) -> str:
    """"latin" if most letters-or-more of the text are below U+0250, else "other"."""
    # UTF-8 lead bytes: below 0x80 one code point each, 0xC2 to 0xC9 those up to U+024F
    codes = np.frombuffer(text, np.uint8)
    low = int(((codes < 0x80) & (codes > 0x20)).sum()) + int(((codes >= 0xC2) & (codes <= 0xC9)).sum())
    high = int((codes >= 0xCA).sum())
    return "latin" if low >= high else "other"


def within(band: Band, tokens: int, chars_per_token: float, byte_share: float, spread: float) -> bool:
    room = 0.8 if tokens < band.short else 1.0
    power = math.log2(max(tokens, 1))
    chars, least = band.chars_low, band.spread_low
    chars = np.interp(power, POWERS, chars) if isinstance(chars, tuple) else chars * room
    if isinstance(least, tuple):
        least = np.interp(power, POWERS, least) * min(1.0, POWERS[-1] / max(power, 1.0))
    return bool(chars <= chars_per_token <= band.chars_high / room and byte_share <= band.byte_high and spread >= least)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]
_SHARES = ["chars_per_token", "byte_share", "token_spread"]


def judge_texts(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", lang: str = "lang", bands: dict[str, Band] | None = None, more: dict[str, dict[str, Band]] | None = None) -> DataFrame:
    """One row for each document: key, counts, token statistics, base_failed, kept, more_chars_per_token.

    n_words; word_chars: code points in words; n_symbols: characters of `#*$%&|<>`;
    n_dup_lines: lines with a word that equal an earlier line; n_repeat_words: words in
    windows of five words that are found twice or more in the text. base_failed: fewer
    than 10 words, or over 20 % of them repeated. kept: not base_failed and within the
    band of the language, or of the script if the language is null or unknown, by each
    vocabulary: `model_file` with `bands`, and the files of `more` with theirs, whose
    characters per token are `more_chars_per_token`. A file that ends in .tiktoken holds
    the ranks of a byte-level vocabulary, any other is a SentencePiece model.

    With neither band, only the base rules hold. Null and empty texts count as texts
    without words, and fail. Repeated rows are judged alike, each a row. A text is measured
    whole; a task needs about 100 bytes for each of a text's. Columns other than key, text and
    lang aren't read. An empty table gives no rows. `model_file` is a path that the
    executors can open, or the name of a file added with SparkContext.addFile.
    """
    limits = [(model_file, BANDS if bands is None else bands), *(more or {}).items()]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = [(_fertility(f if "/" in f else SparkFiles.get(f)), b) for f, b in limits]
        for piece in pieces(batches, "text"):
            texts = [x or b"" for x in as_bytes(piece.column("text"))]
            words = Piece(texts)
            counts = base_counts(words, texts)
            places = [v.learn(words) for v, _ in vocabularies]
            failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
            rows = []
            for k, (body, code) in enumerate(zip(texts, piece.column("lang").to_pylist(), strict=True)):
                own = slice(words.first[k], words.first[k + 1])
                measured = [v.measure(at[own], int(counts["word_chars"][k])) for (v, _), at in zip(vocabularies, places, strict=True)]
                fits = all(within(b.get(code) or b.get(script_of(body), OPEN), *m) for (_, b), m in zip(vocabularies, measured, strict=True))
                rows.append((*measured[0], bool(failed[k]), not failed[k] and fits, [m[1] for m in measured[1:]]))
            out = {**counts, **dict(zip(("n_tokens", *_SHARES, "base_failed", "kept", "more_chars_per_token"), zip(*rows, strict=True), strict=True))}
            types = [pa.int64()] * len(_COUNTS) + [pa.float64()] * len(_SHARES) + [pa.bool_()] * 2 + [pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([piece.column("key"), *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))], names=["key", *out])

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    fields = [f"key {slim.schema['key'].dataType.simpleString()}", *(f"{c} long" for c in _COUNTS), *(f"{c} double" for c in _SHARES), "base_failed boolean", "kept boolean", "more_chars_per_token array<double>"]
    return slim.mapInArrow(judged, ", ".join(fields)).withColumnRenamed("key", key)
