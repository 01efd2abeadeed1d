"""Whole texts as 64-bit word hashes, by vectorised passes over their UTF-8 bytes.

Words are runs of anything but the six ASCII white-space characters. A word's hash is a
polynomial of random byte values modulo 2**64, mixed. Two different words of a text of n
words share a hash with a chance of about n**2 / 2**64; counts made on hashes are exact
up to that.
"""

from __future__ import annotations

import numpy as np

SPACES = b" \t\n\v\f\r"
#: Bytes that are hashed at once; a text is cut at white space, so memory doesn't follow its length.
SEGMENT = 1 << 17

_U = np.uint64
_rng = np.random.default_rng(20240601)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_SPACE_BYTES = tuple(SPACES[k : k + 1] for k in range(len(SPACES)))
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SEGMENT, 1 << (n - 1).bit_length())
    if size not in _powers:
        if size > SEGMENT:
            _powers.clear()  # one odd size at a time
        with np.errstate(over="ignore"):
            up, down = np.full(size, _BASE, _U), np.full(size, pow(_BASE, -1, 1 << 64), _U)
            up[0] = down[0] = 1
            _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hashed(segment: bytes, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(segment, np.uint8)
    space = np.empty(codes.size + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _IS_SPACE[codes]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = _power_table(codes.size)
    sums = np.empty(codes.size + 1, _U)
    sums[0] = 0
    np.cumsum(values[codes] * up[: codes.size], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts, ends


def hashed_words(text: bytes, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word in order; with `fold`, A-Z count as a-z."""
    values = _FOLDED if fold else _VALUES
    parts, at = [], 0
    while at < len(text):
        end = at + SEGMENT
        if end < len(text):
            cut = max(text.rfind(c, at, end) for c in _SPACE_BYTES)
            if cut < at:  # one long word
                cut = min((k for c in _SPACE_BYTES if (k := text.find(c, end)) >= 0), default=len(text) - 1)
            end = cut + 1
        hashes, starts, ends = _hashed(text[at:end], values)
        parts.append((hashes, starts + at, ends + at))
        at = end
    if not parts:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64)
    return parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts, strict=True)))


def word_hashes(text: bytes, fold: bool = False) -> np.ndarray:
    return hashed_words(text, fold)[0]


class Piece:
    """Some whole texts as one buffer: `hashes`, `starts`, `ends` and `doc` of all their words."""

    def __init__(self, texts: list[bytes], fold: bool = False) -> None:
        self.n = len(texts)
        self.buffer = b"\n".join(texts)
        self.doc_start = np.zeros(self.n + 1, np.int64)
        np.cumsum([len(x) + 1 for x in texts], out=self.doc_start[1:])
        self.hashes, self.starts, self.ends = hashed_words(self.buffer, fold)
        self.doc = np.searchsorted(self.doc_start, self.starts, "right") - 1
        self.words = np.bincount(self.doc, minlength=self.n)
        #: where each text's words begin
        self.first = np.concatenate(([0], np.cumsum(self.words)))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each run of n words within one text, and the place of its first word."""
        runs = shingle_hashes(self.hashes, n)
        inside = np.flatnonzero(self.doc[: runs.size] == self.doc[n - 1 :]) if runs.size else np.empty(0, np.int64)
        return runs[inside], inside

    def per_text(self, of_byte: np.ndarray) -> np.ndarray:
        """The sum of `of_byte[b]` over the bytes b of each text."""
        sums = np.zeros(len(self.buffer) + 2, np.int64)
        np.cumsum(of_byte[np.frombuffer(self.buffer, np.uint8)], out=sums[1:-1])
        sums[-1] = sums[-2]
        return sums[self.doc_start[1:]] - sums[self.doc_start[:-1]]


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words, in order; none for fewer words."""
    if words.size < n:
        return np.empty(0, _U)
    total = np.zeros(words.size - n + 1, _U)
    for k in range(n):
        total = total * _U(0xD6E8FEB86659FD93) + words[k : words.size - n + 1 + k]
    return mixed(total)
