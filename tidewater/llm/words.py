"""Word boundaries and 64-bit word hashes of whole texts, vectorised over the text's bytes.

A word is a run of bytes other than ASCII white space. Its hash is a polynomial over random byte
values modulo 2**64, read off prefix sums, then mixed; equal words have equal hashes everywhere.
Texts go through in pieces that end between words, so memory doesn't follow a text's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACES = re.compile(rb"[\x09-\x0d\x20]")
_BYTE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_power = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _inverse
    if len(_power) < n:
        size = max(n, 1 << 14)
        ones = np.full(size, 1, np.uint64)
        ones[1:] = np.uint64(_BASE)
        _power = np.multiply.accumulate(ones)
        ones[1:] = np.uint64(_INVERSE)
        _inverse = np.multiply.accumulate(ones)
    return _power, _inverse


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while len(raw) - at > PIECE:
        found = _SPACES.search(raw, at + PIECE)
        end = found.start() if found else len(raw)
        yield at, raw[at:end]
        at = end
    yield at, raw[at:]


def spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(inside))
    return edge[::2], edge[1::2]


def located_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``raw`` starts, and its hash, in order."""
    where, out = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at, piece in _pieces(raw):
        starts, ends = spans(piece)
        if len(starts):
            power, inverse = _powers(len(piece) + 1)
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTE[np.frombuffer(piece, np.uint8)] * power[: len(piece)], out=total[1:])
            where.append(starts + at)
            out.append(mix((total[ends] - total[starts]) * inverse[starts]))
    return np.concatenate(where), np.concatenate(out)


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """The hash of each word, in order; none for a null text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return located_hashes(raw.translate(LOWER) if lower else raw)[1]


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` words; of the whole sequence where it is shorter; none without words."""
    n = min(n, len(words))
    if not n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j : len(words) - n + 1 + j]
    return mix(out + np.uint64(n))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
