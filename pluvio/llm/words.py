"""Hashes of the words and shingles of many texts at once, in numpy.

All texts of a call are laid end to end and hashed with prefix sums, so there is no Python work per word.
A word's hash is a polynomial in a random odd base over a random 64-bit value for each byte, mixed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS = 5
_U = np.uint64
_BASE, _SALT = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
# Bytes hashed in one go: their arrays stay within a few MB. A longer text is still taken whole.
CHUNK_BYTES = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all others."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_SALT))
_PLACE = mix(np.arange(1, WORDS + 1, dtype=_U) * _U(_BASE)) | _U(1)
_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers.update(n=n, up=np.multiply.accumulate(np.full(n, _BASE, _U)), down=np.multiply.accumulate(np.full(n, inverse, _U)))
    return _powers["up"][:n], _powers["down"][:n]


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes, in runs of at most CHUNK_BYTES (or one text), each with the index of its first."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        data = text.encode() if isinstance(text, str) else b""
        if run and size + len(data) > CHUNK_BYTES:
            yield first, run
            first, run, size = i, [], 0
        run.append(data)
        size += len(data) + 1
    if run:
        yield first, run


def word_hashes(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, in order, and where each text's words start (one entry more than texts)."""
    data = _LOWER[np.frombuffer(b" ".join([*run, b""]), np.uint8)]
    white = _WHITE[data]
    before = np.empty_like(white)
    before[0], before[1:] = True, white[:-1]
    starts = np.flatnonzero(~white & before)
    ends = np.flatnonzero(white & ~before)
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in run])])
    return hashes, np.searchsorted(starts, firsts)


def shingle_sets(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """Of each text the ascending distinct hashes of its five-word shingles; with fewer words, of the whole sequence."""
    for _, run in chunks(texts):
        hashes, bounds = word_hashes(run)
        n = len(hashes)
        rolled = np.zeros(max(0, n - WORDS + 1), _U)
        for k in range(WORDS if len(rolled) else 0):
            rolled += hashes[k : n - WORDS + 1 + k] * _PLACE[k]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(rolled[a : b - WORDS + 1])
            elif b > a:
                yield mix((hashes[a:b] * _PLACE[: b - a]).sum(dtype=_U, keepdims=True) + _U(_SALT * (b - a) % (1 << 64)))
            else:
                yield np.empty(0, _U)
