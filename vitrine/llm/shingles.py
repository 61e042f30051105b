"""Hashes of the word shingles of whole texts, many texts at a time."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
PIECE = 1 << 20
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, PIECE + 1)
        up, down = np.full(n, _BASE), np.full(n, _INVERSE)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def _word_hashes(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a piece that ends with a space."""
    a = np.frombuffer(piece, np.uint8)
    space = _SPACE[a]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    up, down = _power(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _cut(text: bytes) -> list[bytes]:
    """Pieces of about PIECE bytes, cut at spaces."""
    out, at = [], 0
    while len(text) - at > PIECE:
        to = max(text.rfind(c, at, at + PIECE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if to <= at:
            found = [i for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (i := text.find(c, at + PIECE)) >= 0]
            to = min(found, default=len(text))
        out.append(text[at : to + 1])
        at = to + 1
    out.append(text[at:])
    return out


def words_of(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of each text, in order; A-Z are lower-cased. Texts are joined up to PIECE bytes, longer ones cut."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal batch, size
        if batch:
            lengths = np.array([len(t) + 1 for t in batch])
            hashes, starts = _word_hashes((b" ".join(batch) + b" ").lower())
            out.extend(np.split(hashes, np.searchsorted(starts, np.cumsum(lengths)[:-1])))
            batch, size = [], 0

    for t in texts:
        if len(t) > PIECE:
            flush()
            out.append(np.concatenate([_word_hashes((p + b" ").lower())[0] for p in _cut(t)]))
        else:
            if size + len(t) > PIECE:
                flush()
            batch.append(t)
            size += len(t) + 1
    flush()
    return out


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words; with fewer words, of the whole sequence; empty without words."""
    if not len(words):
        return words
    k = min(n, len(words))
    total = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - k + 1 + i]
    return np.unique(mixed(total + np.uint64(k)))
