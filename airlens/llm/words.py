"""Vectorised 64-bit hashes of words and word shingles over Arrow text buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z
lower-cased. A word's hash is a polynomial over its bytes, taken from prefix
sums, so one pass of numpy covers every word of a chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from airlens.llm.shared import CHUNK_BYTES, document_runs, text_buffers

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U64)
    with np.errstate(over="ignore"):
        out[1:] = U64(base)
        np.multiply.accumulate(out, out=out)
    return out


_byte = np.arange(256)
_lowered = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte)
_SPACE = (_byte == 32) | ((_byte >= 9) & (_byte <= 13))
with np.errstate(over="ignore"):
    _VALUE = mix((_lowered.astype(U64) + U64(1)) * U64(_BASE))
_tables: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        _tables["up"] = _powers(_BASE, CHUNK_BYTES)
        _tables["down"] = _powers(pow(_BASE, -1, 1 << 64), CHUNK_BYTES)
    return _tables["up"], _tables["down"]


def _hash_piece(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of at most CHUNK_BYTES bytes and each word's first byte; a word never spans a break."""
    n = len(raw)
    if not n:
        return np.empty(0, U64), np.empty(0, np.int64)
    up, down = _power_tables()
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[0] = True
    edge[breaks[(breaks > 0) & (breaks < n)]] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    with np.errstate(over="ignore"):
        total = np.cumsum(_VALUE[raw] * up[:n])
        before = np.where(starts > 0, total[starts - 1], U64(0))
        h = (total[ends] - before) * down[starts]
        return mix(h + (ends - starts + 1).astype(U64)), starts


def word_hashes(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_hash_piece`` for any length: longer input is cut after a white-space byte.

    A single word longer than a chunk is hashed piece by piece, so memory stays bounded.
    """
    if len(raw) <= CHUNK_BYTES:
        return _hash_piece(raw, breaks)
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(at + CHUNK_BYTES, len(raw))
        if end < len(raw):
            spaces = np.flatnonzero(_SPACE[raw[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:  # one word longer than a chunk: combine the hashes of its pieces
                stop = end
                while stop < len(raw) and not _SPACE[raw[stop]]:
                    stop += 1
                h = U64(0)
                with np.errstate(over="ignore"):
                    for i in range(at, stop, CHUNK_BYTES):
                        piece, _ = _hash_piece(raw[i:min(i + CHUNK_BYTES, stop)], np.empty(0, np.int64))
                        h = mix(h * U64(_BASE) + piece[0])
                hashes.append(np.array([h], U64))
                starts.append(np.array([at], np.int64))
                at = stop
                continue
        h, s = _hash_piece(raw[at:end], breaks - at)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def documents(column: pa.Array):
    """Yield (first document, word hashes, word bounds) for runs of documents; bounds has one entry more."""
    raw, off = text_buffers(column)
    for i, j in document_runs(off):
        piece = raw[off[i]:off[j]]
        own = off[i:j + 1] - off[i]
        h, starts = word_hashes(piece, own)
        yield i, h, np.searchsorted(starts, own)


_COEF = [pow(_BASE, 2 * k + 3, 1 << 64) for k in range(SHINGLE)]


def gram_hashes(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hash of the n words from each position on; positions near the end have none."""
    if len(h) < n:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(h) - n + 1, U64)
        for k in range(n):
            total += h[k:len(h) - n + 1 + k] * U64(pow(_BASE, 2 * k + 3, 1 << 64))
        return mix(total)


def shingle_sets(column: pa.Array):
    """Yield one sorted array of distinct shingle hashes per document.

    Five words make a shingle; a document of one to four words has one shingle,
    its whole sequence (told apart from longer ones by its length); without
    words the set is empty.
    """
    for _, h, bounds in documents(column):
        grams = gram_hashes(h)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= SHINGLE:
                s = np.sort(grams[a:b - SHINGLE + 1])
                keep = np.ones(len(s), bool)
                keep[1:] = s[1:] != s[:-1]
                yield s[keep]
            elif b > a:
                with np.errstate(over="ignore"):
                    yield gram_hashes(h[a:b], b - a) + U64(b - a)
            else:
                yield np.empty(0, U64)
