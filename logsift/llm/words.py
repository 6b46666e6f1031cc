"""Vectorised word spans and hashes over Arrow string columns.

Everything works on the UTF-8 bytes of a whole Arrow batch at once.  The word
classes used here treat every byte of a multi-byte character as a word byte,
so byte spans and character spans agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MUL = U64(0x9E3779B97F4A7C15)

#: word bytes of ``[^\x20\x09-\x0D]+``
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased text
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The batch's bytes and its ``n + 1`` row offsets; null counts as empty.
    ``lower`` folds A-Z only."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    lo, hi = offsets[0], offsets[-1]
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    return (_LOWER[raw] if lower else raw), offsets - lo


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and ``n + 1`` offsets of each row's
    words.  Words never cross a row's end."""
    w = table[data]
    if not len(w):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty_like(w)
    before[0] = False
    before[1:] = w[:-1]
    after = np.empty_like(w)
    after[-1] = False
    after[:-1] = w[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(w))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit numbers (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.empty(n, U64)
    p[0] = 1
    done, step = 1, U64(base)
    while done < n:  # p[done + i] = p[i] * base ** done
        k = min(done, n - done)
        p[done : done + k] = p[:k] * step
        step = step * step
        done += k
    return p


_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=U64) * _MUL)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every process.  Works
    through the bytes ``chunk`` at a time to bound its memory."""
    out = np.empty(len(starts), U64)
    with np.errstate(over="ignore"):
        longest = int((ends - starts).max(initial=0))
        size = max(chunk, longest)
        size = min(size, len(data)) + 1
        power, inverse = _powers(_BASE, size), _powers(_INVERSE, size)
        i = 0
        while i < len(starts):
            a = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, a + size - 1, side="right")))
            b = ends[j - 1]
            sums = np.zeros(b - a + 1, U64)
            np.cumsum(_BYTE[data[a:b]] * power[: b - a], out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64) * _MUL
            i = j
        return mix(out)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive word hashes (``len(h) - k + 1``); rows
    are not looked at, so the caller drops grams that cross a row's end."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        acc = h[:n].copy()
        for j in range(1, k):
            acc *= U64(_BASE)
            acc += h[j : j + n]
        return mix(acc)


def cut_rows(batches: Iterator[pa.RecordBatch], text: str, limit: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Slice batches so that each holds at most ``limit`` bytes of ``text``, or
    one row.  Bounds the memory of what follows; no row is cut or lost."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
