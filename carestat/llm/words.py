"""Vectorised word hashing over Arrow string columns (numpy, inside tasks).

Words are maximal runs of word bytes in a text's UTF-8 form. A word's 64-bit
hash depends on its bytes alone, so it is the same in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 20  # bytes hashed at a time: bounds the memory, not the text
SUB_BYTES = 2 << 20  # bytes of text handled together; a longer text is handled alone

#: [^\x20\x09-\x0D]
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z are lower case
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        _powers[:] = []
        for b in (_BASE, _INV):
            p = np.full(n + 1, b, _U)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def text_parts(batch: pa.RecordBatch, column: str, max_bytes: int = SUB_BYTES):
    """Yield (first row, end row, bytes, offsets) over whole texts; null is empty."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if not len(col):
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
    pa.default_memory_pool().release_unused()  # Python workers share an executor with the JVM


def word_spans(data: np.ndarray, offs: np.ndarray, kind: np.ndarray):
    """Byte starts and ends of words, and word offsets by text."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offs), np.int64)
    word = kind[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased."""
    out, at = np.empty(len(starts), _U), 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + _SEGMENT, "right")))
        seg = data[lo:ends[to - 1]]
        power, inverse = _power_tables(max(len(seg), _SEGMENT))
        sums = np.zeros(len(seg) + 1, _U)
        np.cumsum((_LOWER[seg] + _U(1)) * power[:len(seg)], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93))
        at = to
    return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbouring words (empty when there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out, c = np.zeros(n, _U), 1
    for j in range(k):
        out += words[j:j + n] * _U(c)
        c = c * 0xD1342543DE82EF95 % (1 << 64)
    return mix(out + _U(k))


def whole_hash(words: np.ndarray) -> np.ndarray:
    """One hash for a whole word sequence."""
    return gram_hashes(words, len(words))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct k-word shingle hashes; a shorter text is one shingle, none if empty."""
    if not len(words):
        return np.zeros(0, _U)
    return np.unique(gram_hashes(words, k) if len(words) >= k else whole_hash(words))


def documents_words(batch: pa.RecordBatch, column: str, kind: np.ndarray):
    """Yield (row, word hashes, byte starts, byte ends, text bytes) for each text."""
    for lo, hi, data, offs in text_parts(batch, column):
        starts, ends, at = word_spans(data, offs, kind)
        hashes = word_hashes(data, starts, ends)
        for i in range(hi - lo):
            a, b = at[i], at[i + 1]
            yield lo + i, hashes[a:b], starts[a:b] - offs[i], ends[a:b] - offs[i], data[offs[i]:offs[i + 1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
