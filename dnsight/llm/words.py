"""Words of whole texts as 64-bit hashes, computed on the UTF-8 bytes of an Arrow column.

A word is a run of word bytes; A-Z count as a-z. Every byte from 0x80 on is a word byte in the
tables below, so a word never ends inside a multi-byte character. Two different words share a hash
with probability 2**-64; operators that promise exact results treat equal hashes as equal words.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, a-z and all bytes of other scripts.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

#: [^\x20\x09-\x0D]+: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LONG_WORD = 512


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind) if offsets is not None else np.zeros(1, kind)
    offsets = offsets[column.offset:][: len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Start and end of each word, as positions in the bytes, and the first word of each row."""
    inside = np.concatenate([[False], table[_LOWER[data]], [False]])
    starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # A row border ends a word, too.
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    joined = borders[inside[borders] & inside[borders + 1]]
    starts[joined] = ends[joined] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each lower-cased span, eight bytes at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data]
    blocks = np.ndarray((len(data) + 1,), np.uint64, padded.data, 0, (1,))
    lengths = ends - starts
    kept = np.uint64(0xFFFFFFFFFFFFFFFF) >> np.arange(64, -8, -8).clip(0, 63).astype(np.uint64)
    kept[0] = 0

    def absorb(state, at, left):
        return mix(state ^ (blocks[at] & kept[np.minimum(left, 8)]))

    hashes = absorb(mix(lengths.astype(np.uint64) + _M2), starts, lengths)
    rest = np.flatnonzero((lengths > 8) & (lengths <= _LONG_WORD))
    done = 8
    while len(rest):
        hashes[rest] = absorb(hashes[rest], starts[rest] + done, lengths[rest] - done)
        done += 8
        rest = rest[lengths[rest] > done]
    for i in np.flatnonzero(lengths > _LONG_WORD):
        digest = blake2b(padded[starts[i]: ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def word_hashes(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and where the words of each row begin (one more at last)."""
    data, offsets = column_bytes(column)
    starts, ends, first = word_spans(data, offsets, table)
    return hash_spans(data, starts, ends), first


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes that word_hashes gives to these words."""
    data, offsets = column_bytes(pa.array(words, pa.large_string()))
    return hash_spans(data, offsets[:-1], offsets[1:])


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` neighbouring words (of all rows; runs across rows included)."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        out = mix(out + hashes[k: len(hashes) - width + 1 + k] + np.uint64(k + 1))
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text, or one row, each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit)))
        last = min(last, batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
