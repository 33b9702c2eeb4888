"""Vectorised words of Arrow text batches: spans, 64-bit hashes and shingles, without a Python object per word.

A word is a run of bytes outside 0x20 and 0x09-0x0D of the UTF-8 text; words never cross documents. Hashes
are 64 bits wide, equal on every machine, and taken for identity (two of n words clash with odds n^2 / 2^65).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20       # text handled at once; a longer document is a chunk of its own
LONG_WORD = 512             # longer words are digested one by one

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (finaliser with multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` for each span."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64)
    padded = data + bytes(8)
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lengths = ends - starts
    state = mix(lengths.astype(np.uint64) + _ODD)
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    rest, at = np.arange(n), starts.copy()
    left = lengths.copy()
    whole = True
    while len(rest):
        block = eights[at] & masks[np.minimum(left, 8)]
        mixed = mix((state if whole else state[rest]) * _ODD + block)
        if whole:
            state = mixed
        else:
            state[rest] = mixed
        more = left > 8
        if whole:
            more &= lengths <= LONG_WORD
        rest, at, left, whole = rest[more], at[more] + 8, left[more] - 8, False
    for i in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i]:ends[i]], digest_size=8).digest()
        state[i] = np.frombuffer(digest, "<u8")[0]
    return state


@dataclass
class Text:
    """Bytes of some documents, end to end; document i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: bytes
    offsets: np.ndarray

    def lowered(self) -> Text:
        """A-Z in lower case, all else as it is."""
        return Text(self.data.translate(_LOWER), self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first): byte spans of all words; document i has words first[i] to first[i + 1]."""
        size = len(self.data)
        inside = np.empty(size + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(_SPACE[np.frombuffer(self.data, np.uint8)], out=inside[1:-1])
        starts = inside[1:] & ~inside[:-1]      # position p starts a word
        ends = inside[:-1] & ~inside[1:]        # position p ends one
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < size)]
        joined = cuts[inside[cuts] & inside[cuts + 1]]
        starts[joined] = True
        ends[joined] = True
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
        return starts, ends, np.searchsorted(starts, self.offsets)


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Text]]:
    """Slices of a batch with at most ``most`` bytes of text (or one document); a null text is empty."""
    texts = batch.column(batch.schema.get_field_index(column)).fill_null("").cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, at, values = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset:texts.offset + n + 1]
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        data = values.slice(int(offsets[low]), int(offsets[high] - offsets[low])).to_pybytes() if values is not None else b""
        yield batch.slice(low, high - low), Text(data, offsets[low:high + 1] - offsets[low])
        low = high


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, first): every run of ``width`` words of a document; a shorter one is a single run of all its words.

    A document without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    out_first = np.concatenate([[0], np.cumsum(made)])
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    room = max(0, n - width + 1)
    # The hashes of words are scrambled already, so a sum with odd factors tells their order.
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    for k in range(width):
        rolled[:room] += hashes[k:k + room] * factors[k]
    rolled[:room] = mix(rolled[:room])
    places = np.arange(out_first[-1]) + np.repeat(first[:-1] - out_first[:-1], made)
    out = rolled[places]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        value = np.zeros(1, np.uint64)
        for k, h in enumerate(hashes[first[i]:first[i + 1]]):
            value = mix(value * _ODD + h + np.uint64(k + 1))
        out[out_first[i]] = mix(value + np.uint64(counts[i]))[0]
    return out, out_first


def gather_ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
