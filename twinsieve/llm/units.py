"""Worker-side memory of already encoded text units, looked up for a whole batch at once."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from .words import gather_ragged, hash_spans

MOST_UNITS = 2_000_000       # units remembered per worker; beyond that the memory starts afresh
_MEMORY = "twinsieve_memory_"


def worker_memory(name: str) -> dict:
    """A dict that lasts as long as the worker process.

    Functions travel to the workers by value, so their module globals end with the task; a module object does not.
    """
    return sys.modules.setdefault(_MEMORY + name, types.ModuleType(name)).__dict__


def give_back() -> None:
    """Give free memory of this worker back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc keeps freed arrays otherwise
    if trim is not None:
        trim(0)


def _forget() -> None:
    held = [name for name in sys.modules if name.startswith(_MEMORY)]
    for name in held:
        del sys.modules[name]
    if held:
        gc.collect()


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow`` of an operator without a worker memory.

    Workers outlive operators, so what others remembered is dropped first, and what this one freed goes back at the end.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        give_back()
        yield from run(batches)
        give_back()

    return whole


class UnitCache:
    """Ids of distinct units (byte strings), kept as flat arrays sorted by the unit's 64-bit hash.

    ``encode`` turns a list of units into one id list each, or into (all ids end to end, ids of each unit). It is asked once per distinct unit of a batch
    that is not remembered. Results never depend on what is remembered.
    """

    def __init__(self, encode: Callable[[list[bytes]], list], most: int = MOST_UNITS):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode_spans(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all spans end to end, number of ids of each span)."""
        codes, distinct = pd.factorize(hash_spans(data, starts, ends))
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        if not known.all():
            if len(self.hashes) + int((~known).sum()) > self.most:
                self._clear()
                known[:] = False
            self._learn(data, starts, ends, codes, distinct, known)
            at = np.searchsorted(self.hashes, distinct)
        lengths = self.lengths[at][codes]
        return self.ids[gather_ragged(self.starts[at][codes], lengths)], lengths

    def _learn(self, data, starts, ends, codes, distinct, known) -> None:
        place = np.empty(len(distinct), np.int64)
        place[codes[::-1]] = np.arange(len(codes))[::-1]        # first occurrence of each distinct unit
        fresh = np.flatnonzero(~known)
        spans = place[fresh]
        found = self.encode([data[low:high] for low, high in zip(starts[spans].tolist(), ends[spans].tolist())])
        if isinstance(found, tuple):
            flat, lengths = found
        else:
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        begins = len(self.ids) + np.cumsum(lengths) - lengths
        hashes = np.concatenate([self.hashes, distinct[fresh]])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.starts = np.concatenate([self.starts, begins])[order]
        self.lengths = np.concatenate([self.lengths, lengths])[order]
        self.ids = np.concatenate([self.ids, flat])
