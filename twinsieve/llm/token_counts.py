"""Token counts of whole texts without encoding most of them: lengths looked up in two tiers, nothing shuffled.

Texts are cut into pre-tokens, stretches that the tokenizer splits from their neighbours whatever these are, so a
text's count is the sum of its stretches' counts. First tier: a hash table of the corpus' frequent pre-tokens and
their numbers of tokens, broadcast to all tasks. Second tier: each worker remembers the stretches that the table
lacked. Only what neither knows is given to the tokenizer's library.

The table comes from one pass over all texts in which every task counts its pre-tokens and reports the frequent
ones as (hash, tokens, occurrences); pre-tokens themselves never leave their task. Both tiers only spare work: a
count is the same whatever they hold. Stretches are known by 64-bit hashes, see ``words``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c
from .pieces import BLANK, load as load_pieces
from .stored import small_batches
from .token_blocks import unit_cuts
from .units import worker_memory
from .words import Text, chunks, hash_spans

MOST_FREQUENT = 1 << 16     # pre-tokens in the broadcast table (1.5 MB)
FREQUENT_IN_FOLD = 16       # occurrences in a fold that make a pre-token worth reporting
FOLD = 500_000              # pre-tokens of one fold
MOST_REMEMBERED = 1 << 20   # stretches a worker remembers (24 MB); beyond that it starts afresh
ENCODED_AT_ONCE = 4096      # stretches given to the library in one call: each comes back as an object of about a KB
LIMIT = 512
_CHUNK = 1 << 20


class LengthTable:
    """Open-addressing hash table from 64-bit hashes to numbers of tokens, asked and filled with whole arrays."""

    def __init__(self, most: int):
        self.bits = max(4, int(2 * most - 1).bit_length())
        self.most, self.size = most, 0
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros(1 << self.bits, np.uint32)

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> LengthTable:
        """A table over the arrays of another one."""
        made = cls.__new__(cls)
        made.keys, made.values, made.bits = keys, values, len(keys).bit_length() - 1
        made.most, made.size = len(keys) // 2, int(np.count_nonzero(keys))
        return made

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes with 0, the mark of a free slot, moved to 1; first slot of each)."""
        hashes = np.maximum(hashes, np.uint64(1))
        return hashes, (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens, whether known) of every hash."""
        hashes, slot = self._places(hashes)
        out, known = np.zeros(len(hashes), np.uint32), np.zeros(len(hashes), bool)
        open_ = np.arange(len(hashes))
        while len(open_):
            held = self.keys[slot[open_]]
            same = held == hashes[open_]
            met = open_[same]
            out[met], known[met] = self.values[slot[met]], True
            open_ = open_[~same & (held != 0)]
            slot[open_] = slot[open_] + 1 & len(self.keys) - 1
        return out, known

    def add(self, hashes: np.ndarray, lengths: np.ndarray) -> None:
        """Add hashes that are distinct and not known yet; a table without room for them is emptied first."""
        if self.size + len(hashes) > self.most:
            self.keys[:], self.size = 0, 0
            hashes, lengths = hashes[:self.most], lengths[:self.most]
        self.size += len(hashes)
        hashes, slot = self._places(hashes)
        open_ = np.arange(len(hashes))
        while len(open_):
            free = open_[self.keys[slot[open_]] == 0]
            self.keys[slot[free]] = hashes[free]                    # of several on one slot, one stays
            won = free[self.keys[slot[free]] == hashes[free]]
            self.values[slot[won]] = lengths[won]
            open_ = np.setdiff1d(open_, won, assume_unique=True)
            slot[open_] = slot[open_] + 1 & len(self.keys) - 1


# ---------------------------------------------------------------- tokenizers

# Classes of bytes that the byte-level splitting pattern tells apart: letters, digits, other visible signs.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_APOSTROPHE = 39


def byte_level_cuts(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Cuts of ``unit_cuts`` and those between ASCII letters, digits and other signs.

    An apostrophe makes no cut before a letter, which it may take along.
    """
    cuts = np.zeros(len(data) + 1, bool)
    cuts[unit_cuts(data, offsets)] = True
    kind = _KIND[np.frombuffer(data, np.uint8)]
    left, right = kind[:-1], kind[1:]
    apart = (left != right) & (left > 0) & (right > 0)
    apart &= (np.frombuffer(data, np.uint8)[:-1] != _APOSTROPHE) | (right != 1)
    cuts[1:-1] |= apart
    return np.flatnonzero(cuts)


@dataclass
class Counter:
    """What counting needs of one tokenizer file."""

    cuts: Callable[[bytes, np.ndarray], np.ndarray]     # (data, bounds of texts) -> sorted cuts, bounds included
    lengths: Callable[[list[bytes]], list[int]]         # tokens of every stretch
    prepare: Callable[[Text], Text]
    table: bool                                         # whether stretches repeat enough to be tabled
    memory: LengthTable


def _json_counter(path: str) -> Counter:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    before = held.get("pre_tokenizer") or {}
    added = held.get("added_tokens") or []
    plain = all(not t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    known = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
             and held.get("normalizer") is None and plain)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    literal = [re.escape(t["content"].encode()) for t in sorted(added, key=lambda t: -len(t["content"]))]
    special = re.compile(b"|".join(literal)) if literal else None

    def cuts(data: bytes, offsets: np.ndarray) -> np.ndarray:
        if not known:
            return np.unique(offsets)
        # The library takes its special strings out before it splits the text around them.
        found = [m.span() for m in special.finditer(data)] if special else []
        if found:
            spans = np.array(found)
            within = np.searchsorted(offsets, spans[:, 0], side="right") == np.searchsorted(offsets, spans[:, 1], side="left")
            if not within.all():                        # a literal across two texts hides what begins inside it
                return np.unique(np.concatenate([cuts(data[a:b], np.array([0, b - a])) + a
                                                 for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())] + [offsets]))
            bounds = np.unique(np.concatenate([offsets, spans.ravel()]))
            inner = byte_level_cuts(data, bounds)
            inside = np.searchsorted(spans[:, 0], inner, side="left") - 1
            return inner[(inside < 0) | (inner >= spans[np.maximum(inside, 0), 1])]
        return byte_level_cuts(data, offsets)

    def lengths(stretches: list[bytes]) -> list[int]:
        found: list[int] = []
        for low in range(0, len(stretches), ENCODED_AT_ONCE):
            some = [s.decode() for s in stretches[low:low + ENCODED_AT_ONCE]]
            found += map(len, tokenizer.encode_batch_fast(some, add_special_tokens=False))
        return found

    return Counter(cuts, lengths, lambda text: text, known, LengthTable(MOST_REMEMBERED))


def _piece_counter(path: str) -> Counter:
    model, _ = load_pieces(path)

    def prepare(text: Text) -> Text:
        """A blank before every text that is not empty, as the model's own encoding adds."""
        parts = [text.data[a:b].replace(BLANK.encode(), b" ") for a, b in zip(text.offsets[:-1].tolist(), text.offsets[1:].tolist())]
        parts = [b" " + p if p else p for p in parts]
        return Text(b"".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]))

    return Counter(model.spans, lambda stretches: [len(model.unit(s)) for s in stretches], prepare, True, LengthTable(MOST_REMEMBERED))


def counter(path: str) -> Counter:
    """The counter of a tokenizer file (.json or .model), one per worker."""
    held = worker_memory("token_counts")
    if path not in held:
        if not path.endswith((".json", ".model")):
            raise ValueError(f"neither a .json nor a .model file: {path}")
        held[path] = _json_counter(path) if path.endswith(".json") else _piece_counter(path)
    return held[path]


# ---------------------------------------------------------------- counting

def _new_lengths(used: Counter, data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Tokens of stretches through the worker's memory."""
    codes, distinct = pd.factorize(hashes)
    out, known = used.memory.find(distinct)
    fresh = np.flatnonzero(~known)
    if len(fresh):
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        out[fresh] = used.lengths([data[a:b] for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())])
        used.memory.add(distinct[fresh], out[fresh])
    return out[codes]


def text_tokens(text: Text, path: str, table: LengthTable | None = None) -> np.ndarray:
    """Number of tokens of every text."""
    used = counter(path)
    text = used.prepare(text)
    cuts = used.cuts(text.data, text.offsets)
    starts, ends = cuts[:-1], cuts[1:]
    hashes = hash_spans(text.data, starts, ends)
    if table is None:
        lengths = _new_lengths(used, text.data, starts, ends, hashes)
    else:
        lengths, known = table.find(hashes)
        rest = np.flatnonzero(~known)
        lengths[rest] = _new_lengths(used, text.data, starts[rest], ends[rest], hashes[rest])
    sums = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return np.diff(sums[np.searchsorted(cuts, text.offsets)])


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(hashes, tokens) of the MOST_FREQUENT pre-tokens that occur most in all texts, as the arrays of a ``LengthTable``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = counter(path)
        held: list[tuple[bytes, np.ndarray, np.ndarray]] = []       # (text, cuts, hashes) of a fold's chunks

        def report():
            ends = np.cumsum([len(h) for _, _, h in held])
            hashes, first, counts = np.unique(np.concatenate([h for _, _, h in held]), return_index=True, return_counts=True)
            often = counts >= FREQUENT_IN_FOLD
            hashes, first, counts = hashes[often], first[often], counts[often]
            lengths, known = used.memory.find(hashes)
            missing = np.flatnonzero(~known)
            if len(missing):
                spelled = []
                for i in first[missing].tolist():
                    k = int(np.searchsorted(ends, i, side="right"))
                    data, cuts, own = held[k]
                    i -= int(ends[k]) - len(own)
                    spelled.append(data[cuts[i]:cuts[i + 1]])
                lengths[missing] = used.lengths(spelled)
                used.memory.add(hashes[missing], lengths[missing])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(lengths.astype(np.int64)), pa.array(counts, pa.int64())],
                                              ["hash", "tokens", "n"])

        for batch in batches:
            for _, text in chunks(batch, "text", _CHUNK):
                text = used.prepare(text)
                cuts = used.cuts(text.data, text.offsets)
                held.append((text.data, cuts, hash_spans(text.data, cuts[:-1], cuts[1:])))
                if sum(len(h) for _, _, h in held) >= FOLD:
                    yield report()
        if held:
            yield report()

    chosen = docs.select(c(text_col).cast("string").alias("text"))
    often = (chosen.mapInArrow(run, "hash long, tokens long, n long").groupBy("hash").agg(F.max("tokens").alias("tokens"), F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "hash").limit(MOST_FREQUENT).toArrow())
    table = LengthTable(MOST_FREQUENT)
    table.add(often.column("hash").to_numpy().view(np.uint64), often.column("tokens").to_numpy().astype(np.uint32))
    return table.keys, table.values


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, as the file's library counts the whole text.

    No begin, end or added special tokens; special strings inside a text count as the library's default takes
    them. A null text is empty: 0 bytes, 0 tokens. Null ids and repeated rows come back as they are; other columns
    are not read; an empty table gives no rows. Rows keep their partition. Tokenizer files whose splitting is not
    known here are given whole texts, distinct ones of a batch once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text_col)) if counter(path).table else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = LengthTable.of(*table.value) if table is not None else None
        for batch in batches:
            for rows, text in chunks(batch, "text", _CHUNK):
                tokens = text_tokens(text, path, lookup)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(text.offsets), pa.int64()), pa.array(tokens, pa.int64()), pc.greater(pa.array(tokens, pa.int64()), limit)],
                    ["id", "n_bytes", "n_tokens", "over_limit"])

    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    counted = chosen.mapInArrow(run, "id long, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_col)
