"""Benchmark decontamination by greedy string tiling.

Every run of ``MATCH_WORDS`` benchmark words has a Karp-Rabin fingerprint. A document that shares fingerprints
with an item is tiled against it: the longest common run of unmarked words is marked in both, again and again,
until no run of ``MATCH_WORDS`` words is left. The share of the item's words under tiles is its coverage, which
does not depend on the order of the passages. At ``COVERAGE`` or more the document holds the item, and also when
the tiles of at least ``LONG_TILE`` words together have ``LONG_WORDS``, however small a share of a long item that is.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c
from .words import Text, chunks, hash_spans, mix

MATCH_WORDS = 5             # shortest tile; an item with fewer words must be matched whole
COVERAGE = 0.8
LONG_TILE = 13              # shortest tile that counts towards LONG_WORDS; shorter ones may be common phrases
LONG_WORDS = 25             # verbatim words of an item, whatever its length
BLOCK_WORDS = 2_000_000     # benchmark words sent to the workers at once (about 40 MB); more take more passes
_BASE = np.uint64(0xD1342543DE82EF95)       # odd, so it has an inverse modulo 2^64
_FILTER_BITS = 22


def fingerprints(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin fingerprints (modulo 2^64) of all runs of ``width`` words, rolled over the sequence."""
    room = len(words) - width + 1
    if room <= 0:
        return np.zeros(0, np.uint64)
    rolled = np.zeros(room, np.uint64)
    for k in range(width):
        rolled = rolled * _BASE + words[k:k + room]
    return mix(rolled)


@dataclass
class Block:
    """Some benchmark items and the fingerprints of their runs."""

    names: list
    words: list[np.ndarray]

    @classmethod
    def of(cls, fields: dict) -> Block:
        """A block from the fields of another one."""
        made = cls.__new__(cls)
        vars(made).update(fields)
        return made

    def __post_init__(self):
        self.widths = sorted({min(MATCH_WORDS, len(w)) for w in self.words if len(w)})
        self.seeds = {}
        for width in self.widths:
            prints, items = [], []
            for i, w in enumerate(self.words):
                if min(MATCH_WORDS, len(w)) == width:
                    found = np.unique(fingerprints(w, width))
                    prints.append(found)
                    items.append(np.full(len(found), i))
            prints, items = np.concatenate(prints), np.concatenate(items)
            order = np.argsort(prints, kind="stable")
            prints, items = prints[order], items[order]
            flags = np.zeros(1 << _FILTER_BITS, bool)
            flags[(prints >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.seeds[width] = prints, items, flags


def tile(item: np.ndarray, text: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, text position, length): longest first, then leftmost in item and text."""
    places: dict[int, list[int]] = {}
    for i, f in enumerate(fingerprints(item, shortest).tolist()):
        places.setdefault(f, []).append(i)
    starts = np.flatnonzero(np.isin(prints := fingerprints(text, shortest), np.fromiter(places, np.uint64, len(places))))
    # Matching runs on one diagonal join into maximal ones.
    open_runs: dict[int, list[int]] = {}
    runs: list[tuple[int, int, int]] = []
    for j in starts.tolist():
        for i in places[int(prints[j])]:
            run = open_runs.get(j - i)
            if run and run[1] + run[2] - shortest + 1 == j:
                run[2] += 1
            else:
                if run:
                    runs.append((-run[2], run[0], run[1]))
                open_runs[j - i] = [i, j, shortest]
    runs += [(-r[2], r[0], r[1]) for r in open_runs.values()]
    heapq.heapify(runs)
    marked_item, marked_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    tiles = []
    while runs:
        length, i, j = heapq.heappop(runs)
        length = -length
        taken = marked_item[i:i + length] | marked_text[j:j + length]
        if not taken.any():
            marked_item[i:i + length] = marked_text[j:j + length] = True
            tiles.append((i, j, length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]])))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if high - low >= shortest:
                heapq.heappush(runs, (low - high, i + low, j + low))
    return tiles


def _leaks(block: Block, text: Text, coverage: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(document number, item number, coverage, tiles, tiled words) of one chunk."""
    low = text.lowered()
    starts, ends, first = low.words()
    words = hash_spans(low.data, starts, ends)
    pairs = []
    for width in block.widths:
        prints, items, flags = block.seeds[width]
        own = fingerprints(words, width)
        at = np.flatnonzero(flags[(own >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        left, right = np.searchsorted(prints, own[at]), np.searchsorted(prints, own[at], side="right")
        at, left, right = at[right > left], left[right > left], right[right > left]
        doc = np.searchsorted(first, at, side="right") - 1
        whole = at + width <= first[doc + 1]            # a run must not leave its document
        at, left, right, doc = at[whole], left[whole], right[whole], doc[whole]
        counts = right - left
        item = items[np.repeat(left - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        pairs.append(np.stack([np.repeat(doc, counts), item, np.repeat(own[at].view(np.int64), counts)], 1))
    pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 3), np.int64)
    if not len(pairs):
        return
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(pairs[:, :2], axis=0) != 0).any(1), [True]]))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        d, i = int(pairs[lo, 0]), int(pairs[lo, 1])
        item = block.words[i]
        width = min(MATCH_WORDS, len(item))
        # Words under shared runs bound the coverage from above.
        shared = np.isin(fingerprints(item, width), pairs[lo:hi, 2].view(np.uint64))
        under = np.convolve(shared, np.ones(width, int)) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], under, [False]]).astype(np.int8)))
        runs = edges[1::2] - edges[::2]
        if under.sum() < coverage * len(item) and runs[runs >= LONG_TILE].sum() < LONG_WORDS:
            continue
        tiles = tile(item, words[first[d]:first[d + 1]], width)
        tiled = sum(t[2] for t in tiles)
        if tiled >= coverage * len(item) or sum(t[2] for t in tiles if t[2] >= LONG_TILE) >= LONG_WORDS:
            yield d, i, tiled / len(item), len(tiles), tiled


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of about BLOCK_WORDS words, dealt by a hash of the whole row. Items without words are left out."""
    chosen = benchmark.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / 5 / BLOCK_WORDS))
    for part in range(parts):
        mine = chosen.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part) if parts > 1 else chosen
        names, words = [], []
        for batch in mine.toArrow().to_batches():
            for rows, text in chunks(batch, "text"):
                low = text.lowered()
                starts, ends, first = low.words()
                hashes = hash_spans(low.data, starts, ends)
                for k, name in enumerate(rows.column(0).to_pylist()):
                    if first[k + 1] > first[k]:
                        names.append(name)
                        words.append(hashes[first[k]:first[k + 1]].copy())
        if names:
            yield Block(names, words)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", coverage: float = COVERAGE) -> DataFrame:
    """(id, item, coverage, n_tiles, tiled_words) of every row and item with at least this coverage or LONG_WORDS verbatim words.

    Documents are read once per benchmark block and never shuffled. Null and empty texts hold nothing; repeated
    rows and items give repeated pairs; an item shorter than MATCH_WORDS words must occur whole. Other columns
    are not read.
    """
    spark = docs.sparkSession
    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    schema = "id long, item long, coverage double, n_tiles int, tiled_words int"
    found = spark.createDataFrame([], schema)
    for block in blocks(benchmark, item_col):
        shared = spark.sparkContext.broadcast(vars(block))         # plain arrays, which workers can read without this module

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = Block.of(shared.value)
            for batch in batches:
                for rows, text in chunks(batch, "text"):
                    hits = list(_leaks(held, text, coverage))
                    if hits:
                        d, i, share, n, tiled = zip(*hits)
                        yield pa.RecordBatch.from_arrays(
                            [rows.column(0).take(pa.array(d)), pa.array([held.names[k] for k in i], pa.int64()),
                             pa.array(share, pa.float64()), pa.array(n, pa.int32()), pa.array(tiled, pa.int32())],
                            ["id", "item", "coverage", "n_tiles", "tiled_words"])

        found = found.union(chosen.mapInArrow(search, schema))
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "coverage", "n_tiles", "tiled_words")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns as they were, nothing shuffled."""
    kept = docs
    for block in blocks(benchmark, item_col):
        shared = docs.sparkSession.sparkContext.broadcast(vars(block))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = Block.of(shared.value)
            for batch in batches:
                for rows, text in chunks(batch, text_col):
                    leaky = np.zeros(rows.num_rows, bool)
                    leaky[[hit[0] for hit in _leaks(held, text, coverage)]] = True
                    yield rows.filter(pa.array(~leaky))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
