"""Interpolated modified Kneser-Ney bigram model, counted in Spark and read by memory-mapped workers.

Tokens are lower-cased words and one end per document. Tasks fold their pairs of neighbours before anything is
shuffled. Pairs meet in shards by the hash of the pair, so a frequent word is spread over all shards; each
shard writes its pair hashes sorted beside their counts and passes on one partial sum per word. Words then
meet in shards by their own hash and are written the same way. A shard is two plain arrays in the shared
folder; workers map the files they need and look up sorted queries.

Probability: (count - D) / context + back-off * continuation, where D is one of three discounts by count and the
continuation model is discounted alike and interpolated with a uniform share for unknown words.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from ..session import ensure_checkpoint_dir
from .words import Text, chunks, hash_spans, mix

FOLD_TOKENS = 3_000_000     # pairs folded at once in a task
LEAST_SHARDS = 128
SHARD_BYTES = 64 << 20      # text behind one shard
START = np.uint64(0x5354415254)
END = np.uint64(0x454E44)
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Sums kept per word: as a token, distinct words before it, as a context, continuations seen once, twice, oftener.
_FIELDS = ("seen", "before", "follows", "once", "twice", "more")


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: crc32 of the id's text, modulo 5, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def tokens(text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with an end after each document, the token before each, tokens of each document)."""
    low = text.lowered()
    starts, ends, first = low.words()
    docs = len(first) - 1
    out = np.full(len(starts) + docs, END, np.uint64)
    places = np.arange(len(starts)) + np.repeat(np.arange(docs), np.diff(first))
    out[places] = hash_spans(low.data, starts, ends)
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[first[:-1] + np.arange(docs)] = START
    return out, before, np.diff(first) + 1


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _ODD + word)


# ---------------------------------------------------------------- arrays in messages and files

def _planes(values: np.ndarray, rising: bool = False) -> bytes:
    """Bytes of an array, all first bytes first, so that small and rising numbers compress in the shuffle."""
    if rising and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplaned(raw: memoryview, dtype: str, n: int, at: int, rising: bool = False) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n).T
    values = np.ascontiguousarray(flat).view(dtype).reshape(n)
    return np.cumsum(values, dtype=values.dtype) if rising else values


def _pack_pairs(before, word, count) -> bytes:
    return len(count).to_bytes(8, "little") + _planes(before, True) + word.tobytes() + _planes(count)


def _unpack_pairs(raw: memoryview):
    n = int.from_bytes(raw[:8], "little")
    return (_unplaned(raw, "<u8", n, 8, True), np.frombuffer(raw, "<u8", n, 8 + 8 * n), _unplaned(raw, "<u8", n, 8 + 16 * n))


def _pack_words(words, sums) -> bytes:
    return len(words).to_bytes(8, "little") + _planes(words, True) + b"".join(_planes(s) for s in sums)


def _unpack_words(raw: memoryview):
    n = int.from_bytes(raw[:8], "little")
    return _unplaned(raw, "<u8", n, 8, True), [_unplaned(raw, "<u8", n, 8 + 8 * n * (k + 1)) for k in range(len(_FIELDS))]


def _sum_by_key(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], [np.add.reduceat(x[order].astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64) for x in columns]


def _store(folder: str, name: str, keys: np.ndarray, *columns: np.ndarray) -> None:
    """Write sorted keys and their counts as one file in the shared folder; a repeated task replaces it by the same bytes.

    Counts take four bytes each unless one of the file needs eight.
    """
    kind = "<u8" if any(len(x) and x.max() >= 2**32 for x in columns) else "<u4"
    arrays = [keys, *(x.astype(kind) for x in columns)]
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(np.array([len(keys), np.dtype(kind).itemsize], "<u8").tobytes())
        for array in arrays:
            out.write(np.ascontiguousarray(array).tobytes())
    fs.move(draft, f"{path}/{name}")


_MAPPED: dict[str, np.memmap] = {}


def _mapped(folder: str, name: str) -> np.memmap:
    """The file as a memory map; one that lies in a remote store is copied to the worker's disk once."""
    key = f"{folder}/{name}"
    if key not in _MAPPED:
        if len(_MAPPED) > 4096:
            _MAPPED.clear()
        fs, path = pyarrow.fs.FileSystem.from_uri(folder)
        local = f"{path}/{name}"
        if not isinstance(fs, pyarrow.fs.LocalFileSystem):
            handle, local = tempfile.mkstemp(prefix="kneser-ney-")
            with fs.open_input_stream(f"{path}/{name}") as source, os.fdopen(handle, "wb") as copy:
                while part := source.read(1 << 22):
                    copy.write(part)
        _MAPPED[key] = np.memmap(local, np.uint8, "r")
    return _MAPPED[key]


def _table(folder: str, name: str, columns: int) -> tuple[np.ndarray, list[np.ndarray]]:
    raw = _mapped(folder, name)
    n, size = raw[:16].view("<u8").tolist()
    at = 16 + 8 * n
    return raw[16:at].view("<u8"), [raw[at + size * n * k:at + size * n * (k + 1)].view(f"<u{size}") for k in range(columns)]


def _look_up(folder: str, kind: str, bits: int, keys: np.ndarray, columns: int) -> np.ndarray:
    """Columns of the sorted distinct keys; zeros where a key is not stored."""
    found = np.zeros((columns, len(keys)), np.int64)
    shards = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.searchsorted(shards, np.arange((1 << bits) + 1)) if len(keys) else []
    for shard in np.unique(shards).tolist():
        low, high = int(cuts[shard]), int(cuts[shard + 1])
        stored, values = _table(folder, f"{kind}-{shard:06d}", columns)
        if not len(stored):
            continue
        at = np.minimum(np.searchsorted(stored, keys[low:high]), len(stored) - 1)
        hit = stored[at] == keys[low:high]
        for k in range(columns):
            found[k, low:high] = np.where(hit, values[k][at], 0)
    return found


# ---------------------------------------------------------------- counting

class Model:
    """Where the arrays lie, and the few numbers that go with them."""

    def __init__(self, folder: str, bits: int, train_tokens: int, distinct: int, pair_kinds: list[int], word_kinds: list[int]):
        self.folder, self.bits, self.train_tokens, self.distinct = folder, bits, train_tokens, distinct
        self.discounts, self.word_discounts = _discounts(pair_kinds), _discounts(word_kinds)
        self.pair_types = pair_kinds[4]
        spare = sum(d * k for d, k in zip(self.word_discounts, (word_kinds[0], word_kinds[1], word_kinds[4 + 1])))
        self.uniform = (spare / self.pair_types if self.pair_types else 1.0) / (distinct + 1)


def _discounts(kinds: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many entries occur once to four times."""
    n1, n2, n3, n4 = kinds[:4]
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def _kinds(counts: np.ndarray) -> list[int]:
    """Entries with count 1, 2, 3, 4, all entries, entries with count 3 or more."""
    return [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts > 0).sum()), int((counts > 2).sum())]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> Model:
    """Count all rows that are not held out and write the model's arrays to the shared folder."""
    spark = docs.sparkSession
    chosen = (docs.filter(~held_out(c(id_col))).select(c(text_col).cast("string").alias("text")))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = (max(LEAST_SHARDS, math.ceil(size / SHARD_BYTES)) - 1).bit_length()
    shards = 1 << bits
    ensure_checkpoint_dir(spark)
    folder = folder or f"{spark.sparkContext.getCheckpointDir()}/kneser-ney-{uuid.uuid4().hex}"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush():
            before, word = (np.concatenate(x) for x in zip(*held))
            held.clear()
            keys = pair_hash(before, word)
            order = np.argsort(keys)
            keys = keys[order]
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(heads, len(keys))).astype("<u8")
            shard = keys[heads] >> np.uint64(64 - bits)
            before, word = before[order[heads]], word[order[heads]]
            # Inside a shard the pairs lie by their first word, which then takes few bytes.
            order = np.argsort(shard << np.uint64(64 - bits) | before >> np.uint64(bits))
            before, word, counts = before[order], word[order], counts[order]
            cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            some = [s for s in range(shards) if cuts[s + 1] > cuts[s]]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([_pack_pairs(before[cuts[s]:cuts[s + 1]], word[cuts[s]:cuts[s + 1]], counts[cuts[s]:cuts[s + 1]])
                                                       for s in some], pa.binary())], ["shard", "payload"])

        for batch in batches:
            for _, text in chunks(batch, "text"):
                word, before, _ = tokens(text)
                held.append((before, word))
                waiting += len(word)
                if waiting >= FOLD_TOKENS:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()

    def merge_pairs(key, table):
        parts = [_unpack_pairs(memoryview(x.as_buffer())) for x in table.column("payload")]
        before, word, count = (np.concatenate(x) for x in zip(*parts))
        keys = pair_hash(before, word)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat(count[order].astype(np.int64), heads)
        _store(folder, f"pair-{key[0].as_py():06d}", keys[heads], counts)
        before, word = before[order[heads]], word[order[heads]]
        none = np.zeros(len(heads), np.int64)
        names, sums = _sum_by_key(np.concatenate([word, before]), [
            np.concatenate([counts, none]), np.concatenate([none + 1, none]), np.concatenate([none, counts]),
            *(np.concatenate([none, x.astype(np.int64)]) for x in (counts == 1, counts == 2, counts > 2))])
        cuts = np.searchsorted(names >> np.uint64(64 - bits), np.arange(shards + 1, dtype=np.uint64))
        some = [s for s in range(shards) if cuts[s + 1] > cuts[s]]
        payloads = [_pack_words(names[cuts[s]:cuts[s + 1]], [x[cuts[s]:cuts[s + 1]].astype("<u8") for x in sums]) for s in some]
        # The last row carries how many pairs occur once, twice and so on.
        return pa.table({"shard": pa.array([*some, -1], pa.int32()), "payload": pa.array([*payloads, None], pa.binary()),
                         "kinds": pa.array([None] * len(some) + [_kinds(counts)], pa.list_(pa.int64()))})

    def merge_words(key, table):
        if key[0].as_py() < 0:
            kinds = np.array(table.column("kinds").to_pylist()).sum(0).tolist()
            return pa.table({"part": pa.array(["pairs"]), "n": pa.array([0], pa.int64()), "words": pa.array([0], pa.int64()),
                             "kinds": pa.array([kinds], pa.list_(pa.int64()))})
        parts = [_unpack_words(memoryview(x.as_buffer())) for x in table.column("payload")]
        names, sums = _sum_by_key(np.concatenate([p[0] for p in parts]),
                                  [np.concatenate([p[1][k] for p in parts]) for k in range(len(_FIELDS))])
        _store(folder, f"word-{key[0].as_py():06d}", names, *sums)
        seen, before = sums[:2]
        return pa.table({"part": pa.array(["words"]), "n": pa.array([int(seen.sum())], pa.int64()),
                         "words": pa.array([int((seen > 0).sum())], pa.int64()),
                         "kinds": pa.array([_kinds(before)], pa.list_(pa.int64()))})

    pairs = chosen.mapInArrow(fold, "shard int, payload binary")
    sums = pairs.groupBy("shard").applyInArrow(merge_pairs, "shard int, payload binary, kinds array<long>")
    stats = sums.groupBy("shard").applyInArrow(merge_words, "part string, n long, words long, kinds array<long>")
    totals = stats.groupBy("part").agg(F.sum("n").alias("n"), F.sum("words").alias("words"),
                                       F.array(*[F.sum(F.get("kinds", F.lit(k))) for k in range(6)]).alias("kinds"))
    by = {r["part"]: r for r in totals.collect()}                  # two rows
    empty = np.zeros(0, np.uint64)
    none = [0] * 6
    words = by.get("words")
    model = Model(folder, bits, words["n"] if words else 0, words["words"] if words else 0,
                  by["pairs"]["kinds"] if "pairs" in by else none, words["kinds"] if words else none)
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path)
    there = {os.path.basename(f.path) for f in fs.get_file_info(pyarrow.fs.FileSelector(path))}
    for shard in range(shards):                                    # shards without an entry
        for name, columns in ((f"pair-{shard:06d}", 1), (f"word-{shard:06d}", len(_FIELDS))):
            if name not in there:
                _store(folder, name, empty, *[np.zeros(0, np.int64)] * columns)
    return model


# ---------------------------------------------------------------- scoring

def log10_probabilities(model: Model, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log10 of the model, log10 of the add-half unigram base, whether the token was seen) of each token."""
    names, at = np.unique(np.concatenate([word, before]), return_inverse=True)
    seen, distinct_before, follows, once, twice, more = _look_up(model.folder, "word", model.bits, names, len(_FIELDS))
    w, v = at[:len(word)], at[len(word):]
    pairs, pair_at = np.unique(pair_hash(before, word), return_inverse=True)
    count = _look_up(model.folder, "pair", model.bits, pairs, 1)[0][pair_at]

    def discount(n, d):
        return np.where(n == 0, 0.0, np.where(n == 1, d[0], np.where(n == 2, d[1], d[2])))

    types = max(1, model.pair_types)
    below = np.maximum(distinct_before - discount(distinct_before, model.word_discounts), 0.0) / types + model.uniform
    context = np.maximum(follows, 1)
    d = model.discounts
    back_off = np.where(follows > 0, (d[0] * once + d[1] * twice + d[2] * more) / context, 1.0)
    p = np.maximum(count - discount(count, d), 0.0) / context[v] + back_off[v] * below[w]
    base = np.log10((seen + 0.5) / (model.train_tokens + 0.5 * (model.distinct + 1)))
    return np.log10(p), base[w], seen[w] > 0


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row, over whole texts.

    Null and empty texts are one end token. Repeated rows are repeated; other columns are not read; with nothing
    to learn from, every token has the uniform probability.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in chunks(batch, "text"):
                word, before, sizes = tokens(text)
                score_of, base_of, known = log10_probabilities(model, word, before)
                begin = np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), begin), pa.int64()),
                     pa.array(np.add.reduceat(base_of, begin), pa.float64()), pa.array(np.add.reduceat(score_of, begin), pa.float64())],
                    ["id", "n_tokens", "n_known", "base_score", "score"])

    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    scored = chosen.mapInArrow(run, "id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
                         F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
