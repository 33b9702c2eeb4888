"""Toxicity of restored text: a noisy channel undoes leetspeak, spacing and repetition before scoring.

Words that may be disguised (a substitute sign beside letters, a letter three times in a row, a chain of single
letters) become lattices: every sign may stand for the letters it imitates, a run of one letter for one or two
of them, and at every gap or separator a word may end or go on. Viterbi decoding under a model of four characters
picks the likeliest plain words, whatever the length. Signs at the edges of a word are read both as punctuation and
as letters. All other words have a lattice with one path and are their
own restoration. A logistic model over the restored words and their
beginnings scores the document.

The character model is counted over all texts. The classifier is fitted on a bounded sample of labelled rows
(``SAMPLE_PER_CLASS``), drawn by hash; Spark counts the features of its texts, and only those that tell the classes
apart are gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from .stored import Tables, small_batches
from .units import tidied
from .words import Text, chunks, hash_spans, mix

SAMPLE_PER_CLASS = 3000     # labelled rows of each class that the classifier learns from
MOST_FEATURES = 1 << 18     # size of the classifier: features that differ most (4 MB)
BEGINNINGS = (4, 5, 6)      # a word's first bytes are features too, so inflected and compound forms count
CUT = 0.7
LEAST_DOCS = 3              # documents of the sample a feature must occur in
LEAST_Z = 4.0               # difference of its shares in both classes, in standard deviations
EPOCHS = 300
RIDGE = 1e-3

# Signs and the letters they imitate (fixed values).
SUBSTITUTES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
SUBSTITUTE_COST = 1.0       # in nats
REPEAT_COST = 0.5
SEPARATORS = ".-_*"

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_EDGE = 26                  # word boundary
_OTHER = 27                 # any other sign
_SYMBOLS = 28
ORDER = 4                   # characters of a run that the model counts
_CLASS = np.full(256, _OTHER)
_CLASS[[9, 10, 11, 12, 13, 32]] = _EDGE
for _k, _letter in enumerate(_LETTERS):
    _CLASS[ord(_letter)] = _CLASS[ord(_letter.upper())] = _k
_IS_LETTER = _CLASS < 26
_SYMBOL = _CLASS.tolist()
_START = sum(_EDGE * _SYMBOLS ** k for k in range(ORDER - 1))
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[[ord(s) for s in SUBSTITUTES]] = True
_IS_TRIM = np.zeros(256, bool)
_IS_TRIM[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


# ---------------------------------------------------------------- character model

def _gram_counts(text: Text) -> np.ndarray:
    """Runs of ORDER symbols of every text by itself: edges before, between and after the texts keep them apart."""
    apart = b" " * (ORDER - 1)
    texts = apart.join(text.data[a:b] for a, b in zip(text.offsets[:-1].tolist(), text.offsets[1:].tolist()))
    symbols = _CLASS[np.frombuffer(apart + texts + apart, np.uint8)]
    room = len(symbols) - ORDER + 1
    grams = np.zeros(room, np.int64)
    for k in range(ORDER):
        grams = grams * _SYMBOLS + symbols[k:k + room]
    return np.bincount(grams, minlength=_SYMBOLS ** ORDER)


def model_of(counts: np.ndarray) -> np.ndarray:
    """Log probabilities [all before the last, last, next] from the counts of all runs of ORDER symbols, each order smoothed by the one below."""
    below = counts.reshape(-1, _SYMBOLS).sum(0) + 1.0
    below /= below.sum()
    for order in range(2, ORDER + 1):
        seen = counts.reshape(-1, _SYMBOLS ** (order - 1), _SYMBOLS).sum(0) + 4 * np.tile(below.reshape(-1, _SYMBOLS), (_SYMBOLS, 1))
        below = seen / seen.sum(1, keepdims=True)
    return np.log(below).reshape(-1, _SYMBOLS, _SYMBOLS)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """``model_of`` all texts. Each task adds its counts; the sums are a table of at most 28^4 rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS ** ORDER, np.int64)
        for batch in batches:
            for _, text in chunks(batch, "text"):
                total += _gram_counts(text)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["gram", "n"])

    counted = docs.select(c(text_col).cast("string").alias("text")).mapInArrow(tidied(count), "gram int, n long")
    found = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()      # at most 614,656 rows
    counts = np.zeros(_SYMBOLS ** ORDER)
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return model_of(counts)


def _arcs(word: str) -> Iterator[list[tuple[str, float]]]:
    """Readings, as (text, cost), of each sign, run of a letter or gap in turn; a space in a reading ends a word."""
    # Asterisks are separators if all that stands between them is single signs; else each hides a letter.
    parts = word.strip("*").split("*")
    spaced = len(parts) > 2 and all(len(x) == 1 for x in parts)
    first, last = len(word) - len(word.lstrip("*")), len(word.rstrip("*"))
    at = 0
    while at < len(word):
        sign, end = word[at], at + 1
        if sign.isspace() or sign in SEPARATORS and sign != "*":
            while end < len(word) and (word[end].isspace() or word[end] in SEPARATORS and word[end] != "*"):
                end += 1
            yield [("", 0.0), (" ", 0.0)]
        elif sign == "*":
            hidden = [(x, SUBSTITUTE_COST) for x in SUBSTITUTES[sign]]
            if first <= at < last:
                yield hidden + ([("", 0.0), (" ", 0.0)] if spaced else [])
            else:
                yield hidden + [(sign, 0.0)]
        else:
            while end < len(word) and word[end] == sign:
                end += 1
            run = end - at
            readings: list[tuple[str, float]] = []
            for letter, cost in [(sign, 0.0)] + [(x, SUBSTITUTE_COST) for x in SUBSTITUTES.get(sign, "")]:
                if letter.isascii() and letter.isalpha() and run > 1:
                    readings += [(letter, cost + REPEAT_COST * (run > 2)), (letter * 2, cost + REPEAT_COST * (run > 2))]
                else:
                    readings.append((letter * run, cost))
            yield readings
        at = end


def restore(word: str, model: np.ndarray | list[float]) -> str:
    """Likeliest plain reading of one lower-case word or chain of letters; spaces tell its words apart.

    A state is the last ORDER - 1 symbols; an arc takes one sign, a whole run of a letter, or a gap. Signs that are
    neither letters nor substitutes stay as they are. Paths are linked backwards, so the work is linear.
    """
    table = model.ravel().tolist() if isinstance(model, np.ndarray) else model
    states = _SYMBOLS ** (ORDER - 1)
    best: dict[int, tuple[float, tuple | None]] = {_START: (0.0, None)}
    for readings in _arcs(word):
        coded = [(reading, cost, [_SYMBOL[x] if (x := ord(sign)) < 256 else _OTHER for sign in reading])
                 for reading, cost in readings]
        after: dict[int, tuple[float, tuple | None]] = {}
        for before, (score, path) in best.items():
            for reading, cost, symbols in coded:
                if symbols == [_EDGE] and before % _SYMBOLS == _EDGE:
                    continue
                total, state = score - cost, before
                for symbol in symbols:
                    at = state * _SYMBOLS + symbol
                    total += table[at]
                    state = at % states
                if state not in after or after[state][0] < total:
                    after[state] = total, ((path, reading) if reading else path)
        best = after
    ended = {state: score + (table[state * _SYMBOLS + _EDGE] if state % _SYMBOLS != _EDGE else 0.0) for state, (score, _) in best.items()}
    path = best[max(ended, key=ended.get)][1]
    out = []
    while path is not None:
        path, reading = path
        out.append(reading)
    return "".join(reversed(out))


# ---------------------------------------------------------------- features of a chunk

_RESTORED: dict[tuple[bytes, bool], list[bytes]] = {}
_LAST: list = [None, None]
_PUNCTUATION = bytes(np.flatnonzero(_IS_TRIM).tolist())
_NO_LETTERS = bytes(np.flatnonzero(_IS_TRIM & ~_IS_SIGN).tolist())


def _table(model: np.ndarray) -> list[float]:
    """The model as a flat list, made once a task; words restored under another model are forgotten."""
    if _LAST[0] is not model:
        _LAST[:] = model, model.ravel().tolist()
        _RESTORED.clear()
    return _LAST[1]


def _restored(raw: bytes, table: list[float], bare: bool = True) -> list[bytes]:
    """Plain words of a disguised word or chain; signs at either edge are read as punctuation and as letters.

    Without ``bare`` the reading with both edges as punctuation is left out.
    """
    found = _RESTORED.get((raw, bare))
    if found is None:
        whole = raw.strip(_NO_LETTERS) or raw[:1]
        core = whole.strip(_PUNCTUATION) or whole[:1]
        readings = {whole, whole.lstrip(_PUNCTUATION) or core, whole.rstrip(_PUNCTUATION) or core, core} - (set() if bare else {core})
        plain = {x for reading in readings for x in restore(reading.decode(errors="replace"), table).split()}
        found = sorted({x.encode().strip(_PUNCTUATION) or x[:1].encode() for x in plain})
        if len(raw) <= 256:                 # longer ones seldom come again
            if len(_RESTORED) >= 200_000:
                _RESTORED.clear()
            _RESTORED[raw, bare] = found
    return found


def features(text: Text, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document number, feature) of all restored words and their beginnings; repeats are kept."""
    low = text.lowered()
    starts, ends, first = low.words()
    b = np.frombuffer(low.data, np.uint8)
    docs = np.repeat(np.arange(len(first) - 1), np.diff(first))

    def inside(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return sums[ends] - sums[starts]

    letters = inside(_IS_LETTER[b])
    triple = np.zeros(len(b), bool)
    triple[2:] = (b[2:] == b[1:-1]) & (b[1:-1] == b[:-2]) & _IS_LETTER[b[2:]]
    separated = np.zeros(len(b), bool)
    if len(b) > 4:
        apart = np.isin(b, [ord(s) for s in SEPARATORS])
        separated[4:] = _IS_LETTER[b[4:]] & apart[3:-1] & _IS_LETTER[b[2:-2]] & apart[1:-3] & _IS_LETTER[b[:-4]]
    # Plain edges: trim the punctuation around a word.
    left, right = starts.copy(), ends.copy()
    for edge, step in ((left, 1), (right, -1)):
        going = np.arange(len(left))
        while len(going):
            going = going[right[going] - left[going] > 1]
            at = edge[going] if step > 0 else edge[going] - 1
            going = going[_IS_TRIM[b[at]]]
            edge[going] += step
    kept_signs = np.concatenate([[0], np.cumsum(_IS_SIGN[b], dtype=np.int32)])
    odd = (letters > 0) & ((kept_signs[right] > kept_signs[left]) | (inside(triple) > 0) | (inside(separated) > 0))
    # Signs at the edges are punctuation, or imitate an edge letter, as in "$word".
    edged = (letters > 0) & ~odd & (inside(_IS_SIGN[b]) > 0)
    # Chains of single letters, as in "w o r d".
    single = (right - left == 1) & (letters == 1)
    chained = np.zeros(len(single), bool)
    if len(single) > 2:
        here = single[2:] & single[1:-1] & single[:-2] & (docs[2:] == docs[:-2])
        chained[2:] |= here
        chained[1:-1] |= here
        chained[:-2] |= here
    plain = ~(odd | chained)

    table = _table(model)
    made, made_docs = [], []

    def add(low_at: int, high_at: int, doc: int, bare: bool = True) -> None:
        words = _restored(low.data[low_at:high_at], table, bare)
        made.extend(words)
        made_docs.extend([doc] * len(words))

    for i in np.flatnonzero(odd & ~chained).tolist():
        add(starts[i], ends[i], docs[i])
    for i in np.flatnonzero(edged & ~chained).tolist():
        add(starts[i], ends[i], docs[i], bare=False)
    # A chain ends where a word is no single letter or the document ends.
    at = np.flatnonzero(chained)
    breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(docs[at]) > 0)) + 1 if len(at) else []
    for chain in np.split(at, breaks) if len(at) else []:
        add(starts[chain[0]], ends[chain[-1]], docs[chain[0]])
    sizes = np.fromiter(map(len, made), np.int64, len(made))
    offset = len(low.data)
    data = low.data + b"".join(made)
    more = offset + np.cumsum(sizes) - sizes
    all_left = np.concatenate([left[plain], more])
    all_right = np.concatenate([right[plain], more + sizes])
    owner = np.concatenate([docs[plain], np.array(made_docs, np.int64)])
    out_docs, out = [owner], [hash_spans(data, all_left, all_right)]
    for size in BEGINNINGS:
        long = all_right - all_left > size
        out_docs.append(owner[long])
        out.append(mix(hash_spans(data, all_left[long], all_left[long] + size) + np.uint64(size)))
    return np.concatenate(out_docs), np.concatenate(out)


# ---------------------------------------------------------------- classifier

@dataclass
class Scorer:
    """Weights of the features that tell the classes apart."""

    model: np.ndarray
    keys: np.ndarray            # sorted features
    weights: np.ndarray
    bias: float

    def parts(self) -> tuple:
        """Plain arrays and numbers, which workers can read without this module."""
        return self.model, self.keys, self.weights, self.bias

    def scores(self, text: Text) -> np.ndarray:
        docs, found = features(text, self.model)
        flags = np.zeros(1 << 16, bool)
        flags[(self.keys >> np.uint64(48)).astype(np.int64)] = True
        near = flags[(found >> np.uint64(48)).astype(np.int64)]
        docs, found = docs[near], found[near]
        at = np.minimum(np.searchsorted(self.keys, found), max(0, len(self.keys) - 1))
        hit = self.keys[at] == found if len(self.keys) else np.zeros(len(found), bool)
        seen = np.unique(docs[hit] * np.int64(len(self.keys) + 1) + at[hit])       # a feature counts once a document
        total = np.full(len(text.offsets) - 1, self.bias)
        if len(seen):
            total += np.bincount(seen // (len(self.keys) + 1), self.weights[seen % (len(self.keys) + 1)], len(total))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id's text, modulo 3, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer:
    """Character model over all rows, classifier over a bounded hash sample of labelled rows that are not held out.

    Null labels teach nothing; an id with several labels is toxic if one says so, one with several texts teaches the
    first in byte order. With a class missing the scorer knows nothing and scores the share of toxic rows.
    """
    small_batches(docs.sparkSession)
    model = character_model(docs, text_col)
    known = (labels.select(c(id_col).cast("long").alias("id"), c(label_col).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    drawn = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CLASS) for y in (0, 1)]
    sample = F.broadcast(drawn[0].union(drawn[1]))              # at most 2 * SAMPLE_PER_CLASS rows
    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text")).join(sample, "id")
    chosen = chosen.groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    spark, tables = docs.sparkSession, Tables(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in chunks(batch, "text", 1 << 20):
                owner, found = features(text, shared.value)
                pairs = np.unique(np.stack([owner.astype(np.uint64), found], 1), axis=0) if len(found) else np.zeros((0, 2), np.uint64)
                ends = np.searchsorted(pairs[:, 0], np.arange(rows.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs[:, 1].copy().view(np.int64)))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], ["id", "y", "found"])

    taught = tables.stored(chosen.mapInArrow(tidied(extract), "id long, y int, found array<long>"), "toxicity-features")
    n, toxic = taught.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if toxic in (0, n):
        tables.drop_all()
        share = toxic / n if n else 0.0
        return Scorer(model, np.zeros(0, np.uint64), np.zeros(0), math.log((share + 1e-9) / (1 - share + 1e-9)))
    keys = np.sort(_telling(taught, n, toxic).toArrow().column("feature").to_numpy().view(np.uint64))
    kept = spark.sparkContext.broadcast(keys)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            found = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.minimum(np.searchsorted(kept.value, found), max(0, len(kept.value) - 1))
            hit = kept.value[at] == found if len(kept.value) else np.zeros(len(found), bool)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(sizes)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(at[hit], pa.int32()))],
                                             ["id", "y", "columns"])

    # Rows of the bounded sample, with columns of the bounded classifier.
    rows = taught.mapInArrow(tidied(select), "id long, y int, columns array<int>").toArrow().sort_by("id")
    tables.drop_all()
    lists = rows.column("columns").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return _fit(model, keys, rows.column("y").to_numpy().astype(float), np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(zero_copy_only=False))


def _telling(taught: DataFrame, n: int, n_toxic: int) -> DataFrame:
    """Features whose shares of the two classes differ clearly: column ``feature``."""
    seen = taught.select("y", F.explode("found").alias("feature")).groupBy("feature").agg(F.sum("y").alias("toxic"), F.count("*").alias("seen"))
    clean, pooled = F.col("seen") - F.col("toxic"), F.col("seen") / n
    spread = F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-12)) * (1 / n_toxic + 1 / (n - n_toxic)))
    z = F.abs(F.col("toxic") / n_toxic - clean / (n - n_toxic)) / spread
    clear = seen.filter(F.col("seen") >= LEAST_DOCS).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
    return clear.orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).select("feature")


def _fit(model: np.ndarray, keys: np.ndarray, y: np.ndarray, rows: np.ndarray, column: np.ndarray) -> Scorer:
    """Logistic regression by adaptive gradient steps; row ``rows[i]`` has feature ``keys[column[i]]``."""
    weights, bias = np.zeros(len(keys)), 0.0
    past, past_bias = np.full(len(keys), 1e-8), 1e-8
    for _ in range(EPOCHS):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(rows, weights[column], len(y)), -30, 30)))
        gap = (p - y) / len(y)
        step = np.bincount(column, gap[rows], len(keys)) + RIDGE / len(y) * weights
        past += step * step
        past_bias += gap.sum() ** 2
        weights -= 0.5 * step / np.sqrt(past)
        bias -= 0.5 * gap.sum() / math.sqrt(past_bias)
    return Scorer(model, keys, weights, bias)


# ---------------------------------------------------------------- Spark side

def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row, over whole texts; nothing is shuffled.

    Null and empty texts get the score of a text without known words. Repeated rows are repeated; other columns
    are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer.parts())   # features that passed the test on a bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = Scorer(*shared.value)
        for batch in batches:
            for rows, text in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(used.scores(text), pa.float64())], ["id", "score"])

    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    scored = chosen.mapInArrow(tidied(run), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored at the cut or above; all columns as they were, nothing shuffled."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer.parts())

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = Scorer(*shared.value)
        for batch in batches:
            for rows, text in chunks(batch, text_col):
                yield rows.filter(pa.array(used.scores(text) < CUT))

    return docs.mapInArrow(tidied(clean), docs.schema)
