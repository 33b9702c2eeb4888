"""Phrase collocations of two and three words per language, by the stripes pattern.

A stripe belongs to a prefix of one or two words and counts its next words. Tasks build stripes of their texts and
ship them whole; stripes of one prefix are merged elementwise. A merged stripe of one word gives the counts of its
extensions and, as the end of a piece counts as a next word too, the count of the prefix itself. Two-word prefixes
get stripes only where both pairs of a word triple are frequent, which a bitmap of frequent pairs mostly tells.
The merged stripes of two words hold the maxima by which a longer phrase swallows a shorter one.

A hot prefix, one with more than 1 / PARTS of all words, has its stripe split by ranges of the next word's hash, so
no merge holds more than its share. Words are known by 64-bit hashes that take in the language, see ``words``; a
prefix of two words by both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import c
from .bitmaps import bitmap, hit
from .packed import packed, packed_lengths, unpacked
from .stored import stored
from .words import Text, chunks, hash_spans, mix

LEAST = 10                  # occurrences of a candidate
SWALLOWED = 50              # 100 * f(longer) >= SWALLOWED * f drops a phrase
BEST = 2000                 # phrases reported per language
NO_LANGUAGE = "und"
PARTS = 4096                # a stripe holds this fraction of all words at most, or is split
FOLD = 1 << 21              # words whose stripes a task builds at once
MERGED = 1 << 20            # stripe entries merged at once
SALTS = 64                  # groups of a language that are ranked apart before the whole

# The signs that end a piece, and the blanks between words.
_END_SIGNS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_END_SIGNS)] = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0)         # next word at the end of a piece
_STRIPES = "lang string, w1 long, w2 long, part int, word string, nexts binary, counts binary"
_MERGED = "lang string, w1 long, w2 long, word string, total long, nexts array<struct<next: long, a: long, pair: long>>"


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _ODD + second)


class _Fold:
    """Words of some chunks, end to end."""

    def __init__(self):
        self.langs: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.texts: list[bytes] = []
        self.columns: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, rows: pa.RecordBatch, text: Text) -> None:
        """Take the texts of a chunk; ``rows`` has the language in its first column."""
        ends = text.offsets[1:].tolist()
        low = Text(b"\n".join(text.data[a:b] for a, b in zip(text.offsets[:-1].tolist(), ends)), text.offsets + np.arange(len(text.offsets))).lowered()
        kind = _KIND[np.frombuffer(low.data, np.uint8)]
        inside = np.concatenate([[False], kind == 0, [False]])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        stops = np.flatnonzero(inside[:-1] & ~inside[1:])
        if not len(starts):
            return
        piece = np.cumsum(kind == 2)[starts]
        spoken = rows.column(0).fill_null(NO_LANGUAGE).dictionary_encode()
        names = spoken.dictionary.to_pylist()
        codes = np.array([self.langs.setdefault(n, len(self.langs)) for n in names], np.int32)
        raw = [n.encode() for n in names]
        cuts = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        seeds = mix(hash_spans(b"".join(raw), cuts[:-1], cuts[1:]))
        doc = np.searchsorted(low.offsets, starts, side="right") - 1
        own = spoken.indices.to_numpy()[doc]
        keys = np.maximum(mix(hash_spans(low.data, starts, stops) ^ seeds[own]), np.uint64(1))
        joined = np.append(piece[1:] == piece[:-1], False)
        self.columns.append((keys, joined, codes[own], starts, stops, np.full(len(keys), len(self.texts), np.int32)))
        self.texts.append(low.data)
        self.size += len(keys)

    def take(self) -> tuple[list[bytes], tuple[np.ndarray, ...], list[str]]:
        """(texts, columns, names of languages); the fold is empty afterwards."""
        texts, columns = self.texts, tuple(map(np.concatenate, zip(*self.columns)))
        self._clear()
        return texts, columns, list(self.langs)


def _folds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], tuple[np.ndarray, ...], list[str]]]:
    fold = _Fold()
    for batch in batches:
        for rows, text in chunks(batch, "text"):
            fold.add(rows, text)
            if fold.size >= FOLD:
                yield fold.take()
    if fold.size:
        yield fold.take()


# ---------------------------------------------------------------- building stripes

def _hot_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, parts) of the words above 1 / PARTS of all words; tasks report what is half as hot in a fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (keys, *_), _ in _folds(batches):
            found, counts = np.unique(keys, return_counts=True)
            often = counts * 2 * PARTS >= len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(found[often].view(np.int64))]), pa.array(np.append(len(keys), counts[often]), pa.int64())], ["w", "n"])

    seen = stored(docs.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "hot-words")
    every = seen.filter("w IS NULL").first()
    return _parted(seen.filter("w IS NOT NULL"), "w", "n", every.n if every else 0)


def _parted(keys: DataFrame, key: str, count: str, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than PARTS * 3 keys are above their share: a word lies in at most three prefixes' stripes."""
    hot = keys.filter(F.col(count) * PARTS > every).select(key, count).toArrow()
    names, counts = hot.column(0).to_numpy().view(np.uint64), hot.column(1).to_numpy()
    order = np.argsort(names)
    return names[order], -(-counts[order] * PARTS // max(1, every))


def _stripes(first: np.ndarray, keys: np.ndarray, nexts: np.ndarray, hot) -> tuple[np.ndarray, ...]:
    """(row of the first occurrence, part, cuts, next words, counts) of the stripes of (key, next) rows."""
    order = np.lexsort((nexts, keys))
    k, x = keys[order], nexts[order]
    entry = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1])]))
    counts = np.diff(np.append(entry, len(k))).astype(np.uint32)
    k, x = k[entry], x[entry]
    part = np.zeros(len(k), np.int64)
    names, parts = hot
    if len(names):
        at = np.minimum(np.searchsorted(names, k), len(names) - 1)
        split = names[at] == k
        part[split] = 1 + ((x[split] >> np.uint64(32)) * parts[at[split]].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (part[1:] != part[:-1])]))
    return first[order[entry[head]]], part[head], np.append(head, len(k)), x, counts


def word_stripes(docs: DataFrame, hot) -> DataFrame:
    """Stripes of all words; the next word of a piece's last word is its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, (keys, joined, lang, starts, stops, chunk), names in _folds(batches):
            nexts = np.where(joined, np.append(keys[1:], _END), _END)
            row, part, cuts, x, counts = _stripes(np.arange(len(keys)), keys, nexts, hot.value)
            spelled = [texts[k][a:b] for k, a, b in zip(chunk[row].tolist(), starts[row].tolist(), stops[row].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names).take(pa.array(lang[row])), pa.array(keys[row].view(np.int64)), pa.array(np.zeros(len(row), np.int64)), pa.array(part, pa.int32()),
                 pa.array(spelled, pa.binary()).cast(pa.string()), packed(x, cuts), packed(counts, cuts)], ["lang", "w1", "w2", "part", "word", "nexts", "counts"])

    return docs.mapInArrow(run, _STRIPES)


def pair_stripes(docs: DataFrame, hot, frequent) -> DataFrame:
    """Stripes of pairs of words, of those word triples whose two pairs may both be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (keys, joined, lang, *_), names in _folds(batches):
            pairs = pair_key(keys[:-1], keys[1:])
            often = joined[:-1] & hit(frequent.value, pairs)
            at = np.flatnonzero(often[:-1] & often[1:])
            if not len(at):
                continue
            row, part, cuts, x, counts = _stripes(at, pairs[at], keys[at + 2], hot.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names).take(pa.array(lang[row])), pa.array(keys[row].view(np.int64)), pa.array(keys[row + 1].view(np.int64)), pa.array(part, pa.int32()),
                 pa.nulls(len(row), pa.string()), packed(x, cuts), packed(counts, cuts)], ["lang", "w1", "w2", "part", "word", "nexts", "counts"])

    return docs.mapInArrow(run, _STRIPES)


# ---------------------------------------------------------------- merging stripes

class _Merger:
    """Merges sorted stripe rows; the stripe that may go on in the next rows waits, merged."""

    def __init__(self):
        self.waiting: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        x, counts = unpacked(batch.column(5), np.uint64), unpacked(batch.column(6), np.uint32)
        self._hold(batch.select([0, 1, 2, 3, 4]), packed_lengths(batch.column(6), np.uint32), x, counts.astype(np.int64))

    def _hold(self, rows, lengths, x, counts) -> None:
        self.waiting.append((rows, lengths, x, counts))
        self.size += len(x)

    def merge(self, last: bool) -> pa.RecordBatch | None:
        if not self.waiting:
            return None
        rows = pa.Table.from_batches([w[0] for w in self.waiting]).combine_chunks().to_batches()[0]
        lengths, x, counts = (np.concatenate([w[k] for w in self.waiting]) for k in (1, 2, 3))
        self.waiting, self.size = [], 0
        w1, w2, part = (rows.column(k).to_numpy() for k in (1, 2, 3))
        head = np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (part[1:] != part[:-1])])
        group = np.repeat(np.cumsum(head) - 1, lengths)
        order = np.lexsort((x, group))
        group, x, counts = group[order], x[order], counts[order]
        entry = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (x[1:] != x[:-1])]))
        group, x, counts = group[entry], x[entry], np.add.reduceat(counts, entry)
        first = np.flatnonzero(head)
        cuts = np.searchsorted(group, np.arange(len(first) + 1))
        if not last:
            # The last stripe waits for more rows of its own.
            self._hold(rows.slice(int(first[-1]), 1), np.array([len(x) - cuts[-2]]), x[cuts[-2]:], counts[cuts[-2]:])
            first, x, counts, cuts = first[:-1], x[:cuts[-2]], counts[:cuts[-2]], cuts[:-1]
        return self._out(rows.take(pa.array(first)), x, counts, cuts) if len(first) else None

    @staticmethod
    def _out(rows: pa.RecordBatch, x, counts, cuts) -> pa.RecordBatch:
        totals = np.add.reduceat(counts, cuts[:-1])
        often = (counts >= LEAST) & (x != _END)
        upto = np.concatenate([[0], np.cumsum(often)])[cuts]
        w1 = rows.column(1).to_numpy().view(np.uint64)
        pairs = pair_key(np.repeat(w1, np.diff(upto)), x[often])
        lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(x[often].view(np.int64)), pa.array(counts[often]), pa.array(pairs.view(np.int64))], ["next", "a", "pair"]))
        kept = pa.array(np.flatnonzero((totals >= LEAST) | (rows.column(3).to_numpy() > 0)))
        made = pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), rows.column(4), pa.array(totals), lists],
                                          ["lang", "w1", "w2", "word", "total", "nexts"]).take(kept)
        # One row per language with the words of all its stripes, also of those that go.
        langs = rows.column(0).dictionary_encode()
        sums = np.bincount(langs.indices.to_numpy(), weights=None if not len(totals) else totals, minlength=len(langs.dictionary)).astype(np.int64)
        k = len(langs.dictionary)
        every = pa.RecordBatch.from_arrays([langs.dictionary, pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.string()), pa.array(sums),
                                            pa.nulls(k, lists.type)], made.schema.names)
        return pa.Table.from_batches([made, every.cast(made.schema)]).combine_chunks().to_batches()[0]


def merged(stripes: DataFrame) -> DataFrame:
    """Stripes merged elementwise: frequent extensions and the total of each, and each language's total under a null word.

    Rows of a stripe meet in one sorted partition, and Python holds one stripe or MERGED entries at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _Merger()
        for batch in batches:
            if batch.num_rows:
                merger.add(batch)
            if merger.size >= MERGED and (out := merger.merge(last=False)) is not None:
                yield out
        if (out := merger.merge(last=True)) is not None:
            yield out

    return stripes.repartition("w1", "w2", "part").sortWithinPartitions("w1", "w2", "part").mapInArrow(run, _MERGED)


# ---------------------------------------------------------------- scores

def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)), exact in 38 digits."""
    wide = lambda x: F.col(x).cast("decimal(18,0)")
    frame = {"up": wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), "down": wide(left) * wide(right)}
    return F.call_function("div", frame["up"], frame["down"])


def _first(df: DataFrame, order: list[Column], spread: list[str], most: int, ties: bool) -> DataFrame:
    """The first rows of each language, with the rows equal to the last one if ``ties``; hash groups are ranked before the whole."""
    place = F.rank() if ties else F.row_number()
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)))
    some = salted.withColumn("__rank", place.over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("__rank") <= most)
    return some.drop("__salt").withColumn("__rank", place.over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("__rank") <= most)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language.

    A null text is empty, a null language is ``und``; repeated rows count as often as they stand there; phrases do
    not cross the signs that end a piece, nor texts. Equal scores and counts are told apart by the phrase's bytes.
    A language without a candidate, or an empty table, gives no rows. Other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    chosen = docs.select(c(lang_col).cast("string").alias("lang"), c(text_col).cast("string").alias("text"))
    ones = stored(merged(word_stripes(chosen, context.broadcast(_hot_words(chosen)))), "word-stripes")
    langs = ones.filter("w1 IS NULL").groupBy("lang").agg(F.sum("total").alias("n"))
    single = stored(ones.filter("w1 IS NOT NULL").groupBy(F.col("w1").alias("w")).agg(F.sum("total").alias("f"), F.min("word").alias("word")), "word-counts")
    pairs = stored(ones.select("lang", "w1", F.explode("nexts").alias("e")).select("lang", "w1", F.col("e.next").alias("w2"), "e.a", "e.pair"), "word-pairs")

    every = langs.agg(F.sum("n")).first()[0] or 0
    hot = context.broadcast(_parted(pairs, "pair", "a", every))
    twos = merged(pair_stripes(chosen, hot, context.broadcast(bitmap(pairs, "pair"))))
    triples = stored(twos.select("lang", "w1", "w2", F.explode("nexts").alias("e")).select("lang", "w1", "w2", F.col("e.next").alias("w3"), "e.a"), "word-triples")

    part = lambda w, f: single.select(F.col("w").alias(w), F.col("f").alias(f))
    known = stored(pairs.select("lang", "w1", "w2", "a").join(part("w1", "l"), "w1").join(part("w2", "r"), "w2"), "word-pair-parts")
    swallowing = triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    shorter = (known.join(swallowing, ["w1", "w2"], "left").filter(f"longer IS NULL OR 100 * longer < {SWALLOWED} * a")
               .select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "l", "r", _score("a", "l", "r").alias("score")))
    ahead = known.select("w1", "w2", F.col("l").alias("l1"), F.col("a").alias("l2"))
    behind = known.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    cut = (triples.join(ahead, ["w1", "w2"]).join(behind, ["w2", "w3"])
           .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2")))
    early = F.col("s1") <= F.col("s2")
    longer = cut.select("lang", "w1", "w2", "w3", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))

    by_score = [F.desc("score"), F.desc("a")]
    top = stored(_first(shorter.union(longer), by_score, ["w1", "w2", "w3"], best, ties=True).drop("__rank"), "best-phrases")
    spelled = lambda w: single.select(F.col("w").alias(w), F.col("word").alias(f"t{w}"))
    text = top.join(spelled("w1"), "w1").join(spelled("w2"), "w2").join(spelled("w3"), "w3", "left").withColumn("phrase", F.concat_ws(" ", "tw1", "tw2", "tw3"))
    ranked = _first(text, [*by_score, F.asc("phrase")], ["phrase"], best, ties=False)
    return ranked.join(langs, "lang").select("lang", F.col("__rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# The same rows in DuckDB.
PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece_id, piece
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
ones AS (SELECT lang, piece_id, unnest(ws) AS w1, unnest(range(len(ws))) AS place
         FROM (SELECT lang, piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces)),
runs AS (SELECT lang, w1, lead(w1) OVER ordered AS w2, lead(w1, 2) OVER ordered AS w3
         FROM ones WINDOW ordered AS (PARTITION BY piece_id ORDER BY place)),
uni AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
bi AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
tri AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM uni GROUP BY lang),
swallowing AS (SELECT lang, w1, w2, max(f) AS longer
               FROM (SELECT lang, w1, w2, f FROM tri UNION ALL SELECT lang, w2, w3, f FROM tri) GROUP BY ALL),
cuts AS (
  SELECT bi.lang, concat_ws(' ', bi.w1, bi.w2) AS phrase, 1 AS place, bi.f AS a, x.f AS l, y.f AS r
  FROM bi JOIN uni x ON x.lang = bi.lang AND x.w1 = bi.w1 JOIN uni y ON y.lang = bi.lang AND y.w1 = bi.w2
  LEFT JOIN swallowing s ON s.lang = bi.lang AND s.w1 = bi.w1 AND s.w2 = bi.w2
  WHERE s.longer IS NULL OR 100 * s.longer < 50 * bi.f
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.w1, t.w2, t.w3), 1, t.f, x.f, y.f
  FROM tri t JOIN uni x ON x.lang = t.lang AND x.w1 = t.w1 JOIN bi y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.w1, t.w2, t.w3), 2, t.f, x.f, y.f
  FROM tri t JOIN bi x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN uni y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
