"""Source divergence audit: how far the words of each source of a language are from other sources and from all.

Terms that enough documents of a language hold are found by iceberg refinement of byte prefixes. The first level
counts documents per short prefix; each further level counts longer prefixes of only those terms whose shorter
prefix is in enough documents, since a term cannot be in more documents than its prefixes; the last level counts
whole terms. Prefixes are told by hashes in a bitmap of bounded size, whose false bits only let more through; the
last level counts exactly, per term one packed row of its sources and counts, merged term by term.

Sums over pairs of sources are taken in blocks of terms: a task holds one block of a language's terms for two tiles
of its sources and gives one sum per pair, so no pair is emitted per term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import c
from ..functions.skew import attach_small
from .bitmaps import bitmap, hit
from .packed import packed, packed_lengths, unpacked
from .stored import stored
from .words import Text, chunks, hash_spans, mix

LEAST_DOCS = 10             # documents of a language that hold a kept term
LEVELS = (3, 6, 12, 24)     # prefix bytes of the levels before whole terms; any levels give the same result
BEST = 10                   # terms reported per source
SCALE = 1_000_000_000
BLOCK_TERMS = 2048          # terms of one block, about
TILE = 128                  # sources of one tile
FOLD = 1 << 20              # terms of texts counted at once
MERGED = 1 << 19            # entries of terms merged at once
SALTS = 64

# A term is a run of ASCII letters and of bytes above ASCII.
_TERM = np.zeros(256, bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_WHOLE = np.uint64(0xD6E8FEB86659FD93)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Terms:
    """Terms of some texts: spans, document and language seed of each."""

    def __init__(self, rows: pa.RecordBatch, text: Text):
        ends = text.offsets[1:].tolist()
        low = Text(b"\n".join(text.data[a:b] for a, b in zip(text.offsets[:-1].tolist(), ends)), text.offsets + np.arange(len(text.offsets))).lowered()
        self.data = low.data
        inside = np.concatenate([[False], _TERM[np.frombuffer(low.data, np.uint8)], [False]])
        self.starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        self.ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        self.doc = np.searchsorted(low.offsets, self.starts, side="right") - 1
        spoken = rows.column(0).fill_null("").dictionary_encode()
        raw = [n.encode() for n in spoken.dictionary.to_pylist()]
        cuts = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        self.seed = mix(hash_spans(b"".join(raw), cuts[:-1], cuts[1:]))[spoken.indices.to_numpy()][self.doc]

    def keys(self, level: int, some: np.ndarray) -> np.ndarray:
        """Hashes of the first bytes of the terms at ``some``; a term that is no longer is marked as whole."""
        starts, ends = self.starts[some], self.ends[some]
        whole = ends - starts <= level
        hashes = hash_spans(self.data, starts, np.minimum(ends, starts + level)) ^ self.seed[some]
        return np.where(whole, mix(hashes ^ _WHOLE), mix(hashes + np.uint64(level)))

    def surviving(self, levels: tuple[int, ...], known: np.ndarray) -> np.ndarray:
        """Positions of the terms whose prefixes may be frequent at each of the levels they were counted at."""
        some, last = np.arange(len(self.starts)), 0
        for level in levels:
            # A term no longer than the level before was whole there.
            counted = self.ends[some] - self.starts[some] > last
            ok = ~counted
            ok[counted] = hit(known, self.keys(level, some[counted]))
            some, last = some[ok], level
        return some


def _once(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Mask of the first of equal (document, key) rows."""
    return ~pd.Series(mix(keys + doc.astype(np.uint64) * _ODD)).duplicated().to_numpy()


def _prefix_level(docs: DataFrame, levels: tuple[int, ...], known) -> DataFrame:
    """(key, docs): documents per prefix of the next level, of terms that survive the levels before."""
    before, level = levels[:-1], levels[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def fold():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], ["key", "docs"])

        for batch in batches:
            for rows, text in chunks(batch, "text"):
                terms = _Terms(rows, text)
                some = terms.surviving(before, known.value if before else None)
                # A term that was whole at the level before has been counted there.
                if before:
                    some = some[terms.ends[some] - terms.starts[some] > before[-1]]
                keys = terms.keys(level, some)
                held.append(keys[_once(terms.doc[some], keys)])
                size += len(held[-1])
                if size >= FOLD:
                    yield fold()
                    size = 0
        if size:
            yield fold()

    return docs.mapInArrow(run, "key long, docs long")


def frequent_prefixes(docs: DataFrame, levels: tuple[int, ...] = LEVELS, least: int = LEAST_DOCS) -> Broadcast:
    """Broadcast bitmap of the prefixes of all levels that at least ``least`` documents of their language hold."""
    context, found, known = docs.sparkSession.sparkContext, None, None
    for k in range(len(levels)):
        level = _prefix_level(docs, levels[:k + 1], known).groupBy("key").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("key")
        level = stored(level, "term-prefixes")
        found = level if found is None else found.union(level)
        known = context.broadcast(bitmap(found, "key"))
    return known


_STRIPES = "key long, lang string, term string, codes binary, docs binary, counts binary"
_KEPT = "lang string, code long, term string, n long, lang_n long, head int"


def _source_codes(names: list[str]) -> np.ndarray:
    raw = [n.encode() for n in names]
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return hash_spans(b"".join(raw), cuts[:-1], cuts[1:])


def _term_stripes(docs: DataFrame, levels: tuple[int, ...], known) -> DataFrame:
    """The last level: for each whole term of surviving prefixes, documents and occurrences per source, counted per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        held, texts, size = [], [], 0

        def fold():
            lang, code, keys, first, starts, ends, chunk = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((code, keys))
            k, x = keys[order], code[order]
            entry = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1])]))
            n = np.diff(np.append(entry, len(k))).astype(np.uint32)
            in_docs = np.add.reduceat(first[order], entry, dtype=np.uint32)
            head = np.flatnonzero(np.concatenate([[True], k[entry][1:] != k[entry][:-1]]))
            row, cuts = order[entry[head]], np.append(head, len(entry))
            spelled = [texts[c][a:b] for c, a, b in zip(chunk[row].tolist(), starts[row].tolist(), ends[row].tolist())]
            held.clear(), texts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[row].view(np.int64)), pa.array(list(langs)).take(pa.array(lang[row])), pa.array(spelled, pa.binary()).cast(pa.string()),
                 packed(x[entry], cuts), packed(in_docs, cuts), packed(n, cuts)], ["key", "lang", "term", "codes", "docs", "counts"])

        for batch in batches:
            for rows, text in chunks(batch, "text"):
                terms = _Terms(rows, text)
                some = terms.surviving(levels, known.value)
                if not len(some):
                    continue
                keys = mix(hash_spans(terms.data, terms.starts[some], terms.ends[some]) ^ terms.seed[some])
                spoken, sources = (rows.column(k).dictionary_encode() for k in (0, 1))
                lang = np.array([langs.setdefault(n, len(langs)) for n in spoken.dictionary.to_pylist()], np.int32)[spoken.indices.to_numpy()]
                code = _source_codes(sources.dictionary.to_pylist())[sources.indices.to_numpy()]
                doc = terms.doc[some]
                held.append((lang[doc], code[doc], keys, _once(doc, keys), terms.starts[some], terms.ends[some], np.full(len(some), len(texts), np.int32)))
                texts.append(terms.data)
                size += len(some)
                if size >= FOLD:
                    yield fold()
                    size = 0
        if size:
            yield fold()

    return docs.mapInArrow(run, _STRIPES)


def kept_terms(docs: DataFrame, levels: tuple[int, ...] = LEVELS, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, code, term, n, lang_n, head): occurrences of every kept term per source and in its language.

    ``docs`` has columns lang, source, text without nulls; sources are given by their hash. ``head`` is 1 in one row
    of each term. Rows of a term meet in one sorted partition; Python holds one term or MERGED entries at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def merge(last: bool) -> pa.RecordBatch:
            nonlocal size
            rows = pa.Table.from_batches([w[0] for w in waiting]).combine_chunks().to_batches()[0]
            lengths, code, in_docs, n = (np.concatenate([w[k] for w in waiting]) for k in (1, 2, 3, 4))
            waiting.clear()
            keys = rows.column(0).to_numpy()
            fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
            term = np.repeat(np.cumsum(fresh) - 1, lengths)
            order = np.lexsort((code, term))
            term, code = term[order], code[order]
            entry = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (code[1:] != code[:-1])]))
            in_docs, n, term, code = np.add.reduceat(in_docs[order], entry), np.add.reduceat(n[order], entry), term[entry], code[entry]
            first = np.flatnonzero(fresh)
            cuts = np.searchsorted(term, np.arange(len(first) + 1))
            done = len(first) if last else len(first) - 1
            size = 0
            if not last:
                # The last term may go on in the next rows.
                rest = slice(int(cuts[done]), len(code))
                waiting.append((rows.slice(int(first[done]), 1), np.array([len(code) - cuts[done]]), code[rest], in_docs[rest], n[rest]))
                size = len(code) - int(cuts[done])
            cuts = cuts[:done + 1]
            if not done:
                return None
            often = np.add.reduceat(in_docs[:cuts[-1]], cuts[:-1]) >= least
            total = np.add.reduceat(n[:cuts[-1]], cuts[:-1])
            keep = np.flatnonzero(np.repeat(often, np.diff(cuts)))
            own = pa.array(first[term[keep]])
            head = np.zeros(len(code), np.int32)
            head[cuts[:-1]] = 1
            return pa.RecordBatch.from_arrays([rows.column(1).take(own), pa.array(code[keep].view(np.int64)), rows.column(2).take(own), pa.array(n[keep]),
                                               pa.array(total[term[keep]]), pa.array(head[keep])], ["lang", "code", "term", "n", "lang_n", "head"])

        for batch in batches:
            if batch.num_rows:
                waiting.append((batch.select([0, 1, 2]), packed_lengths(batch.column(3), np.uint64), unpacked(batch.column(3), np.uint64),
                                unpacked(batch.column(4), np.uint32).astype(np.int64), unpacked(batch.column(5), np.uint32).astype(np.int64)))
                size += len(waiting[-1][2])
            if size >= MERGED and (out := merge(last=False)) is not None:
                yield out
        if waiting and (out := merge(last=True)) is not None:
            yield out

    stripes = _term_stripes(docs, levels, frequent_prefixes(docs, levels, least))
    return stripes.repartition("key").sortWithinPartitions("key").mapInArrow(run, _KEPT)


def _coded(groups: DataFrame) -> DataFrame:
    """(lang, source, code) of (lang, source) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _source_codes(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes.view(np.int64))], ["lang", "source", "code"])

    return groups.mapInArrow(run, "lang string, source string, code long")


# ---------------------------------------------------------------- divergences

def _share(count: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact in 38 digits; null without kept terms."""
    wide = lambda x: x.cast("decimal(20,0)")
    return 1 + F.call_function("div", (wide(count) + 2) * F.lit(SCALE).cast("decimal(10,0)"), F.nullif(wide(total) + wide(kept) * 2, F.lit(0).cast("decimal(20,0)")))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q stay below 2^31, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of the gaps of one block of terms for all pairs of two tiles of sources."""
    lang, low, high = rows["lang"].iloc[0], rows["low"].iloc[0], rows["high"].iloc[0]
    heads = rows[rows["term"].isna()]
    terms, met = pd.factorize(rows["term"])
    # The last column stands for the block's terms that no source of both tiles holds.
    width, absent = len(met) + 1, int(heads["size"].iloc[0]) - len(met)
    sides = []
    for tile in (low, high):
        of_tile = heads[heads["tile"] == tile].sort_values("place")
        places = of_tile["place"].to_numpy()
        shares = np.repeat(of_tile["p"].to_numpy(np.int64)[:, None], width, axis=1)
        own = ((rows["tile"] == tile) & rows["term"].notna()).to_numpy()
        shares[np.searchsorted(places, rows["place"].to_numpy()[own]), terms[own]] = rows["p"].to_numpy(np.int64)[own]
        sides.append((places, shares))
    (left, p), (right, q) = sides
    found = []
    for i in range(len(left)):
        later = np.flatnonzero(right > left[i])
        gap = (q[later] - p[i]) ** 2 // (q[later] + p[i])
        gap[:, -1] *= absent
        found.append((np.full(len(later), left[i]), right[later], gap.sum(axis=1)))
    one, other, value = (np.concatenate(x) for x in zip(*found))
    return pd.DataFrame({"lang": lang, "one": one, "other": other, "value": value})


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, one, other, value) of all pairs of places of a language's sources, the lower place first."""
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("kept") / BLOCK_TERMS))
    tiles = F.ceil(F.col("sources") / TILE)
    kept = kept.withColumn("block", F.pmod(F.xxhash64("term"), blocks))
    sizes = kept.groupBy("lang", "block").agg(F.sum("head").alias("size"))
    # A head row of every source, in every block, gives the share of terms that the source lacks. Without kept terms it is of no account.
    heads = groups.select("lang", "place", F.lit(None).cast("string").alias("term"), F.coalesce("p0", F.lit(1)).alias("p"), "sources",
                          F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block")).join(sizes, ["lang", "block"], "left").fillna(0, ["size"])
    columns = ["lang", "place", "term", "p", "sources", "block", "size"]
    rows = kept.withColumn("size", F.lit(0).cast("long")).select(columns).union(heads.select(columns))
    rows = rows.withColumn("tile", F.floor(F.col("place") / TILE)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    rows = rows.withColumn("low", F.least("tile", "with")).withColumn("high", F.greatest("tile", "with"))
    sums = (rows.select("lang", "block", "low", "high", "tile", "place", "term", "p", "size")
            .groupBy("lang", "block", "low", "high").applyInPandas(_pair_block, "lang string, one long, other long, value long"))
    return sums.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): each source against every other of its language, and its telling terms.

    Null text, language and source are ''. Part ``pair`` has a row per other source of the language, also for sources
    without a kept term; a language with one source has none. Part ``term`` has the kept terms that the source uses
    more than its language, the BEST by value. Equal values are ranked by the item's bytes. Repeated rows count as
    documents of their own; an empty table gives no rows. Other columns are not read.
    """
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit(""))
    chosen = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    found = stored(kept_terms(chosen), "kept-terms")
    langs = found.groupBy("lang").agg(F.sum("head").alias("kept"), F.sum("n").alias("lang_total"))
    totals = found.groupBy("lang", "code").agg(F.sum("n").alias("total"))
    in_lang = Window.partitionBy("lang")
    groups = (_coded(chosen.select("lang", "source").distinct()).join(totals, ["lang", "code"], "left").join(langs, "lang", "left")
              .fillna(0, ["kept", "total", "lang_total"])
              .withColumn("place", F.row_number().over(in_lang.orderBy("source")).cast("long") - 1).withColumn("sources", F.count("*").over(in_lang)))
    group_key = F.concat_ws(":", F.length("lang"), "lang", "code").alias("group")
    groups = stored(groups.select("*", group_key, _share(F.lit(0), F.col("total"), F.col("kept")).alias("p0")), "source-groups")

    shares = attach_small(found.select("term", "n", "lang_n", "head", group_key), groups, "group", ["term"])
    shares = stored(shares.select("lang", "source", "place", "sources", "kept", "term", "head", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                                  _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")), "term-shares")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    apart = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(SALTS))).orderBy(F.desc("value"), F.asc("item"))
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(apart)).filter(F.col("rank") <= BEST).withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= BEST)

    sums = stored(_pairs(shares, groups), "source-pairs")
    both = sums.union(sums.select("lang", F.col("other").alias("one"), F.col("one").alias("other"), "value"))
    names = groups.select("lang", F.col("place").alias("one"), "source")
    pairs = (both.join(names, ["lang", "one"]).join(names.select("lang", F.col("one").alias("other"), F.col("source").alias("item")), ["lang", "other"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value)))
    return pairs.union(terms)


# The same rows in DuckDB.
DIVERGENCE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
found AS (SELECT id, lang, source,
                 unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS BIGINT) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts SEMI JOIN kept USING (lang, term) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (l.total + 2 * l.v) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
