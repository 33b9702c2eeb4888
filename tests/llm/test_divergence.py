import re
from collections import Counter, defaultdict

import pytest

import oracle
from odd_rows import empty, frame
from twinsieve.llm import divergence as audit
from twinsieve.llm.queries import op12_prefix_iceberg

PATTERN = "[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def plain(rows, least=10):
    """Brute force in exact integers: (lang, source, part, item, value, rank)."""
    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = re.findall(PATTERN, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        docs.update((lang, t) for t in set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for (own, t), n in docs.items() if own == lang and n >= least]
        every = Counter()
        for s in sources:
            every.update(counts[lang, s])

        def shares(of):
            total = sum(of[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 2) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(every)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_query_against_sql(spark, sf_dir):
    assert oracle.compare(spark, oracle.connect(sf_dir), sf_dir, op12_prefix_iceberg, audit.DIVERGENCE_SQL) is None


ROWS = ([("en", f"s{k % 5}", f"Alpha beta{'x' * (k % 3)} gamma-{'longterm' * (k % 4)} the the the ß{'é' * (k % 2)} same{k % 12}") for k in range(90)]
        + [("en", "lone", "12 34 !"), ("en", None, "alpha the"), (None, "s0", "alpha"), (None, "s1", None), ("xx", "only", "the " * 5)]
        + [("de", f"q{k % 7}", "straße " + "x" * 40 + " Ünder " * (k % 3)) for k in range(30)])


@pytest.mark.parametrize("levels,fold,block,tile", [((3, 6, 12, 24), 1 << 22, 2048, 128), ((1,), 50, 2, 2), ((2, 4, 8, 16, 32), 20, 3, 3), ((30,), 7, 1, 1)])
def test_brute_force(spark, monkeypatch, levels, fold, block, tile):
    monkeypatch.setattr(audit, "FOLD", fold)
    monkeypatch.setattr(audit, "MERGED", fold)
    monkeypatch.setattr(audit, "BLOCK_TERMS", block)
    monkeypatch.setattr(audit, "TILE", tile)
    monkeypatch.setattr(audit.kept_terms, "__defaults__", (levels, 10))
    docs = spark.createDataFrame(ROWS, "lang string, source string, text string").repartition(4)
    assert got(audit.divergence(docs)) == plain(ROWS)


def test_prefixes_shrink_level_by_level(spark):
    docs = spark.createDataFrame([("en", "s", f"common{'abcdefghij'[k % 10]} shared") for k in range(40)], "lang string, source string, text string")
    known = audit.frequent_prefixes(docs, (3,))
    level = audit._prefix_level(docs, (3, 6), known).groupBy("key").sum("docs").collect()
    assert sorted(r[1] for r in level) == [40, 40]                                           # "common", "shared" as a whole
    known = audit.frequent_prefixes(docs, (3, 6))
    assert audit._term_stripes(docs, (3, 6), known).select("term").distinct().count() == 11
    assert {r.term for r in audit.kept_terms(docs, (3, 7)).collect()} == {"shared"}


def test_odd_rows(spark):
    docs = frame(spark).selectExpr("text", "token AS lang", "CAST(id % 3 AS string) AS source", "score AS value", "doc_id AS rank", "shard AS item", "id AS p")
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert got(audit.divergence(docs)) == plain(rows)
    assert audit.divergence(empty(spark).selectExpr("text", "token AS lang", "shard AS source")).count() == 0
