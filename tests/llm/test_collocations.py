import re
from collections import Counter

import pytest

import oracle
from odd_rows import empty, frame
from twinsieve.llm import collocations as words
from twinsieve.llm.queries import op11_stripes


def plain(rows, best=words.BEST):
    """Brute force in exact integers: (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for k in (1, 2, 3):
                counts.update((lang, tuple(found[i:i + k])) for i in range(len(found) - k + 1))
    candidates = {g: f for g, f in counts.items() if len(g[1]) > 1 and f >= 10}
    out = {}
    for (lang, gram), a in candidates.items():
        held = [f for (other, longer), f in candidates.items() if other == lang and len(longer) > len(gram) and gram in (longer[:2], longer[1:])]
        if any(100 * f >= 50 * a for f in held):
            continue
        cuts = [(10**6 * a * a // (counts[lang, gram[:k]] * counts[lang, gram[k:]]), k) for k in range(1, len(gram))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(gram).encode(), " ".join(gram), counts[lang, gram[:k]], counts[lang, gram[k:]]))
    return sorted((lang, rank, phrase, -a, left, right, totals[lang], -score)
                  for lang, found in out.items() for rank, (score, a, _, phrase, left, right) in enumerate(sorted(found)[:best], 1))


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_query_against_sql(spark, sf_dir):
    assert oracle.compare(spark, oracle.connect(sf_dir), sf_dir, op11_stripes, words.PHRASES_SQL) is None


TEXTS = [("en", "New york City, new york state. the new york the"), ("en", "san  francisco\tbay; san francisco bay ! of the of the of the of the"),
         (None, "san francisco bay"), ("de", "Ärger ärger ÄRGER ärger"), ("und", "san francisco Bay\x0bsan"), ("en", None), ("en", ""), ("", "a b c a b c a b c a b c")]


@pytest.mark.parametrize("hot", [1, 4, 4096])
def test_brute_force_with_split_stripes(spark, monkeypatch, hot):
    """One part for all, hot words in a few parts, many parts; folds and merges of a few entries."""
    monkeypatch.setattr(words, "PARTS", hot)
    monkeypatch.setattr(words, "FOLD", 40)
    monkeypatch.setattr(words, "MERGED", 16)
    rows = [(lang, text) for k in range(11) for lang, text in TEXTS] + [("en", f"new york w{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = plain(rows)
    assert want and got(words.collocations(docs)) == want


def test_ties_at_the_last_rank(spark):
    rows = [("en", f"a{k} b{k}. ä{k} b{k}") for k in range(30) for _ in range(10)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(words.collocations(docs, best=17)) == plain(rows, 17)


def test_products_past_64_bits(spark):
    df = spark.createDataFrame([(4_000_000_007, 4_000_000_011, 5_000_000_029)], "a long, l long, r long")
    found = df.select(words._score("a", "l", "r")).first()[0]
    assert found == 10**6 * 4_000_000_007**2 // (4_000_000_011 * 5_000_000_029)


def test_odd_rows(spark):
    docs = frame(spark).selectExpr("text", "token AS lang", "id AS n", "score AS rank", "doc_id AS w1", "shard AS phrase")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(words.collocations(docs)) == plain(rows)
    assert words.collocations(empty(spark).withColumnRenamed("token", "lang")).count() == 0
