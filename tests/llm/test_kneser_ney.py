import collections
import math
import zlib

import numpy as np
import pytest

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import kneser_ney as kn
from twinsieve.llm.queries import table
from twinsieve.llm.words import hash_spans


class Brute:
    def __init__(self, rows):
        self.words, self.pairs = collections.Counter(), collections.Counter()
        for key, text in rows:
            if zlib.crc32(("" if key is None else str(key)).encode()) % 5 != 1:
                w = self.tokens(text)
                self.words.update(w)
                self.pairs.update(zip([None, *w[:-1]], w))
        self.context = collections.defaultdict(lambda: [0, 0, 0, 0])
        self.before = collections.Counter()
        for (v, w), n in self.pairs.items():
            self.context[v][0] += n
            self.context[v][min(n, 3)] += 1
            self.before[w] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.d2, self.d1 = (kn._discounts([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]) for c in (self.pairs, self.before))
        kinds = [sum(min(x, 3) == k for x in self.before.values()) for k in (1, 2, 3)]
        self.rest = sum(d * k for d, k in zip(self.d1, kinds)) / max(1, len(self.pairs)) if self.pairs else 1.0

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), 0]

    def p(self, v, w):
        below = max(self.before[w] - (self.d1[min(self.before[w], 3) - 1] if self.before[w] else 0), 0) / max(1, len(self.pairs)) + self.rest / (self.v + 1)
        if v not in self.context:
            return below
        total, *kinds = self.context[v]
        n = self.pairs[v, w]
        return max(n - (self.d2[min(n, 3) - 1] if n else 0), 0) / total + sum(d * k for d, k in zip(self.d2, kinds)) / total * below


def _check(rows, found):
    model = Brute(rows)
    want = []
    for key, text in rows:
        w = model.tokens(text)
        want.append((key is None, key or 0, zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1, len(w), sum(x in model.words for x in w), model.n,
                     sum(math.log10((model.words[x] + 0.5) / (model.n + 0.5 * (model.v + 1))) for x in w),
                     sum(math.log10(model.p(v, x)) for v, x in zip([None, *w[:-1]], w))))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    for a, b in zip(sorted(want), got, strict=True):
        assert a[:6] == b[:6]
        assert b[6:] == pytest.approx(a[6:], rel=1e-9)


def test_query_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = kn.score(docs, kn.train(docs)).collect()
    _check([(r.doc_id, r.text) for r in docs.collect()], found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark):
    _check(TEXTS, kn.score(frame(spark), kn.train(frame(spark))).collect())
    none = kn.train(empty(spark))
    assert none.train_tokens == 0 and kn.score(empty(spark), none).count() == 0
    _check([], kn.score(empty(spark), none).collect())
    assert all(math.isfinite(r.score) for r in kn.score(frame(spark), none).collect())


def test_probabilities_sum_to_one(spark):
    rows = [(i, t) for i, t in enumerate(["a b a c", "b a b a a", "c c a", "d a b", "a b c d", "b b"] * 3)]
    model = kn.train(spark.createDataFrame(rows, "doc_id long, text string"))
    words = [hash_spans(w.encode(), np.array([0]), np.array([1]))[0] for w in "abcd"]
    everything = np.array([*words, kn.END, 12345], np.uint64)           # the last one stands for all unknown words
    for context in (*words, kn.START):
        logs, _, _ = kn.log10_probabilities(model, everything, np.full(len(everything), context, np.uint64))
        assert (10 ** logs).sum() == pytest.approx(1)
