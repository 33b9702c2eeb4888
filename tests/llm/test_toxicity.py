import zlib

import numpy as np
import pytest

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import toxicity
from twinsieve.llm.queries import table
from twinsieve.llm.words import Text, hash_spans


@pytest.fixture(scope="module")
def scorer(spark, sf_dir):
    return toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "the idiot was a loser and stupid as a worthless scum, a clown in the world so cool") for i in range(50)]
    return toxicity.character_model(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("raw, plain", [("1d10t", "idiot"), ("l0s3r", "loser"), ("stuuuuupid", "stupid"), ("scummmm", "scum"), ("cool", "cool"),
                                        ("5tup1d", "stupid"), ("worthless", "worthless")])
def test_lattice_decoding(model, raw, plain):
    assert toxicity.restore(raw, model) == plain


def test_spacing_and_separators_join(model):
    data = b"you i d i o t and s.t.u.p.i.d. $cum, plain 2024"
    owners, found = toxicity.features(Text(data, np.array([0, len(data)])), model)
    for word in (b"idiot", b"stupid", b"scum", b"plain", b"you", b"and", b"2024"):
        assert hash_spans(word, np.array([0]), np.array([len(word)]))[0] in found
    assert set(owners.tolist()) == {0}


def _words(data, model, words):
    _, found = toxicity.features(Text(data, np.array([0, len(data)])), model)
    return [w for w in words if hash_spans(w, np.array([0]), np.array([len(w)]))[0] in found]


@pytest.mark.parametrize("data, words", [
    (b"a s t u p i d", [b"a", b"stupid"]), (b"y o u i d i o t", [b"you", b"idiot"]), (b"y.o.u.s.t.u.p.i.d.i.d.i.o.t", [b"you", b"stupid", b"idiot"]),
    (b"id*ot", [b"idiot"]), (b"st*pid", [b"stupid"]), (b"i*d*i*o*t", [b"idiot"]),
    (b"!diot", [b"idiot"]), (b"|diot", [b"idiot"]), (b"idio+", [b"idiot"]), (b"(idiot)", [b"idiot"]), (b"idiot!!!", [b"idiot"]),
    (b"s" + b"t" * 200 + b"upid", [b"stupid"]), (b".".join([b"y.o.u.i.d.i.o.t"] * 9), [b"you", b"idiot"])])
def test_gaps_signs_and_lengths_are_decoded(scorer, data, words):
    assert _words(data, scorer.model, words) == words


def test_chains_have_no_block_edges(scorer):
    for before in range(56, 68):                        # the word stands across every place near 64
        text = " ".join("the" * (before // 3) + "a" * (before % 3) + "stupid").encode()
        assert _words(text, scorer.model, [b"stupid"]) == [b"stupid"], before


def test_model_probabilities_sum_to_one(model):
    assert np.allclose(np.exp(model).sum(2), 1)


def test_held_out_accuracy_and_contract(spark, sf_dir, scorer):
    docs = table(spark, sf_dir, "documents")
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    rows = toxicity.score(docs, scorer).collect()
    assert len(rows) == docs.count()
    held = []
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.held_out and r.doc_id in labels:
            held.append((r.predicted, labels[r.doc_id]))
    hits = sum(p and y for p, y in held)
    assert hits >= 0.6 * sum(y for _, y in held)
    assert hits >= 0.9 * sum(p for p, _ in held)


def test_disguised_words_are_caught(spark, sf_dir, scorer):
    plain = "That was the thing and it is on the table for them "
    rows = [(1, plain + "you idiot moron"), (2, plain + "you 1d10t m0r0n"), (3, plain + "you i d i o t m.o.r.o.n"), (4, plain)]
    found = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), scorer).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 0}


def test_odd_rows(spark, scorer):
    assert toxicity.score(frame(spark), scorer).count() == len(TEXTS)
    kept = toxicity.without_toxic(frame(spark), scorer)
    assert kept.columns == frame(spark).columns
    assert toxicity.score(empty(spark), scorer).count() == 0
    labels = spark.createDataFrame([(1, None), (5, 0)], "doc_id long, toxic int")
    blank = toxicity.fit(frame(spark), labels)
    assert all(r.predicted == 0 for r in toxicity.score(frame(spark), blank).collect())
    assert toxicity.fit(empty(spark), labels.limit(0)).scores(Text(b"", np.array([0, 0]))).shape == (1,)


def test_runs_are_counted_text_by_text():
    def counts(texts):
        raw = [t.encode() for t in texts]
        return toxicity._gram_counts(Text(b"".join(raw), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)))

    texts = ["abc", "def", "", "no letters 12", "é"]
    extra = counts([""])                                            # edges alone
    together = counts(texts)
    apart = sum(counts([t]) for t in texts)
    edges = np.flatnonzero(extra)
    assert (np.delete(together, edges) == np.delete(apart, edges)).all()


def test_workers_get_plain_arrays():
    scorer = toxicity.Scorer(np.zeros((1, 2, 2)), np.zeros(0, np.uint64), np.zeros(0), 0.5)
    assert all(isinstance(part, (np.ndarray, float)) for part in scorer.parts())


def test_repeated_ids_and_telling_features(spark):
    """A training id that stands in many rows teaches once; the chosen features are those of a plain count."""
    docs = [(i, f"word{i % 7} " + ("awful nasty" if i % 3 == 0 else "fine lovely")) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    once = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    many = toxicity.fit(spark.createDataFrame(docs + docs[:1] * 500 + docs[4:5] * 300, "doc_id long, text string"), labels)
    assert len(once.keys) and (once.keys == many.keys).all()
    taught = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = sum(i % 3 == 0 for i in taught)
    telling = set()
    for word in ("awful", "nasty", "fine", "lovely", *(f"word{k}" for k in range(7))):
        has = [i for i in taught if word in docs[i][1].split()]
        ours = sum(i % 3 == 0 for i in has)
        pooled = len(has) / len(taught)
        spread = (max(pooled * (1 - pooled), 1e-12) * (1 / toxic + 1 / (len(taught) - toxic))) ** 0.5
        if len(has) >= toxicity.LEAST_DOCS and abs(ours / toxic - (len(has) - ours) / (len(taught) - toxic)) / spread >= toxicity.LEAST_Z:
            telling.add(word)
    kept = {w for w in ("awful", "nasty", "fine", "lovely", *(f"word{k}" for k in range(7)))
            if hash_spans(w.encode(), np.array([0]), np.array([len(w)]))[0] in once.keys}
    assert kept == telling and {"awful", "nasty"} <= kept


def test_long_runs_of_signs_weigh_each_sign(model):
    assert toxicity.restore("=" * 5000 + "1d10t", model).endswith("idiot")
