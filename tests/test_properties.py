"""Randomised checks of the pure rules, with one Spark job per property over many generated rows."""

import math

from hypothesis import HealthCheck, given, settings, strategies as st

from twinsieve.functions.columns import c, cuts_passed, endpoint_key, to_number
from twinsieve.operators import evaluation as e
from twinsieve.operators.detectors.autoencoder import Trainer, gradients, initial_weights, squared_errors
from twinsieve.operators.segments import merge_rule

import numpy as np

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ip = st.one_of(st.none(), st.from_regex(r"10\.0\.[0-9]{1,3}\.[0-9]{1,3}", fullmatch=True))
port = st.one_of(st.none(), st.integers(0, 65535).map(str), st.sampled_from(["80.0", "x", ""]))


@few
@given(st.lists(st.tuples(ip, ip, port, port), min_size=1, max_size=60))
def test_endpoint_key_is_symmetric(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, p string, q string")
    keys = df.select(endpoint_key(c("a"), c("b"), c("p"), c("q")).alias("x"), endpoint_key(c("b"), c("a"), c("q"), c("p")).alias("y"))
    assert all(r["x"] == r["y"] and r["x"].count("|") == 1 for r in keys.collect())


@few
@given(st.lists(st.one_of(st.none(), st.floats(-2, 2, allow_nan=False)), min_size=1, max_size=60),
       st.lists(st.floats(-1, 1, allow_nan=False), min_size=1, max_size=30, unique=True).map(sorted), st.booleans())
def test_cuts_passed_counts_cuts(spark, values, cuts, strict):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["k"] for r in df.select(cuts_passed(c("v"), cuts, strict).alias("k")).collect()]
    assert got == [0 if v is None else sum(v > t if strict else v >= t for t in cuts) for v in values]


@few
@given(st.lists(st.text(alphabet="0123456789.eE+-naif ", max_size=8), min_size=1, max_size=60))
def test_text_never_breaks_number_parsing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", to_number(c("t")).alias("v")).collect():
        try:
            expected = float(r["t"])
        except ValueError:
            continue
        assert r["v"] is None or math.isnan(expected) or r["v"] == expected


@given(st.integers(0, 400), st.integers(0, 400))
def test_binomial_tail_is_exact(b, k):
    n = b + k
    exact = 1.0 if 2 * min(b, k) >= n else min(1.0, 2 * sum(math.comb(n, i) for i in range(min(b, k) + 1)) / 2 ** n)
    assert math.isclose(e.binomial_two_sided(b, k), exact, rel_tol=1e-8, abs_tol=1e-300)


@given(st.text(max_size=20))
def test_merge_rule_is_total(name):
    rule, low = merge_rule(name), name.lower()
    assert rule in {"sum", "max", "min", "mean"}
    if "duration" in low or low.startswith(("total", "subflow")):
        assert rule == "sum"


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(7, 4))
    weights = initial_weights(4, (3, 2), 1)

    def loss(ws):
        ridge = sum((w ** 2).sum() for w in ws[::2])
        return squared_errors(ws, x).sum() / (2 * len(x)) + 1e-4 * ridge / (2 * len(x))

    for i, g in enumerate(gradients(weights, x)):
        at = tuple(0 for _ in g.shape)
        moved = [w.copy() for w in weights]
        moved[i][at] += 1e-6
        assert math.isclose((loss(moved) - loss(weights)) / 1e-6, g[at], rel_tol=1e-3, abs_tol=1e-6)


def test_training_lowers_the_error():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) @ rng.normal(size=(2, 6))
    start = initial_weights(6, (2,), 3)
    flat = np.concatenate([w.ravel() for w in start])
    trainer = Trainer([w.shape for w in start], np.concatenate([flat, np.zeros(2 * len(flat))]), 0, 1e-2)
    for _ in range(300):
        trainer.learn(x)
    assert squared_errors(trainer.weights, x).mean() < 0.1 * squared_errors(start, x).mean()
