import pytest
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import sampling as s


def sources(spark, parts=4):
    cls = F.when(c("id") < 100, "a").when(c("id") < 110, "b").otherwise("c")
    return spark.range(113).select(c("id").alias("row_id"), cls.alias("cls")).repartition(parts)


def counts(df):
    return {r["cls"]: r["count"] for r in df.groupBy("cls").count().collect()}


def test_exact_quota_and_repeatability(spark):
    first = s.sample_quota(sources(spark), ["row_id"], "cls", {"a": 40, "b": 10})
    assert counts(first) == {"a": 40, "b": 10}
    again = s.sample_quota(sources(spark, 1), ["row_id"], "cls", {"a": 40, "b": 10})
    assert sorted(first.collect()) == sorted(again.collect())
    other = s.sample_quota(sources(spark), ["row_id"], "cls", {"a": 40, "b": 10}, seed=1)
    assert sorted(first.collect()) != sorted(other.collect())


def test_deficit_is_an_error_unless_all_may_be_taken(spark):
    with pytest.raises(s.QuotaError, match="b has 10 of 20.*d has 0 of 5"):
        s.sample_quota(sources(spark), ["row_id"], "cls", {"a": 1, "b": 20, "d": 5})
    assert counts(s.sample_stratified(sources(spark), ["row_id"], "cls", {"a": 7, "b": 20, "c": 3})) == {"a": 7, "b": 10, "c": 3}


def test_fraction_is_close_and_shuffle_free(spark):
    df = spark.range(20_000).withColumnRenamed("id", "row_id")
    got = s.sample_fraction(df, ["row_id"], 5_000, total=20_000)
    assert abs(got.count() - 5_000) < 300


def test_shuffle_is_a_permutation(spark):
    got = s.shuffle_order(sources(spark), ["row_id"]).collect()
    assert sorted(r["position"] for r in got) == list(range(1, 114))
    assert [r["row_id"] for r in sorted(got, key=lambda r: r["position"])] != list(range(113))


def test_split_shares_per_class(spark):
    got = s.split_stratified(sources(spark), ["row_id"], "cls")
    table = {(r["cls"], r["split"]): r["count"] for r in got.groupBy("cls", "split").count().collect()}
    assert (table["a", "test"], table["a", "val"], table["a", "train"]) == (30, 14, 56)
    assert (table["b", "test"], table["b", "val"], table["b", "train"]) == (3, 1, 6)
    assert got.count() == 113


def test_folds_are_stratified(spark):
    got = s.kfold_assign(sources(spark), ["row_id"], "cls").groupBy("cls", "fold").count().collect()
    for cls, size in (("a", 20), ("b", 2)):
        assert [r["count"] for r in got if r["cls"] == cls] == [size] * 5


def test_composition_follows_the_seed(monkeypatch, caplog):
    one, two = (s.draw_composition(["v", "w", "x", "y", "z"], seed=42) for _ in range(2))
    assert one == two and one["Benign"] == 200_000
    assert 3_990 <= sum(one.values()) - 200_000 <= 6_210
    even = s.draw_composition(["v", "w", "x", "y", "z"], seed=42, concentration=None)
    assert len(set(list(even.values())[1:])) == 1
    with caplog.at_level("WARNING"):
        assert s.resolve_seed(None) >= 0
    assert "drew seed" in caplog.text
    assert s.even_quota(10, ["a", "b", "c"]) == {"a": 3, "b": 3, "c": 3}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "y int")
    got = {r["y"]: r["weight"] for r in s.with_class_weight(df, "y").distinct().collect()}
    assert got == {0: 10 / 16, 1: 10 / 4}
    assert {r["y"]: r["weight"] for r in s.class_weights(df, "y").collect()} == got
