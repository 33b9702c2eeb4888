import numpy as np
import pytest
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.functions import ordered
from twinsieve.functions.ordered import draw_cuts, draw_rank, exact_quantiles, value_edges, with_value_bucket
from twinsieve.functions.skew import even_join, hot_keys, salted_join
from twinsieve.operators.sampling import with_occurrence


def frame(spark, values, parts=4):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(parts)


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("kind", ["normal", "ties", "mostly_one_value", "two_values", "tiny"])
@pytest.mark.parametrize("kept", [1000, 100_000])
def test_quantiles_match_numpy(spark, kind, kept):
    rng = np.random.default_rng(3)
    values = {"normal": rng.normal(size=30_000), "ties": rng.integers(0, 50, 20_000).astype(float),
              "mostly_one_value": np.concatenate([np.zeros(20_000), rng.normal(size=9_001)]),
              "two_values": np.array([0.0] * 6000 + [1.0] * 6000), "tiny": np.array([3.0, 1.0])}[kind]
    got = exact_quantiles(frame(spark, values), {"v": c("v")}, PROBS, max_kept=kept, accuracy=200)["v"]
    assert got == pytest.approx(list(np.quantile(values, PROBS)), abs=1e-12)


def test_quantiles_skip_missing_values(spark):
    df = frame(spark, [1.0, None, float("nan"), float("inf"), 3.0])
    assert exact_quantiles(df, {"v": c("v"), "none": F.lit(None).cast("double")}, [0.5]) == {"v": [2.0], "none": [None]}


def test_draw_rank_is_a_permutation_for_any_partitioning(spark):
    def ranks(parts):
        df = spark.range(5000).repartition(parts).withColumn("g", c("id") % 50 == 0)
        return {r["id"]: r["draw_rank"] for r in draw_rank(df, ["id"], 7, ["g"]).collect()}

    one, many = ranks(1), ranks(32)
    assert one == many
    assert sorted(v for k, v in one.items() if k % 50) == list(range(1, 4901))


@pytest.mark.parametrize("broadcast_limit", ["-1", "10485760"])
def test_rows_without_a_group_are_ranked_too(spark, broadcast_limit):
    df = spark.range(60).withColumn("g", F.when(c("id") % 3 > 0, c("id") % 3))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        ranks = [(r["g"], r["draw_rank"]) for r in draw_rank(df, ["id"], 1, ["g"]).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(ranks, key=str) == sorted(((g, i) for g in (None, 1, 2) for i in range(1, 21)), key=str)


def test_copies_of_one_row_spread(spark):
    left = spark.range(0, 4000, 1, 16).select(F.lit("hot").alias("k"), F.lit(1).alias("x"))
    right = spark.createDataFrame([("hot", 2)], "k string, s int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shares = salted_join(left, right, "k", "inner", ["x"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in shares) == 4000 and max(r["count"] for r in shares) <= 2500


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(6000).select("id", F.when(c("id") % 3 == 0, "hot").when(c("id") % 7 == 0, None)
                                    .otherwise((c("id") % 500).cast("string")).alias("k"))
    right = left.select("k").distinct().filter(F.coalesce(c("k"), F.lit("x")) < "3").withColumn("score", F.length("k"))
    right = right.unionByName(spark.createDataFrame([("hot", 99)], "k string, score int"))
    plain = sorted(left.join(right, "k", how).collect(), key=str)
    assert "hot" in hot_keys(left, "k")
    assert sorted(salted_join(left, right, "k", how, ["id"]).collect(), key=str) == plain
    assert sorted(salted_join(left, right, "k", how, ["id"], hot=[]).collect(), key=str) == plain
    for limit in (0, 100_000):
        assert sorted(even_join(left, right, "k", how, ["id"], limit).collect(), key=str) == plain


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(4000).select("id", F.when(c("id") % 2 == 0, "hot").otherwise(c("id").cast("string")).alias("k"))
    right = left.select("k").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, "k", "inner", ["id"]).withColumn("p", F.spark_partition_id())
        shares = joined.filter(c("k") == "hot").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(shares) >= 4 and max(r["count"] for r in shares) < 1200


def test_occurrence_numbers_copies(spark):
    df = spark.createDataFrame([("a",)] * 500 + [("b",)] * 3, "x string").repartition(7)
    got = sorted((r["x"], r["occurrence"]) for r in with_occurrence(df).collect())
    assert got == [("a", i) for i in range(1, 501)] + [("b", i) for i in range(1, 4)]


@pytest.mark.parametrize("most", [1, 7, 50_000])
def test_hash_cuts_lie_at_their_ranks_at_any_depth(spark, most):
    df = spark.range(3000).withColumn("g", F.when(c("id") % 10 > 0, F.when(c("id") % 10 < 3, "few").otherwise("many")))
    wanted = {"first": F.lit(1), "half": F.floor(c("group_size") / 2), "last": c("group_size"), "none": F.lit(0)}
    cuts = {(r["g"], r["part"]): r["cut"]["key0"] for r in draw_cuts(df, ["id"], 5, "g", wanted, most=most).collect()}
    ranks = draw_rank(df, ["id"], 5, ["g"]).collect()
    place = {(r["g"], r["draw_rank"]): r["id"] for r in ranks}
    size = {g: sum(r["g"] == g for r in ranks) for g in ("few", "many")}
    assert cuts == {(g, p): place[g, k] for g in size for p, k in (("first", 1), ("half", size[g] // 2), ("last", size[g]))}


def test_no_task_orders_more_than_a_bounded_number_of_rows_of_a_large_class(spark, monkeypatch):
    held, before = [], ordered.small_side
    monkeypatch.setattr(ordered, "small_side", lambda df: held.append(df) or before(df))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        df = spark.range(0, 5_000_000, 1, 4).withColumn("g", F.lit("one"))
        cut = draw_cuts(df, ["id"], 3, "g", {"tenth": F.floor(c("group_size") / 10)}).first()
        assert held[-1].agg(F.max("__n")).first()[0] <= 100_000
        drawn = ordered.with_draw(df, ["id"], 3)
        assert drawn.filter(c("__draw") <= F.lit(cut["cut"]["draw"])).count() == 500_000
        assert drawn.groupBy("__bucket").count().agg(F.max("count")).first()[0] <= 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("kind", ["normal", "crowded", "equal", "groups", "infinite"])
def test_value_ranges_hold_a_bounded_number_of_rows(spark, kind):
    rng = np.random.default_rng(4)
    values = {"normal": rng.normal(size=20_000), "crowded": np.concatenate([rng.normal(size=1000) * 1e6, 1 + rng.uniform(size=19_000) * 1e-12]),
              "equal": np.ones(3000), "groups": np.repeat(rng.normal(size=2000), 3), "infinite": np.append(rng.normal(size=3000), [np.inf, -np.inf])}[kind]
    df = frame(spark, values)
    edges = value_edges(df, "v", 100)
    assert edges == sorted(set(edges))
    rows = with_value_bucket(df, "v", 100).groupBy("__bucket").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("__bucket").collect()
    assert all(r["n"] <= 100 or r["lo"] == r["hi"] for r in rows) and sum(r["n"] for r in rows) == len(values)
    assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))
    assert value_edges(df, "v", len(values)) == []
