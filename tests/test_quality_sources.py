import os

import pytest
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import quality as q
from twinsieve.sources import sinks, tables


def test_gate_passes_and_names_failures(spark):
    limits = q.GateLimits(benign_quota=90, benign_slack=5, attack_rows=(8, 12), attack_share_pct=(5.0, 15.0), classes=["x", "y"])
    df = spark.range(100).select("id", F.when(c("id") < 90, "Benign").when(c("id") < 95, "x").otherwise("y").alias("cls"),
                                 (c("id") * 2).alias("v"))
    q.require_integrity(df, "cls", limits)
    broken = df.withColumn("empty", F.lit(None).cast("int")).withColumn("v", F.lit(1)).filter(c("cls") != "y")
    with pytest.raises(q.IntegrityError, match="all_classes_present.*attack_rows.*few_duplicates.*no_empty_column"):
        q.require_integrity(broken, "cls", limits, key="id")


def test_duplicates_count_nulls_and_nan_as_equal(spark):
    rows = [(1.0, "a"), (1.0, "a"), (1.0, "a"), (None, "b"), (None, "b"), (float("nan"), "c"), (float("nan"), "c"), (2.0, None)]
    assert q.duplicate_count(spark.createDataFrame(rows, "x double, s string")).first().asDict() == {"n_rows": 8, "n_duplicate": 4}


def test_name_checks():
    assert q.suspect_columns(["Attack_Type", "Category", "bytes", "Anomaly"]) == ["Attack_Type", "Category", "Anomaly"]
    assert q.forbidden_features(["stream_1_mean", "src_ip_1_mean", "src_ip_mac_1_var", "dst_port", "stream", "rate"]) == ["dst_port", "stream"]
    q.require_clean_features(["rate", "stream_1_mean"])
    with pytest.raises(q.IntegrityError):
        q.require_clean_features(["rate", "src_mac"])


def test_profile_and_alignment(spark):
    df = spark.createDataFrame([(1, None, "Benign"), (2, None, "x"), (3, "v", "x")], "id int, t string, cls string")
    p = q.profile(df, "cls", limit=1)
    assert p["n_columns"] == 3 and p["types"] == {"int": 1, "string": 2} and p["text_columns"] == ["t", "cls"]
    assert [tuple(r) for r in p["nulls"].collect()] == [("t", 2)]
    assert p["n_rows"].first()["n_rows"] == 3
    assert {r["cls"]: r["n"] for r in p["classes"].collect()} == {"Benign": 1, "x": 2}
    assert [r["id"] for r in q.unaligned_rows(df, df.filter("id < 3"), "id").collect()] == [3]


def test_labelled_scan_of_many_csv_files(spark, tmp_path):
    for name, header, rows in (("flows/b/one.csv", "id,v", ["1,2", '3,"x\ny"']), ("flows/b/two.csv", "id,v", ["5,6"]),
                               ("flows/deep/er/one.csv", "id,w", ["7,8"])):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *rows]) + "\n")
    root = str(tmp_path / "flows")
    both = tables.scan_labelled(spark, {"Benign": [f"{root}/b/one.csv", f"{root}/b/two.csv"], "XSS": [f"{root}/deep/er/one.csv"]},
                                source_column="file", multiLine=True)
    assert {(r["id"], r["v"], r["w"], r["Label"]) for r in both.collect()} == {
        ("1", "2", None, "Benign"), ("3", "x\ny", None, "Benign"), ("5", "6", None, "Benign"), ("7", None, "8", "XSS")}
    assert {r["Label"]: r["n"] for r in tables.source_counts(both, "Label").collect()} == {"Benign": 3, "XSS": 1}
    assert tables.find_files(spark, root, "one.csv").count() == 2
    named = tables.scan_named(spark, root, "one.csv", "id int, v string", multiLine=True)
    assert sorted(r["id"] for r in named.collect()) == [1, 3, 7]
    by_path = tables.label_by_path(spark.read.option("recursiveFileLookup", True).csv(root, header=True), {"deep": "/deep/", "b": "/b/"})
    assert {r["Label"] for r in by_path.collect()} == {"deep", "b"}
    tables.require_sources(["Benign"], both, "Label")
    with pytest.raises(tables.MissingSourceError, match="DoS"):
        tables.require_sources(["Benign", "DoS"], both, "Label")


def test_default_path_rules(spark):
    paths = {"Packet/DDoS-HTTP_Flood/a.csv": True, "Packet/DoS-HTTP_Flood/a.csv": True, "x/DoS-TCP_Flood/a.csv": False,
             "Flow Based/DNS_Spoofing/b.csv": True, "x/UDP/benign.csv": False, "x/Mirai/a.csv": False, "README.txt": True}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r["p"]: r["w"] for r in df.select("p", tables.wanted_path(c("p")).alias("w")).collect()} == paths
    routed = spark.createDataFrame([("Flow+Based%20Features/XSS:1/a.csv",), ("Packet\\b.csv",), ("bad%zz/c/d.csv",)], "p string")
    got = [tuple(r) for r in routed.select(tables.route_path(c("p")).alias("r")).select("r.*").collect()]
    assert got == [("flow", "XSS_1", "a.csv"), ("packet", "root", "b.csv"), ("packet", "c", "d.csv")]


def test_sinks_round_trip(spark, tmp_path):
    from twinsieve.operators.features import named_vector
    df = spark.createDataFrame([(1, 0.5, "train"), (2, 1.5, "test")], "row_id int, v double, split string")
    sinks.write_table(df, str(tmp_path / "t"), partition_by=["split"])
    assert sorted(os.listdir(tmp_path / "t"))[-2:] == ["split=test", "split=train"]
    sinks.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    featured = df.select("row_id", named_vector([c("v"), c("row_id")], ["v", "id"], "features"))
    sinks.write_features(featured, str(tmp_path / "f"), keep=["row_id"])
    assert q.feature_names(spark.read.parquet(str(tmp_path / "f")), "features") == ["v", "id"]
    with pytest.raises(ValueError):
        sinks.write_features(df.withColumn("features", F.array("v")), str(tmp_path / "g"))
    sinks.write_metrics(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    stats = {r["column_name"]: (r["mean"], r["std"]) for r in q.scaling_check(featured, "features").collect()}
    assert stats == {"v": (1.0, 0.5), "id": (1.5, 0.5)}


def test_nan_is_missing_and_empty_columns_stay(spark):
    from twinsieve.operators import quality

    df = spark.createDataFrame([(float("nan"), None, 1.0), (2.0, None, float("nan")), (2.0, None, 1.0)], "a double, b string, c double")
    assert {r.column_name: r.n_null for r in quality.null_counts(df).collect()} == {"a": 1, "b": 3, "c": 1}
    assert {r.column_name: round(r.presence, 3) for r in quality.presence_rate(df, ["a", "b"]).collect()} == {"a": 0.667, "b": 0.0}
    assert {r.column_name for r in quality.constant_columns(df).collect()} == {"a", "b", "c"}
    assert {r.column_name: r.n_distinct for r in quality.column_cardinality(df, ["b", "c"]).collect()}["b"] == 0


def test_instants_of_a_repeated_hour_are_different_rows(spark):
    from twinsieve.operators import quality

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp_seconds(s) AS t FROM VALUES (1730611800), (1730615400) AS v(s)")     # 01:30 twice
        assert quality.duplicate_count(df).first().n_duplicate == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
