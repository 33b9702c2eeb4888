from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators.matching import (flows_for_alerts, look_up_scores, match_rate, score_per_key, unmatched,
                                          with_endpoint_key, without_training_flows)
from twinsieve.operators.segments import merge_rules, merge_segments
from twinsieve.plans import recheck as plan

ALERT = "row_id long, src_ip string, dst_ip string, src_port string, dst_port string, attack_type string"


def alerts(spark):
    rows = [
        (1, "10.0.0.9", "10.0.0.10", "80", "443", "Benign"), (2, "10.0.0.10", "10.0.0.9", "443", "80", "XSS"),
        (3, "10.0.0.1", "10.0.0.2", "80.0", None, "Benign"), (4, "10.0.0.2", "10.0.0.1", "bad", "80", "Benign"),
        (5, "10.0.0.3", "10.0.0.4", "1", "2", "XSS"), (6, "10.0.0.4", "10.0.0.3", "2", "1", "Benign"),
        (7, "10.9.9.9", "10.8.8.8", "5", "6", "Benign"), (8, None, "10.0.0.1", "1", "80", "XSS")]
    df = spark.createDataFrame(rows, ALERT).withColumn("y", (c("attack_type") != "Benign").cast("int"))
    return with_endpoint_key(df, "src_ip", "dst_ip", "src_port", "dst_port")


def test_key_ignores_direction_and_compares_as_text(spark):
    keys = {r["row_id"]: r["key"] for r in alerts(spark).collect()}
    assert keys[1] == keys[2] == "10.0.0.10:443|10.0.0.9:80"
    assert keys[3] == keys[4] == "10.0.0.1:80|10.0.0.2:<NA>"
    assert keys[5] == keys[6]
    assert keys[8] == "10.0.0.1:80|nan:1"


def test_last_connection_or_highest_score_wins(spark):
    flows = spark.createDataFrame([("k", "f1", 0.9), ("k", "f2", 0.2), (None, "f3", 0.5)], "key string, fid string, proba double")
    assert score_per_key(flows, "key", "fid", "proba").collect()[0]["proba"] == 0.2
    assert score_per_key(flows, "key", "fid", "proba", "max").collect()[0]["proba"] == 0.9


def test_lookup_match_rate_and_unmatched(spark):
    a = alerts(spark)
    scores = spark.createDataFrame([("10.0.0.10:443|10.0.0.9:80", 0.7), ("10.0.0.3:1|10.0.0.4:2", 0.1)], "key string, proba double")
    got = {r["row_id"]: r["proba"] for r in look_up_scores(a, scores, salt_on=["row_id"]).collect()}
    assert got == {1: 0.7, 2: 0.7, 5: 0.1, 6: 0.1}
    rate = match_rate(a, scores).first()
    assert (rate["flagged"], rate["matched"], rate["match_rate"]) == (8, 4, 0.5)
    assert sorted(r["row_id"] for r in unmatched(a, scores, salt_on=["row_id"]).collect()) == [3, 4, 7, 8]


SEGMENT = ("`Flow ID` string, `Src IP` string, `Src Port` int, `Dst IP` string, `Dst Port` int, Timestamp int, "
           "`Total Fwd` double, `Max Duration` double, `Pkt Max` double, `Min Max` double, `Pkt Min` double, `Rate` double, Label string")


def segments(spark):
    rows = [
        ("f1", None, 80, "b", 443, 1, 1.0, 1.0, 5.0, 1.0, 5.0, 1.0, "x"), ("f1", "a2", 80, "b", 443, 3, 2.0, 2.0, 7.0, 4.0, 2.0, 2.0, "x"),
        ("f1", "a1", 80, "b", 443, 2, 4.0, 3.0, 6.0, 2.0, 3.0, None, "x"), ("f2", "c", None, "d", 1, 1, None, None, None, None, None, None, "x"),
        (None, "z", 1, "z", 1, 1, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, "x")]
    return spark.createDataFrame(rows, SEGMENT)


def test_merge_rules_and_precedence(spark):
    assert merge_rules(["Flow ID", "Label", "Max Duration", "Min Max", "totals", "subflow min", "Pkt Min", "x"]) == {
        "Max Duration": "sum", "Min Max": "max", "totals": "sum", "subflow min": "sum", "Pkt Min": "min", "x": "mean"}
    got = {r["Flow ID"]: r for r in merge_segments(segments(spark)).collect()}
    assert set(got) == {"f1", "f2"}
    f1, f2 = got["f1"], got["f2"]
    assert (f1["Total Fwd"], f1["Max Duration"], f1["Pkt Max"], f1["Min Max"], f1["Pkt Min"], f1["Rate"]) == (7, 6, 7, 4, 2, 1.5)
    assert f1["Src IP"] == "a1"         # first non-null by time
    assert (f2["Total Fwd"], f2["Pkt Max"], f2["Src Port"]) == (0.0, None, None)


def test_text_measures_and_nan_are_tolerated(spark):
    df = spark.createDataFrame([("f", 1, "1.5", float("nan")), ("f", 2, "bad", 4.0)], "`Flow ID` string, Timestamp int, Rate string, `Pkt Max` double")
    row = merge_segments(df).first()
    assert (row["Rate"], row["Pkt Max"]) == (1.5, 4.0)


def test_semi_join_and_holdout(spark):
    keyed = with_endpoint_key(segments(spark), "Src IP", "Dst IP", "Src Port", "Dst Port")
    wanted = keyed.filter(c("Flow ID") == "f2").select("key")
    assert [r["Flow ID"] for r in flows_for_alerts(keyed, wanted).collect()] == ["f2"]
    fresh = without_training_flows(segments(spark), segments(spark).filter(c("Flow ID") == "f1"), "Flow ID")
    assert sorted(str(r["Flow ID"]) for r in fresh.collect()) == ["None", "f2"]


def test_recheck_end_to_end_excludes_training_connections(spark):
    n = 400
    base = spark.range(n).select(
        c("id").alias("row_id"), F.concat(F.lit("10.0.0."), c("id") % 40).alias("src_ip"), F.lit("10.1.1.1").alias("dst_ip"),
        F.lit(80).alias("src_port"), F.lit(443).alias("dst_port"), (c("id") % 4 == 0).cast("int").alias("y"))
    flagged = with_endpoint_key(base, "src_ip", "dst_ip", "src_port", "dst_port")
    segs = spark.range(120).select(
        F.concat(F.lit("f"), c("id") % 40).alias("Flow ID"), F.lit("10.1.1.1").alias("Src IP"), F.lit(443).alias("Src Port"),
        F.concat(F.lit("10.0.0."), c("id") % 40).alias("Dst IP"), F.lit(80).alias("Dst Port"), c("id").alias("Timestamp"),
        F.when(c("id") % 4 == 0, 0.95).otherwise(0.02).alias("Rate"))
    training = spark.createDataFrame([("f0",), ("f1",)], "`Flow ID` string")
    score = lambda merged: merged.withColumn("proba", c("Rate"))
    got = plan.recheck(flagged, segs, score, training=training).first().asDict()
    assert (got["flagged"], got["matched"]) == (400, 380)
    assert (got["fp_before"], got["fp_after"], got["tp_before"], got["tp_kept"]) == (290, 0, 90, 90)
    assert got["threshold"] == 0.05 and got["fp_reduction_pct"] == 100.0


def test_recheck_keeps_renamed_endpoints(spark):
    from pyspark.sql import functions as F

    from twinsieve.plans import recheck

    columns = recheck.FlowColumns(flow_id="fid", src_ip="a", dst_ip="b", src_port="ap", dst_port="bp", order=("at",))
    rows = spark.createDataFrame([("f", "a", "b", 1, 2, 5, 0.25), ("f", "a", "b", 1, 2, 6, 0.75), ("g", "c", "d", 1, 2, 7, float("nan"))],
                                 "fid string, a string, b string, ap int, bp int, at int, price double")
    flagged = spark.createDataFrame([(1, "b", "a", 2, 1, 1), (2, "c", "d", 1, 2, 0)], "row_id int, s string, d string, sp int, dp int, y int")
    keyed = with_endpoint_key(flagged, "s", "d", "sp", "dp")
    found = recheck.flow_scores(rows, keyed, lambda m: m.withColumn("proba", F.col("price")), columns).collect()
    assert {r.key: r.proba for r in found} == {"a:1|b:2": 0.5, "c:1|d:2": None}
