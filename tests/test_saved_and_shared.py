import os
import re

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import quality, supervised as sup
from twinsieve.operators.detectors.iforest import IsolationForest
from twinsieve.operators.detectors.simple import PcaDetector
from twinsieve.operators.features import RowPreprocessor
from twinsieve.plans import grains, study
from twinsieve.plans.screening import Screening, screen
from twinsieve.session import SharedTables
from twinsieve.sources import sinks

SMALL = {"forest": {"numTrees": 5, "maxDepth": 3}, "boosting": {"maxIter": 2, "maxDepth": 2}, "linear": {"maxIter": 20}}


@pytest.fixture()
def folder(spark, tmp_path):
    """A checkpoint folder of its own, given back afterwards."""
    held = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path}/shared")
    yield tmp_path / "shared"
    if held:
        spark.sparkContext.setCheckpointDir(held)


def tables_in(folder):
    return sorted(n for _, names, _ in os.walk(folder) for n in names if re.search("-[0-9a-f]{32}$", n))


def labelled(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.uniform(size=n) < 0.2
    x = rng.normal(size=(n, 3)) + 2.5 * y[:, None]
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, d double")


def test_a_scope_deletes_what_it_wrote(spark, folder):
    with SharedTables(spark) as shared:
        held = shared.write(spark.range(10), "ten")
        assert held.count() == 10 and tables_in(folder)
    assert tables_in(folder) == []


def packets(spark, seen=None):
    rows = labelled(spark).select(c("id").alias("row_id"), F.when(c("y") == 1, "XSS").otherwise("Benign").alias("attack_type"), "a", "b", c("d").alias("port_class_dst"))
    if seen is None:
        return rows

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(count, rows.schema)


def test_screening_reads_its_source_once_and_leaves_nothing(spark, folder):
    seen = spark.sparkContext.accumulator(0)
    run = screen(packets(spark, seen), "row_id", "attack_type", PcaDetector(k=1), RowPreprocessor(), drop_leaky=["port_class_dst"])
    assert run.alerts().count() and run.metrics().count() == 1 and run.operating_curve().count()
    assert seen.value == 600
    assert "port_class_dst" not in run.preprocessor.feature_names
    run.release()
    assert tables_in(folder) == []


def test_saved_screening_gives_the_same_scores_in_a_new_session(spark, folder, tmp_path):
    rows = packets(spark)
    run = screen(rows, "row_id", "attack_type", IsolationForest(trees=10), RowPreprocessor(identity=[]))
    want = {r["row_id"]: r["score"] for r in run.score(rows).collect()}
    path = f"file://{tmp_path}/screening"
    run.save(path)
    with pytest.raises(Exception):
        run.save(path)                                              # nothing is overwritten by chance
    other = Screening.load(path)
    assert other.threshold == run.threshold and other.cls == run.cls and other.scored is None
    again = spark.newSession().createDataFrame(rows.collect(), rows.schema)
    assert {r["row_id"]: r["score"] for r in other.score(again).collect()} == want
    with pytest.raises(ValueError):
        sup.Rescorer.load(path)


@pytest.mark.parametrize("kind", list(SMALL))
def test_saved_second_stage_gives_the_same_scores_and_cut(spark, tmp_path, kind):
    found = study.supervised_study(labelled(spark), "id", "y", RowPreprocessor.for_flows(identity=[]), [kind], params=SMALL)
    path = f"file://{tmp_path}/stage"
    found.rescorer.save(path)
    back = sup.Rescorer.load(path)
    raw = labelled(spark, 100, 5)
    score = lambda stage: {r["id"]: (r["proba"], r["pred"]) for r in stage.score_raw(raw).collect()}
    assert score(back) == score(found.rescorer) and len(score(back)) == 100
    assert (back.kind, back.threshold, back.key) == (kind, found.rescorer.threshold, ("id",))
    found.release()


def test_study_keeps_test_rows_out_of_every_fit(spark, folder):
    rows = labelled(spark)
    found = study.supervised_study(rows, "id", "y", RowPreprocessor.for_flows(identity=[]), ["linear", "forest"], params=SMALL)
    parts = {r["id"]: r["part"] for r in found.parts.collect()}
    scored = found.scored.collect()
    assert {r["id"] for r in scored} == {i for i, p in parts.items() if p == "test"} and len(parts) == 600
    truth = {r["id"]: r["y"] for r in rows.collect()}
    for y in (0, 1):
        assert sum(p == "test" and truth[i] == y for i, p in parts.items()) == round(0.3 * sum(v == y for v in truth.values()))
    block = found.metrics().first()
    assert block["tp"] + block["fn"] == sum(truth[r["id"]] for r in scored) and block["tp"] + block["fn"] + block["fp"] + block["tn"] == len(scored)
    assert block["recall"] == pytest.approx(block["tp"] / (block["tp"] + block["fn"])) and block["auc"] > 0.9
    curve = found.operating_curve().orderBy("threshold").collect()
    assert [r["tp_kept"] for r in curve] == sorted((r["tp_kept"] for r in curve), reverse=True) and len(curve) == 19
    # What the test rows hold does not matter to what is fitted.
    spoiled = rows.withColumn("a", F.when(c("id").isin([r["id"] for r in scored]), c("a") + 100).otherwise(c("a")))
    other = study.supervised_study(spoiled, "id", "y", RowPreprocessor.for_flows(identity=[]), ["linear", "forest"], params=SMALL)
    assert other.rescorer.threshold == pytest.approx(found.rescorer.threshold) and other.rescorer.cv_f1 == pytest.approx(found.rescorer.cv_f1)
    for mine, theirs in zip(other.rescorer.preprocessor.fitted["steps"], found.rescorer.preprocessor.fitted["steps"]):
        assert all(mine[k] == pytest.approx(theirs[k]) for k in ("fill", "mean", "std"))
    for run in (found, other):
        run.release()
    assert tables_in(folder) == []


def test_one_detector_at_both_grains_carries_labels_through_the_merge(spark, folder):
    rows = labelled(spark, 900).select(c("id").alias("row_id"), F.concat(F.lit("f"), c("id") % 90 + F.when(c("y") == 1, 1000).otherwise(0)).alias("Flow ID"),
                                       F.timestamp_seconds("id").alias("Timestamp"), "a", "b", c("d").alias("max_d"), "y")
    merged = grains.merged_with_label(rows, ["Flow ID"], ["Timestamp"], "y", ["row_id", "Timestamp"]).collect()
    want = {r["Flow ID"]: r["y"] for r in rows.groupBy("Flow ID").agg(F.max("y").alias("y")).collect()}
    assert {r["Flow ID"]: r["y"] for r in merged} == want
    found = {r["grain"]: r for r in grains.both_grains(rows, "row_id", ["Flow ID"], ["Timestamp"], "y", IsolationForest(trees=20), RowPreprocessor.for_flows()).collect()}
    assert set(found) == {"record", "connection"} and all(r["auc"] > 0.8 for r in found.values())
    assert found["record"]["n"] == pytest.approx(270, abs=1) and found["connection"]["n"] == pytest.approx(0.3 * len(want), abs=1)
    assert tables_in(folder) == []


def test_curve_is_written_by_many_tasks_and_read_in_order(spark, tmp_path):
    path = f"file://{tmp_path}/curve"
    curve = spark.range(0, 100_000, 1, 7).select((F.pmod(F.hash("id"), F.lit(10**9)) + c("id") / 1e6).alias("threshold"), c("id").alias("tp"))
    sinks.write_curve(curve, path, points_per_part=6000)
    manifest = sinks.curve_manifest(spark, path).orderBy("part").collect()
    assert len(manifest) >= 12 and sum(r["points"] for r in manifest) == 100_000
    assert all(a["last"] < b["first"] for a, b in zip(manifest, manifest[1:]))
    values = [r["threshold"] for r in sinks.curve_in_order(spark, path)]
    assert values == sorted(r["threshold"] for r in curve.collect())
    low, high = manifest[3]["first"], manifest[5]["last"]
    some = sinks.read_curve(spark, path, low, high)
    assert {r["part"] for r in some.select("part").distinct().collect()} == {manifest[k]["part"] for k in (3, 4, 5)}


def test_a_column_of_nan_only_fails_the_gate(spark):
    rows = labelled(spark, 30).withColumn("gone", F.lit(float("nan"))).withColumn("attack_type", F.lit("Benign"))
    report = {r["check_name"]: r["passed"] for r in quality.integrity_report(rows, "attack_type").collect()}
    assert report["no_empty_column"] is False
    assert {r["check_name"]: r["passed"] for r in quality.integrity_report(rows.drop("gone"), "attack_type").collect()}["no_empty_column"] is True
