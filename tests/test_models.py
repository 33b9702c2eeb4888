import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import supervised as sup
from twinsieve.operators.curves import roc_auc
from twinsieve.operators.detectors import autoencoder as ae
from twinsieve.operators.detectors.iforest import IsolationForest, IsolationForestModel, average_path, grow_tree
from twinsieve.operators.detectors.simple import PcaDetector, PcaDetectorModel, TwoMeansCutoff, TwoMeansCutoffModel, alert_cluster
from twinsieve.operators.features import RowPreprocessor
from twinsieve.plans.flows import build_flow_dataset
from twinsieve.plans.screening import screen

WIDTH = 8


@pytest.fixture(scope="module")
def planted(spark):
    """2000 rows on a low-dimensional surface; 2% are moved away from it."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2000, 3)) @ rng.normal(size=(3, WIDTH)) + 0.1 * rng.normal(size=(2000, WIDTH))
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = (np.arange(2000) % 50 == 0).astype(int)
    x[y == 1] += 6 * rng.choice([-1, 1], size=(y.sum(), WIDTH))
    rows = [(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, features array<double>, y int").repartition(4)
    return df.cache()


def auc(df, score="score"):
    return roc_auc(df, "y", score).first()["auc"]


@pytest.mark.parametrize("detector", [
    ae.Autoencoder(hidden=[16, 3, 16], maxIter=30), ae.Autoencoder(hidden=[16, 3, 16], maxIter=15, normalised=True),
    ae.Autoencoder(hidden=[16, 3, 16], maxIter=15, trimShare=0.1), IsolationForest(trees=100), PcaDetector(k=3)])
def test_planted_outliers_are_found(planted, detector):
    assert auc(detector.fit(planted).transform(planted)) > 0.95


def test_same_seed_same_model_and_save_load(spark, planted, tmp_path):
    for i, (detector, kind) in enumerate([(ae.Autoencoder(hidden=[4], maxIter=3), ae.AutoencoderModel),
                                          (IsolationForest(trees=20), IsolationForestModel), (PcaDetector(k=2), PcaDetectorModel)]):
        one, two = detector.fit(planted), detector.fit(planted.repartition(3))
        score = {r["row_id"]: r["score"] for r in one.transform(planted).collect()}
        again = {r["row_id"]: r["score"] for r in two.transform(planted).collect()}
        assert all(again[k] == pytest.approx(v, rel=1e-9, abs=1e-12) for k, v in score.items())
        one.write().save(str(tmp_path / str(i)))
        back = kind.load(str(tmp_path / str(i)))
        assert {r["row_id"]: r["score"] for r in back.transform(planted).collect()} == score


def test_many_workers_train_one_model(planted, monkeypatch):
    monkeypatch.setattr(ae, "ROWS_PER_WORKER", 250)
    monkeypatch.setattr(ae, "TREE_FANOUT", 2)          # forces a tree on the executors
    model = ae.Autoencoder(hidden=[16, 3, 16], maxIter=40).fit(planted)
    assert auc(model.transform(planted)) > 0.95


def test_an_epoch_ships_one_sum_per_task_and_averages_as_a_plain_loop_does(planted, monkeypatch):
    monkeypatch.setattr(ae, "ROWS_PER_WORKER", 50)
    rows, workers = ae.training_rows(planted, "row_id", "features", 42, 0.1)
    width = rows.select(F.size("x")).first()[0]
    start = ae.initial_weights(width, (4,), 42)
    flat = np.concatenate([a.ravel() for a in start])
    state = ([a.shape for a in start], np.concatenate([flat, np.zeros(2 * len(flat))]), 0)
    tasks = rows.rdd.getNumPartitions()
    assert workers > 2 * tasks
    shipped = ae._epoch(rows, {0: state}, 1e-3, 200)
    assert shipped.count() <= tasks
    total, n = 0.0, 0
    for worker, part in rows.toPandas().groupby("worker"):
        trainer, kept = ae.Trainer(*state, 1e-3), part[part.held == 0]
        trainer.learn(np.stack(kept.x))
        total, n = total + trainer.flat * len(kept), n + len(kept)
    for fanout in (2, 3, 32):
        monkeypatch.setattr(ae, "TREE_FANOUT", fanout)
        mean = ae._gather(shipped, tasks)[0]
        assert mean.n == n and np.allclose(mean.total / mean.n, total / n, rtol=1e-9, atol=1e-12)
        assert mean.held_n == rows.filter("held = 1").count()


def test_layout_sweep_and_refit(planted):
    found = ae.sweep(planted, planted, "y", "row_id", "features", [(8, 2, 8), (4,)], epochs=5)
    assert len(found) == 2 and found[0][0] >= found[1][0]
    model = ae.fit_best(planted, planted, "y", "row_id", "features", [(8, 2, 8), (4,)], 3, 5)
    assert tuple(model.getOrDefault("hidden")) in {(8, 2, 8), (4,)}


def test_forest_on_a_table_smaller_than_its_subsample(spark, planted):
    few = planted.limit(30)
    scored = IsolationForest(trees=10).fit(few).transform(few)
    assert scored.filter((c("score") > 0) & (c("score") < 1)).count() == 30
    assert [float(average_path(n)) for n in (1, 2)] == [0.0, 1.0] and 1.2 < float(average_path(3)) < 1.8


def test_forest_alerts_on_its_contamination_share(planted, tmp_path):
    model = IsolationForest(trees=30, contamination=0.02).fit(planted)
    assert model.transform(planted).filter("alert = 1").count() == 40
    model.write().save(str(tmp_path / "f"))
    assert IsolationForestModel.load(str(tmp_path / "f")).transform(planted).filter("alert = 1").count() == 40


def test_two_means_cut(spark, tmp_path):
    df = spark.createDataFrame([(float(v),) for v in [0.1, 0.2, 0.15, 9.0, 11.0]], "score double")
    model = TwoMeansCutoff().fit(df)
    alerts = model.transform(df)
    assert sorted(r["score"] for r in alerts.filter("alert = 1").collect()) == [9.0, 11.0]
    assert alert_cluster(alerts, "alert", "score").first()["alert_cluster"] == 1
    one_value = spark.createDataFrame([(2.0,), (2.0,)], "score double")
    assert TwoMeansCutoff().fit(one_value).transform(one_value).filter("alert = 1").count() == 0
    model.write().save(str(tmp_path / "k"))
    assert TwoMeansCutoffModel.load(str(tmp_path / "k")).getOrDefault("cut") == model.getOrDefault("cut")


SMALL = {"forest": {"numTrees": 10, "maxDepth": 5}, "boosting": {"maxIter": 3, "maxDepth": 3}, "linear": {"maxIter": 20}}


def test_supervised_choice_threshold_and_persistence(spark, planted, tmp_path):
    dev = planted.withColumn("features", array_to_vector("features"))
    rescorer = sup.train_rescorer(dev, ["row_id"], params=SMALL)
    assert set(rescorer.cv_f1) == set(sup.KINDS) and rescorer.kind == sup.best_kind(rescorer.cv_f1)
    scored = rescorer.score(dev)
    row = sup.evaluate_scored(scored, "y", "pred", "proba").first()
    assert row["f1"] > 0.8 and row["auc"] > 0.95
    PipelineModel([rescorer.model]).write().save(str(tmp_path / "p"))
    back = PipelineModel.load(str(tmp_path / "p"))
    assert auc(sup.with_probability(back, dev), "proba") == pytest.approx(row["auc"])
    with pytest.raises(ValueError):
        sup.make_classifier("svm")


def test_score_as_a_feature(planted):
    scored = PcaDetector(k=3).fit(planted).transform(planted).withColumn("features", array_to_vector("features"))
    got = sup.compare_with_score(scored, scored, "y", "features", "score", numTrees=10, maxDepth=5).collect()
    assert [r["features"] for r in got] == ["without_score", "with_score"] and got[1]["auc"] > 0.95


def test_screening_end_to_end(spark, planted):
    rows = planted.select("row_id", F.when(c("y") == 1, "XSS").otherwise("Benign").alias("attack_type"),
                          *[c("features")[i].alias(f"f{i}") for i in range(WIDTH)], F.lit("h").alias("src_ip"))
    run = screen(rows, "row_id", "attack_type", PcaDetector(k=3), RowPreprocessor())
    assert run.scored.groupBy("split").count().count() == 3
    alerts = run.alerts()
    assert {"row_id", "attack_type", "src_ip", "score"} <= set(alerts.columns)
    assert alerts.filter(c("score") < run.threshold).count() == 0
    assert run.metrics().first()["recall"] > 0.7
    assert {r["attack_type"] for r in run.by_class().collect()} == {"Benign", "XSS"}
    assert run.operating_curve().count() == 25


def test_flow_dataset(spark):
    segments = spark.range(300).select(
        F.concat(F.lit("f"), c("id") % 60).alias("Flow ID"), F.when(c("id") % 60 < 50, "Benign").otherwise("XSS").alias("Label"),
        F.when(c("id") < 150, "one").otherwise("two").alias("file"), c("id").alias("Timestamp"), c("id").cast("double").alias("total"))
    whole = build_flow_dataset(segments, {"Benign": 20, "XSS": 1000})
    assert {r["Label"]: r["count"] for r in whole.groupBy("Label").count().collect()} == {"Benign": 20, "XSS": 10}
    assert sorted(r["position"] for r in whole.collect()) == list(range(1, 31))
    per_file = build_flow_dataset(segments, {"Benign": 1000, "XSS": 1000}, source="file")
    assert per_file.count() == 120


def test_autoencoder_learns_the_same_under_any_session_setting(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from twinsieve.operators.detectors import autoencoder

    monkeypatch.setattr(autoencoder, "ROWS_PER_WORKER", 150)
    draw = np.random.default_rng(4)
    rows = [(i, Vectors.dense(v)) for i, v in enumerate(draw.normal(size=(700, 5)).round(3))]
    df = spark.createDataFrame(rows, ["row_id", "features"])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    found = []
    try:
        for parts, records in ((1, "10000"), (4, "10000"), (13, "37")):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            model = autoencoder.Autoencoder(hidden=[3], maxIter=3).fit(df.repartition(parts))
            found.append({r.row_id: r.score for r in model.transform(df).collect()})
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for other in found[1:]:
        assert max(abs(other[k] - v) for k, v in found[0].items()) < 1e-9


def test_cross_validation_fits_each_fold_once_and_agrees_with_the_validator(spark, planted, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from twinsieve.operators.sampling import kfold_assign, with_class_weight

    rows = planted.withColumn("features", array_to_vector("features"))
    fits, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    found = sup.cv_scores(rows, ["row_id"], ["linear"], params={"linear": {"maxIter": 20}})
    assert len(fits) == sup.FOLDS
    held = kfold_assign(with_class_weight(rows, "y"), ["row_id"], "y", sup.FOLDS, 42)
    f1 = MulticlassClassificationEvaluator(labelCol="y", metricName="fMeasureByLabel", metricLabel=1.0)
    check = CrossValidator(estimator=sup.make_classifier("linear", maxIter=20), estimatorParamMaps=ParamGridBuilder().build(), evaluator=f1,
                           numFolds=sup.FOLDS, foldCol="fold", seed=42)
    assert found["linear"] == pytest.approx(check.fit(held).avgMetrics[0])


def test_an_empty_fold_is_an_error(spark):
    rows = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(4)], "row_id long, features array<double>, y int")
    with pytest.raises(ValueError):
        sup.cv_scores(rows.withColumn("features", array_to_vector("features")), ["row_id"], ["linear"])


def test_forest_keeps_node_ids_and_grows_the_same_trees(planted):
    rows = planted.withColumn("features", array_to_vector("features")).withColumn("weight", F.lit(1.0))
    kept = sup.make_classifier("forest", numTrees=5)
    assert kept.getCacheNodeIds()
    shipped = sup.make_classifier("forest", numTrees=5, cacheNodeIds=False)
    assert kept.fit(rows).toDebugString.split("\n", 1)[1] == shipped.fit(rows).toDebugString.split("\n", 1)[1]


def test_a_tree_splits_neighbouring_doubles():
    x = np.array([[0.05], [np.nextafter(0.05, 1)]])
    for seed in range(40):
        nodes = grow_tree(x, 0, seed)
        assert [n[6] for n in nodes] == [2, 1, 1]


def test_tasks_of_a_forest_hold_few_statistics_at_a_time(spark):
    """Two tasks beside each other in a heap of 1800 MB, of which Spark's own memory (0.6 of all but 300 MB) is taken."""
    forest = sup.make_classifier("forest")
    assert 2 * forest.getMaxMemoryInMB() <= 0.4 * (1800 - 300)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (300, 20, 32)
