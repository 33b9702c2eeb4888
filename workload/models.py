"""Detectors and supervised models over the embedding rows (label 0 is the rare class)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import supervised
from twinsieve.operators.curves import roc_auc
from twinsieve.operators.detectors import autoencoder, iforest, simple
from twinsieve.operators.features import RowPreprocessor
from twinsieve.operators.matching import with_endpoint_key
from twinsieve.operators.sampling import split_stratified
from twinsieve.operators.segments import merge_segments
from twinsieve.plans import grains, recheck, screening, study
from twinsieve.session import SharedTables, spread_scan

from .base import SEED, round6, table


def rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", c("embedding").cast("array<double>").alias("features"), (c("label") == 0).cast("int").alias("y"))


def parts(spark, sf_dir):
    split = split_stratified(rows(spark, sf_dir), ["vec_id"], "y", seed=SEED)
    return {name: split.filter(c("split") == name).drop("split") for name in ("train", "val", "test")}


def _scored(detector, spark, sf_dir):
    """Fit without labels on the training rows, score the whole table."""
    model = detector.fit(parts(spark, sf_dir)["train"])
    return model.transform(rows(spark, sf_dir)).select("vec_id", "y", "score")


def _autoencoder(**params):
    return autoencoder.Autoencoder(idCol="vec_id", hidden=[64, 16, 64], seed=SEED, **params)


def ae_score(spark, sf_dir):
    return _scored(_autoencoder(), spark, sf_dir)


def normalised_ae(spark, sf_dir):
    return _scored(_autoencoder(normalised=True), spark, sf_dir)


def robust_ae(spark, sf_dir):
    return _scored(_autoencoder(trimShare=autoencoder.TRIM_SHARE), spark, sf_dir)


def ae_sweep(spark, sf_dir):
    """Validation AUC of the four layouts."""
    split = parts(spark, sf_dir)
    found = autoencoder.sweep(split["train"], split["val"], "y", "vec_id", "features", seed=SEED)
    return spark.createDataFrame([("-".join(map(str, layout)), auc) for auc, layout in found], "layout string, auc double")


def iforest_score(spark, sf_dir):
    return _scored(iforest.IsolationForest(idCol="vec_id", seed=SEED), spark, sf_dir)


def iforest_items(spark, sf_dir):
    """Isolation forest over the numeric columns of every line item."""
    items = spread_scan(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_id"),
        F.array(*[c(n).cast("double") for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]).alias("features"))
    model = iforest.IsolationForest(seed=SEED).fit(items)
    return model.transform(items).select("row_id", "score")


def iforest_alerts(spark, sf_dir):
    """Alerts of the forest at its contamination share, over all rows."""
    whole = rows(spark, sf_dir)
    model = iforest.IsolationForest(idCol="vec_id", seed=SEED, contamination=0.05).fit(whole)
    return model.transform(whole).select("vec_id", "y", "score", "alert")


def pca_score(spark, sf_dir):
    return _scored(simple.PcaDetector(k=8), spark, sf_dir)


def kmeans_cutoff(spark, sf_dir):
    scored = pca_score(spark, sf_dir)
    return simple.TwoMeansCutoff().fit(scored).transform(scored).select("vec_id", "score", "alert")


def kmeans_alert_cluster(spark, sf_dir):
    """Mean error of the two groups and the one that alerts."""
    return simple.alert_cluster(kmeans_cutoff(spark, sf_dir), "alert", "score")


def vector_parts(spark, sf_dir):
    return {n: p.withColumn("features", array_to_vector("features")) for n, p in parts(spark, sf_dir).items()}


def _probabilities(kind, spark, sf_dir, **params):
    split = vector_parts(spark, sf_dir)
    model = supervised.fit_balanced(kind, split["train"], **params)
    whole = rows(spark, sf_dir).withColumn("features", array_to_vector("features"))
    return supervised.with_probability(model, whole).select("vec_id", "y", "proba")


def rf_score(spark, sf_dir):
    return _probabilities("forest", spark, sf_dir)


def gbt_score(spark, sf_dir):
    return _probabilities("boosting", spark, sf_dir)


def lr_score(spark, sf_dir):
    return _probabilities("linear", spark, sf_dir)


CV_PARAMS = {"forest": {"numTrees": 50, "maxDepth": 8}, "boosting": {"maxIter": 10, "maxDepth": 3}, "linear": {"maxIter": 100}}


def cv_select(spark, sf_dir):
    """Mean F1 of each kind of model over five folds, with smaller models than the final fit."""
    found = supervised.cv_scores(vector_parts(spark, sf_dir)["train"], ["vec_id"], params=CV_PARAMS, seed=SEED)
    best = supervised.best_kind(found)
    return spark.createDataFrame([(k, v, k == best) for k, v in found.items()], "kind string, f1 double, chosen boolean")


def score_augmented(spark, sf_dir):
    """Forest metrics without and with the anomaly score as a feature."""
    split = parts(spark, sf_dir)
    detector = iforest.IsolationForest(idCol="vec_id", seed=SEED).fit(split["train"])
    train, test = (detector.transform(split[n]).withColumn("features", array_to_vector("features"))
                   for n in ("train", "test"))
    return supervised.compare_with_score(train, test, "y", "features", "score", numTrees=100, maxDepth=10)


def detector_auc(spark, sf_dir):
    """AUC of two detectors on the same rows, for the comparison of grains and methods."""
    scores = [("pca", pca_score(spark, sf_dir)), ("isolation_forest", iforest_score(spark, sf_dir))]
    long = scores[0][1].select(F.lit(scores[0][0]).alias("system"), "y", "score").unionByName(
        scores[1][1].select(F.lit(scores[1][0]).alias("system"), "y", "score"))
    return round6(roc_auc(long, "y", "score", ["system"]), "auc")


def screening_job(spark, sf_dir):
    """Stage 1 with its own detector over every line item: prepare, split, fit, cut, alerts of the test rows."""
    items = spread_scan(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_id"),
        c("l_suppkey").cast("string").alias("src_ip"), F.when(c("l_returnflag") == "R", "XSS").otherwise("Benign").alias("attack_type"),
        "l_quantity", "l_extendedprice", "l_discount", c("l_tax").alias("tax_var"), c("l_linestatus").alias("highest_layer"))
    run = screening.screen(items, "row_id", "attack_type", simple.PcaDetector(k=3), RowPreprocessor())
    return run.alerts().select("row_id", "attack_type", "src_ip", "score")


def recheck_job(spark, sf_dir):
    """Stage 2 with its own model: train on some connections, re-check alerts on the others, summarise."""
    measures = ["total_qty", "price", "tax_max"]
    segments = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_suppkey", "l_linenumber", "l_returnflag").alias("Flow ID"),
        c("l_suppkey").cast("string").alias("Src IP"), F.lit(80).alias("Src Port"),
        c("l_linenumber").cast("string").alias("Dst IP"), F.lit(443).alias("Dst Port"), c("l_shipdate").alias("Timestamp"),
        c("l_quantity").alias("total_qty"), c("l_extendedprice").alias("price"), c("l_tax").alias("tax_max"),
        c("l_discount").alias("discount"))
    merged = merge_segments(segments.filter(c("Flow ID").endswith("A")), ["Flow ID"]).withColumn("y", (c("discount") > 0.05).cast("int"))
    with SharedTables(spark) as shared:
        # Preparation, choice and fit read the merged connections many times; the segments are merged once.
        training = shared.write(merged, "recheck-training")
        prepared = RowPreprocessor.for_flows(keepCols=["Flow ID", "y"], identity=[]).fit(training.select("Flow ID", "y", *measures))
        rescorer = supervised.train_rescorer(prepared.transform(training), ["Flow ID"], kinds=["linear"], seed=SEED)

        def score(merged):
            kept = prepared.copy()._set(keepCols=[n for n in merged.columns if n not in measures])
            return rescorer.score(kept.transform(merged))

        flagged = with_endpoint_key(
            table(spark, sf_dir, "lineitem").filter(c("l_quantity") >= 45).select(
                c("l_linenumber").cast("string").alias("src_ip"), c("l_suppkey").cast("string").alias("dst_ip"),
                F.lit(443).alias("src_port"), F.lit(80).alias("dst_port"), (c("l_discount") > 0.05).cast("int").alias("y")),
            "src_ip", "dst_ip", "src_port", "dst_port")
        return recheck.recheck(flagged, segments, score, training=training)


def _item_records(spark, sf_dir):
    """Line items as records of connections between supplier and line; the detector does not see the label."""
    return spread_scan(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_id"),
        F.concat_ws("-", "l_suppkey", "l_linenumber").alias("Flow ID"), c("l_shipdate").alias("Timestamp"),
        c("l_quantity").alias("total_qty"), c("l_extendedprice").alias("price"), c("l_discount").alias("discount"),
        ((c("l_quantity") >= 49) & (c("l_discount") >= 0.09)).cast("int").alias("y"))


def grain_forest(spark, sf_dir):
    """The isolation forest at both grains, labels carried through the merge."""
    return grains.both_grains(_item_records(spark, sf_dir), "row_id", ["Flow ID"], ["Timestamp"], "y", iforest.IsolationForest(seed=SEED),
                              RowPreprocessor.for_flows())


def supervised_study(spark, sf_dir):
    """Choice among all kinds, cut, refit and the metric block of the test rows, with a row per part of the split."""
    flat = rows(spark, sf_dir).filter("y IS NOT NULL").select("vec_id", "y", *[c("features")[i].alias(f"x{i}") for i in range(64)])
    found = study.supervised_study(flat, "vec_id", "y", RowPreprocessor.for_flows())
    return found.metrics()


def study_parts(spark, sf_dir):
    """How the study's split deals the rows: per part the number of rows and of attacks."""
    split = split_stratified(rows(spark, sf_dir).filter("y IS NOT NULL"), ["vec_id"], "y", 0.30, 0.0, SEED)
    part = F.when(c("split") == "test", "test").otherwise("dev").alias("part")
    return split.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("n_attack"))


QUERIES = {
    "grain_forest": grain_forest, "supervised_study": supervised_study, "study_parts": study_parts,
    "ae_score": ae_score, "normalised_ae": normalised_ae, "robust_ae": robust_ae, "ae_sweep": ae_sweep,
    "iforest_score": iforest_score, "iforest_items": iforest_items, "iforest_alerts": iforest_alerts, "pca_score": pca_score,
    "kmeans_cutoff": kmeans_cutoff, "kmeans_alert_cluster": kmeans_alert_cluster, "rf_score": rf_score,
    "gbt_score": gbt_score, "lr_score": lr_score, "cv_select": cv_select, "score_augmented": score_augmented,
    "detector_auc": detector_auc, "screening_job": screening_job, "recheck_job": recheck_job,
}

ORACLES: dict[str, str] = {
    "study_parts": """
        WITH k AS (SELECT label = 0 AS attack, count(*) AS n, CAST(round(count(*) * 0.3) AS BIGINT) AS held FROM embeddings WHERE label IS NOT NULL GROUP BY 1)
        SELECT 'test' AS part, CAST(sum(held) AS BIGINT) AS n, CAST(sum(CASE WHEN attack THEN held ELSE 0 END) AS BIGINT) AS n_attack FROM k
        UNION ALL SELECT 'dev', CAST(sum(n - held) AS BIGINT), CAST(sum(CASE WHEN attack THEN n - held ELSE 0 END) AS BIGINT) FROM k""",
}
