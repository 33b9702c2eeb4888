import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import features as f
from twinsieve.operators.quality import feature_names, require_clean_features

N = 40


def packets(spark, parts=4):
    k = c("id")
    return spark.range(N).repartition(parts).select(
        k.alias("row_id"), F.concat(F.lit("10.0.0."), k).alias("src_ip"), (k + 1).cast("int").alias("dst_port"),
        F.when(k % 10 == 0, "XSS").otherwise("Benign").alias("attack_type"),
        F.when(k == 0, "abc").when(k == 1, "inf").when(k == 2, "NaN").when(k == 3, None).otherwise(k.cast("string")).alias("rate"),
        F.when(k % 2 == 0, k.cast("double")).alias("stream_1_var"), F.lit(None).cast("double").alias("all_null"),
        F.lit(5.0).alias("flat"), F.when(k > 5, 2.0).alias("flat_with_gaps"), (k * 1.5).alias("stream.1.mean"),
        F.when(k % 3 == 0, "GET").when(k % 3 == 1, "POST").alias("http_request_method"),
        (k % 25).cast("string").alias("dns_server"), (k % 26).cast("string").alias("http_host"),
        F.when(k % 4 == 0, "application/octet-stream;x").when(k % 4 == 1, "text").alias("http_content_type"),
        (k % 2).alias("port_class_dst"))


@pytest.fixture(scope="module")
def model(spark):
    return f.RowPreprocessor(keepCols=["row_id"]).fit(packets(spark))


def test_feature_list(model):
    names = model.feature_names
    assert names[:4] == ["rate", "stream_1_var", "stream.1.mean", "port_class_dst"]
    assert "http_request_method=GET" in names and "has_http_request_method" in names
    assert sum(n.startswith("dns_server=") for n in names) == 25
    assert not any(n.startswith("http_host=") for n in names)       # 26 values: too wide
    assert {"all_null", "flat", "flat_with_gaps", "has_dns_server", "has_http_host"} <= set(model.constant_features)
    assert not {"src_ip", "dst_port", "attack_type", "row_id"} & set(names)


def test_matrix_is_scaled_and_aligned(spark, model):
    out = model.transform(packets(spark))
    assert out.columns == ["row_id", "attack_type", "src_ip", "dst_port", "features"]
    assert feature_names(out, "features") == model.feature_names
    x = np.array([r[0] for r in out.orderBy("row_id").select(vector_to_array("features")).collect()])
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x.std(axis=0), 1)
    rate = np.array([np.nan] * 4 + list(range(4, N)), dtype=float)
    rate[np.isnan(rate)] = np.nanmedian(rate)
    assert np.allclose(x[:, 0], (rate - rate.mean()) / rate.std())
    var = np.where(np.arange(N) % 2 == 0, np.arange(N), 0.0)
    assert np.allclose(x[:, 1], (var - var.mean()) / var.std())
    with pytest.raises(AssertionError):
        require_clean_features(model.feature_names + ["src_mac"])


def test_drifted_rows(spark, model):
    drifted = packets(spark).limit(5).drop("rate", "http_request_method").withColumn("extra", F.lit(1)).withColumn(
        "http_content_type", F.lit("never seen"))
    raw = drifted.select(*model.feature_columns(drifted, scaled=False)).collect()
    assert all(r["rate"] == 0.0 and r["has_http_request_method"] == 0 and r["http_content_type=text"] == 0
               and r["has_http_content_type"] == 1 for r in raw)
    flows = f.RowPreprocessor.for_flows(keepCols=["row_id"]).fit(packets(spark).select("row_id", "rate", "flat"))
    assert flows.feature_names == ["rate", "flat"]
    filled = packets(spark).select("row_id", "flat")
    assert filled.select(*flows.feature_columns(filled, scaled=False)).first()["rate"] == 21.5


def test_leaky_features_are_dropped_loudly(model):
    kept = model.without()
    gone = set(model.feature_names) - set(kept.feature_names)
    assert gone == {"port_class_dst", "http_content_type=application/octet-stream;x"}
    with pytest.raises(f.EmptyDropError):
        kept.without()
    assert kept.without(allow_empty=True).feature_names == kept.feature_names


def test_only_training_rows_shape_the_state(spark):
    def fitted(changed):
        rows = packets(spark).withColumn("stream.1.mean", F.when((c("row_id") >= 30) & F.lit(changed), 1e9).otherwise(c("stream.1.mean")))
        return f.RowPreprocessor(keepCols=["row_id"]).fit(rows.filter(c("row_id") < 30)).fitted
    assert fitted(False) == fitted(True)


def test_partitioning_and_save_load(spark, model, tmp_path):
    assert f.RowPreprocessor(keepCols=["row_id"]).fit(packets(spark, 1)).feature_names == model.feature_names
    model.write().save(str(tmp_path / "m"))
    back = f.RowPreprocessorModel.load(str(tmp_path / "m"))
    assert back.transform(packets(spark)).orderBy("row_id").collect() == model.transform(packets(spark)).orderBy("row_id").collect()
    f.RowPreprocessor(oneHotLimit=3).write().save(str(tmp_path / "e"))
    assert f.RowPreprocessor.load(str(tmp_path / "e")).getOrDefault("oneHotLimit") == 3


def test_approximate_medians_are_close(spark):
    df = spark.range(10_001).select(c("id").cast("double").alias("v"))
    assert f.medians(df, ["v"]) == {"v": 5000.0}
    assert abs(f.medians(df, ["v"], exact=False)["v"] - 5000) < 5
