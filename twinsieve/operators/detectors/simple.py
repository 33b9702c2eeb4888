"""Detectors made of built-in parts: PCA reconstruction, two-means cut-off, rank fusion."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ...functions.columns import c, ratio
from ...functions.ordered import prefix_sums, with_value_bucket
from ...functions.skew import salted_join
from ...session import cut_lineage
from .common import DetectorParams, StateModel, feature_array, pack, with_batch_score


class _PcaParams(DetectorParams):
    k = Param(Params._dummy(), "k", "components kept", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", scoreCol="score", idCol="row_id", seed=42, k=8)


class PcaDetector(Estimator, _PcaParams, DefaultParamsReadable, DefaultParamsWritable):
    """Mean squared distance of a row from the space of the first k components."""

    @keyword_only
    def __init__(self, *, featuresCol=None, scoreCol=None, k=None):
        super().__init__()
        self._defaults()
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PcaDetectorModel:
        rows = df.select(array_to_vector(feature_array(df, self.getOrDefault(self.featuresCol))).alias("v"))
        mean = rows.select(Summarizer.mean(c("v")).alias("m")).first()["m"].toArray()
        fitted = PCA(k=self.getOrDefault(self.k), inputCol="v", outputCol="z").fit(rows)
        return self._copyValues(PcaDetectorModel(pack({"mean": mean, "axes": fitted.pc.toArray()})))


class PcaDetectorModel(Model, _PcaParams, StateModel, DefaultParamsReadable, DefaultParamsWritable):

    def __init__(self, state: str = ""):
        super().__init__()
        self._defaults()
        self._set(state=state)

    def _transform(self, df: DataFrame) -> DataFrame:
        """The axes are orthonormal, so the residual is |x - mean|² less the squared projections."""
        a = self.arrays()
        mean, axes = a["mean"], a["axes"]

        def residual(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            left = (centred ** 2).sum(axis=1) - ((centred @ axes) ** 2).sum(axis=1)
            return np.maximum(left, 0.0) / len(mean)

        return with_batch_score(df, self.getOrDefault(self.featuresCol), self.getOrDefault(self.scoreCol), residual)


# ---------------------------------------------------------------- two-means cut-off

def two_means_split(df: DataFrame, score: str) -> DataFrame:
    """(low_centre, high_centre, cut) of the best two clusters on log1p(score), in one row.

    In one dimension the best two clusters are the two sides of one split, so the optimum is exact: prefix
    sums over the distinct values give every split's between-cluster sum of squares. No restarts, no passes
    over cached rows. The cut lies half-way between the centres.
    """
    logs = df.select(F.log1p(c(score).cast("double")).alias("v")).filter(c("v").isNotNull() & ~F.isnan("v"))
    hist = logs.groupBy("v").agg(F.count(F.lit(1)).alias("n")).withColumn("s", c("v") * c("n"))
    summed = prefix_sums(with_value_bucket(cut_lineage(hist), "v"), "__bucket", [c("v")], ["n", "s"])
    low, high = c("s_cum") / c("n_cum"), F.try_divide(c("s_all") - c("s_cum"), c("n_all") - c("n_cum"))
    between = F.when(c("n_cum") < c("n_all"),
                     c("n_cum") * low * low + (c("n_all") - c("n_cum")) * high * high)
    best = F.max_by(F.struct(low.alias("low_centre"), high.alias("high_centre")), F.struct(between, -c("v")))
    middle = (c("low_centre") + c("high_centre")) / 2
    return summed.agg(best.alias("b")).select("b.*").withColumn("cut", F.coalesce(middle, c("low_centre")))


class _TwoMeansParams(DetectorParams):
    predictionCol = Param(Params._dummy(), "predictionCol", "0/1 alert", TypeConverters.toString)
    cut = Param(Params._dummy(), "cut", "log1p score above which a row alerts", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(scoreCol="score", predictionCol="alert")


class TwoMeansCutoff(Estimator, _TwoMeansParams, DefaultParamsReadable, DefaultParamsWritable):
    """Label-free alert rule: two clusters on log1p(error); the one with the higher mean error alerts."""

    @keyword_only
    def __init__(self, *, scoreCol=None, predictionCol=None):
        super().__init__()
        self._defaults()
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> TwoMeansCutoffModel:
        return self._copyValues(TwoMeansCutoffModel(two_means_split(df, self.getOrDefault(self.scoreCol)).first()["cut"]))


class TwoMeansCutoffModel(Model, _TwoMeansParams, DefaultParamsReadable, DefaultParamsWritable):

    def __init__(self, cut: float = 0.0):
        super().__init__()
        self._defaults()
        self._set(cut=cut)

    def _transform(self, df: DataFrame) -> DataFrame:
        above = F.log1p(c(self.getOrDefault(self.scoreCol))) > F.lit(self.getOrDefault(self.cut))
        return df.withColumn(self.getOrDefault(self.predictionCol), above.cast("int"))


def cluster_means(df: DataFrame, cluster: str, score: str) -> DataFrame:
    return df.groupBy(c(cluster)).agg(F.avg(c(score)).alias("mean_error"), F.count(F.lit(1)).alias("n"))


def alert_cluster(df: DataFrame, cluster: str, score: str) -> DataFrame:
    """The cluster with the larger mean error."""
    return cluster_means(df, cluster, score).agg(
        F.max_by(c(cluster), c("mean_error")).alias("alert_cluster"), F.max("mean_error").alias("mean_error"))


# ---------------------------------------------------------------- rank fusion

_WHICH, _SCORE = "__which", "__score"


def average_ranks(long: DataFrame) -> DataFrame:
    """(which, score, rank) of a long table of scores: average-tie ascending rank divided by the number of rows.

    All scores are ranked together: one histogram, one set of value ranges, one prefix sum per score.
    """
    valid = long.filter(c(_SCORE).isNotNull() & ~F.isnan(c(_SCORE)))
    hist = cut_lineage(valid.groupBy(c(_WHICH), c(_SCORE)).agg(F.count(F.lit(1)).alias("n")))
    summed = prefix_sums(with_value_bucket(hist, _SCORE), "__bucket", [c(_SCORE)], ["n"], [_WHICH])
    middle = c("n_cum") - c("n") + (c("n") + 1) * F.lit(0.5).cast("double")
    return summed.select(c(_WHICH), c(_SCORE), ratio(middle, c("n_all")).alias("rank"))


def rank_fusion(df: DataFrame, scores: Sequence[str], row_id: str, out: str = "fused") -> DataFrame:
    """Mean of the ranks of several scores; null when one is missing.

    ``row_id`` tells the rows apart. The scores are unpivoted once, ranked together, looked up in one join (a score
    shared by many rows is salted) and brought back by row, so the number of jobs does not follow that of scores.
    """
    # A sum with zero makes both zeros one value.
    each = F.array(*[F.struct(F.lit(i).alias(_WHICH), (c(s).cast("double") + F.lit(0.0).cast("double")).alias(_SCORE)) for i, s in enumerate(scores)])
    long = df.select(c(row_id).alias("__row"), F.inline(each))
    key = F.when(c(_SCORE).isNotNull(), F.concat_ws(":", c(_WHICH), c(_SCORE).cast("string"))).alias("__key")
    ranks = average_ranks(long).select(key, "rank")
    found = salted_join(long.select("__row", _WHICH, key), ranks, "__key", "left", ["__row"])
    in_order = F.array_sort(F.collect_list(F.struct(_WHICH, "rank")))       # as many entries as scores
    total = F.aggregate(F.transform(in_order, lambda x: x["rank"]), F.lit(0.0).cast("double"), lambda a, x: a + x)
    fused = found.groupBy("__row").agg((total / len(scores)).alias("__fused"))
    return df.join(fused, c(row_id) == c("__row"), "left").select(*[c(n) for n in df.columns], c("__fused").alias(out))
