"""Isolation forest (Liu, Ting and Zhou, 2008): trees grow in parallel from small hash samples."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ...functions.columns import c, draw_text, draw_uniform
from ...session import cut_lineage
from ..curves import contamination_cut
from .common import DetectorParams, StateModel, feature_array, pack, with_batch_score

TREES = 200
SUBSAMPLE = 256
OVERSAMPLE = 1.5        # rows dealt per tree before trimming, as a multiple of the subsample

_NODES = "tree int, node int, feature int, split double, left int, right int, size int, depth int"


def average_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def deal_rows(df: DataFrame, id_col: str, features: str, trees: int, subsample: int, seed: int,
              count: int) -> DataFrame:
    """(tree, draw, x): about ``OVERSAMPLE * subsample`` rows for each tree.

    The table is dealt into slots of that size by hash. A table with more slots than trees uses the
    first ``trees`` slots; a smaller one is dealt again with another hash until every tree has rows.
    The rows that move are about trees * slot size in either case.
    """
    slots = max(1, int(count // (OVERSAMPLE * subsample)))
    rounds = math.ceil(trees / slots)
    rows = df.select(c(id_col).alias("id"), feature_array(df, features).alias("x"))
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("deal")) if rounds > 1 \
        else rows.withColumn("deal", F.lit(0))
    slot = F.floor(draw_uniform([c("deal"), c("id")], seed) * F.lit(float(slots))).cast("bigint")
    return (dealt.withColumn("tree", (c("deal") * F.lit(slots) + slot).cast("bigint"))
            .filter(c("tree") < trees)
            .select(c("tree").cast("int").alias("tree"), draw_text([c("tree"), c("id")], seed).alias("draw"), "x"))


def grow_tree(x: np.ndarray, tree: int, seed: int) -> list[tuple]:
    """Nodes of one tree over at most a subsample of rows."""
    rng = np.random.default_rng([seed, tree])
    limit = max(1, math.ceil(math.log2(max(2, len(x)))))
    nodes: list[list] = []
    open_parts = [(np.arange(len(x)), 0, None)]
    while open_parts:
        rows, depth, parent = open_parts.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = me
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) < 2 or not len(usable):
            nodes.append([tree, me, -1, 0.0, -1, -1, len(rows), depth])
            continue
        feature = int(rng.choice(usable))
        # Between neighbouring doubles the draw may round up to the high end, which would leave the right side empty.
        split = min(float(rng.uniform(low[feature], high[feature])), float(np.nextafter(high[feature], low[feature])))
        nodes.append([tree, me, feature, split, -1, -1, len(rows), depth])
        goes_left = x[rows, feature] <= split
        open_parts += [(rows[~goes_left], depth + 1, (me, 5)), (rows[goes_left], depth + 1, (me, 4))]
    return [tuple(n) for n in nodes]


class _ForestParams(DetectorParams):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    subsample = Param(Params._dummy(), "subsample", "rows per tree", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share of training rows to alert on; 0 gives no alerts column",
                          TypeConverters.toFloat)
    predictionCol = Param(Params._dummy(), "predictionCol", "0/1 alert", TypeConverters.toString)
    cut = Param(Params._dummy(), "cut", "score above which a row alerts", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", scoreCol="score", idCol="row_id", seed=42,
                         trees=TREES, subsample=SUBSAMPLE, contamination=0.0, predictionCol="alert")


class IsolationForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Score 2^(-mean depth / c(subsample)); higher is more anomalous. No labels are used.

    With ``contamination`` the model also alerts on scores above that share's quantile of the training scores.
    """

    @keyword_only
    def __init__(self, *, featuresCol=None, scoreCol=None, idCol=None, seed=None, trees=None, subsample=None,
                 contamination=None, predictionCol=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> IsolationForestModel:
        get = self.getOrDefault
        subsample, seed = get(self.subsample), get(self.seed)

        def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            chosen = pdf.sort_values("draw", kind="stable").head(subsample)
            nodes = grow_tree(np.stack(chosen["x"].to_numpy()), int(key[0]), seed)
            return pd.DataFrame(nodes, columns=[f.split()[0] for f in _NODES.split(", ")])

        count = df.count()
        dealt = deal_rows(df, get(self.idCol), get(self.featuresCol), get(self.trees), subsample, seed, count)
        # At most trees * (2 * subsample) small rows: the forest itself.
        table = dealt.groupBy("tree").applyInPandas(build, _NODES).toPandas()
        if table.empty:
            raise ValueError("no rows to grow trees from")
        model = self._copyValues(IsolationForestModel(pack(_forest_arrays(table, subsample, count))))
        if get(self.contamination) > 0:
            scored = cut_lineage(model.transform(df).select(c(get(self.scoreCol))))     # scored once, read several times
            model._set(cut=contamination_cut(scored, get(self.scoreCol), get(self.contamination)))
        return model


def _forest_arrays(table: pd.DataFrame, subsample: int, rows: int) -> dict[str, np.ndarray]:
    """Nodes of all trees in one set of arrays with absolute child positions.

    A leaf points to itself and its split is infinite, so a row that reached it stays there.
    """
    table = table.sort_values(["tree", "node"]).reset_index(drop=True)
    sizes = table.groupby("tree")["node"].size()
    offset = table["tree"].map((sizes.cumsum() - sizes).to_dict()).to_numpy()
    leaf = (table["feature"] < 0).to_numpy()
    here = np.arange(len(table))
    left = np.where(leaf, here, table["left"].to_numpy() + offset)
    right = np.where(leaf, here, table["right"].to_numpy() + offset)
    return {
        "feature": np.where(leaf, 0, table["feature"]).astype(np.int32),
        "split": np.where(leaf, np.inf, table["split"]),
        "children": np.stack([left, right], axis=1).astype(np.int32),
        "length": np.where(leaf, table["depth"] + average_path(table["size"].to_numpy()), 0.0),
        "roots": np.flatnonzero(table["node"].to_numpy() == 0).astype(np.int32),
        "levels": np.array([int(table["depth"].max())]),
        "norm": np.array([float(average_path(min(subsample, rows))) or 1.0]),
    }


def mean_depth(x: np.ndarray, forest: dict[str, np.ndarray], chunk: int = 512) -> np.ndarray:
    """Mean path length of every row: all trees descend together, a chunk of rows at a time."""
    feature, split, children = forest["feature"], forest["split"], forest["children"].ravel()
    out = np.empty(len(x))
    for start in range(0, len(x), chunk):
        part = np.ascontiguousarray(x[start:start + chunk])
        first = (np.arange(len(part)) * part.shape[1])[:, None]
        values = part.ravel()
        at = np.repeat(forest["roots"][None, :], len(part), axis=0)
        for _ in range(int(forest["levels"][0])):
            above = values.take(first + feature.take(at)) > split.take(at)
            at = children.take(2 * at + above)
        out[start:start + chunk] = forest["length"].take(at).mean(axis=1)
    return out


class IsolationForestModel(Model, _ForestParams, StateModel, DefaultParamsReadable, DefaultParamsWritable):

    def __init__(self, state: str = ""):
        super().__init__()
        self._defaults()
        self._set(state=state)

    def _transform(self, df: DataFrame) -> DataFrame:
        forest = self.arrays()
        norm = float(forest["norm"][0])

        def anomaly(x: np.ndarray) -> np.ndarray:
            return np.exp2(-mean_depth(x, forest) / norm)

        score = self.getOrDefault(self.scoreCol)
        scored = with_batch_score(df, self.getOrDefault(self.featuresCol), score, anomaly)
        if not self.isSet(self.cut):
            return scored
        above = c(score) > F.lit(self.getOrDefault(self.cut))
        return scored.withColumn(self.getOrDefault(self.predictionCol), above.cast("int"))
