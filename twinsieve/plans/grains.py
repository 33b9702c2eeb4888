"""One detector at both grains: single records and the connections merged from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c
from ..operators.curves import roc_auc
from ..operators.features import RowPreprocessor
from ..operators.sampling import split_stratified
from ..operators.segments import merge_segments
from ..session import SharedTables


def merged_with_label(records: DataFrame, key: Sequence[str], order: Sequence[str], y: str, identity: Sequence[str]) -> DataFrame:
    """Merged connections that carry the labels of their records: a connection is an attack if one record is."""
    # The label travels under a name whose rule is the maximum.
    return merge_segments(records.withColumnRenamed(y, "__max_label"), key, order, identity).withColumnRenamed("__max_label", y)


def both_grains(records: DataFrame, row_id: str, key: Sequence[str], order: Sequence[str], y: str, detector: Estimator,
                preprocessor: RowPreprocessor, identity: Sequence[str] = (), test: float = 0.30, seed: int = 42) -> DataFrame:
    """(grain, auc, n, n_attack): the same detector fitted and judged on records and on their merged connections.

    Each grain is split by its own rows, prepared and fitted on its training rows without labels, and judged on its
    test rows. Merged rows get an id from their key.
    """
    merged = merged_with_label(records, key, order, y, [*identity, row_id, *order]).drop(row_id)
    merged = merged.withColumn(row_id, F.concat_ws("\x1f", *[c(k) for k in key]))
    out = None
    with SharedTables(records.sparkSession) as shared:
        results = []
        for grain, rows in (("record", records), ("connection", merged)):
            source = shared.write(rows.filter(c(y).isNotNull()), f"grain-{grain}")
            parts = shared.write(split_stratified(source, [row_id], y, test, 0.0, seed), f"grain-{grain}-parts")
            prepared = preprocessor.copy()._set(keepCols=[row_id, y, "split"], identity=[*key, *identity, *order])
            fitted = prepared.fit(parts.filter(c("split") == "train"))
            featured = shared.write(fitted.transform(parts), f"grain-{grain}-features")
            model = detector.fit(featured.filter(c("split") == "train"))
            scored = shared.write(model.transform(featured.filter(c("split") == "test")).select(c(y).alias("y"), "score"), f"grain-{grain}-scored")
            auc = roc_auc(scored, "y", "score").first()["auc"]
            counts = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("n_attack")).first()
            results.append((grain, auc, counts["n"], counts["n_attack"]))
        out = records.sparkSession.createDataFrame(results, "grain string, auc double, n long, n_attack long")
    return out
