"""Stage 1: prepare rows, split, fit a detector, choose a cut on validation rows, list the alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c, is_attack
from ..operators.curves import RECALL_TARGET, quantile_sweep, recall_threshold
from ..operators.evaluation import detection_by_class, evaluate
from ..operators.features import RowPreprocessor, RowPreprocessorModel
from ..operators.sampling import split_stratified
from ..operators.saved import BundleReader, BundleWriter
from ..session import SharedTables


@dataclass(frozen=True)
class Screening:
    """Fitted stage 1. ``scored`` holds every row with its split and score, until ``release``; a loaded one has none."""

    preprocessor: RowPreprocessorModel
    detector: Model
    threshold: float
    scored: DataFrame | None
    cls: str
    tables: SharedTables | None = None

    def write(self) -> BundleWriter:
        """Preprocessor, detector and cut as one unit."""
        return BundleWriter("screening", {"preprocessor": self.preprocessor, "detector": self.detector}, {"threshold": self.threshold, "cls": self.cls})

    def save(self, path: str) -> None:
        self.write().save(path)

    @classmethod
    def load(cls, path: str) -> Screening:
        stages, held = BundleReader("screening").load(path)
        return cls(stages["preprocessor"], stages["detector"], held["threshold"], None, held["cls"])

    def score(self, rows: DataFrame) -> DataFrame:
        """Score and verdict of new rows, beside the kept columns they have."""
        scored = self.detector.transform(self.preprocessor.transform(rows)).drop(self.preprocessor.getOrDefault("outputCol"))
        return scored.withColumn("pred", (c("score") >= F.lit(self.threshold)).cast("int"))

    def release(self) -> None:
        """Delete the scored table; alerts and metrics cannot be read afterwards."""
        if self.tables is not None:
            self.tables.release()

    def alerts(self, split: str = "test") -> DataFrame:
        return flagged(self.scored.filter(c("split") == split), "score", self.threshold)

    def metrics(self, split: str = "test") -> DataFrame:
        return evaluate(self._judged(split), "y", "pred")

    def by_class(self, split: str = "test") -> DataFrame:
        return detection_by_class(self._judged(split), self.cls, "pred")

    def operating_curve(self) -> DataFrame:
        return quantile_sweep(self.scored.filter(c("split") == "val"), "y", "score")

    def _judged(self, split: str) -> DataFrame:
        part = self.scored.filter(c("split") == split)
        return part.withColumn("pred", (c("score") >= F.lit(self.threshold)).cast("int"))


def flagged(scored: DataFrame, score: str, threshold: float, strict: bool = False) -> DataFrame:
    """Rows at or above the cut (above it when strict); a NaN score is never flagged."""
    hit = c(score) > F.lit(threshold) if strict else c(score) >= F.lit(threshold)
    return scored.filter(hit & ~F.isnan(c(score)))


def screen(rows: DataFrame, row_id: str, cls: str, detector: Estimator, preprocessor: RowPreprocessor,
           drop_leaky: Sequence[str] | None = None, target: float = RECALL_TARGET, test: float = 0.30,
           validation: float = 0.20, seed: int = 42, benign: str = "Benign") -> Screening:
    """Everything fitted sees training rows only; the cut sees validation rows only.

    The source is read once: its rows are written with their split, then as features, each time for all readers, and
    deleted at the end. The scored table stays for the alerts, curve and metrics until the result is released.
    """
    kept = SharedTables(rows.sparkSession)
    with SharedTables(rows.sparkSession) as shared:
        labelled = shared.write(rows.withColumn("y", is_attack(c(cls), benign)), "labelled")
        parts = shared.write(split_stratified(labelled, [row_id], "y", test, validation, seed), "parts")
        prepared = preprocessor.copy()._set(
            keepCols=[*dict.fromkeys([*preprocessor.getOrDefault("keepCols"), row_id, cls, "y", "split"])])
        fitted = prepared.fit(parts.filter(c("split") == "train"))
        if drop_leaky is not None:
            fitted = fitted.without(exact=drop_leaky, allow_empty=False)
        featured = shared.write(fitted.transform(parts), "featured")
        model = detector.fit(featured.filter(c("split") == "train"))
        scored = kept.write(model.transform(featured).drop(fitted.getOrDefault("outputCol")), "scored")
    cut = recall_threshold(scored.filter(c("split") == "val"), "y", "score", target).first()["threshold"]
    return Screening(fitted, model, float(cut), scored, cls, kept)
