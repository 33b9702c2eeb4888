"""Autoencoder family, trained data-parallel.

Each epoch is one Spark job: every virtual worker, a stretch of rows given by their hash, runs mini-batch Adam
from the current weights and returns one weight set, and the row-weighted mean becomes the next weights. Training
rows never leave the executors, and partitions, Arrow batches and session settings do not change what is learned.
Several layouts can train in the same pass over the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ...functions.columns import c, draw_text, uniform_of
from ...functions.ordered import exact_quantiles
from ...session import cut_lineage
from ..curves import roc_auc
from .common import DetectorParams, StateModel, feature_array, matrix_of, pack, with_batch_score

# Layouts of the sweep and epoch counts.
LAYOUTS = [(64, 16, 64), (128, 32, 128), (64, 8, 64), (32,)]
SWEEP_EPOCHS = 40
FINAL_EPOCHS = 80
TRIM_SHARE = 0.10

Weights = list[np.ndarray]      # alternating matrices and biases

ROWS_PER_WORKER = 20_000        # rows of one virtual worker
TREE_FANOUT = 32                # weight sums that one node of the tree adds up
DECAY1, DECAY2, TINY, RIDGE = 0.9, 0.999, 1e-8, 1e-4


# ---------------------------------------------------------------- network arithmetic (one Arrow batch)

def initial_weights(width: int, layout: Sequence[int], seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    sizes = [width, *layout, width]
    out: Weights = []
    for fan_in, fan_out in zip(sizes, sizes[1:]):
        bound = math.sqrt(6.0 / (fan_in + fan_out))
        out += [rng.uniform(-bound, bound, (fan_in, fan_out)), rng.uniform(-bound, bound, fan_out)]
    return out


def activations(weights: Weights, x: np.ndarray) -> list[np.ndarray]:
    """Input, hidden ReLU layers and linear output."""
    layers = [x]
    last = len(weights) // 2 - 1
    for i in range(last + 1):
        z = layers[-1] @ weights[2 * i] + weights[2 * i + 1]
        layers.append(z if i == last else np.maximum(z, 0.0))
    return layers


def squared_errors(weights: Weights, x: np.ndarray) -> np.ndarray:
    return (x - activations(weights, x)[-1]) ** 2


def gradients(weights: Weights, x: np.ndarray) -> Weights:
    layers = activations(weights, x)
    delta = (layers[-1] - x) / len(x)
    out: Weights = []
    for i in reversed(range(len(weights) // 2)):
        out = [layers[i].T @ delta + RIDGE / len(x) * weights[2 * i], delta.sum(axis=0), *out]
        if i:
            delta = (delta @ weights[2 * i].T) * (layers[i] > 0)
    return out


class Trainer:
    """Weights with Adam moments of one layout, as one flat vector for shipping."""

    def __init__(self, shapes: Sequence[tuple], flat: np.ndarray, step: int, rate: float):
        self.shapes, self.step, self.rate = list(shapes), step, rate
        self.w, self.m, self.v = flat.reshape(3, -1).copy()

    @property
    def weights(self) -> Weights:
        return split_weights(self.w, self.shapes)

    def learn(self, x: np.ndarray) -> None:
        g = np.concatenate([a.ravel() for a in gradients(self.weights, x)])
        self.step += 1
        self.m += (1 - DECAY1) * (g - self.m)
        self.v += (1 - DECAY2) * (g * g - self.v)
        scale = math.sqrt(1 - DECAY2 ** self.step) / (1 - DECAY1 ** self.step)
        self.w -= self.rate * scale * self.m / (np.sqrt(self.v) + TINY)

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([self.w, self.m, self.v])


def split_weights(flat: np.ndarray, shapes: Sequence[tuple]) -> Weights:
    out, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(flat[at:at + size].reshape(shape))
        at += size
    return out


# ---------------------------------------------------------------- data-parallel training

def training_rows(df: DataFrame, id_col: str, features: str, seed: int, holdout: float) -> tuple[DataFrame, int]:
    """(worker, x, held) sorted by worker and row hash, and the number of virtual workers.

    There is one virtual worker per ROWS_PER_WORKER rows, and the row hash deals the rows, so what is learned depends
    on the rows and the seed and not on partitions. A partition may hold several workers. The rows are written
    to the checkpoint folder, because every epoch reads them.
    """
    rows = df.select(feature_array(df, features).alias("x"), draw_text(c(id_col), seed).alias("__draw"))
    workers = max(1, math.ceil(df.count() / ROWS_PER_WORKER))
    tail = F.conv(F.substring("__draw", 9, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    fixed = (rows.withColumn("held", (tail < F.lit(holdout)).cast("int"))
             .withColumn("worker", F.floor(uniform_of(c("__draw")) * workers).cast("int"))
             .repartition("worker").sortWithinPartitions("worker", "__draw", F.xxhash64("x")).select("worker", "x", "held"))
    return cut_lineage(fixed), workers


_SCHEMA = "layout int, part int, n bigint, held_n bigint, held_loss double, blob binary"


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(worker, x, held) of up to ``size`` rows of one worker, however Arrow cuts its batches."""
    owner, xs, helds, waiting = None, [], [], 0

    def flush():
        return owner, np.concatenate(xs), np.concatenate(helds)

    for part in batches:
        if not part.num_rows:
            continue
        workers = part.column("worker").to_numpy(zero_copy_only=False)
        x = matrix_of(part.column("x"))
        held = part.column("held").to_numpy(zero_copy_only=False) == 1
        low = 0
        while low < len(workers):
            if waiting and (workers[low] != owner or waiting == size):
                yield flush()
                xs, helds, waiting = [], [], 0
            owner = int(workers[low])
            end = int(np.searchsorted(workers, owner, side="right"))
            high = min(end, low + size - waiting)
            xs.append(x[low:high])
            helds.append(held[low:high])
            waiting += high - low
            low = high
    if waiting:
        yield flush()


class _Sum:
    """Sum of weights times rows over any number of workers, of one layout: a fixed size, however many rows."""

    def __init__(self):
        self.n = self.held_n = 0
        self.held_loss, self.total = 0.0, None

    def add(self, n: int, held_n: int, held_loss: float, total: np.ndarray | None) -> None:
        self.n, self.held_n, self.held_loss = self.n + n, self.held_n + held_n, self.held_loss + held_loss
        if total is not None and n:
            self.total = total.copy() if self.total is None else self.total + total

    def row(self, layout: int, part: int) -> dict:
        return {"layout": layout, "part": part, "n": self.n, "held_n": self.held_n, "held_loss": self.held_loss,
                "blob": None if self.total is None else self.total.tobytes()}


def _sums_batch(sums: dict[int, _Sum], part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([s.row(k, part) for k, s in sums.items()], pa.schema(
        [("layout", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("held_n", pa.int64()), ("held_loss", pa.float64()), ("blob", pa.binary())]))


def _epoch(rows: DataFrame, states: dict[int, tuple], rate: float, batch: int) -> DataFrame:
    """One pass: each task's sums over its workers, one row per layout, with the held-out loss of the incoming weights."""
    def train(pieces: Iterator[tuple[np.ndarray, np.ndarray]], sums: dict[int, _Sum]) -> None:
        """One worker's mini-batches of ``batch`` rows, cut in hash order, from the incoming weights."""
        trainers = {k: Trainer(shapes, flat, step, rate) for k, (shapes, flat, step) in states.items()}
        incoming = {k: Trainer(*states[k], rate).weights for k in states}
        n = held_n = 0
        loss = dict.fromkeys(states, 0.0)
        for x, held in pieces:
            kept, seen = x[~held], x[held]
            held_n, n = held_n + len(seen), n + len(kept)
            for k, trainer in trainers.items():
                if len(seen):
                    loss[k] += float(squared_errors(incoming[k], seen).mean(axis=1).sum())
                if len(kept):
                    trainer.learn(kept)
        for k, trainer in trainers.items():
            sums[k].add(n, held_n, loss[k], trainer.flat * n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        sums = {k: _Sum() for k in states}
        for _, pieces in groupby(_pieces(batches, batch), key=lambda piece: piece[0]):
            train(((x, held) for _, x, held in pieces), sums)
        yield _sums_batch(sums, TaskContext.get().partitionId())

    return rows.mapInArrow(work, _SCHEMA)


def _added(rows: Iterator[dict]) -> dict[int, _Sum]:
    sums: dict[int, _Sum] = {}
    for r in rows:
        total = None if r["blob"] is None else np.frombuffer(r["blob"])
        sums.setdefault(r["layout"], _Sum()).add(r["n"], r["held_n"], r["held_loss"], total)
    return sums


def _fold(batch: pa.Table) -> pa.Table:
    """Sum of the rows of one node of the tree."""
    rows = batch.to_pylist()
    part = min(r["part"] for r in rows)
    return pa.Table.from_batches([_sums_batch(_added(rows), part // TREE_FANOUT)])


def _gather(partial: DataFrame, parts: int) -> dict[int, _Sum]:
    """Sums over all tasks: a tree of TREE_FANOUT rows a node on the executors, the last few rows here."""
    while parts > TREE_FANOUT:
        partial = partial.groupBy("layout", F.floor(c("part") / TREE_FANOUT)).applyInArrow(_fold, _SCHEMA)
        parts = math.ceil(parts / TREE_FANOUT)
    rows = sorted(partial.collect(), key=lambda r: (r["layout"], r["part"]))
    return _added(r.asDict() for r in rows)


def train_layouts(df: DataFrame, id_col: str, features: str, layouts: Sequence[Sequence[int]],
                  epochs: int = FINAL_EPOCHS, seed: int = 42, rate: float = 1e-3, batch: int = 200,
                  patience: int = 10, holdout: float = 0.10, tolerance: float = 1e-4) -> list[Weights]:
    """Train all layouts in shared passes; each stops by itself when its held-out loss stalls."""
    rows, workers = training_rows(df, id_col, features, seed, holdout)
    width, parts = rows.select(F.size("x")).first()[0], rows.rdd.getNumPartitions()
    states, best = {}, {}
    for k, layout in enumerate(layouts):
        start = initial_weights(width, layout, seed)
        flat = np.concatenate([a.ravel() for a in start])
        states[k] = ([a.shape for a in start], np.concatenate([flat, np.zeros(2 * len(flat))]), 0)
        best[k] = {"loss": math.inf, "flat": flat, "stalled": 0}
    for epoch in range(epochs + 1):      # the extra pass only measures the last weights
        for k, mean in _gather(_epoch(rows, states, rate, batch), parts).items():
            shapes, flat, step = states[k]
            loss = mean.held_loss / mean.held_n if mean.held_n else -epoch
            if loss < best[k]["loss"] - tolerance * abs(best[k]["loss"] if best[k]["loss"] < math.inf else 0):
                best[k].update(loss=loss, flat=flat.reshape(3, -1)[0], stalled=0)
            else:
                best[k]["stalled"] += 1
            taken = math.ceil(mean.n / max(1, workers) / batch)
            states[k] = (shapes, flat if mean.total is None else mean.total / mean.n, step + max(1, taken))
            if best[k]["stalled"] >= patience:
                del states[k]
        if not states:
            break
    return [split_weights(best[k]["flat"], [a.shape for a in initial_weights(width, layout, seed)])
            for k, layout in enumerate(layouts)]


# ---------------------------------------------------------------- estimator

class _AutoencoderParams(DetectorParams):
    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    maxIter = Param(Params._dummy(), "maxIter", "most epochs", TypeConverters.toInt)
    normalised = Param(Params._dummy(), "normalised", "divide by each feature's training error", TypeConverters.toBoolean)
    trimShare = Param(Params._dummy(), "trimShare", "share of worst rows left out of a second fit", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", scoreCol="score", idCol="row_id", seed=42,
                         hidden=list(LAYOUTS[0]), maxIter=FINAL_EPOCHS, normalised=False, trimShare=0.0)


class Autoencoder(Estimator, _AutoencoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Reconstruction-error detector; no labels are used.

    ``trimShare`` > 0 fits, drops the worst rows and fits again (robust variant). ``normalised`` weighs
    each feature's error by its mean error in training.
    """

    @keyword_only
    def __init__(self, *, featuresCol=None, scoreCol=None, idCol=None, seed=None, hidden=None, maxIter=None,
                 normalised=None, trimShare=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> AutoencoderModel:
        get = self.getOrDefault
        model = self._model(self._weights(df))
        share = get(self.trimShare)
        if share > 0:
            scored = cut_lineage(model.transform(df))
            cut = exact_quantiles(scored, {"s": c(get(self.scoreCol))}, [1.0 - share])["s"][0]
            kept = scored.filter(c(get(self.scoreCol)) <= F.lit(cut)).drop(get(self.scoreCol))
            model = self._model(self._weights(kept))
        if get(self.normalised):
            model = self._model(model.weights, model.feature_errors(df))
        return model

    def _weights(self, df: DataFrame) -> Weights:
        get = self.getOrDefault
        return train_layouts(df, get(self.idCol), get(self.featuresCol), [get(self.hidden)],
                             get(self.maxIter), get(self.seed))[0]

    def _model(self, weights: Weights, scale: np.ndarray | None = None) -> AutoencoderModel:
        return self._copyValues(AutoencoderModel.of(weights, scale))


class AutoencoderModel(Model, _AutoencoderParams, StateModel, DefaultParamsReadable, DefaultParamsWritable):

    def __init__(self, state: str = ""):
        super().__init__()
        self._defaults()
        self._set(state=state)

    @classmethod
    def of(cls, weights: Weights, scale: np.ndarray | None = None) -> AutoencoderModel:
        arrays = {f"w{i:03d}": a for i, a in enumerate(weights)}
        return cls(pack(arrays if scale is None else {**arrays, "scale": scale}))

    @property
    def weights(self) -> Weights:
        arrays = self.arrays()
        return [arrays[n] for n in sorted(arrays) if n != "scale"]

    def feature_errors(self, df: DataFrame) -> np.ndarray:
        """Mean squared reconstruction error of each feature."""
        weights, features = self.weights, self.getOrDefault(self.featuresCol)

        @F.arrow_udf("array<double>")
        def errors(rows: pa.Array) -> pa.Array:
            e = squared_errors(weights, matrix_of(rows)) if len(rows) else np.empty((0, 0))
            return pa.array(list(e), pa.list_(pa.float64()))

        rows = df.select(array_to_vector(errors(feature_array(df, features))).alias("e"))
        return rows.select(Summarizer.mean(c("e")).alias("m")).first()["m"].toArray()

    def _transform(self, df: DataFrame) -> DataFrame:
        weights, scale = self.weights, self.arrays().get("scale")

        def error(x: np.ndarray) -> np.ndarray:
            e = squared_errors(weights, x)
            return (e if scale is None else e / np.maximum(scale, 1e-12)).mean(axis=1)

        return with_batch_score(df, self.getOrDefault(self.featuresCol), self.getOrDefault(self.scoreCol), error)


def sweep(train: DataFrame, validation: DataFrame, y: str, id_col: str, features: str,
          layouts: Sequence[Sequence[int]] = tuple(LAYOUTS), epochs: int = SWEEP_EPOCHS,
          seed: int = 42) -> list[tuple[float, tuple[int, ...]]]:
    """(validation AUC, layout) of each layout, best first. All layouts share every training pass."""
    trained = train_layouts(train, id_col, features, layouts, epochs, seed)
    scored = validation
    for i, weights in enumerate(trained):
        model = AutoencoderModel.of(weights)._set(featuresCol=features, scoreCol=f"__s{i}")
        scored = model.transform(scored)
    names = [f"__s{i}" for i in range(len(trained))]
    long = cut_lineage(scored.select(c(y).alias("y"), *names)).unpivot(["y"], names, "layout", "score")
    aucs = {r["layout"]: r["auc"] for r in roc_auc(long, "y", "score", ["layout"]).collect()}
    table = [(aucs[n], tuple(layouts[i])) for i, n in enumerate(names)]
    return sorted(table, key=lambda t: (-(t[0] or 0.0), t[1]))


def fit_best(train: DataFrame, validation: DataFrame, y: str, id_col: str, features: str,
             layouts: Sequence[Sequence[int]] = tuple(LAYOUTS), sweep_epochs: int = SWEEP_EPOCHS,
             epochs: int = FINAL_EPOCHS, seed: int = 42, score_col: str = "score") -> AutoencoderModel:
    """Sweep the layouts on validation AUC and refit the winner with more epochs."""
    best = sweep(train, validation, y, id_col, features, layouts, sweep_epochs, seed)[0][1]
    return Autoencoder(featuresCol=features, scoreCol=score_col, idCol=id_col, hidden=list(best),
                       maxIter=epochs, seed=seed).fit(train)
