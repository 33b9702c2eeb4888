"""Fit / transform preparation of wide, mixed-type rows into a scaled feature vector.

Fitting is a few aggregate passes over the training rows; transforming is one projection, however many
columns there are.
"""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import c, clean_number, matches_value, name_has, presence
from ..functions.ordered import exact_quantiles
from .quality import value_counts

log = logging.getLogger(__name__)

# Column groups of the packet table and the leaky features found in it.
IDENTITY = [
    "stream", "src_mac", "dst_mac", "src_ip", "dst_ip", "src_port",
    "dst_port", "device_mac", "eth_src_oui", "eth_dst_oui",
]
PROTOCOL_TEXT = [
    "handshake_version", "tls_server", "http_request_method", "http_host",
    "user_agent", "dns_server", "highest_layer", "http_uri",
    "http_content_type", "dns_query_type",
]
LABEL_WORDS = ["label", "attack_type"]
LEAKY_NAMES = ["port_class_dst"]
LEAKY_PREFIXES = ["http_content_type=application/octet-stream"]
FLOW_IDENTITY = ["Flow ID", "Src IP", "Dst IP", "Src Port", "Dst Port", "Timestamp"]
ONE_HOT_LIMIT = 25


# ---------------------------------------------------------------- single steps

def label_columns(columns: Sequence[str], words: Sequence[str] = tuple(LABEL_WORDS)) -> list[str]:
    return [n for n in columns if name_has(n, parts=words)]


def bookkeeping(df: DataFrame, identity: Sequence[str] = tuple(IDENTITY), keep: Sequence[str] = (),
                words: Sequence[str] = tuple(LABEL_WORDS)) -> DataFrame:
    """Label and identity columns, which never enter the features, and ``keep`` (such as a row id)."""
    names = [*keep, *label_columns(df.columns, words), *identity]
    return df.select(*[c(n) for n in dict.fromkeys(names) if n in df.columns])


def clean_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce columns to double: bad text, NaN and infinities become null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    chosen = set(columns)
    return df.select(*[clean_number(c(n), types[n]).alias(n) if n in chosen else c(n) for n in df.columns])


def impute_zero(df: DataFrame, suffix: str = "_var") -> DataFrame:
    """Missing window variances mean a single packet, so they are 0."""
    names = [n for n in df.columns if n.endswith(suffix)]
    return df.fillna(0.0, subset=names) if names else df


def medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float | None]:
    """Median per column: exact, or the built-in approximation for a single cheap pass."""
    types = {f.name: f.dataType for f in df.schema.fields}
    clean = {n: clean_number(c(n), types[n]) for n in columns}
    if exact:
        log.info("exact medians of %d columns", len(columns))
        return {n: v[0] for n, v in exact_quantiles(df, clean, [0.5]).items()}
    log.info("approximate medians of %d columns", len(columns))
    row = df.agg(*[F.percentile_approx(col, 0.5, 10_000).alias(f"m{i}")
                   for i, col in enumerate(clean.values())]).first()
    return {n: row[f"m{i}"] for i, n in enumerate(clean)}


def impute(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    return df.select(*[F.coalesce(c(n), F.lit(values[n])).alias(n) if values.get(n) is not None else c(n)
                       for n in df.columns])


def presence_flags(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c(n) for n in keep], *[presence(c(n)).alias(f"has_{n}") for n in columns])


def one_hot_values(df: DataFrame, columns: Sequence[str], limit: int = ONE_HOT_LIMIT) -> dict[str, dict[str, int]]:
    """Values (sorted) and their counts of every column with 1..limit distinct values.

    An approximate distinct count rules out wide columns first, so their values are never listed.
    """
    if not columns:
        return {}
    row = df.agg(*[F.approx_count_distinct(c(n).cast("string"), 0.02).alias(f"d{i}")
                   for i, n in enumerate(columns)]).first()
    likely = [n for i, n in enumerate(columns) if 0 < row[f"d{i}"] <= 2 * limit]
    if not likely:
        return {}
    listed: dict[str, dict[str, int]] = {n: {} for n in likely}
    for r in value_counts(df, likely).collect():
        listed[r["column_name"]][r["value"]] = r["n"]
    return {n: dict(sorted(v.items())) for n, v in listed.items() if 0 < len(v) <= limit}


def one_hot_table(df: DataFrame, columns: Sequence[str], limit: int = ONE_HOT_LIMIT) -> DataFrame:
    """(column_name, n_distinct, values): sorted values of the columns narrow enough for one-hot."""
    counts = value_counts(df, columns)
    narrow = (counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
              .filter(c("n_distinct") <= limit))
    return (counts.join(F.broadcast(narrow), "column_name")      # at most one row per named column
            .groupBy("column_name", "n_distinct").agg(F.array_sort(F.collect_list("value")).alias("values")))


def one_hot(df: DataFrame, values: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Flags ``column=value`` for the frozen values; null and unseen values give all zeros."""
    return df.select(*[c(n) for n in keep],
                     *[matches_value(c(n).cast("string"), v).alias(f"{n}={v}") for n, vs in values.items() for v in vs])


def align(df: DataFrame, names: Sequence[str], fill: float | None = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the fitted columns, in order: missing ones get ``fill``, extra ones go."""
    have = set(df.columns)
    return df.select(*[c(n) for n in keep],
                     *[c(n) if n in have else F.lit(fill).cast("double").alias(n) for n in names])


def scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a zero deviation counts as 1."""
    row = df.agg(*[f(c(n)).alias(f"{t}{i}") for i, n in enumerate(columns)
                   for t, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {n: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, n in enumerate(columns)}


def standard_scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c(n) for n in keep],
                     *[((c(n) - F.lit(m)) / F.lit(s)).alias(n) for n, (m, s) in fitted.items()])


class EmptyDropError(ValueError):
    """A column drop matched nothing."""


def drop_matching(names: Sequence[str], exact: Sequence[str] = tuple(LEAKY_NAMES),
                  prefixes: Sequence[str] = tuple(LEAKY_PREFIXES), allow_empty: bool = False
                  ) -> tuple[list[str], list[str]]:
    """Split feature names into kept and dropped. Dropping nothing is an error unless allowed."""
    dropped = [n for n in names if n in exact or n.startswith(tuple(prefixes))]
    if not dropped and not allow_empty:
        raise EmptyDropError(f"no feature matches {list(exact)} or prefixes {list(prefixes)}")
    log.info("dropped %d leaky features: %s", len(dropped), dropped)
    return [n for n in names if n not in set(dropped)], dropped


def named_vector(columns: Sequence[Column], names: Sequence[str], out: str) -> Column:
    """Vector column whose ML attributes carry the feature names."""
    attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]},
                         "num_attrs": len(names)}}
    return array_to_vector(F.array(*[col.cast("double") for col in columns])).alias(out, metadata=attrs)


# ---------------------------------------------------------------- estimator

class _PrepParams(Params):
    identity = Param(Params._dummy(), "identity", "identity columns, kept beside the features", TypeConverters.toListString)
    keepCols = Param(Params._dummy(), "keepCols", "further columns kept beside the features", TypeConverters.toListString)
    textCols = Param(Params._dummy(), "textCols", "text columns: presence flag, one-hot when narrow", TypeConverters.toListString)
    labelWords = Param(Params._dummy(), "labelWords", "words that mark a label column", TypeConverters.toListString)
    zeroSuffix = Param(Params._dummy(), "zeroSuffix", "columns with this ending are 0 when missing", TypeConverters.toString)
    oneHotLimit = Param(Params._dummy(), "oneHotLimit", "most distinct values of a one-hot column", TypeConverters.toInt)
    exactMedians = Param(Params._dummy(), "exactMedians", "exact or approximate medians", TypeConverters.toBoolean)
    dropConstant = Param(Params._dummy(), "dropConstant", "drop features that are constant in training", TypeConverters.toBoolean)
    missingColumns = Param(Params._dummy(), "missingColumns", "value of an absent column: zero or median", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)


class RowPreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, one-hot values, constant columns and scaling from training rows only."""

    @keyword_only
    def __init__(self, *, identity=None, keepCols=None, textCols=None, labelWords=None, zeroSuffix="_var",
                 oneHotLimit=ONE_HOT_LIMIT, exactMedians=True, dropConstant=True, missingColumns="zero",
                 outputCol="features"):
        super().__init__()
        self._setDefault(identity=IDENTITY, keepCols=[], textCols=PROTOCOL_TEXT, labelWords=LABEL_WORDS,
                         zeroSuffix="_var", oneHotLimit=ONE_HOT_LIMIT, exactMedians=True, dropConstant=True,
                         missingColumns="zero", outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def for_flows(cls, **changes) -> RowPreprocessor:
        """Settings of the merged-connection table: numeric only, absent columns take the median."""
        return cls(**{"identity": FLOW_IDENTITY, "textCols": [], "zeroSuffix": "", "dropConstant": False,
                      "missingColumns": "median", **changes})

    def _fit(self, df: DataFrame) -> RowPreprocessorModel:
        get = self.getOrDefault
        labels = label_columns(df.columns, get(self.labelWords))
        aside = {*labels, *get(self.identity), *get(self.keepCols)}
        text = [n for n in get(self.textCols) if n in df.columns]
        numeric = [f for f in df.schema.fields if f.name not in aside and f.name not in text]
        clean = {f.name: clean_number(c(f.name), f.dataType) for f in numeric}
        stats = _column_stats(df, clean, text)
        suffix = get(self.zeroSuffix)
        zeroed = {n for n in clean if suffix and n.endswith(suffix)}
        middles = self._medians(df, [n for n in clean if n not in zeroed])
        steps = [_numeric_step(n, 0.0 if n in zeroed else middles[n], stats) for n in clean]
        hot = one_hot_values(df, text, get(self.oneHotLimit))
        for n in text:
            steps.append(_flag_step({"kind": "has", "column": n, "name": f"has_{n}"}, stats["n"][n], stats["rows"]))
            steps += [_flag_step({"kind": "is", "column": n, "value": v, "name": f"{n}={v}"}, k, stats["rows"])
                      for v, k in hot.get(n, {}).items()]
        kept = [s for s in steps if not (get(self.dropConstant) and s["constant"])]
        state = {"labels": labels, "steps": kept, "constant": [s["name"] for s in steps if s["constant"]]}
        model = RowPreprocessorModel(json.dumps(state))
        return self._copyValues(model)

    def _medians(self, df: DataFrame, names: list[str]) -> dict[str, float | None]:
        return medians(df, names, self.getOrDefault(self.exactMedians)) if names else {}


def _column_stats(df: DataFrame, clean: Mapping[str, Column], text: Sequence[str]) -> dict:
    """Counts and moments of all columns from one aggregate pass."""
    flat = df.select(*[col.alias(f"v{i}") for i, col in enumerate(clean.values())],
                     *[c(n).isNotNull().alias(f"t{i}") for i, n in enumerate(text)])
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(clean)):
        v = F.col(f"v{i}")
        exprs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                  F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"s{i}")]
    exprs += [F.count_if(F.col(f"t{i}")).alias(f"tn{i}") for i in range(len(text))]
    row = flat.agg(*exprs).first()
    out = {"rows": row["rows"], "n": {n: row[f"tn{i}"] for i, n in enumerate(text)}}
    for i, name in enumerate(clean):
        out[name] = {"n": row[f"n{i}"], "lo": row[f"lo{i}"], "hi": row[f"hi{i}"],
                     "mean": row[f"m{i}"], "var": row[f"s{i}"]}
    return out


def _numeric_step(name: str, fill: float | None, stats: Mapping) -> dict:
    """Moments of the filled column follow from those of the present values and the fill count."""
    s, rows = stats[name], stats["rows"]
    step = {"kind": "number", "column": name, "name": name, "fill": fill}
    if not s["n"]:
        return {**step, "fill": fill or 0.0, "mean": fill or 0.0, "std": 1.0, "constant": True}
    gaps = rows - s["n"]
    mean = (s["n"] * s["mean"] + gaps * fill) / rows
    spread = (s["n"] * (s["var"] + (s["mean"] - mean) ** 2) + gaps * (fill - mean) ** 2) / rows
    constant = s["lo"] == s["hi"] and (gaps == 0 or fill == s["lo"])
    return {**step, "mean": mean, "std": 1.0 if constant else math.sqrt(spread) or 1.0, "constant": constant}


def _flag_step(step: dict, hits: int, rows: int) -> dict:
    share = hits / rows if rows else 0.0
    return {**step, "mean": share, "std": math.sqrt(share * (1 - share)) or 1.0, "constant": hits in (0, rows)}


class RowPreprocessorModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Applies the fitted state in one projection."""

    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def __init__(self, state: str = "{}"):
        super().__init__()
        self._setDefault(identity=IDENTITY, keepCols=[], textCols=PROTOCOL_TEXT, labelWords=LABEL_WORDS,
                         zeroSuffix="_var", oneHotLimit=ONE_HOT_LIMIT, exactMedians=True, dropConstant=True,
                         missingColumns="zero", outputCol="features")
        self._set(state=state)

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def feature_names(self) -> list[str]:
        return [s["name"] for s in self.fitted["steps"]]

    @property
    def constant_features(self) -> list[str]:
        return self.fitted["constant"]

    def without(self, exact: Sequence[str] = tuple(LEAKY_NAMES), prefixes: Sequence[str] = tuple(LEAKY_PREFIXES),
                allow_empty: bool = False) -> RowPreprocessorModel:
        """Copy that leaves the named features out (see ``drop_matching``)."""
        kept, _ = drop_matching(self.feature_names, exact, prefixes, allow_empty)
        state = self.fitted
        state["steps"] = [s for s in state["steps"] if s["name"] in set(kept)]
        copy = self.copy()
        copy._set(state=json.dumps(state))
        return copy

    def _value(self, step: Mapping, types: Mapping[str, T.DataType]) -> Column:
        name, there = step["column"], step["column"] in types
        if step["kind"] == "number":
            if there:
                return F.coalesce(clean_number(c(name), types[name]), F.lit(step["fill"]))
            absent_zero = self.getOrDefault(self.missingColumns) == "zero"
            return F.lit(0.0 if absent_zero else step["fill"])
        if not there:
            return F.lit(0)
        if step["kind"] == "has":
            return presence(c(name))
        return matches_value(c(name).cast("string"), step["value"])

    def feature_columns(self, df: DataFrame, scaled: bool = True) -> list[Column]:
        """One named double column per feature."""
        types = {f.name: f.dataType for f in df.schema.fields}
        out = []
        for step in self.fitted["steps"]:
            value = self._value(step, types).cast("double")
            if scaled:
                value = (value - F.lit(step["mean"])) / F.lit(step["std"])
            out.append(value.alias(step["name"]))
        return out

    def kept_columns(self, df: DataFrame) -> list[str]:
        names = [*self.getOrDefault(self.keepCols), *self.fitted["labels"], *self.getOrDefault(self.identity)]
        return [n for n in dict.fromkeys(names) if n in df.columns]

    def _transform(self, df: DataFrame) -> DataFrame:
        vector = named_vector(self.feature_columns(df), self.feature_names, self.getOrDefault(self.outputCol))
        return df.select(*[c(n) for n in self.kept_columns(df)], vector)
