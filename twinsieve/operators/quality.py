"""Profiles, integrity gates and leakage checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.columns import c, name_has, ratio

# Words that give away a label column, and limits of the integrity gate.
SUSPECT_WORDS = ["label", "class", "anomal", "attack", "category", "type"]
FORBIDDEN_WORDS = ["label", "attack", "src_ip", "dst_ip", "mac", "port", "oui", "stream"]
ALLOWED_PREFIXES = ["stream_", "src_ip_", "src_ip_mac_"]


@dataclass(frozen=True)
class GateLimits:
    benign_quota: int = 200_000
    benign_slack: int = 1_000
    attack_rows: tuple[int, int] = (3_800, 6_400)
    attack_share_pct: tuple[float, float] = (1.8, 3.2)
    duplicate_share: float = 0.01
    benign: str = "Benign"
    classes: Sequence[str] = field(default_factory=list)


class IntegrityError(AssertionError):
    """The table failed its integrity gate."""


def one_row_to_long(row: DataFrame, key: str, value: str) -> DataFrame:
    """Turn a one-row table of like-typed columns into (name, value) rows."""
    return row.unpivot([], list(row.columns), key, value)


# ---------------------------------------------------------------- nulls and classes

def missing(df: DataFrame, name: str) -> Column:
    """A null, or a NaN in a fractional column."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c(name).isNull() | F.isnan(c(name))
    return c(name).isNull()


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null) for every column, from one aggregate pass."""
    names = list(columns or df.columns)
    return one_row_to_long(df.agg(*[F.count_if(missing(df, n)).alias(n) for n in names]), "column_name", "n_null")


def top_null_columns(df: DataFrame, limit: int = 30) -> DataFrame:
    """The columns with most nulls; columns without nulls are left out."""
    return (null_counts(df).filter(c("n_null") > 0)
            .orderBy(c("n_null").desc(), c("column_name")).limit(limit))


def null_columns(df: DataFrame) -> DataFrame:
    """Columns without a single value."""
    row = df.agg(*[(F.count_if(~missing(df, n)) == 0).alias(n) for n in df.columns])
    return one_row_to_long(row, "column_name", "empty").filter(c("empty")).select("column_name")


def presence_rate(df: DataFrame, columns: Sequence[str], cls: str | None = None) -> DataFrame:
    """Share of rows that hold a value, per column (and per class)."""
    shares = [F.avg((~missing(df, n)).cast("double")).alias(n) for n in columns]
    if cls is None:
        return one_row_to_long(df.agg(*shares), "column_name", "presence")
    return df.groupBy(c(cls)).agg(*shares).unpivot([cls], list(columns), "column_name", "presence")


def class_counts(df: DataFrame, cls: str) -> DataFrame:
    return df.groupBy(c(cls)).agg(F.count(F.lit(1)).alias("n"))


def class_mix(df: DataFrame, cls: str) -> DataFrame:
    """Rows and share of each class."""
    total = F.sum("n").over(Window.partitionBy())       # over one row per class
    return class_counts(df, cls).withColumn("share", ratio(c("n"), total))


def column_types(df: DataFrame) -> dict[str, int]:
    """How many columns of each type the table has."""
    out: dict[str, int] = {}
    for _, dtype in df.dtypes:
        out[dtype] = out.get(dtype, 0) + 1
    return out


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def profile(df: DataFrame, cls: str, limit: int = 30) -> dict[str, object]:
    """Shape, types, text columns (plan-time facts) and the null and class tables."""
    return {"n_columns": len(df.columns), "n_rows": df.agg(F.count(F.lit(1)).alias("n_rows")),
            "types": column_types(df), "text_columns": text_columns(df),
            "nulls": top_null_columns(df, limit), "classes": class_counts(df, cls)}


# ---------------------------------------------------------------- duplicates and cardinality

def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a whole row. Each value is written with its length, so different rows differ as text.

    As in grouping, nulls are equal to each other, so are NaNs, and -0.0 equals 0.0.
    """
    parts = []
    for f in df.schema.fields:
        value = c(f.name)
        if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType):
            value = value + F.lit(0.0)
        elif isinstance(f.dataType, T.BinaryType):
            value = F.hex(value)
        elif isinstance(f.dataType, T.TimestampType):
            value = F.unix_micros(value)        # as text, the two passes of a repeated autumn hour would look alike
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value.alias("v")))
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def duplicate_count(df: DataFrame) -> DataFrame:
    """(n_rows, n_duplicate): rows beyond the first of each group of equal rows.

    Rows are grouped by their digest, so 32 bytes per distinct row are shuffled and not the row, and copies
    combine before the shuffle.
    """
    groups = df.select(row_digest(df).alias("__d")).groupBy("__d").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                      F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("n_duplicate"))


def column_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct non-null values per column, without one distinct aggregate per column."""
    values = value_counts(df, columns).groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(n,) for n in columns], "column_name string")
    return names.join(values, "column_name", "left").select("column_name", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of all non-null values, as text."""
    long = df.select(*[c(n).cast("string").alias(n) for n in columns]).unpivot(
        [], list(columns), "column_name", "value")
    return long.filter(c("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with at most one distinct value (nulls aside), by min = max in one pass."""
    names = list(columns or df.columns)
    held = {n: F.when(~missing(df, n), c(n)) for n in names}
    row = df.agg(*[(F.count(v).eqNullSafe(F.lit(0)) | F.min(v).eqNullSafe(F.max(v))).alias(n) for n, v in held.items()])
    return one_row_to_long(row, "column_name", "constant").filter(c("constant")).select("column_name")


# ---------------------------------------------------------------- names

def suspect_columns(columns: Sequence[str], words: Sequence[str] = tuple(SUSPECT_WORDS)) -> list[str]:
    return [n for n in columns if name_has(n, parts=words)]


def suspect_column_table(df: DataFrame) -> DataFrame:
    """Schema names of a table that look like a label (a plan-time fact, shown as rows)."""
    found = suspect_columns(df.columns)
    return df.sparkSession.createDataFrame([(n,) for n in found], "column_name string")


def forbidden_features(names: Sequence[str], words: Sequence[str] = tuple(FORBIDDEN_WORDS),
                       allowed: Sequence[str] = tuple(ALLOWED_PREFIXES)) -> list[str]:
    return [n for n in names if name_has(n, parts=words) and not n.startswith(tuple(allowed))]


def require_clean_features(names: Sequence[str]) -> None:
    bad = forbidden_features(names)
    if bad:
        raise IntegrityError(f"forbidden features in the matrix: {bad}")


# ---------------------------------------------------------------- gate

def integrity_report(df: DataFrame, cls: str, limits: GateLimits = GateLimits(),
                     key: str | None = None) -> DataFrame:
    """(check_name, passed) of the six gate checks. ``key`` is left out of the duplicate test."""
    data = df.drop(key) if key else df
    counted = data.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(c(cls) == limits.benign).alias("benign"),
        *[F.count_if(c(cls) == name).alias(f"__class{i}") for i, name in enumerate(limits.classes)],
        *[F.count_if(~missing(data, n)).alias(f"__filled{i}") for i, n in enumerate(data.columns)])
    duplicates = duplicate_count(data).select("n_duplicate").scalar()
    rows, benign = c("rows"), c("benign")
    attacks, share = rows - benign, 100 * ratio(rows - benign, rows)
    checks = {
        "benign_quota": F.abs(benign - limits.benign_quota) < limits.benign_slack,
        "attack_rows": attacks.between(*limits.attack_rows),
        "attack_share": share.between(*limits.attack_share_pct),
        "all_classes_present": _all_above_zero("__class", len(limits.classes)),
        "few_duplicates": duplicates < limits.duplicate_share * rows,
        "no_empty_column": _all_above_zero("__filled", len(data.columns)),
    }
    row = counted.select(*[F.coalesce(test, F.lit(False)).alias(name) for name, test in checks.items()])
    return one_row_to_long(row, "check_name", "passed")


def _all_above_zero(prefix: str, size: int) -> Column:
    return reduce(and_, [c(f"{prefix}{i}") > 0 for i in range(size)], F.lit(True))


def require_integrity(df: DataFrame, cls: str, limits: GateLimits = GateLimits(), key: str | None = None) -> None:
    failed = [r["check_name"] for r in integrity_report(df, cls, limits, key).filter(~c("passed")).collect()]
    if failed:
        raise IntegrityError(f"failed integrity checks: {sorted(failed)}")


# ---------------------------------------------------------------- scaled features

def scaling_check(df: DataFrame, features: Mapping[str, Column] | str) -> DataFrame:
    """(column_name, mean, std) with population std, from named columns or a feature vector."""
    if isinstance(features, str):
        names = feature_names(df, features)
        array = vector_to_array(c(features))
        features = {n: array[i] for i, n in enumerate(names)}
    stats = df.agg(*[F.struct(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std")).alias(n)
                     for n, col in features.items()])
    return one_row_to_long(stats, "column_name", "s").select("column_name", "s.mean", "s.std")


def feature_names(df: DataFrame, features: str) -> list[str]:
    """Names carried in the ML attributes of a vector column."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    found = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name for _, name in found]


def unaligned_rows(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Rows of one table without a partner in the other, by row id; one join sees both directions."""
    sides = [d.select(c(row_id), F.lit(True).alias(f"__in{i}")) for i, d in enumerate((left, right))]
    both = sides[0].join(sides[1], row_id, "full_outer")
    return both.filter(c("__in0").isNull() | c("__in1").isNull()).select(c(row_id))
