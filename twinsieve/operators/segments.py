"""Merging of connection segments into one row per connection, with a rule per column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import c, name_has, nan_to_null, to_number

# Identity columns of a segment table and its class column.
IDENTITY = ["Flow ID", "Src IP", "Src Port", "Dst IP", "Dst Port", "Protocol", "Timestamp"]
LABEL = "Label"


def merge_rule(name: str) -> str:
    """Aggregate for a measure; totals and durations win over max, max over min, min over mean."""
    if name_has(name, prefixes=("total", "subflow"), parts=("duration",)):
        return "sum"
    for word in ("max", "min"):
        if name_has(name, parts=(word,)):
            return word
    return "mean"


def merge_rules(columns: Sequence[str], identity: Sequence[str] = tuple(IDENTITY),
                label: str | None = LABEL) -> dict[str, str]:
    skip = {*identity, label}
    return {name: merge_rule(name) for name in columns if name not in skip}


def _merged(name: str, rule: str, data_type: T.DataType) -> Column:
    value = c(name)
    if isinstance(data_type, (T.StringType, T.FractionalType)):
        value = nan_to_null(to_number(value, data_type))      # missing, as NaN is in the measures
    if rule == "sum":       # an all-null sum is 0
        return F.coalesce(F.sum(value), F.lit(0)).alias(name)
    return {"max": F.max, "min": F.min, "mean": F.avg}[rule](value).alias(name)


def merge_segments(df: DataFrame, key: Sequence[str] = ("Flow ID",), order: Sequence[str] = ("Timestamp",),
                   identity: Sequence[str] = tuple(IDENTITY), label: str | None = LABEL,
                   count_as: str | None = None) -> DataFrame:
    """One row per connection.

    Identity columns take the first non-null value in ``order``; give enough order columns to make it
    unique. Measures read as text are taken as numbers, and NaN counts as missing. Rows with a null key
    are dropped. All aggregates combine on the map side, so one connection
    may hold any share of the rows.
    """
    present = [n for n in identity if n in df.columns and n not in key]
    rank = F.struct(*[c(o) for o in order])
    firsts = [F.min_by(c(n), F.when(c(n).isNotNull(), rank)).alias(n) for n in present]
    rules = merge_rules([n for n in df.columns if n not in key], identity, label)
    counted = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    valued = df
    for name in key:
        valued = valued.filter(c(name).isNotNull())
    return valued.groupBy(*[c(k) for k in key]).agg(
        *firsts, *[_merged(n, r, df.schema[n].dataType) for n, r in rules.items()], *counted)
