"""Scalar column expressions: clean-up, labels, keys, hash draws."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F, types as T

BENIGN = "Benign"


def c(name: str) -> Column:
    """Column by its literal name, also when it holds dots, blanks or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------- clean-up

def finite_or_null(col: Column) -> Column:
    """NaN and both infinities become null; everything else is unchanged."""
    infinity = F.lit(float("inf"))
    return F.when(F.isnan(col) | (F.abs(col) == infinity), F.lit(None)).otherwise(col)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def to_number(col: Column, data_type: T.DataType | None = None) -> Column:
    """Numeric value of a column as double; text that is no number becomes null.

    Nested and temporal types have no numeric reading and give null.
    """
    if isinstance(data_type, T.StringType) or data_type is None:
        return col.try_cast("double")
    if isinstance(data_type, T.BooleanType):
        return col.cast("int").cast("double")
    if isinstance(data_type, T.NumericType):
        return col.cast("double")
    return F.lit(None).cast("double")


def clean_number(col: Column, data_type: T.DataType | None = None) -> Column:
    return finite_or_null(to_number(col, data_type))


def presence(col: Column) -> Column:
    """1 when the value is there, 0 when it is null."""
    return col.isNotNull().cast("tinyint")


def matches_value(col: Column, value: object) -> Column:
    """One-hot flag: null and unseen values give 0."""
    return F.coalesce(col == F.lit(value), F.lit(False)).cast("tinyint")


def is_attack(col: Column, benign: str = BENIGN) -> Column:
    return (col != F.lit(benign)).cast("int")


def name_has(name: str, prefixes: Sequence[str] = (), parts: Sequence[str] = (),
             suffixes: Sequence[str] = ()) -> bool:
    """Case-blind test of a column name, used while a plan is put together."""
    low = name.lower()
    return (low.startswith(tuple(prefixes)) or low.endswith(tuple(suffixes))
            or any(part in low for part in parts))


# ---------------------------------------------------------------- vectors

def mean_squared_difference(left: Column, right: Column) -> Column:
    """Mean of squared element differences of two double arrays, computed in the JVM."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v) / F.size(left)


def sum_of_squares(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)


# ---------------------------------------------------------------- keys

def port_text(port: Column) -> Column:
    """Port as integer text; ``<NA>`` when it is missing or no number."""
    return F.coalesce(port.try_cast("double").try_cast("bigint").cast("string"), F.lit("<NA>"))


def endpoint(ip: Column, port: Column) -> Column:
    return F.concat(F.coalesce(ip.cast("string"), F.lit("nan")), F.lit(":"), port_text(port))


def endpoint_key(src_ip: Column, dst_ip: Column, src_port: Column, dst_port: Column) -> Column:
    """Connection key that is the same for A→B and B→A (smaller endpoint text first)."""
    a, b = endpoint(src_ip, src_port), endpoint(dst_ip, dst_port)
    return F.concat(F.least(a, b), F.lit("|"), F.greatest(a, b))


# ---------------------------------------------------------------- hash draws

TWO_32 = 4294967296.0


def draw_text(key: Column | Sequence[Column], seed: int) -> Column:
    """Full md5 text of ``seed|key``: the order in which rows are drawn.

    The key has to be built from integers, strings and dates, so that every engine prints it alike.
    """
    keys: Iterable[Column] = [key] if isinstance(key, Column) else key
    texts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def draw_uniform(key: Column | Sequence[Column], seed: int) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of the draw text."""
    return uniform_of(draw_text(key, seed))


def uniform_of(text: Column) -> Column:
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


# ---------------------------------------------------------------- small helpers

def cuts_passed(score: Column, cuts: Sequence[float], strict: bool = False) -> Column:
    """How many of the ascending cuts a score reaches (``>=``, or ``>`` when strict); a null or NaN score none.

    Written as a binary search of nested conditions, so a row meets about log2 of the cuts.
    """
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        cut = F.lit(float(cuts[middle]))
        return F.when(score > cut if strict else score >= cut, search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(F.isnan(score), F.lit(0)).otherwise(search(0, len(cuts)))


def ratio(top: Column, bottom: Column) -> Column:
    """Plain double division; null when the bottom is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))
