"""Feature preparation steps and the whole preprocessor."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsieve.functions.columns import c, is_attack, mean_squared_difference, to_number
from twinsieve.functions.ordered import exact_quantiles
from twinsieve.operators import features, quality

from .base import DOCS_SQL, documents_with_labels, round6, sql_quantiles, table


def bookkeeping(spark, sf_dir):
    return features.bookkeeping(table(spark, sf_dir, "events"), identity=["user_id", "src_ip"], keep=["event_id"],
                                words=["type"])


def coerce_numeric(spark, sf_dir):
    """Numbers inside the text of ``props``, and the text itself, which is no number."""
    digits = F.regexp_extract("props", r"(\d+)", 1)
    return table(spark, sf_dir, "events").select(
        "event_id", to_number(digits).alias("k"), to_number(c("props")).alias("whole_text"))


def odd_text(spark, sf_dir):
    m = c("event_id") % 7
    text = F.when(m == 0, "inf").when(m == 1, "-Infinity").when(m == 2, "NaN").when(m == 3, "abc").otherwise(
        c("value").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", "value", text.alias("raw"))


def inf_to_null(spark, sf_dir):
    rows = odd_text(spark, sf_dir)
    return features.clean_numbers(rows.drop("value"), ["raw"])


def impute_zero(spark, sf_dir):
    docs = documents_with_labels(spark, sf_dir).select(
        "doc_id", c("quality").cast("double").alias("quality_var"), c("toxic").cast("double").alias("toxic"))
    return features.impute_zero(docs)


def gapped_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(c("o_custkey") % 10 != 0, c("o_totalprice")).alias("price"),
        F.when(c("o_custkey") % 3 != 0, c("o_custkey").cast("double")).alias("cust"))


def impute_median(spark, sf_dir):
    orders = gapped_orders(spark, sf_dir)
    return round6(features.impute(orders, features.medians(orders, ["price", "cust"])), "price", "cust")


def presence_flags(spark, sf_dir):
    return features.presence_flags(documents_with_labels(spark, sf_dir), ["quality", "source"], keep=["doc_id"])


def onehot_lowcard(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    values = features.one_hot_values(customers, ["c_mktsegment", "c_name"])
    return features.one_hot(customers, {n: list(v) for n, v in values.items()}, keep=["c_custkey"])


def onehot_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus", c("o_custkey").cast("string"))
    found = features.one_hot_table(orders, orders.columns)
    return found.select("column_name", "n_distinct", F.array_join("values", "|").alias("listed"))


def schema_align(spark, sf_dir):
    return features.align(table(spark, sf_dir, "events"), ["value", "bytes_total", "user_id"], keep=["event_id"])


def scaled_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", c("o_custkey").cast("double").alias("o_custkey"), F.lit(3.0).alias("flat"))
    fitted = features.scaling(orders.filter(c("o_orderkey") % 10 < 7), ["o_totalprice", "o_custkey", "flat"])
    return features.standard_scale(orders, fitted, keep=["o_orderkey"])


def standard_scale(spark, sf_dir):
    return round6(scaled_orders(spark, sf_dir), "o_totalprice", "o_custkey", "flat")


def scaling_check(spark, sf_dir):
    scaled = scaled_orders(spark, sf_dir)
    checked = quality.scaling_check(scaled, {"o_totalprice": c("o_totalprice"), "o_custkey": c("o_custkey")})
    return round6(checked, "mean", "std")


def mixed_orders(spark, sf_dir):
    """Orders as wide mixed rows: gaps, text numbers, a constant, narrow and wide text."""
    k = c("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", k.alias("src_ip"), c("o_orderstatus").alias("attack_type"),
        F.when(k % 10 != 0, c("o_totalprice")).alias("price"), F.when(k % 7 != 0, c("o_totalprice") / 1000).alias("price_var"),
        F.when(k % 4 == 0, "abc").when(k % 4 == 1, "inf").when(k % 4 == 2, "NaN").otherwise(k.cast("string")).alias("size_text"),
        F.lit(1.0).alias("flat"), F.when(k % 5 != 0, c("o_orderpriority")).alias("highest_layer"),
        k.cast("string").alias("http_uri"))


def feature_matrix(spark, sf_dir):
    orders = mixed_orders(spark, sf_dir)
    model = features.RowPreprocessor(keepCols=["o_orderkey"]).fit(orders.filter(c("o_orderkey") % 10 < 7))
    wide = orders.select("o_orderkey", *model.feature_columns(orders))
    return round6(wide, *model.feature_names)


def scalar_suite(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    middle = exact_quantiles(rows, {"v": c("value")}, [0.9])["v"][0]
    low = F.lower(F.upper("event_type"))
    return rows.select(
        "event_id", F.round(F.log1p("value"), 6).alias("log1p_value"), low.alias("low"),
        low.startswith("s").alias("starts"), low.endswith("w").alias("ends"), low.contains("ur").alias("has"),
        F.concat("event_type", F.lit(":"), c("user_id")).alias("joined"), F.round("value", 1).alias("rounded"),
        F.round(mean_squared_difference(F.array("value", c("user_id").cast("double")),
                                        F.array(F.lit(10.0), F.lit(20.0))), 6).alias("mse"),
        (c("value") > F.lit(middle)).alias("above_p90"), is_attack(c("event_type"), "view").alias("y"))


def port_events(spark, sf_dir):
    """Events whose columns carry names of traffic features."""
    return table(spark, sf_dir, "events").select("event_id", c("user_id").alias("port_class_dst"), c("value").alias("stream_5_mean"),
                                                 c("event_type").alias("attack_kind"), F.when(c("user_id") % 5 > 0, c("user_id")).alias("src_ip"))


def drop_leaky(spark, sf_dir):
    """The numeric features of all events without the leaky one."""
    rows = port_events(spark, sf_dir)
    kept, _ = features.drop_matching(["port_class_dst", "stream_5_mean"])
    return rows.select("event_id", *[c(n) for n in kept])


def forbidden_columns(spark, sf_dir):
    """Columns that may not be features, and in how many rows each is present."""
    rows = port_events(spark, sf_dir)
    found = quality.forbidden_features(rows.columns)
    counted = rows.agg(*[F.count(c(n)).alias(n) for n in found])
    return counted.unpivot([], found, "column_name", "n_present")


QUERIES = {
    "drop_leaky": drop_leaky, "forbidden_columns": forbidden_columns,
    "bookkeeping": bookkeeping, "coerce_numeric": coerce_numeric, "inf_to_null": inf_to_null,
    "impute_zero": impute_zero, "impute_median": impute_median, "presence_flags": presence_flags,
    "onehot_lowcard": onehot_lowcard, "onehot_values": onehot_values, "schema_align": schema_align,
    "standard_scale": standard_scale, "scaling_check": scaling_check, "feature_matrix": feature_matrix,
    "scalar_suite": scalar_suite,
}

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _scaled(name: str, train: str = "o_orderkey % 10 < 7") -> str:
    return (f"(\"{name}\" - (SELECT avg(\"{name}\") FROM x WHERE {train})) "
            f"/ (SELECT CASE WHEN stddev_pop(\"{name}\") > 0 THEN stddev_pop(\"{name}\") ELSE 1 END FROM x WHERE {train})")


_SCALED_ORDERS = f"""x AS (SELECT o_orderkey, o_totalprice, o_custkey::DOUBLE AS o_custkey, 3e0 AS flat FROM orders),
z AS (SELECT o_orderkey, {', '.join(f'{_scaled(n)} AS {n}' for n in ('o_totalprice', 'o_custkey', 'flat'))} FROM x)"""

_MATRIX = {
    "price": "coalesce(price, (SELECT median(price) FROM m WHERE o_orderkey % 10 < 7))",
    "price_var": "coalesce(price_var, 0)",
    "size_text": "coalesce(size, (SELECT median(size) FROM m WHERE o_orderkey % 10 < 7))",
    "has_highest_layer": "(layer IS NOT NULL)::INT",
    **{f"highest_layer={v}": f"coalesce(layer = '{v}', false)::INT" for v in _PRIORITIES},
}
_MATRIX_SQL = f"""
    WITH m AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 0 THEN o_totalprice END AS price,
                      CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice / 1000 END AS price_var,
                      CASE WHEN o_custkey % 4 = 3 THEN o_custkey::DOUBLE END AS size,
                      CASE WHEN o_custkey % 5 <> 0 THEN o_orderpriority END AS layer FROM orders),
    x AS (SELECT o_orderkey, {', '.join(f'{e} AS "{n}"' for n, e in _MATRIX.items())} FROM m)
    SELECT o_orderkey, {', '.join(f'round({_scaled(n)}, 6) + 0 AS "{n}"' for n in _MATRIX)} FROM x"""

ORACLES = {
    "drop_leaky": "SELECT event_id, value AS stream_5_mean FROM events",
    "forbidden_columns": """
        SELECT 'port_class_dst' AS column_name, count(user_id) AS n_present FROM events
        UNION ALL SELECT 'attack_kind', count(event_type) FROM events
        UNION ALL SELECT 'src_ip', count(*) FILTER (user_id % 5 > 0) FROM events""",
    "bookkeeping": "SELECT event_id, event_type, user_id FROM events",
    "coerce_numeric": r"""
        SELECT event_id, TRY_CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) AS k, TRY_CAST(props AS DOUBLE) AS whole_text FROM events""",
    "inf_to_null": "SELECT event_id, CASE WHEN event_id % 7 > 3 THEN value END AS raw FROM events",
    "impute_zero": f"WITH {DOCS_SQL} SELECT doc_id, coalesce(quality, 0)::DOUBLE AS quality_var, toxic::DOUBLE AS toxic FROM dl",
    "impute_median": """
        WITH g AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 0 THEN o_totalprice END AS price,
                          CASE WHEN o_custkey % 3 <> 0 THEN o_custkey::DOUBLE END AS cust FROM orders)
        SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM g)), 6) AS price,
               round(coalesce(cust, (SELECT median(cust) FROM g)), 6) AS cust FROM g""",
    "presence_flags": f"""WITH {DOCS_SQL}
        SELECT doc_id, (quality IS NOT NULL)::TINYINT AS has_quality, (source IS NOT NULL)::TINYINT AS has_source FROM dl""",
    "onehot_lowcard": "SELECT c_custkey, " + ", ".join(
        f"""coalesce(c_mktsegment = '{v}', false)::TINYINT AS "c_mktsegment={v}\"""" for v in _SEGMENTS) + " FROM customer",
    "onehot_values": " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(DISTINCT {n}) AS n_distinct, string_agg(DISTINCT {n}, '|' ORDER BY {n}) AS listed FROM orders"
        for n in ("o_orderpriority", "o_orderstatus")),
    "schema_align": "SELECT event_id, value, 0e0 AS bytes_total, user_id FROM events",
    "standard_scale": f"""WITH {_SCALED_ORDERS}
        SELECT o_orderkey, round(o_totalprice, 6) + 0 AS o_totalprice, round(o_custkey, 6) + 0 AS o_custkey, round(flat, 6) + 0 AS flat FROM z""",
    "scaling_check": f"WITH {_SCALED_ORDERS} " + " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, round(avg({n}), 6) + 0 AS mean, round(stddev_pop({n}), 6) AS std FROM z"
        for n in ("o_totalprice", "o_custkey")),
    "feature_matrix": _MATRIX_SQL,
    "scalar_suite": f"""
        SELECT event_id, round(ln(1 + value), 6) AS log1p_value, lower(event_type) AS low, starts_with(event_type, 's') AS starts,
               ends_with(event_type, 'w') AS ends, contains(event_type, 'ur') AS has, event_type || ':' || user_id AS joined,
               round(value, 1) AS rounded, round(((value - 10) * (value - 10) + (user_id - 20) * (user_id - 20)) / 2, 6) AS mse,
               value > cut AS above_p90, (event_type <> 'view')::INT AS y
        FROM events, {sql_quantiles('events', 'value', [0.9])} q""",
}
