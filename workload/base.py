"""Stand-in roles of the given tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinsieve.functions.columns import c, draw_uniform
from twinsieve.plans.recheck import FlowColumns

Query = Callable[[SparkSession, str], DataFrame]

ATTACK = "error"
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def round6(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round the named columns; adding zero turns -0.0 into 0.0."""
    return df.select(*[(F.round(c(n), digits) + F.lit(0.0)).alias(n) if n in names else c(n) for n in df.columns])


# ---------------------------------------------------------------- scored records: events

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event_type, y, score, s2): ``value`` is the stage-1 score, ``s2`` a hash."""
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", (c("event_type") == ATTACK).cast("int").alias("y"), c("value").alias("score"),
        draw_uniform(c("event_id"), SEED).alias("s2"))


def sql_draw(key: str, seed: int = SEED) -> str:
    return f"md5('{seed}|' || {key})"


def sql_uniform(key: str, seed: int = SEED) -> str:
    return f"(('0x' || substr({sql_draw(key, seed)}, 1, 8))::BIGINT / 4294967296e0)"


EVENTS_SQL = f"""ev AS (
  SELECT event_id, event_type, CASE WHEN event_type = '{ATTACK}' THEN 1 ELSE 0 END AS y, value AS score,
         {sql_uniform('event_id')} AS s2
  FROM events)"""


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with two verdicts: s1 by score, s2 by hash, and no s2 for every eleventh record."""
    return events(spark, sf_dir).select(
        "event_id", "event_type", "y", (c("score") >= 60).cast("int").alias("s1"),
        F.when(c("event_id") % 11 != 0, (c("s2") >= 0.4).cast("int")).alias("s2"))


VERDICTS_SQL = EVENTS_SQL + """, vd AS (
  SELECT event_id, event_type, y, CASE WHEN score >= 60 THEN 1 ELSE 0 END AS s1,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN s2 >= 0.4e0 THEN 1 ELSE 0 END AS s2
  FROM ev)"""


def sql_metrics(source: str) -> str:
    """Metric block over a relation with columns system, tn, fp, fn, tp."""
    return f"""SELECT *,
      round(CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp)::DOUBLE END, 6) AS precision,
      round(CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn)::DOUBLE END, 6) AS recall,
      round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END, 6) AS f1,
      round(fp / nullif(fp + tn, 0)::DOUBLE, 6) AS fpr, round(fn / nullif(fn + tp, 0)::DOUBLE, 6) AS fnr,
      round((tp + tn) / nullif(tn + fp + fn + tp, 0)::DOUBLE, 6) AS accuracy
    FROM ({source})"""


def sql_cells(pred: str, y: str = "y") -> str:
    return (f"count(*) FILTER (WHERE {y} = 0 AND {pred} = 0) AS tn, count(*) FILTER (WHERE {y} = 0 AND {pred} = 1) AS fp, "
            f"count(*) FILTER (WHERE {y} = 1 AND {pred} = 0) AS fn, count(*) FILTER (WHERE {y} = 1 AND {pred} = 1) AS tp")


METRICS = ("precision", "recall", "f1", "fpr", "fnr", "accuracy")


def sql_quantiles(source: str, value: str, probs: Sequence[float]) -> str:
    """(point, prob, cut) by linear interpolation between the two nearest ranks."""
    points = ", ".join(f"({i + 1}, {p!r}e0)" for i, p in enumerate(probs))
    return f"""(SELECT q.point, q.prob, a.v + (b.v - a.v) * (q.place - floor(q.place)) AS cut
      FROM (SELECT point, prob, prob * ((SELECT count(*) FROM {source}) - 1) AS place
            FROM (VALUES {points}) AS p(point, prob)) q
      JOIN (SELECT {value} AS v, row_number() OVER (ORDER BY {value}) - 1 AS k FROM {source}) a ON a.k = floor(q.place)
      JOIN (SELECT {value} AS v, row_number() OVER (ORDER BY {value}) - 1 AS k FROM {source}) b ON b.k = ceil(q.place))"""


# ---------------------------------------------------------------- alerts: orders; segments: lineitem

ALERT_KEY = ["o_orderkey"]


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as alerts, some of them without any item; endpoints swap sides when the customer key is odd."""
    orders = table(spark, sf_dir, "orders")
    odd = c("o_custkey") % 2 == 1
    order, line = F.concat(F.lit("o"), c("o_orderkey")), F.concat(F.lit("n"), c("o_orderkey") % 7)

    def side(first, second):
        return F.when(odd, second).otherwise(first)

    return orders.select(
        *ALERT_KEY, (c("o_orderpriority") == "1-URGENT").cast("int").alias("y"),
        side(order, line).alias("src_ip"), side(line, order).alias("dst_ip"),
        side(F.lit(1000), F.lit(443)).alias("src_port"), side(F.lit(443), F.lit(1000)).alias("dst_port"))


SEGMENT_COLUMNS = FlowColumns(order=("Timestamp", "l_suppkey", "l_partkey"))


def segments(spark: SparkSession, sf_dir: str, per_flag: bool = False) -> DataFrame:
    """Items as segments of their order's connection; ``per_flag`` gives several connections per endpoint pair."""
    flow = [F.lit("f"), c("l_orderkey"), *([F.lit("-"), c("l_returnflag")] if per_flag else [])]
    return table(spark, sf_dir, "lineitem").select(
        F.concat(*flow).alias("Flow ID"), F.concat(F.lit("o"), c("l_orderkey")).alias("Src IP"), F.lit(1000).alias("Src Port"),
        F.concat(F.lit("n"), c("l_orderkey") % 7).alias("Dst IP"), F.lit(443).alias("Dst Port"),
        c("l_shipdate").alias("Timestamp"), c("l_extendedprice").alias("price"), c("l_tax").alias("tax_max"),
        "l_suppkey", "l_partkey")


def price_score(merged: DataFrame) -> DataFrame:
    """Given second-stage score: the merged mean price, scaled to about 0..1."""
    return merged.withColumn("proba", (c("price") - 40000) / 30011)


def _sql_key(a: str, b: str) -> str:
    return f"least({a}, {b}) || '|' || greatest({a}, {b})"


def _sql_endpoints(key: str) -> str:
    return _sql_key(f"'o' || {key} || ':1000'", f"'n' || ({key} % 7) || ':443'")


ALERTS_SQL = f"""al AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y, {_sql_endpoints('o_orderkey')} AS key
  FROM orders)"""


def segments_sql(per_flag: bool = False) -> str:
    flow = "'f' || l_orderkey" + (" || '-' || l_returnflag" if per_flag else "")
    return f"""sg AS (
  SELECT {flow} AS flow_id, {_sql_endpoints('l_orderkey')} AS key, l_extendedprice, l_tax, l_suppkey, l_partkey
  FROM lineitem),
fl AS (
  SELECT flow_id, min(key) AS key, (avg(l_extendedprice) - 40000) / 30011 AS proba, max(l_tax) AS tax_max
  FROM sg WHERE key IN (SELECT key FROM al) GROUP BY flow_id),
sc AS (SELECT key, arg_max(proba, flow_id) AS proba FROM fl GROUP BY key)"""


# ---------------------------------------------------------------- documents with labels

def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the label columns, which are null for unlabelled documents."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


DOCS_SQL = "dl AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
