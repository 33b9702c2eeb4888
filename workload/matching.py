"""Segment merge, alert matching and the re-check."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators.curves import operating_point, recheck_grid
from twinsieve.operators.matching import (flows_for_alerts, look_up_scores, match_rate, unmatched, with_endpoint_key,
                                          without_training_flows)
from twinsieve.operators import quality
from twinsieve.operators.segments import merge_segments
from twinsieve.plans import flows as flow_plan, recheck as plan

from .base import (ALERTS_SQL, ALERT_KEY, SEED, SEGMENT_COLUMNS, alerts, price_score, round6, segments, segments_sql,
                   sql_draw, table)


def keyed_alerts(spark, sf_dir):
    return with_endpoint_key(alerts(spark, sf_dir), "src_ip", "dst_ip", "src_port", "dst_port").select(
        *ALERT_KEY, "y", "key")


def scores(spark, sf_dir, per_flag=False):
    return plan.flow_scores(segments(spark, sf_dir, per_flag), keyed_alerts(spark, sf_dir), price_score,
                            SEGMENT_COLUMNS)


def merge_segments_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", c("l_shipdate").alias("Timestamp"), c("l_returnflag").alias("Protocol"),
        c("l_quantity").alias("total_qty"), c("l_quantity").alias("max_duration"), c("l_tax").alias("tax_max"),
        c("l_extendedprice").alias("price_min"), c("l_discount").alias("discount"), "l_orderkey", "l_partkey")
    merged = merge_segments(items, ["l_suppkey", "l_linenumber"], ["Timestamp", "l_orderkey", "l_partkey"],
                            identity=["Protocol", "l_orderkey", "Timestamp", "l_partkey"], count_as="n_segments")
    return round6(merged.select("l_suppkey", "l_linenumber", c("Protocol").alias("protocol"),
                                c("l_orderkey").alias("first_order"), "total_qty", "max_duration", "tax_max",
                                "price_min", "discount", "n_segments"), "discount", digits=9)


def endpoint_key_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    odd = c("l_partkey") % 2 == 1
    a_ip, b_ip = F.concat(F.lit("10.0.0."), c("l_suppkey")), F.concat(F.lit("10.0.0."), c("l_linenumber"))
    a_port = F.when(c("l_suppkey") % 7 == 0, F.lit(None)).when(c("l_suppkey") % 7 == 1, F.lit("80.0")) \
        .when(c("l_suppkey") % 7 == 2, F.lit("https")).otherwise(c("l_suppkey").cast("string"))
    b_port = F.lit("443")
    sides = items.select(
        F.when(odd, b_ip).otherwise(a_ip).alias("src"), F.when(odd, a_ip).otherwise(b_ip).alias("dst"),
        F.when(odd, b_port).otherwise(a_port).alias("sport"), F.when(odd, a_port).otherwise(b_port).alias("dport"))
    return with_endpoint_key(sides, "src", "dst", "sport", "dport").groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def flows_for_alerts_query(spark, sf_dir):
    keyed = with_endpoint_key(segments(spark, sf_dir), *SEGMENT_COLUMNS.endpoints)
    kept = flows_for_alerts(keyed, keyed_alerts(spark, sf_dir), salt_on=["l_suppkey", "l_partkey"])
    return kept.select(c("Flow ID").alias("flow_id"), "key", "l_suppkey", "l_partkey", "price")


def score_lookup(spark, sf_dir):
    looked = look_up_scores(keyed_alerts(spark, sf_dir), scores(spark, sf_dir, True), salt_on=ALERT_KEY)
    return round6(looked.select(*ALERT_KEY, "key", "proba"), "proba")


def match_rate_query(spark, sf_dir):
    return round6(match_rate(keyed_alerts(spark, sf_dir), scores(spark, sf_dir)), "match_rate")


def unmatched_alerts(spark, sf_dir):
    return unmatched(keyed_alerts(spark, sf_dir), scores(spark, sf_dir), salt_on=ALERT_KEY).select(*ALERT_KEY, "key", "y")


def holdout_flows(spark, sf_dir):
    """Segments of the connections left after those the model trained on (returned items) are taken out."""
    seen = table(spark, sf_dir, "lineitem").filter(c("l_returnflag") == "R").select(
        F.concat(F.lit("f"), c("l_orderkey"), F.lit("-"), c("l_returnflag")).alias("Flow ID"))
    fresh = without_training_flows(segments(spark, sf_dir, True), seen, "Flow ID")
    return fresh.groupBy(c("Flow ID").alias("flow_id")).agg(F.count(F.lit(1)).alias("n_segments"))


def keys(spark, sf_dir, per_flag=False):
    return plan.matched_keys(keyed_alerts(spark, sf_dir), scores(spark, sf_dir, per_flag))


def recheck_sweep(spark, sf_dir):
    return plan.sweep_keys(keys(spark, sf_dir, True))


def operating_point_query(spark, sf_dir):
    return operating_point(plan.sweep_keys(keys(spark, sf_dir, True)))


def recheck_summary(spark, sf_dir):
    return plan.recheck_summary(keys(spark, sf_dir), 0.5)


def recheck_percentages(spark, sf_dir):
    return plan.with_percentages(plan.recheck_summary(keys(spark, sf_dir, True), 0.45))


def recheck_alerts(spark, sf_dir):
    scored = scores(spark, sf_dir, True)
    flagged = keyed_alerts(spark, sf_dir)
    cut = plan.choose_cut(plan.matched_keys(flagged, scored)).select("threshold").scalar()
    matched = plan.match_alerts(flagged, scored, "o_orderkey")
    final = F.when(c("proba").isNull(), 1).otherwise((c("proba") >= cut).cast("int"))
    return round6(matched.select(*ALERT_KEY, "y", "proba", final.alias("final")), "proba")


def flow_dataset(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        c("l_returnflag").alias("Label"), F.concat(c("l_suppkey"), F.lit("-"), c("l_linenumber")).alias("Flow ID"),
        c("l_shipdate").alias("Timestamp"), c("l_quantity").alias("total_qty"), c("l_tax").alias("tax_max"),
        c("l_discount").alias("discount"))
    built = flow_plan.build_flow_dataset(items, {"A": 150, "N": 250, "R": 100_000}, seed=SEED)
    return round6(built.select(c("Label").alias("label"), c("Flow ID").alias("flow_id"), "total_qty", "tax_max",
                               "discount", "position"), "discount", digits=9)


def unaligned_documents(spark, sf_dir):
    """Documents without a label and labels without a document, by id."""
    return quality.unaligned_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


QUERIES = {
    "unaligned_documents": unaligned_documents,
    "merge_segments": merge_segments_query, "endpoint_key": endpoint_key_query,
    "flows_for_alerts": flows_for_alerts_query, "score_lookup": score_lookup, "match_rate": match_rate_query,
    "unmatched_alerts": unmatched_alerts, "holdout_flows": holdout_flows, "recheck_sweep": recheck_sweep,
    "operating_point": operating_point_query, "recheck_summary": recheck_summary,
    "recheck_percentages": recheck_percentages, "recheck_alerts": recheck_alerts, "flow_dataset": flow_dataset,
}

_GRID = ", ".join(f"({t!r}e0)" for t in recheck_grid())
_FLAGGED = f"WITH {ALERTS_SQL}, {segments_sql()}"
_FLAGGED_MANY = f"WITH {ALERTS_SQL}, {segments_sql(True)}"
_SWEEP = f"""ma AS (SELECT al.y, sc.proba FROM al JOIN sc USING (key)),
sw AS (
  SELECT t AS threshold, count(*) FILTER (WHERE y = 0 AND proba >= t) AS fp_after,
         count(*) FILTER (WHERE y = 1 AND proba >= t) AS tp_kept,
         count(*) FILTER (WHERE y = 0) AS fp_before, count(*) FILTER (WHERE y = 1) AS tp_before
  FROM ma, (VALUES {_GRID}) AS g(t) GROUP BY t),
pc AS (
  SELECT *, round(100 * (1 - fp_after / fp_before::DOUBLE), 1) AS fp_reduction_pct,
         round(100 * (tp_kept / tp_before::DOUBLE), 1) AS attack_retention_pct FROM sw),
op AS (
  SELECT * FROM pc ORDER BY attack_retention_pct >= 90 DESC,
    CASE WHEN attack_retention_pct >= 90 THEN fp_reduction_pct ELSE attack_retention_pct END DESC, threshold LIMIT 1)"""


def _summary(cut: str) -> str:
    return f"""SELECT count(*) AS flagged, count(proba) AS matched,
      count(*) FILTER (WHERE y = 0 AND proba IS NOT NULL) AS fp_before, count(*) FILTER (WHERE y = 0 AND proba >= {cut}) AS fp_after,
      count(*) FILTER (WHERE y = 1 AND proba IS NOT NULL) AS tp_before, count(*) FILTER (WHERE y = 1 AND proba >= {cut}) AS tp_kept
    FROM al LEFT JOIN sc USING (key)"""


_PORT = ("CASE l_suppkey % 7 WHEN 0 THEN '<NA>' WHEN 1 THEN '80' WHEN 2 THEN '<NA>' ELSE l_suppkey::VARCHAR END")
_A, _B = f"'10.0.0.' || l_suppkey || ':' || {_PORT}", "'10.0.0.' || l_linenumber || ':443'"

ORACLES = {
    "unaligned_documents": """
        SELECT coalesce(d.doc_id, l.doc_id) AS doc_id FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id
        WHERE d.doc_id IS NULL OR l.doc_id IS NULL""",
    "merge_segments": """
        WITH o AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber
                                                ORDER BY l_shipdate, l_orderkey, l_partkey) AS k FROM lineitem)
        SELECT l_suppkey, l_linenumber, max(l_returnflag) FILTER (WHERE k = 1) AS protocol,
               max(l_orderkey) FILTER (WHERE k = 1) AS first_order, sum(l_quantity) AS total_qty,
               sum(l_quantity) AS max_duration, max(l_tax) AS tax_max, min(l_extendedprice) AS price_min,
               round(avg(l_discount), 9) AS discount, count(*) AS n_segments
        FROM o GROUP BY l_suppkey, l_linenumber""",
    "endpoint_key": f"""
        SELECT least({_A}, {_B}) || '|' || greatest({_A}, {_B}) AS key, count(*) AS n FROM lineitem GROUP BY 1""",
    "flows_for_alerts": f"""
        WITH {ALERTS_SQL}, {segments_sql()}
        SELECT flow_id, key, l_suppkey, l_partkey, l_extendedprice AS price FROM sg
        WHERE EXISTS (SELECT 1 FROM al WHERE al.key = sg.key)""",
    "score_lookup": f"""
        {_FLAGGED_MANY}
        SELECT o_orderkey, key, round(proba, 6) AS proba
        FROM al JOIN sc USING (key)""",
    "match_rate": f"""
        {_FLAGGED}
        SELECT count(*) AS flagged, count(proba) AS matched, round(count(proba) / count(*)::DOUBLE, 6) AS match_rate
        FROM al LEFT JOIN sc USING (key)""",
    "unmatched_alerts": f"""
        {_FLAGGED}
        SELECT o_orderkey, key, y FROM al
        WHERE NOT EXISTS (SELECT 1 FROM sc WHERE sc.key = al.key)""",
    "holdout_flows": f"""
        WITH {ALERTS_SQL}, {segments_sql(True)}
        SELECT flow_id, count(*) AS n_segments FROM sg
        WHERE flow_id NOT IN (SELECT 'f' || l_orderkey || '-' || l_returnflag FROM lineitem
                              WHERE l_returnflag = 'R')
        GROUP BY flow_id""",
    "recheck_sweep": f"{_FLAGGED_MANY}, {_SWEEP} SELECT * FROM pc",
    "operating_point": f"{_FLAGGED_MANY}, {_SWEEP} SELECT * FROM op",
    "recheck_summary": f"{_FLAGGED} {_summary('0.5e0')}",
    "recheck_percentages": f"""
        {_FLAGGED_MANY}
        SELECT *, round(matched / flagged::DOUBLE, 3) AS match_rate,
               round(100 * (1 - fp_after / fp_before::DOUBLE), 1) AS fp_reduction_pct,
               round(100 * (tp_kept / tp_before::DOUBLE), 1) AS attack_retention_pct
        FROM ({_summary('0.45e0')})""",
    "recheck_alerts": f"""
        {_FLAGGED_MANY}, {_SWEEP}
        SELECT o_orderkey, y, round(proba, 6) AS proba,
               CASE WHEN proba IS NULL OR proba >= (SELECT threshold FROM op) THEN 1 ELSE 0 END AS final
        FROM al LEFT JOIN sc USING (key)""",
    "flow_dataset": f"""
        WITH m AS (SELECT l_returnflag AS label, l_suppkey || '-' || l_linenumber AS flow_id, sum(l_quantity) AS total_qty,
                          max(l_tax) AS tax_max, avg(l_discount) AS discount
                   FROM lineitem GROUP BY 1, 2),
        h AS (SELECT *, {sql_draw("label || '|' || flow_id")} AS draw FROM m),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY draw, label, flow_id) AS k FROM h)
        SELECT label, flow_id, total_qty, tax_max, round(discount, 9) AS discount,
               row_number() OVER (ORDER BY draw, label, flow_id) AS position
        FROM r WHERE k <= CASE label WHEN 'A' THEN 150 WHEN 'N' THEN 250 ELSE 100000 END""",
}
