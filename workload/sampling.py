"""Sources, sampling, splits, profiles and integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import quality, sampling
from twinsieve.sources import tables

from .base import DOCS_SQL, EVENTS_SQL, SEED, documents_with_labels, events, round6, sql_draw, sql_uniform, table

KEY = ["event_id"]
QUOTAS = {"click": 100, "view": 100, "purchase": 100, "signup": 100, "error": 150}
TAKE_ALL = {**QUOTAS, "error": 5_000}
LANGS = ["de", "es", "fr"]
LIMITS = quality.GateLimits(benign_quota=600, benign_slack=50, attack_rows=(300, 500), attack_share_pct=(30.0, 45.0),
                            duplicate_share=0.01, benign="en", classes=LANGS)


# ---------------------------------------------------------------- sources

def labelled_union(spark, sf_dir):
    """Two classes from different files; columns one of them lacks become null."""
    both = tables.scan_labelled(spark, {"Benign": [f"{sf_dir}/orders.parquet"], "Flood": [f"{sf_dir}/customer.parquet"]},
                                fmt="parquet")
    return both.select(c("Label").alias("label"), "o_orderkey", "o_orderstatus", "c_custkey", "c_mktsegment")


def source_counts(spark, sf_dir):
    return tables.source_counts(table(spark, sf_dir, "documents"), "source")


def missing_sources(spark, sf_dir):
    """Documents without a label."""
    return tables.missing_sources(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


PATH_INCLUDE = [r"/en/", r"blog"]
PATH_EXCLUDE = [r"spam", r"utm_source"]


def path_route(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    routed = pages.withColumn("r", tables.route_path(c("url"), flow_word="https"))
    return routed.select("page_id", tables.wanted_path(c("url"), PATH_INCLUDE, PATH_EXCLUDE).alias("wanted"),
                         "r.layer", "r.category", "r.file_name")


# ---------------------------------------------------------------- sampling

def sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(events(spark, sf_dir), KEY, 2000, SEED).select("event_id", "event_type")


def sample_quota(spark, sf_dir):
    return sampling.sample_quota(events(spark, sf_dir), KEY, "event_type", QUOTAS, SEED).select("event_id", "event_type")


def sample_stratified(spark, sf_dir):
    return sampling.sample_stratified(events(spark, sf_dir), KEY, "event_type", TAKE_ALL, SEED).select(
        "event_id", "event_type")


def class_quota(spark, sf_dir):
    quotas = sampling.even_quota(10_500, ["click", "view", "purchase", "signup", "error"])
    return sampling.quota_table(events(spark, sf_dir), "event_type", quotas)


def shuffle_order(spark, sf_dir):
    return sampling.shuffle_order(events(spark, sf_dir), KEY, SEED).select("event_id", "position")


def split_stratified(spark, sf_dir):
    return sampling.split_stratified(table(spark, sf_dir, "labels"), ["doc_id"], "toxic", seed=SEED).select(
        "doc_id", "toxic", "split")


def split_bernoulli(spark, sf_dir):
    return sampling.split_bernoulli(events(spark, sf_dir), KEY, seed=SEED).select("event_id", "split")


def kfold_assign(spark, sf_dir):
    return sampling.kfold_assign(events(spark, sf_dir), KEY, "y", seed=SEED).select("event_id", "y", "fold")


def occurrence_numbers(spark, sf_dir):
    """Equal rows numbered, so that a table without a key gets one."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return sampling.with_occurrence(flags)


# ---------------------------------------------------------------- profiles and checks

def integrity_report(spark, sf_dir):
    return quality.integrity_report(documents_with_labels(spark, sf_dir), "lang", LIMITS, key="doc_id")


def duplicate_rows(spark, sf_dir):
    return quality.duplicate_count(table(spark, sf_dir, "documents").drop("doc_id"))


def with_empty_column(spark, sf_dir):
    docs = documents_with_labels(spark, sf_dir)
    return docs.withColumn("impossible", F.when(c("quality") > 1, c("quality")))


def null_columns(spark, sf_dir):
    return quality.null_columns(with_empty_column(spark, sf_dir))


def profile_nulls(spark, sf_dir):
    return quality.top_null_columns(with_empty_column(spark, sf_dir))


def class_counts(spark, sf_dir):
    return quality.class_counts(table(spark, sf_dir, "documents"), "lang")


def class_mix(spark, sf_dir):
    return round6(quality.class_mix(events(spark, sf_dir), "event_type"), "share")


def suspect_columns(spark, sf_dir):
    """Columns whose names look like a label, with their distinct values."""
    parts = []
    for name in ("events", "part", "labels"):
        df = table(spark, sf_dir, name)
        found = quality.suspect_columns(df.columns)
        if found:
            parts.append(quality.column_cardinality(df, found).select(F.lit(name).alias("table_name"), "*"))
    return tables.union_labelled(parts)


def presence_rate(spark, sf_dir):
    docs = documents_with_labels(spark, sf_dir)
    return round6(quality.presence_rate(docs, ["source", "quality", "toxic"], "lang"), "presence")


def constant_columns(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_returnflag", (c("l_quantity") * 0 + 7).alias("seven"),
        F.when(c("l_quantity") > 10, 1).alias("one_or_null"), F.when(c("l_quantity") < 0, 1).alias("empty"))
    return quality.constant_columns(items)


def column_cardinality(spark, sf_dir):
    return quality.column_cardinality(table(spark, sf_dir, "lineitem"),
                                      ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey"])


QUERIES = {
    "labelled_union": labelled_union, "source_counts": source_counts, "missing_sources": missing_sources,
    "path_route": path_route, "sample_fraction": sample_fraction, "sample_quota": sample_quota,
    "sample_stratified": sample_stratified, "class_quota": class_quota, "shuffle_order": shuffle_order,
    "split_stratified": split_stratified, "split_bernoulli": split_bernoulli, "kfold_assign": kfold_assign,
    "occurrence_numbers": occurrence_numbers, "integrity_report": integrity_report, "duplicate_rows": duplicate_rows,
    "null_columns": null_columns, "profile_nulls": profile_nulls, "class_counts": class_counts,
    "class_mix": class_mix, "suspect_columns": suspect_columns, "presence_rate": presence_rate,
    "constant_columns": constant_columns, "column_cardinality": column_cardinality,
}

_EV = f"WITH {EVENTS_SQL}"
_DL = f"WITH {DOCS_SQL}"
_EMPTY = f"{_DL}, de AS (SELECT *, CASE WHEN quality > 1 THEN quality END AS impossible FROM dl)"
_DRAW = sql_draw("event_id")


def _quota_sql(quotas: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in quotas.items())
    return f"""{_EV}, k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_DRAW}, event_id) AS k FROM ev)
        SELECT event_id, event_type FROM k WHERE k <= CASE event_type {cases} END"""


def _nulls(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS column_name, count(*) - count({n}) AS n_null FROM de" for n in names)


_DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic", "impossible"]
_CONSTANT = {"l_quantity": "l_quantity", "l_returnflag": "l_returnflag", "seven": "l_quantity * 0 + 7",
             "one_or_null": "CASE WHEN l_quantity > 10 THEN 1 END", "empty": "CASE WHEN l_quantity < 0 THEN 1 END"}
_U = sql_uniform("event_id")

ORACLES = {
    "labelled_union": """
        SELECT 'Benign' AS label, o_orderkey, o_orderstatus, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_mktsegment FROM orders
        UNION ALL SELECT 'Flood', NULL, NULL, c_custkey, c_mktsegment FROM customer""",
    "source_counts": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "missing_sources": """
        SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "path_route": r"""
        WITH p AS (SELECT page_id, url, list_filter(string_split_regex(replace(url_decode(url), '+', ' '), '[/\\]'), lambda x: x <> '') AS parts FROM pages)
        SELECT page_id, regexp_matches(lower(url), '/en/|blog') AND NOT regexp_matches(lower(url), 'spam|utm_source') AS wanted,
               CASE WHEN contains(lower(parts[1]), 'https') THEN 'flow' ELSE 'packet' END AS layer,
               regexp_replace(CASE WHEN len(parts) > 2 THEN parts[-2] ELSE 'root' END, '[<>:"/\\|?*]', '_', 'g') AS category,
               parts[-1] AS file_name
        FROM p""",
    "sample_fraction": f"""{_EV}
        SELECT event_id, event_type FROM ev WHERE {_U} < 2000e0 / (SELECT count(*) FROM ev)""",
    "sample_quota": _quota_sql(QUOTAS),
    "sample_stratified": _quota_sql(TAKE_ALL),
    "class_quota": """
        SELECT event_type, 2100::BIGINT AS wanted, count(*) AS available, greatest(2100 - count(*), 0) AS deficit
        FROM events GROUP BY event_type""",
    "shuffle_order": f"{_EV} SELECT event_id, row_number() OVER (ORDER BY {_DRAW}, event_id) AS position FROM ev",
    "split_stratified": f"""
        WITH k AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {sql_draw('doc_id')}, doc_id) AS k,
                          count(*) OVER (PARTITION BY toxic) AS n FROM labels)
        SELECT doc_id, toxic, CASE WHEN k <= round(n * 0.3e0) THEN 'test'
            WHEN k <= round(n * 0.3e0) + round((n - round(n * 0.3e0)) * 0.2e0) THEN 'val' ELSE 'train' END AS split FROM k""",
    "split_bernoulli": f"""{_EV}
        SELECT event_id, CASE WHEN {_U} < 0.3e0 THEN 'test' WHEN {_U} < {0.3 + (1.0 - 0.3) * 0.2!r}e0 THEN 'val' ELSE 'train' END AS split FROM ev""",
    "kfold_assign": f"""{_EV}
        SELECT event_id, y, (ntile(5) OVER (PARTITION BY y ORDER BY {_DRAW}, event_id) - 1)::INTEGER AS fold FROM ev""",
    "occurrence_numbers": """
        SELECT l_returnflag, l_linestatus, l_linenumber,
               row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber) AS occurrence FROM lineitem""",
    "integrity_report": f"""{_DL},
        n AS (SELECT count(*) AS n_all, count(*) FILTER (WHERE lang = 'en') AS benign,
                     count(DISTINCT lang) FILTER (WHERE lang IN ('de', 'es', 'fr')) AS seen,
                     count(*) - count(DISTINCT (text, lang, source, n_chars, quality, toxic)) AS dup,
                     least(count(text), count(lang), count(source), count(n_chars), count(quality), count(toxic)) AS fewest FROM dl)
        SELECT 'benign_quota' AS check_name, abs(benign - 600) < 50 AS passed FROM n
        UNION ALL SELECT 'attack_rows', n_all - benign BETWEEN 300 AND 500 FROM n
        UNION ALL SELECT 'attack_share', 100 * ((n_all - benign) / n_all::DOUBLE) BETWEEN 30 AND 45 FROM n
        UNION ALL SELECT 'all_classes_present', seen = 3 FROM n
        UNION ALL SELECT 'few_duplicates', dup < 0.01 * n_all FROM n
        UNION ALL SELECT 'no_empty_column', fewest > 0 FROM n""",
    "duplicate_rows": """
        SELECT count(*) AS n_rows, count(*) - count(DISTINCT (text, lang, source, n_chars)) AS n_duplicate FROM documents""",
    "null_columns": f"""{_EMPTY}, nc AS ({_nulls(_DOC_COLUMNS)})
        SELECT column_name FROM nc WHERE n_null = (SELECT count(*) FROM de)""",
    "profile_nulls": f"""{_EMPTY}, nc AS ({_nulls(_DOC_COLUMNS)})
        SELECT * FROM nc WHERE n_null > 0 ORDER BY n_null DESC, column_name LIMIT 30""",
    "class_counts": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "class_mix": """
        SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events)::DOUBLE, 6) AS share
        FROM events GROUP BY event_type""",
    "suspect_columns": """
        SELECT 'events' AS table_name, 'event_type' AS column_name, count(DISTINCT event_type) AS n_distinct FROM events
        UNION ALL SELECT 'part', 'p_type', count(DISTINCT p_type) FROM part""",
    "presence_rate": f"{_DL} " + " UNION ALL ".join(
        f"SELECT lang, '{n}' AS column_name, round(count({n}) / count(*)::DOUBLE, 6) AS presence FROM dl GROUP BY lang"
        for n in ("source", "quality", "toxic")),
    "constant_columns": " UNION ALL ".join(
        f"SELECT '{n}' AS column_name FROM (SELECT count(DISTINCT {e}) AS k FROM lineitem) WHERE k <= 1"
        for n, e in _CONSTANT.items()),
    "column_cardinality": " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(DISTINCT {n}) AS n_distinct FROM lineitem"
        for n in ("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey")),
}
