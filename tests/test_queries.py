"""Every registered query: against DuckDB where SQL can express it, else that it gives whole, stable rows."""

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
ROWS_ONLY = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", ["pca_score", "iforest_score", "lr_score", "kmeans_cutoff", "bootstrap_ci"])
def test_scores_cover_the_table(spark, con, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    whole = con.execute("SELECT count(*) FROM embeddings").fetchall()[0][0]
    assert len(rows) == (1 if name == "bootstrap_ci" else whole)


def test_entry_and_known_counts(spark, con, sf_dir):
    """Every order is flagged; those with items match; the re-check only takes alerts away."""
    from workload import matching
    assert entry_points.entry(spark).count() == 1
    got = matching.recheck_summary(spark, sf_dir).first().asDict()
    flagged, matched = con.execute("SELECT count(*), count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) FROM orders").fetchone()
    assert (got["flagged"], got["matched"]) == (flagged, matched)
    assert got["fp_before"] + got["tp_before"] == matched
    assert 0 < got["fp_after"] < got["fp_before"] and 0 < got["tp_kept"] < got["tp_before"]


@pytest.mark.parametrize("name", ["recheck_summary", "sample_quota", "roc_auc", "kfold_assign", "rank_fusion"])
@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_partitioning_does_not_matter(spark, con, sf_dir, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
