"""Shape of the physical plans: what may not appear, what has to be pushed down, where Python runs."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_points
from workload import base

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_cross_products_and_no_python_in_sql_like_queries(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    python = [step for step in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups") if step in text]
    # McNemar's tail is the one scalar computed in Python, on a single row of two counts.
    assert not python or name.startswith("mcnemar")


@pytest.mark.parametrize("name", ["sample_fraction", "sample_quota", "sample_stratified", "split_stratified", "split_bernoulli",
                                  "kfold_assign", "bookkeeping", "inf_to_null", "standard_scale", "feature_matrix", "path_route",
                                  "robust_trim", "impute_median"])
def test_rows_are_not_shuffled(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "hashpartitioning" not in text and "rangepartitioning" not in text and "RoundRobin" not in text


@pytest.mark.parametrize("name,shuffles", [("merge_segments", 1), ("detection_by_class", 1), ("cascade_union", 2), ("metric_block", 0),
                                           ("duplicate_rows", 1), ("presence_rate", 1), ("column_cardinality", 2)])
def test_shuffle_count(spark, sf_dir, name, shuffles):
    assert plan(QUERIES[name](spark, sf_dir)).count("Exchange hashpartitioning") == shuffles


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(base.segments(spark, sf_dir).filter("tax_max >= 0.08").select("Flow ID", "price"), "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_tax,0\.08\)", text)
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_shipdate" not in columns and "l_suppkey" not in columns
    columns = re.search(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["confusion"](spark, sf_dir), "formatted")).group(1)
    assert sorted(x.split(":")[0] for x in columns.split(",")) == ["event_type", "value"]


def test_recheck_job_merges_its_training_connections_once(spark, tmp_path, monkeypatch):
    import datetime

    from workload import models

    rows = [(i, i % 5, i % 4, i % 3 + 1, float(i % 50 + 1), 100.0 + i, (i % 11) / 100, (i % 9) / 100, "ANR"[i % 7 % 3], datetime.datetime(1995, 1, 1 + i % 28))
            for i in range(600)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                          " l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, train = [], models.supervised.train_rescorer
    monkeypatch.setattr(models.supervised, "train_rescorer", lambda dev, *args, **more: seen.extend(dev.inputFiles()) or train(dev, *args, **more))
    found = models.recheck_job(spark, str(tmp_path)).first()
    assert seen and not [path for path in seen if "lineitem" in path]
    assert found["flagged"] == sum(r[4] >= 45 for r in rows)
