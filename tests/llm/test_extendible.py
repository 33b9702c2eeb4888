import os
from collections import defaultdict

import duckdb

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import extendible
from twinsieve.llm.queries import table


def _shards(rows):
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    return shards


def test_only_oversized_buckets_split(spark, sf_dir):
    docs, limit = table(spark, sf_dir, "documents"), 20_000
    shards = _shards(extendible.assign_shards(docs, limit=limit).collect())
    sizes = {bits: sum(r.n_bytes for r in rows) for bits, rows in shards.items()}
    for bits, rows in shards.items():
        assert len(bits) == rows[0].depth and rows[0].shard_bytes == sizes[bits] and rows[0].shard_docs == len(rows)
        assert sizes[bits] <= limit or len(rows) == 1
        # The parent would not have fitted, and no bucket contains another.
        parent = sum(size for other, size in sizes.items() if bits and other.startswith(bits[:-1]))
        assert not bits or parent > limit
        assert not any(other != bits and other.startswith(bits) for other in sizes)
    assert sum(map(len, shards.values())) == docs.count()


def test_deeper_than_the_first_directory(spark, monkeypatch):
    monkeypatch.setattr(extendible, "FIRST_BITS", 2)
    monkeypatch.setattr(extendible, "MORE_BITS", 3)
    rows = [(i, "x" * 100) for i in range(500)] + [(7, "x" * 100)] * 30
    shards = _shards(extendible.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), limit=1000).collect())
    assert sum(map(len, shards.values())) == 530
    for found in shards.values():
        assert found[0].fits == (sum(r.n_bytes for r in found) <= 1000)
        if not found[0].fits:
            assert {r.doc_id for r in found} == {7} and found[0].depth == extendible.HASH_BITS


def test_same_as_sql(spark, sf_dir):
    found = sorted(map(tuple, extendible.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs", "fits").collect()))
    with duckdb.connect() as base:
        base.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(sf_dir, 'documents.parquet')}'")
        assert found == sorted(base.execute(extendible.SHARDS_SQL).fetchall())


def test_odd_rows_and_files(spark, tmp_path):
    found = extendible.assign_shards(frame(spark), limit=50)
    assert set(frame(spark).columns) <= set(found.columns)
    assert sorted(r.n_bytes for r in found.collect()) == sorted(len((t or "").encode()) for _, t in TEXTS)
    assert extendible.assign_shards(empty(spark)).count() == 0
    extendible.write_shards(frame(spark).drop("shard"), f"{tmp_path}/s", limit=50)
    assert spark.read.parquet(f"{tmp_path}/s").count() == len(TEXTS)
