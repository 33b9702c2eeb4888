"""Extendible hashing into shards: only buckets above the byte limit split, on one more bit of the key's hash.

The hash is the first 60 bits of the MD5 of the key, so shards do not depend on machine or session. Bytes are
summed per hash prefix of ``FIRST_BITS`` bits (a table of at most 2^16 rows); the sums of all shorter prefixes
follow from it. A bucket is a prefix within the limit whose parent is above it. Prefixes that are still above
the limit at full width are looked at again, alone, with ``MORE_BITS`` more bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from ..session import cut_lineage

FIRST_BITS = 16
MORE_BITS = 8
HASH_BITS = 60
SHARD_BYTES = 1 << 20


def hash_key(key: Column) -> Column:
    """60-bit hash of a key; a null key counts as the empty string."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(bits: int) -> Column:
    return F.shiftright("__h", HASH_BITS - bits)


def _entries(bits: int) -> Column:
    """The directory entries (prefixes of ``bits`` bits) that point to a bucket."""
    return F.explode(F.sequence(F.expr(f"shiftleft(node, {bits} - depth)"), F.expr(f"shiftleft(node + 1, {bits} - depth) - 1")))


def _buckets(sized: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(depth, node, shard_bytes, shard_docs) of buckets with depths low to high, from rows under prefixes above the limit."""
    fine = sized.groupBy(_prefix(high).alias("__p")).agg(F.sum("__bytes").alias("b"), F.count("*").alias("n"))
    depths = F.explode(F.sequence(F.lit(low), F.lit(high)))
    nodes = (fine.select("__p", "b", "n", depths.alias("depth"))
             .groupBy("depth", F.expr(f"shiftright(__p, {high} - depth)").alias("node"))
             .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("__up"),
                           (F.col("shard_bytes") > limit).alias("__split"))
    at_bottom = F.lit(high >= HASH_BITS) & (F.col("depth") == HASH_BITS)
    return (nodes.withColumn("__up", F.shiftright("node", 1)).join(parents, ["depth", "__up"], "left")
            .filter(F.coalesce("__split", F.lit(True)) & ((F.col("shard_bytes") <= limit) | at_bottom))
            .select("depth", "node", "shard_bytes", "shard_docs"))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Every row of ``docs`` with the shard it belongs to.

    Adds n_bytes (UTF-8 length, null text 0), shard (the bucket's hash prefix in binary, '' for the root), depth,
    shard_bytes, shard_docs and fits (false only where rows that share their whole hash, or one row, exceed the
    limit alone). Columns of these names are replaced. Repeated rows share a shard; an empty table stays empty.
    """
    added = ("n_bytes", "shard", "depth", "shard_bytes", "shard_docs", "fits")
    kept = [x for x in docs.columns if x not in added or x in (id_col, text_col)]
    rest = docs.select(*map(c, kept), hash_key(c(id_col)).alias("__h"),
                       F.coalesce(F.octet_length(c(text_col)), F.lit(0)).cast("long").alias("__bytes"))
    sized = cut_lineage(rest.select("__h", "__bytes"))
    low, high, parts = 0, FIRST_BITS, []
    while True:
        found = cut_lineage(_buckets(sized, low, high, limit))
        directory = found.withColumn("__p", _entries(high))
        if high == FIRST_BITS:
            directory = F.broadcast(directory)          # at most 2^16 rows
        joined = rest.withColumn("__p", _prefix(high)).join(directory, "__p", "left").drop("__p")
        parts.append(joined.filter(F.col("depth").isNotNull()))
        done = found.agg(F.sum("shard_docs")).first()[0] or 0
        if high >= HASH_BITS or done == sized.count():
            break
        sized = cut_lineage(_unsettled(sized, found, high))
        rest = joined.filter(F.col("depth").isNull()).drop("depth", "node", "shard_bytes", "shard_docs")
        low, high = high + 1, min(HASH_BITS, high + MORE_BITS)
    whole = reduce(DataFrame.unionByName, parts)
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(node), depth, '0')"))
    others = [c(x) for x in kept if x not in added]
    return whole.select(*others, F.col("__bytes").alias("n_bytes"), bits.alias("shard"), F.col("depth").cast("int").alias("depth"),
                        "shard_bytes", "shard_docs", (F.col("shard_bytes") <= limit).alias("fits"))


def _unsettled(sized: DataFrame, found: DataFrame, high: int) -> DataFrame:
    """Rows whose prefix of ``high`` bits lies in no bucket yet."""
    return sized.withColumn("__p", _prefix(high)).join(found.select(_entries(high).alias("__p")), "__p", "left_anti").drop("__p")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> None:
    """Write one folder per shard; a shard is within the limit, so one task writes it."""
    sharded = assign_shards(docs, id_col, text_col, limit).withColumn("shard", F.concat(F.lit("b"), "shard"))
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


SHARDS_SQL = f"""
WITH sized AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_BITS // 4}))::BIGINT AS h,
         coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes
  FROM documents),
nodes AS (
  SELECT d.depth, h >> ({HASH_BITS} - d.depth) AS node, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM sized, (SELECT unnest(range(0, {HASH_BITS + 1}))::INTEGER AS depth) d
  GROUP BY ALL),
leaf AS (
  SELECT doc_id, n_bytes, h, min(n.depth) AS depth
  FROM sized s JOIN nodes n ON n.node = s.h >> ({HASH_BITS} - n.depth)
  WHERE n.shard_bytes <= {SHARD_BYTES} OR n.depth = {HASH_BITS}
  GROUP BY ALL)
SELECT doc_id, l.n_bytes, CASE WHEN l.depth = 0 THEN '' ELSE lpad(bin(n.node), l.depth, '0') END AS shard, l.depth,
       n.shard_bytes, n.shard_docs, n.shard_bytes <= {SHARD_BYTES} AS fits
FROM leaf l JOIN nodes n ON n.depth = l.depth AND n.node = l.h >> ({HASH_BITS} - l.depth)"""
