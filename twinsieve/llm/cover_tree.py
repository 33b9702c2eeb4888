"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors are compared inside one label, by cosine. On the unit sphere a cosine of at least ``t`` is a distance of
at most sqrt(2 - 2t), so a pair of tree nodes can be dropped once their centres lie further apart than that plus
both covering radii. The upper tree is a table: a node above ``NODE_ROWS`` rows is divided among centres drawn
from its own rows. Node pairs are carried down level by level, pruned by the bound. Each surviving pair of
leaves is one task group, where two small trees with nested levels of halving radii are traversed together; what
survives is compared in double precision. Equal vectors are one class and are never expanded into pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c
from ..session import cut_lineage
from .components import components

NODE_ROWS = 1024            # a node with more classes is divided
FAN_OUT = 32                # children of a node at most
MOST_LEVELS = 12            # beyond this, rows too alike to divide by distance are divided by hash
SLACK = 1e-9                # added to every bound, so rounding never prunes a pair


# ---------------------------------------------------------------- one task: two small trees

def halving_levels(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nested levels of a cover tree: (centres, parent of each centre, covering radius), from the root down.

    Centres are row numbers; each level halves the radius, keeps the centres above it and ends with all rows.
    """
    n = len(points)
    owner = np.zeros(n, np.int64)
    away = np.linalg.norm(points - points[0], axis=1)
    levels = [(np.array([0]), np.array([0]), np.array([away.max()]))]
    radius = float(away.max())
    while radius > 1e-6 and len(levels[-1][0]) * 2 < n:
        radius /= 2
        centres, parents, reach, fresh = [], [], [], np.empty(n, np.int64)
        for p, old in enumerate(levels[-1][0]):
            rest = np.flatnonzero(owner == p)
            first = old
            while len(rest):
                far = np.linalg.norm(points[rest] - points[first], axis=1)
                near = far <= radius
                near[rest == first] = True
                fresh[rest[near]] = len(centres)
                centres.append(first)
                parents.append(p)
                reach.append(far[near].max())
                rest = rest[~near]
                first = rest[0] if len(rest) else -1
        owner = fresh
        levels.append((np.array(centres), np.array(parents), np.array(reach)))
    levels.append((np.arange(n), owner, np.zeros(n)))
    return levels


def dual_pairs(a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of unit vectors whose distance bound allows the cosine; both trees go down together."""
    limit = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    one, two = halving_levels(a), halving_levels(b)
    alive = np.ones((1, 1), bool)
    for depth in range(1, max(len(one), len(two))):
        left, right = one[min(depth, len(one) - 1)], two[min(depth, len(two) - 1)]
        up = left[1] if depth < len(one) else np.arange(len(left[0]))
        vp = right[1] if depth < len(two) else np.arange(len(right[0]))
        alive = alive[up][:, vp]
        rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(rows):
            break
        dots = a[left[0][rows]] @ b[right[0][cols]].T
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * dots))
        # A dot product near 1 loses half its digits in the root, so the bound carries that much slack.
        near = apart <= limit + 1e-7 + left[2][rows][:, None] + right[2][cols][None, :]
        kept = np.zeros_like(alive)
        kept[np.ix_(rows, cols)] = near & alive[np.ix_(rows, cols)]
        alive = kept
    return np.nonzero(alive)


def _links(a: pa.Table, b: pa.Table | None, cosine: float):
    """(classes, number of linked vectors of others, edges of a spanning forest) of one group."""
    def columns(t):
        dim = len(t.column("vec")[0])
        raw = t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        return (t.column("cls").to_numpy(), t.column("weight").to_numpy(), raw, raw / np.linalg.norm(raw, axis=1)[:, None])

    same = b is None
    ka, wa, ra, ua = columns(a)
    kb, wb, rb, ub = (ka, wa, ra, ua) if same else columns(b)
    i, j = dual_pairs(ua, ub, cosine)
    if same:
        i, j = i[i < j], j[i < j]
    lengths_a, lengths_b = np.linalg.norm(ra, axis=1), np.linalg.norm(rb, axis=1)
    good = np.empty(len(i), bool)
    for low in range(0, len(i), 1 << 16):
        x, y = i[low:low + (1 << 16)], j[low:low + (1 << 16)]
        good[low:low + (1 << 16)] = np.einsum("ij,ij->i", ra[x], rb[y]) / (lengths_a[x] * lengths_b[y]) >= cosine
    i, j = i[good], j[good]
    ends = np.concatenate([ka[i], kb[j]])
    others = np.concatenate([wb[j], wa[i]])
    classes, at = np.unique(ends, return_inverse=True)
    counts = np.bincount(at, others, len(classes)).astype(np.int64)
    return classes, counts, _forest(at[:len(i)], at[len(i):], classes)


def _forest(a: np.ndarray, b: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each class with the smallest class it is connected to in this group."""
    root = np.arange(len(names))
    while len(a):
        before = root.copy()
        np.minimum.at(root, root[a], root[b])
        np.minimum.at(root, root[b], root[a])
        root = root[root]
        if (root == before).all() and (root[a] == root[b]).all():
            break
    return names, names[root]


# ---------------------------------------------------------------- Spark: the upper tree

def _distance(x: str, y: str):
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(
        F.zip_with(c(x), c(y), lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)))


def _divide(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes with their leaf, all nodes): nodes above NODE_ROWS are divided until none is left or levels end."""
    current = classes.withColumn("node", F.concat(F.col("part"), F.lit("/")))
    nodes, leaves, level = [], [], 0
    while True:
        order = F.xxhash64(F.lit(level), "cls")
        # The smallest hashes of a node are its centres: a bounded list per node, kept small on the map side.
        bounds = current.groupBy("node").agg(F.count("*").alias("rows"), F.min_by("unit", order).alias("centre"))
        reach = current.join(bounds, "node").groupBy("node").agg(
            F.first("rows").alias("rows"), F.first("centre").alias("centre"), F.max(_distance("unit", "centre")).alias("radius"))
        reach = cut_lineage(reach)
        nodes.append(reach.withColumn("level", F.lit(level)))
        large = reach.filter(F.col("rows") > NODE_ROWS).select("node", "rows")
        done = current.join(large.select("node"), "node", "left_anti")
        leaves.append(done)
        if large.isEmpty():
            break
        rest = current.join(large, "node")
        share = F.least(F.lit(FAN_OUT), F.ceil(F.col("rows") / NODE_ROWS)).cast("int")
        if level < MOST_LEVELS:
            slot = F.pmod(F.xxhash64(F.lit(level), F.lit(1), "cls"), share)     # one centre from each slot
            centres = (rest.withColumn("slot", slot).groupBy("node", "slot").agg(F.min_by("unit", order).alias("u"))
                       .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("slot", "u"))).alias("centres")))
            far = F.transform("centres", lambda s: F.struct(
                F.aggregate(F.zip_with("unit", s["u"], lambda p, q: p * q), F.lit(0.0), lambda t, v: t - v).alias("d"), s["slot"].alias("slot")))
            child = F.array_min(far)["slot"]
            rest = rest.join(centres, "node").withColumn("child", child).drop("centres")
        else:
            rest = rest.withColumn("child", F.pmod(F.xxhash64(F.lit(level), F.lit(2), "cls"), share).cast("int"))
        current = cut_lineage(rest.withColumn("node", F.concat("node", F.col("child").cast("string"), F.lit("/"))).drop("rows", "child"))
        level += 1
    found, upper = leaves[0], nodes[0]
    for more in leaves[1:]:
        found = found.unionByName(more)
    for more in nodes[1:]:
        upper = upper.unionByName(more)
    return found, upper


def _leaf_pairs(nodes: DataFrame, cosine: float) -> DataFrame:
    """(a, b) of leaves, a <= b, that the covering radii do not rule out: the dual traversal of the upper tree."""
    limit = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    depth = nodes.agg(F.max("level")).first()[0] or 0
    parent = F.regexp_extract("node", r"^(.*/)[0-9]+/$", 1)
    shape = nodes.select("node", "level", "centre", "radius", (F.col("rows") <= NODE_ROWS).alias("leaf"), parent.alias("up"))
    pairs = shape.filter("level = 0").select(F.col("node").alias("a"), F.col("node").alias("b"),
                                             F.col("leaf").alias("la"), F.col("leaf").alias("lb"))
    for level in range(1, depth + 1):
        below = shape.filter(F.col("level") == level)
        for side, other in (("a", "b"), ("b", "a")):
            down = below.select(F.col("up").alias("__up"), F.col("node").alias("__node"), F.col("leaf").alias("__leaf"))
            pairs = (pairs.join(down, (F.col(side) == F.col("__up")) & ~F.col(f"l{side}"), "left")
                     .withColumn(side, F.coalesce("__node", side)).withColumn(f"l{side}", F.coalesce("__leaf", f"l{side}"))
                     .drop("__up", "__node", "__leaf"))
        known = shape.select("node", "centre", "radius")
        pairs = (pairs.filter("a <= b")
                 .join(known.select(F.col("node").alias("a"), F.col("centre").alias("ca"), F.col("radius").alias("ra")), "a")
                 .join(known.select(F.col("node").alias("b"), F.col("centre").alias("cb"), F.col("radius").alias("rb")), "b")
                 .filter(_distance("ca", "cb") <= F.col("ra") + F.col("rb") + F.lit(limit)).select("a", "b", "la", "lb"))
        pairs = cut_lineage(pairs)
    return pairs.select("a", "b")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 cosine: float = 0.93) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; links are pairs of equal label with at least this cosine.

    A null vector or label, a zero vector and one with null or non-finite components link with nothing. Vectors of
    different length never link. Repeated rows link like other equal vectors and share an id. Other columns are
    not read; an empty table gives no row.
    """
    rows = vectors.select(c(id_col).cast("long").alias("id"), c(label_col).cast("string").alias("label"),
                          F.transform(c(vec_col), lambda x: x.cast("double")).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    usable = F.coalesce(F.col("label").isNotNull() & finite & (length > 0), F.lit(False))
    # A vector in full, not its hash, makes the class, so a hot vector is folded on the map side.
    classes = (rows.filter(usable).groupBy("label", "vec").agg(F.min("id").alias("cls"), F.count("*").alias("weight"))
               .select("cls", "weight", "vec", F.concat(F.col("label"), F.lit("|"), F.size("vec").cast("string")).alias("part"),
                       F.transform("vec", lambda x: x / length).alias("unit")))
    classes = cut_lineage(classes)
    found, upper = _divide(classes)
    found = cut_lineage(found.select("node", "cls", "weight", "vec"))
    pairs = cut_lineage(_leaf_pairs(upper, cosine))

    left = pairs.join(found.withColumnRenamed("node", "a"), "a").withColumn("side", F.lit(0))
    right = pairs.filter("a != b").join(found.withColumnRenamed("node", "b"), "b").withColumn("side", F.lit(1))
    both = left.select("a", "b", "side", "cls", "weight", "vec").unionByName(right.select("a", "b", "side", "cls", "weight", "vec"))

    def compare(key, table):
        import pyarrow.compute as pc
        own = table.filter(pc.equal(table.column("side"), 0))
        other = table.filter(pc.equal(table.column("side"), 1))
        names, counts, (_, roots) = _links(own, other if len(other) else None, cosine)
        return pa.table({"cls": names, "links": counts, "root": roots}, pa.schema(
            [("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    linked = cut_lineage(both.groupBy("a", "b").applyInArrow(compare, "cls long, links long, root long"))
    reach = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    sums = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    per_class = cut_lineage(classes.join(sums, "cls", "left").join(reach.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "vec", F.split("part", "\\|[0-9]+$")[0].alias("label"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "cls").alias("component")))
    good = rows.filter(usable).join(per_class, ["label", "vec"]).select("id", "n_links", "component")
    bad = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return good.unionByName(bad).select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
                                        (F.col("id") == F.col("component")).alias("kept"))


VECTORS_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[64] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_sum([x::DOUBLE * x FOR x IN embedding]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE array_cosine_similarity(a.v, b.v) >= 0.93e0),
reach AS (
  SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings e LEFT JOIN least l ON l.node = e.vec_id LEFT JOIN counts k ON k.node = e.vec_id"""
