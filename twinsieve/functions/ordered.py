"""Distributed order statistics: prefix sums, ranks and exact quantiles.

A window over one global order puts all rows into one task. Everything here first cuts the order into
buckets, sums per bucket, and only then works inside each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .columns import c, draw_text, finite_or_null, uniform_of
from .skew import small_side

_BUCKET = "__bucket"
BUCKET_ROWS = 50_000        # rows that one task orders at once, about
MOST_BUCKETS = 100_000      # beyond that buckets grow instead: the per-bucket table may travel whole
EDGE_ROWS = 50_000          # most rows of a class that a hash cut puts in order
PREFIX_DIGITS = 3           # hexadecimal digits by which a hash prefix grows: 4096 buckets at each level
_DRAW_DIGITS = 32


def bucket_total(rows: int) -> int:
    """Buckets for a table of so many rows; the session's settings play no part."""
    return min(MOST_BUCKETS, max(16, -(-rows // BUCKET_ROWS)))


# ---------------------------------------------------------------- prefix sums

def prefix_sums(df: DataFrame, bucket: str, order: Sequence[Column], values: Sequence[str],
                group: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Add ``<v>_cum`` (sum up to and including the row) and ``<v>_all`` (sum of the group).

    ``bucket`` must be non-null and agree with ``order``: every row of a lower bucket comes before every
    row of a higher one. The per-bucket table has at most one row per group and bucket. It is joined on
    the columns the inner window partitions by, so the rows are shuffled once.
    """
    # Groups travel as one struct: a null group is a group like any other, also in the join.
    tagged = df.withColumn("__group", F.struct(*[c(g) for g in group])) if group else df
    outer = ["__group"] if group else []
    keys = [*outer, bucket]
    direction = c(bucket).desc() if descending else c(bucket).asc()
    whole = Window.partitionBy(*outer)
    before = whole.orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    sums = tagged.groupBy(*[c(k) for k in keys]).agg(*[F.sum(c(v)).alias(v) for v in values])
    offsets = sums.select(
        *[c(k) for k in keys],
        *[F.coalesce(F.sum(c(v)).over(before), F.lit(0)).alias(f"__{v}_before") for v in values],
        *[F.sum(c(v)).over(whole).alias(f"{v}_all") for v in values])
    inside = (Window.partitionBy(*[c(k) for k in keys]).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Without a group the offsets have one row per bucket, of which there are few more than MOST_BUCKETS.
    out = tagged.join(offsets if group else F.broadcast(offsets), keys)
    return out.select(
        *[c(name) for name in df.columns],
        *[c(f"{v}_all") for v in values],
        *[(c(f"__{v}_before") + F.sum(c(v)).over(inside)).alias(f"{v}_cum") for v in values])


def value_edges(df: DataFrame, value: str, most: int | None = None) -> list[float]:
    """Ascending cut points of ``value`` with at most ``most`` rows between two of them (rows of one value stay together).

    Mergeable quantile summaries of bounded size cut the whole table, then again each range that is still too full,
    level by level, until counts prove the bound. ``df`` is read once per level: give a stored table. The cut points
    decide only how even buckets are; answers computed through them are exact.
    """
    rows = df.count()
    most = max(BUCKET_ROWS if most is None else most, -(-rows // MOST_BUCKETS))
    if rows <= most:
        return []
    edges: list[float] = []
    ranges = df.select(c(value).cast("double").alias("v"))
    while True:
        placed = _between(ranges, "v", edges)
        full = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).filter(
            (c("n") > most) & (c("low") < c("high")))
        crowded = full.collect()            # fewer than rows / most <= MOST_BUCKETS
        if not crowded:
            return edges
        parts = min(1024, -(-2 * max(r["n"] for r in crowded) // most))
        probs = F.array(*[F.lit(k / parts) for k in range(1, parts)])
        inside = placed.join(F.broadcast(df.sparkSession.createDataFrame([(r[_BUCKET],) for r in crowded], f"{_BUCKET} double")), _BUCKET)
        guesses = inside.groupBy(_BUCKET).agg(F.percentile_approx("v", probs, 4 * parts).alias("q")).collect()
        # Right above a range's smallest value there is a cut too, so every round gets on.
        fresh = {math.nextafter(r["low"], math.inf) for r in crowded} | {x for r in guesses for x in r["q"]}
        lows = {r["low"] for r in crowded}
        edges = sorted({x for x in fresh - lows if math.isfinite(x)} | set(edges))


def _between(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Add ``__bucket``: the number of cut points up to the value."""
    # A constant bucket would turn the join by bucket into a product, so there is one cut point at least.
    splits = [-math.inf, *(edges or [0.0]), math.inf]
    return Bucketizer(splits=splits, inputCol=value, outputCol=_BUCKET).transform(df)


def with_value_bucket(df: DataFrame, value: str, most: int | None = None) -> DataFrame:
    """Add ``__bucket``: ranges of a double column with at most ``most`` rows each, see ``value_edges``."""
    return _between(df, value, value_edges(df, value, most))


# ---------------------------------------------------------------- hash order

def with_draw(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """Add ``__draw`` (md5 text) and its order bucket.

    ``key`` must tell the rows apart; give tables without a key one by ``with_occurrence`` first. The number of
    buckets follows the number of rows.
    """
    drawn = df.withColumn("__draw", draw_text([c(k) for k in key], seed))
    count = bucket_total(df.count())
    return drawn.withColumn(_BUCKET, F.floor(uniform_of(c("__draw")) * F.lit(float(count))).cast("int"))


def draw_rank(df: DataFrame, key: Sequence[str], seed: int, group: Sequence[str] = (),
              out: str = "draw_rank") -> DataFrame:
    """Add the 1-based position of every row in hash order, per group if one is named.

    A group of any size is spread over all buckets, so a hot class never meets in one task.
    """
    tagged = with_draw(df, key, seed).withColumn("__one", F.lit(1).cast("bigint"))
    order = [c("__draw"), *[c(k) for k in key]]
    ranked = prefix_sums(tagged, _BUCKET, order, ["__one"], group)
    return ranked.withColumn(out, c("__one_cum")).select(*[c(n) for n in df.columns], c(out))


def draw_cuts(df: DataFrame, key: Sequence[str], seed: int, group: str,
              ranks: Mapping[str, Column], most: int | None = None) -> DataFrame:
    """Hash value of the row at each wanted rank, per group, without ranking the whole table.

    ``ranks`` maps a name to an expression over ``group_size`` (and ``group`` itself). A histogram over the first
    digits of the hash finds the one prefix that holds each rank. While such a prefix has more than ``most`` rows, a
    histogram over its next digits follows, of the rows under wanted prefixes only; at last those rows are ordered.
    So no task orders more rows, however large the class. Returns ``(group, part, cut)`` where ``cut`` is a struct
    ``(draw, key...)``; ranks below 1 give no row. Rows without a group belong to none.
    """
    most = EDGE_ROWS if most is None else most
    drawn = df.select(c(group), *[c(k) for k in key if k != group]).filter(c(group).isNotNull()).withColumn("__draw", draw_text([c(k) for k in key], seed))
    digits = PREFIX_DIGITS
    hist = drawn.groupBy(c(group), F.substring("__draw", 1, digits).alias("__prefix")).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(c(group))
    upto = whole.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = hist.select(c(group), "__prefix", "__n", F.sum("__n").over(upto).alias("__upto"), F.sum("__n").over(whole).alias("group_size"))
    parts = F.array(*[F.struct(F.lit(name).alias("part"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()])
    wanted = _holding(summed.select("*", F.inline(parts)), group, "rank")
    wanted, fits = small_side(wanted)
    while True:
        fullest = wanted.agg(F.max("__n")).first()[0]
        if fullest is None or fullest <= most or digits >= _DRAW_DIGITS:
            break
        if not fits:
            wanted = cut_lineage(wanted)
        wanted, fits = small_side(_descend(drawn, wanted, group, digits))
        digits = min(_DRAW_DIGITS, digits + PREFIX_DIGITS)
    # A row per group and rank. With its size proven it is broadcast, and only edge rows are shuffled.
    edge = drawn.withColumn("__prefix", F.substring("__draw", 1, digits)).join(wanted, [group, "__prefix"])
    place = Window.partitionBy(c(group), c("part"), c("__prefix")).orderBy(c("__draw"), *[c(k) for k in key])
    return (edge.withColumn("__place", F.row_number().over(place))
            .filter(c("__place") == c("__inside"))
            .select(c(group), c("part"), draw_struct(key).alias("cut")))


def _holding(summed: DataFrame, group: str, rank: str) -> DataFrame:
    """(group, part, prefix, n, inside): the prefix that holds each wanted rank, and the rank's place in it."""
    return (summed.filter((c(rank) > c("__upto") - c("__n")) & (c(rank) <= c("__upto")))
            .select(c(group), c("part"), c("__prefix"), c("__n"), (c(rank) - c("__upto") + c("__n")).alias("__inside")))


def _descend(drawn: DataFrame, wanted: DataFrame, group: str, digits: int) -> DataFrame:
    """Wanted prefixes with PREFIX_DIGITS more digits, by a histogram of the rows under them."""
    prefixes = small_side(wanted.select(c(group), "__prefix").distinct())[0]
    under = drawn.withColumn("__prefix", F.substring("__draw", 1, digits)).join(prefixes, [group, "__prefix"])
    hist = under.groupBy(c(group), "__prefix", F.substring("__draw", 1, digits + PREFIX_DIGITS).alias("__longer")).agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(c(group), "__prefix").orderBy("__longer").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = hist.withColumn("__upto", F.sum("__n").over(upto))
    inner = summed.join(wanted.drop("__n"), [group, "__prefix"]).drop("__prefix").withColumnRenamed("__longer", "__prefix")
    return _holding(inner, group, "__inside")


def draw_struct(key: Sequence[str], draw: Column | None = None) -> Column:
    return F.struct((c("__draw") if draw is None else draw).alias("draw"),
                    *[c(k).alias(f"key{i}") for i, k in enumerate(key)])


# ---------------------------------------------------------------- exact quantiles

def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float],
                    max_kept: int = 100_000, accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of many columns, with bounded memory in every task.

    The built-in exact percentile keeps every distinct value of a column in one buffer. Here each wanted
    quantile has a bracket of values. An approximate quantile (with its error bound) narrows the bracket,
    a count proves that the wanted ranks lie inside, and this repeats until at most ``max_kept`` values
    are left, which are then ordered. Nulls, NaN and infinities do not count.
    """
    names = list(columns)
    flat = df.select(*[finite_or_null(columns[n].cast("double")).alias(f"v{i}")
                       for i, n in enumerate(names)])
    first = flat.agg(*[f(F.col(f"v{i}")).alias(f"{tag}{i}") for i in range(len(names))
                       for tag, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    targets = []
    for i in range(len(names)):
        n = first[f"n{i}"]
        for j, p in enumerate(probs):
            if n:
                place = p * (n - 1)
                targets.append({"col": i, "prob": j, "k0": math.floor(place), "k1": math.ceil(place),
                                "part": place - math.floor(place), "lo": first[f"lo{i}"],
                                "hi": first[f"hi{i}"], "below": 0, "inside": n})
    keep = max(1000, min(max_kept, 4_000_000 // max(1, len(targets))))
    open_targets = [t for t in targets if t["inside"] > keep and t["lo"] < t["hi"]]
    while open_targets:
        moved = _narrow(flat, open_targets, accuracy)
        open_targets = [t for t in moved if t["inside"] > keep and t["lo"] < t["hi"]]
    out: dict[str, list[float | None]] = {n: [None] * len(probs) for n in names}
    rest = [t for t in targets if t["lo"] < t["hi"]]
    picked = _pick(flat, rest)
    for t in targets:
        v0, v1 = picked.get(id(t), (t["lo"], t["lo"]))
        out[names[t["col"]]][t["prob"]] = v0 + (v1 - v0) * t["part"]
    return out


def _within(t: Mapping) -> Column:
    value = F.col(f"v{t['col']}")
    return (value >= F.lit(t["lo"])) & (value <= F.lit(t["hi"]))


def _narrow(flat: DataFrame, targets: list[dict], accuracy: int) -> list[dict]:
    """One narrowing round for all open targets: two passes over the table. Returns the targets that moved.

    Targets that share a bracket share one sketch. Counts of the old bracket ends are known already, so a
    round counts only rows below the new low end and up to the new high end.
    """
    slack = 3.0 / accuracy
    brackets: dict[tuple, list[dict]] = {}
    for t in targets:
        brackets.setdefault((t["col"], t["lo"], t["hi"]), []).append(t)
    sketches = []
    for i, group in enumerate(brackets.values()):
        probs = [p for t in group for p in (
            max(0.0, (t["k0"] - t["below"]) / t["inside"] - slack),
            min(1.0, (t["k1"] + 1 - t["below"]) / t["inside"] + slack))]
        kept = F.when(_within(group[0]), F.col(f"v{group[0]['col']}"))
        sketches.append(F.percentile_approx(kept, F.array(*[F.lit(p) for p in probs]), accuracy).alias(f"q{i}"))
    guess = flat.agg(*sketches).first()
    ends = [(t, *guess[f"q{i}"][2 * k:2 * k + 2])
            for i, group in enumerate(brackets.values()) for k, t in enumerate(group)]
    seen = flat.agg(*[e for i, (t, low, high) in enumerate(ends) for e in (
        F.count_if(F.col(f"v{t['col']}") < F.lit(low)).alias(f"b{i}"),
        F.count_if(F.col(f"v{t['col']}") <= F.lit(high)).alias(f"u{i}"))]).first()
    moved = []
    for i, (t, low, high) in enumerate(ends):
        before, upto = (t["lo"], t["hi"]), t["below"] + t["inside"]
        if seen[f"b{i}"] <= t["k0"]:
            t.update(lo=low, below=seen[f"b{i}"])
        if seen[f"u{i}"] > t["k1"]:
            t["hi"], upto = high, seen[f"u{i}"]
        t["inside"] = upto - t["below"]
        if (t["lo"], t["hi"]) != before:
            moved.append(t)
    return moved


def _pick(flat: DataFrame, targets: list[dict]) -> dict[int, tuple[float, float]]:
    """Values at the two wanted ranks of each target, from run lengths of the values in its bracket.

    Rows outside every bracket are dropped by a binary search per column; what is left collapses to run
    lengths before it is matched with the single brackets.
    """
    brackets: dict[tuple, set[int]] = {}
    for t in targets:
        wanted = brackets.setdefault((t["col"], t["lo"], t["hi"], t["below"]), set())
        wanted.update((t["k0"] - t["below"], t["k1"] - t["below"]))
    if not brackets:
        return {}
    keys = list(brackets)
    runs = _runs_inside(flat, [k[:3] for k in keys])
    entries = F.array(*[F.when((c("col") == k[0]) & c("v").between(F.lit(k[1]), F.lit(k[2])), F.lit(i))
                        for i, k in enumerate(keys)])
    tagged = runs.select("v", "n", F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("t"))
    order = Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = tagged.withColumn("upto", F.sum("n").over(order))
    ranks = F.array(*[F.array(*[F.lit(r).cast("bigint") for r in sorted(brackets[k])]) for k in keys])
    here = F.filter(F.element_at(ranks, F.col("t") + 1),
                    lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    rows = placed.select("t", "v", F.explode(here).alias("rank")).collect()
    values = {(keys[r["t"]], r["rank"]): r["v"] for r in rows}

    def both(t: dict) -> tuple[float, float]:
        k = (t["col"], t["lo"], t["hi"], t["below"])
        return values[k, t["k0"] - t["below"]], values[k, t["k1"] - t["below"]]

    return {id(t): both(t) for t in targets}


def _runs_inside(flat: DataFrame, brackets: Sequence[tuple[int, float, float]]) -> DataFrame:
    """(col, v, n): how often each value that lies in a bracket of its column occurs."""
    marked, hits = flat, []
    for col in sorted({b[0] for b in brackets}):
        merged: list[list[float]] = []
        for low, high in sorted(b[1:] for b in brackets if b[0] == col):
            end = math.nextafter(high, math.inf)
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([low, end])
        splits = [-math.inf, *(x for pair in merged for x in pair), math.inf]
        marked = Bucketizer(splits=splits, inputCol=f"v{col}", outputCol=f"b{col}",
                            handleInvalid="keep").transform(marked)
        # Odd buckets are brackets; the bucket after the last holds nulls.
        inside = (F.col(f"b{col}") % 2 == 1) & (F.col(f"b{col}") < 2 * len(merged))
        hits.append(F.when(inside, F.struct(F.lit(col).alias("col"), F.col(f"v{col}").alias("v"))))
    found = marked.select(hits[0].alias("h")).filter(F.col("h").isNotNull()).select("h.*") if len(hits) == 1 \
        else marked.select(F.inline(F.filter(F.array(*hits), lambda h: h.isNotNull())))
    return found.groupBy("col", "v").agg(F.count(F.lit(1)).alias("n"))
