"""URL filter: explicit rules first, else the labelled purity of the path templates of each host.

The paths of a host form a tree of segments. Digits become ``{n}``; a segment value that is rare among many
siblings becomes ``*``. The first segments of a host whose shares of blocked pages do not differ significantly
are merged into one branch. A template's purity is its share of blocked pages among the pages that a rule
decides, smoothed towards its branch, that towards the same first segment on all hosts, and that towards the
share of all. A template of purity ``REJECT`` or more is rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import c
from ..session import cut_lineage

# The rules (fixed values): verdict and host with path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))

LEVELS = 3                  # segments that get a level of their own; the rest is one tail
FEW_CHILDREN = 8            # up to so many different values, a level is no variable
RARE_ONE_IN = 20            # a value rarer than this among its siblings is variable
SAME_Z = 1.96               # branches below this difference are merged
PRIOR = 4.0                 # weight of the more general level, in labelled pages
REJECT = 0.5


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null where none does."""
    fitting = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        where, slash, start = rule.partition("/")
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(slash + start)
        fitting = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(fitting)
    return fitting


def _segments(path: Column) -> list[Column]:
    """The first segments with digits as {n} (null where the path is shorter), then the tail."""
    typed = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "{n}"), "/")
    size = F.size(typed)
    levels = [F.when(size > k, F.get(typed, F.lit(k))) for k in range(LEVELS)]
    return [*levels, F.when(size > LEVELS, F.array_join(F.slice(typed, LEVELS + 1, 1 << 30), "/"))]


def _generalised(paths: DataFrame) -> DataFrame:
    """Rare values among many siblings become ``*``, level by level from the host."""
    above = ["host"]
    for level in range(LEVELS + 1):
        name = f"s{level}"
        values = paths.groupBy(*above, name).agg(F.sum("n").alias("__n"))
        siblings = values.groupBy(*[c(x).alias(f"__{x}") for x in above]).agg(
            F.count(name).alias("__kinds"), F.sum("__n").alias("__all"))
        rare = (values.join(siblings, _all(c(x).eqNullSafe(c(f"__{x}")) for x in above))
                .filter(c(name).isNotNull() & (F.col("__kinds") > FEW_CHILDREN) & (F.col("__n") * RARE_ONE_IN < F.col("__all")))
                .select(*[c(x).alias(f"__{x}") for x in [*above, name]]))
        joined = paths.join(rare, _all(c(x).eqNullSafe(c(f"__{x}")) for x in [*above, name]), "left")
        merged = joined.withColumn(name, F.when(F.col("__host").isNotNull(), F.lit("*")).otherwise(c(name))).drop(*rare.columns)
        paths = cut_lineage(merged)
        above.append(name)
    return paths


def _smoothed(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + F.lit(PRIOR) * prior) / (labelled + F.lit(PRIOR))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) of every row.

    A null url or one without ``://`` has an empty host and path and is judged like any other template. Repeated
    rows are repeated; without any labelled page the purity is one half of nothing known, so all is blocked only
    if more pages are blocked than allowed. Other columns are not read. Rows are folded to (host, path shape)
    before anything is shuffled, so a hot host is a few rows; only the last join meets the pages again.
    """
    chosen = pages.select(c(id_col).alias("id"), host_of(c(url_col)).alias("host"), path_of(c(url_col)).alias("path"))
    chosen = chosen.select("id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("by"),
                           *[s.alias(f"r{k}") for k, s in enumerate(_segments(F.col("path")))])
    raw = [f"r{k}" for k in range(LEVELS + 1)]
    shapes = chosen.groupBy("host", *raw).agg(F.count("*").alias("n"), F.count("by").alias("labelled"),
                                              F.sum((F.col("by.verdict") == "block").cast("long")).alias("blocked"))
    shapes = shapes.fillna(0, ["blocked"]).select("*", *[F.col(r).alias(f"s{k}") for k, r in enumerate(raw)])
    shapes = _generalised(cut_lineage(shapes))

    sums = [F.sum(x).alias(x) for x in ("n", "labelled", "blocked")]
    branches = shapes.groupBy("host", "s0").agg(*sums)
    blocked, labelled = branches.agg(F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("labelled"), F.lit(0))).first()
    first = branches.groupBy("s0").agg(*sums).select(
        "s0", _smoothed(F.col("blocked"), F.col("labelled"), F.lit((blocked + 1) / (labelled + 2))).alias("everywhere"))
    first = first.withColumnRenamed("s0", "__s0")
    ranked = branches.join(first, F.col("s0").eqNullSafe(F.col("__s0"))).select(
        "host", "s0", "n", "labelled", "blocked", "everywhere",
        _smoothed(F.col("blocked"), F.col("labelled"), F.col("everywhere")).alias("own"))
    # A host has few first segments after generalising, so its window is short.
    order = Window.partitionBy("host").orderBy("own", F.coalesce("s0", F.lit("")))
    weight = F.col("labelled") + F.lit(PRIOR)
    before = F.lag(weight).over(order)
    pooled = (F.col("own") * weight + F.lag("own").over(order) * before) / (weight + before)
    gap = (F.col("own") - F.lag("own").over(order)) / F.sqrt(
        F.greatest(pooled * (F.lit(1.0) - pooled), F.lit(1e-9)) * (F.lit(1.0) / weight + F.lit(1.0) / before))
    ranked = ranked.withColumn("__new", F.coalesce((gap > SAME_Z).cast("int"), F.lit(1)))
    ranked = ranked.withColumn("branch", F.sum("__new").over(order)).drop("__new")
    whole = ranked.groupBy("host", "branch").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
        (F.sum(F.col("everywhere") * F.col("n")) / F.sum("n")).alias("prior"))
    whole = whole.select("host", "branch", _smoothed(F.col("blocked"), F.col("labelled"), F.col("prior")).alias("branch_purity"))
    branch = ranked.select("host", "s0", "branch").join(whole, ["host", "branch"]).select(
        F.col("host").alias("__host"), F.col("s0").alias("__s0"), "branch_purity")

    levels = ["host", *[f"s{k}" for k in range(LEVELS + 1)]]
    templates = shapes.groupBy(*levels).agg(*sums).join(
        branch, (F.col("host") == F.col("__host")) & F.col("s0").eqNullSafe(F.col("__s0"))).select(
        *[F.col(x).alias(f"__{x}") for x in levels],
        _smoothed(F.col("blocked"), F.col("labelled"), F.col("branch_purity")).alias("purity"))
    shaped = shapes.join(templates, _all(F.col(x).eqNullSafe(F.col(f"__{x}")) for x in levels))
    template = F.concat(F.lit("/"), F.concat_ws("/", *[f"s{k}" for k in range(LEVELS + 1)]))
    known = cut_lineage(shaped.select(F.col("host").alias("__host"), *[F.col(r).alias(f"__{r}") for r in raw],
                                      template.alias("template"), "purity"))

    joined = chosen.join(known, (F.col("host") == F.col("__host")) & _all(F.col(r).eqNullSafe(F.col(f"__{r}")) for r in raw), "left")
    by_method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return joined.select(F.col("id").alias(id_col), "host", "path", F.col("by.rule").alias("rule"),
                         F.coalesce("by.verdict", by_method).alias("verdict"), "template",
                         F.round("purity", 6).alias("purity"))


def _all(tests):
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def _sql_generalised(level: int) -> str:
    above = ["host", *[f"s{k}" for k in range(level)]]
    name, source = f"s{level}", f"g{level}" if level else "shapes"
    rest = ", ".join(f"p.s{k}" for k in range(LEVELS + 1) if k != level)
    same = lambda a, b, names: " AND ".join(f"{a}.{x} IS NOT DISTINCT FROM {b}.{x}" for x in names)
    return f"""
v{level} AS (SELECT {", ".join(above)}, {name}, sum(n) AS n FROM {source} GROUP BY ALL),
k{level} AS (SELECT {", ".join(above)}, count({name}) AS kinds, sum(n) AS total FROM v{level} GROUP BY ALL),
w{level} AS (SELECT {", ".join("v." + x for x in [*above, name])} FROM v{level} v JOIN k{level} k ON {same("v", "k", above)}
  WHERE v.{name} IS NOT NULL AND kinds > {FEW_CHILDREN} AND v.n * {RARE_ONE_IN} < total),
g{level + 1} AS (SELECT p.host, p.n, p.labelled, p.blocked, {", ".join(f"p.r{k}" for k in range(LEVELS + 1))}, {rest},
  CASE WHEN w.host IS NOT NULL THEN '*' ELSE p.{name} END AS {name}
  FROM {source} p LEFT JOIN w{level} w ON {same("p", "w", [*above, name])}),"""


_RAW = [f"r{k}" for k in range(LEVELS + 1)]
_GENERAL = [f"s{k}" for k in range(LEVELS + 1)]
_SQL_RULES = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR host LIKE '%.{r.partition('/')[0]}') AND starts_with(path, '/{r.partition('/')[2]}') THEN '{v} {r}'"
    for v, r in sorted(RULES, key=lambda r: -len(r[1])))
PAGES_SQL = f"""
WITH split AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (
  SELECT *, CASE {_SQL_RULES} END AS fitting,
         string_split(regexp_replace(regexp_replace(path, '^/', ''), '[0-9]+', '{{n}}', 'g'), '/') AS typed FROM split),
chosen AS (
  SELECT page_id, host, path, split_part(fitting, ' ', 2) AS rule, split_part(fitting, ' ', 1) AS decided, fitting,
         {", ".join(f"typed[{k + 1}] AS r{k}" for k in range(LEVELS))},
         CASE WHEN len(typed) > {LEVELS} THEN array_to_string(typed[{LEVELS + 1}:], '/') END AS r{LEVELS} FROM ruled),
shapes AS (
  SELECT host, {", ".join(_RAW)}, {", ".join(f"r{k} AS s{k}" for k in range(LEVELS + 1))}, count(*) AS n, count(fitting) AS labelled,
         count(*) FILTER (decided = 'block') AS blocked FROM chosen GROUP BY ALL),
{"".join(_sql_generalised(k) for k in range(LEVELS + 1))}
paths AS (SELECT * FROM g{LEVELS + 1}),
branches AS (SELECT host, s0, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked FROM paths GROUP BY ALL),
overall AS (SELECT (sum(blocked) + 1)::DOUBLE / (sum(labelled) + 2) AS share FROM branches),
firsts AS (SELECT s0, (sum(blocked) + {PRIOR}e0 * any_value(share)) / (sum(labelled) + {PRIOR}e0) AS everywhere FROM branches, overall GROUP BY s0),
owned AS (
  SELECT b.*, everywhere, (blocked + {PRIOR}e0 * everywhere) / (labelled + {PRIOR}e0) AS own, labelled + {PRIOR}e0 AS weight
  FROM branches b JOIN firsts f ON b.s0 IS NOT DISTINCT FROM f.s0),
lagged AS (
  SELECT *, lag(own) OVER w AS own_before, lag(weight) OVER w AS weight_before FROM owned
  WINDOW w AS (PARTITION BY host ORDER BY own, coalesce(s0, ''))),
gaps AS (
  SELECT *, (own * weight + own_before * weight_before) / (weight + weight_before) AS pooled FROM lagged),
marked AS (
  SELECT *, coalesce(((own - own_before) / sqrt(greatest(pooled * (1e0 - pooled), 1e-9) * (1e0 / weight + 1e0 / weight_before)) > {SAME_Z}e0)::INTEGER, 1) AS fresh
  FROM gaps),
ranked AS (SELECT *, sum(fresh) OVER (PARTITION BY host ORDER BY own, coalesce(s0, '')) AS branch FROM marked),
whole AS (
  SELECT host, branch, (sum(blocked) + {PRIOR}e0 * (sum(everywhere * n) / sum(n))) / (sum(labelled) + {PRIOR}e0) AS branch_purity
  FROM ranked GROUP BY ALL),
counted AS (
  SELECT host, {", ".join(_GENERAL)}, sum(labelled) AS labelled, sum(blocked) AS blocked FROM paths GROUP BY ALL),
pure AS (
  SELECT c.host, {", ".join("c." + s for s in _GENERAL)}, (c.blocked + {PRIOR}e0 * branch_purity) / (c.labelled + {PRIOR}e0) AS purity
  FROM counted c JOIN ranked r ON c.host = r.host AND c.s0 IS NOT DISTINCT FROM r.s0 JOIN whole w ON w.host = r.host AND w.branch = r.branch),
known AS (
  SELECT p.host, {", ".join("p." + r for r in _RAW)}, '/' || concat_ws('/', {", ".join("p." + s for s in _GENERAL)}) AS template, purity
  FROM paths p JOIN pure q ON p.host = q.host AND {" AND ".join(f"p.{s} IS NOT DISTINCT FROM q.{s}" for s in _GENERAL)})
SELECT page_id, c.host, path, nullif(rule, '') AS rule, CASE WHEN fitting IS NOT NULL THEN decided WHEN purity >= {REJECT}e0 THEN 'block' ELSE 'allow' END AS verdict,
       template, round(purity, 6) AS purity
FROM chosen c JOIN known k ON c.host = k.host AND {" AND ".join(f"c.{r} IS NOT DISTINCT FROM k.{r}" for r in _RAW)}"""
