import os

import duckdb

from twinsieve.llm import url_templates as urls


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", 1, "r") for i, u in enumerate(rows)], "page_id long, url string, host string, n int, rule string")


def test_hosts_paths_and_longest_rule(spark):
    rows = {"http://WWW.Example.COM/en/1?x=/y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
            "https://a.example.com/en/x#f": ("a.example.com", "/en/x", "example.com/en/", "block"),
            "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
            "ftp://b.net/fr/2": ("b.net", "/fr/2", "net/fr/", "block"),
            "http://c.com": ("c.com", "", None, None), "http://c.com?q=://d.net/fr/": ("c.com", "", None, None),
            "no scheme": ("", "", None, None), "": ("", "", None, None), None: ("", "", None, None), "a\nb://Ä.net/es/": ("Ä.net", "/es/", "net/es/", "block")}
    found = urls.judge(_pages(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        host, path, rule, verdict = rows[list(rows)[row.page_id]]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict in ("allow", "block") and verdict in (None, row.verdict)


def test_templates_generalise_and_follow_their_host(spark):
    rows = [f"http://bad.net/fr/{k}" for k in range(40)] + [f"http://good.com/fr/{k}" for k in range(40)]
    rows += [f"http://shop.org/item{chr(97 + k % 26)}{chr(97 + k // 26)}/view" for k in range(60)] + ["http://new.org/fr/7"] * 3
    found = {r.page_id: r for r in urls.judge(_pages(spark, rows)).collect()}
    assert {found[k].template for k in range(40)} == {"/fr/{n}"}
    assert {found[k].template for k in range(80, 140)} == {"/*/view"}
    assert found[0].purity > 0.9 and found[40].purity < 0.1
    assert len({found[k].verdict for k in (140, 141, 142)}) == 1


def test_same_as_sql_and_empty(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = sorted(map(str, urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "template", "purity").collect()))
    with duckdb.connect() as base:
        base.execute(f"CREATE VIEW pages AS SELECT * FROM '{os.path.join(sf_dir, 'pages.parquet')}'")
        sql = base.execute(f"SELECT page_id, host, path, rule, verdict, template, purity FROM ({urls.PAGES_SQL})").fetchall()
    names = ("page_id", "host", "path", "rule", "verdict", "template", "purity")
    assert found == sorted("Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, row)) + ")" for row in sql)
    assert urls.judge(pages.limit(0)).count() == 0
