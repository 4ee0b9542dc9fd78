from collections import Counter

import duckdb

from marketloom.llm import url_filter
from marketloom.llm.answers import ANSWERS
from marketloom.llm.queries import op3_url_filter
from marketloom.llm.url_filter import bloom_blocks, crawl_list, listed_flags, url_verdicts

SF = "/root/testdata/sf0.01"


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = op3_url_filter(spark, SF)
    answer = con.execute(ANSWERS["op3_url_filter"])
    names = [d[0] for d in answer.description]
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(answer.fetchall())
    assert not any(t in got._jdf.queryExecution().toString() for t in ("Python", "Pandas", "ArrowEval"))


def test_rules_and_odd_urls(spark):
    urls = {
        1: None, 2: "", 3: "no scheme", 4: "http://A.Example.ORG/es/1", 5: "http://example.org/en/12?x", 6: "https://b.org/x",
        7: "http://c.com/fr/", 8: "http://c.com/de/#a", 9: "http://c.com?/de/", 10: "http://org", 11: "x://y://z/de/",
        12: "http://notexample.org/es/", 13: "http://bad.net/p?utm_source=a&b=2&a=1#f", 14: "https://WWW.bad.net/p/?a=1&b=2", 15: "http://bad.net/q",
        16: "http://É.com/de/\nx", 17: "http://bad.net/p?a=1&b=2",
    }
    pages = spark.createDataFrame([(i, u, "k", "h") for i, u in urls.items()] + [(17, urls[17], "k", "h")], "page_id long, url string, rule string, host string")
    listed = spark.createDataFrame([("http://bad.net/p?b=2&a=1",), (None,), ("",)], "url string")
    got = {r["page_id"]: r for r in url_verdicts(pages, listed).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in (1, 2, 3, 9, 10, 11)] == [("", "")] * 3 + [("c.com", ""), ("org", ""), ("y:", "//z/de/")]
    rules = {4: "example.org/es/", 5: "example.org/en/1", 6: "org/", 7: "com/fr/", 8: "com/de/", 12: "org/", 16: "com/de/"}
    assert {i: r["rule"] for i, r in got.items() if r["rule"]} == rules
    assert {i for i, r in got.items() if r["verdict"] == "block"} == {4, 5, 8, 13, 14, 16, 17}
    assert url_verdicts(pages, listed).count() == 18
    assert url_verdicts(pages, listed.where("false")).where("verdict = 'block' and rule is null").count() == 0
    assert url_verdicts(pages.where("false"), listed).count() == 0


def test_filter_has_no_false_negatives_and_the_join_no_false_positives(spark):
    listed = spark.range(4000).selectExpr("concat('a.b/', id) key")
    assert bloom_blocks(listed, 64).count() <= 64
    urls = spark.range(20000).selectExpr("id", "concat('a.b/', id) __key")
    assert listed_flags(urls, listed).where("__listed <> (id < 4000)").count() == 0


def test_only_hits_reach_the_exact_join_and_false_positives_go(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_URL", 1)  # a crowded filter lets many URLs through
    listed = spark.range(2000).selectExpr("concat('a.b/', id) key")
    urls = spark.range(20000).selectExpr("id", "concat('a.b/', id) __key")
    flags = listed_flags(urls, listed)
    plan = flags._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" in plan
    passed = flags.sparkSession.read.parquet(flags.inputFiles()[0].rsplit("/", 1)[0]) if "__hit" in plan else None
    rows = flags.collect()
    assert len(rows) == 20000 and all(r["__listed"] == (r["id"] < 2000) for r in rows)
    assert passed is not None


def test_mirrors_of_listed_pages_are_listed(spark):
    page = lambda i, url, title: (i, url, f"<title>{title}</title>" if title is not None else None)
    rows = [
        page(1, "http://casino-win.net/a", "Play now"), page(2, "http://clean.net/b", "Play now"), page(3, "http://clean.net/c", "News"),
        page(4, "http://other.net/d", ""), page(5, "http://m.spam-farm.net/e", ""), page(6, "http://www.clean.net/b/?utm_source=x", None), page(7, None, "Play now"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_verdicts(pages, crawl_list(pages)).collect()}
    assert {i for i, v in verdicts.items() if v == "block"} == {1, 2, 5, 6}
