from pyspark.sql import functions as F

from ledgerlark.llm import url_filter as urls

SCHEMA = "page_id long, url string, host int, _features string, _raw int, _verdict string, _cell int, _url string, _page int"
CASES = {
    None: ("", "", None, None),
    "": ("", "", None, None),
    "example.com/en/1": ("", "", None, None),
    "http://A.Example.COM/en/1?x=/fr/": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://x.www.example.com/en/9": ("x.www.example.com", "/en/9", "www.example.com/en/", "allow"),
    "https://example.com/EN/": ("example.com", "/EN/", "com/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://com": ("com", "", None, None),
    "http://com?q": ("com", "", None, None),
    "ftp://b.net/es/#a": ("b.net", "/es/", "net/es/", "block"),
    "ftp://b.net/fr": ("b.net", "/fr", None, None),
    "http://a.com://b.net/es/": ("a.com:", "//b.net/es/", None, None),
    "http://É.Com/\n#": ("É.com", "/\n", "com/", "allow"),
}


def test_parts_and_rules(spark):
    rows = [(i, u, 7, "clash", 1, "block", 2, "x", 3) for i, u in enumerate(CASES)]
    out = urls.judge_urls(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()
    assert {(r._features, r._raw, r._verdict, r._cell, r._url, r._page) for r in out} == {("clash", 1, "block", 2, "x", 3)}
    for r, (url, (host, path, rule, verdict)) in zip(out, CASES.items()):
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block"), url


def test_trees_carry_the_labels_over(spark):
    made = [(i, f"http://{'cdn' if i % 2 else 'www'}{i}.site.{'com' if i % 4 < 2 else 'org'}/{'a/' * 6 + '?x=1&y=2&z=33333' if i % 2 else 'p'}{i}") for i in range(800)]
    df = spark.createDataFrame(made, "page_id long, url string")
    rules = (("allow", "com", "/p"), ("block", "com", "/a/"))
    out = urls.judge_urls(df, rules=rules).filter(F.col("rule").isNull()).collect()
    assert len(out) == 400
    assert sum((r.verdict == "block") == (r.page_id % 2 == 1) for r in out) >= 380


def test_without_labels(spark):
    none = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x")], "page_id long, url string")
    assert [r.verdict for r in urls.judge_urls(none).collect()] == ["allow", "allow"]
    one_kind = none.union(spark.createDataFrame([(2, "http://a.net/es/")], "page_id long, url string"))
    assert {r.verdict for r in urls.judge_urls(one_kind).collect()} == {"block"}
    assert urls.judge_urls(none.limit(0)).count() == 0


def test_few_blocked_and_repeated_urls_are_learned(spark):
    """One label is rare, and one URL stands thousands of times: both labels still reach the trees."""
    rows = spark.range(30_000).selectExpr("id as page_id", "'http://a.com/same' as url")
    rows = rows.union(spark.range(300).selectExpr("id", "concat('http://x', id, '.net/es/', id) as url"))
    rows = rows.union(spark.range(300).selectExpr("id", "concat('http://y', id, '.com/p', id) as url"))
    rows = rows.union(spark.createDataFrame([(1, "http://q77.net/it/7")], "page_id long, url string"))
    assert urls.judge_urls(rows).filter("rule is null").head().verdict == "block"
