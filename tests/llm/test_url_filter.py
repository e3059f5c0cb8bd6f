import re

from pyspark.sql import functions as F

from starflow.llm import queries, url_filter

URLS = [
    ("http://A.Example.ORG/en/1?x", "a.example.org", "/en/1", "example.org/en/1", "block"),
    ("https://example.org/es/2#t", "example.org", "/es/2", "example.org/es/", "block"),
    ("https://notexample.org/es/2", "notexample.org", "/es/2", "org/", "allow"),
    ("https://x.org", "x.org", "", None, None),
    ("//x.com/fr/1", "", "", None, None),
    ("ftp://b.com/fr/1://c.org/", "b.com", "/fr/1://c.org/", "com/fr/", "allow"),
    ("http://com/de/", "com", "/de/", "com/de/", "block"),
    ("http://a.net?q=http://b.org/", "a.net", "", None, None),
    ("http://É.net\n/p\nq#", "É.net\n", "/p\nq", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
]


def test_host_path_and_rule(frame):
    rows = frame([(k, u[0]) for k, u in enumerate(URLS)], "k int, url string")
    rule, verdict = url_filter.rule_of(queries.RULES, url_filter.host(F.col("url")), url_filter.path(F.col("url")))
    got = rows.select("k", url_filter.host(F.col("url")), url_filter.path(F.col("url")), rule, verdict).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {k: u[1:] for k, u in enumerate(URLS)}


def test_the_model_learns_hosts_and_paths(frame):
    bad, good = ("casino-win", "free-bets", "cheap-pills"), ("therhe", "ththan", "tionsh")
    urls = [(f"http://{'www.' if k % 2 else ''}{h}.example.net/en/{k}", int(h in bad)) for h in bad + good for k in range(40)]
    urls += [(None, None), ("http://x.y/", None)]
    weights = url_filter.train(frame(urls, "url string, blocked int"))
    new = [(f"https://m.{h}.example.com/fr/{k}?a=b", "block" if h in bad else "allow") for h in bad + good for k in range(900, 905)]
    made = url_filter.judged(frame(new, "url string, want string"), (), weights)
    assert all(r.verdict == r.want for r in made.collect())


def test_one_class_no_rows_nulls_and_clashing_names(frame):
    schema = "url string, blocked int"
    none, one = url_filter.train(frame([], schema)), url_filter.train(frame([("http://a.b/", 1)], schema))
    pages = frame([(None, "x"), ("http://c.d/" + "e" * 100_000, "x")], "url string, host string")
    assert {r.verdict for r in url_filter.judged(pages, (), none).collect()} == {"allow"}
    made = url_filter.judged(pages, (), one)
    assert {r.verdict for r in made.collect()} == {"block"}
    assert made.columns == ["url", "host", "_host", "path", "rule", "score", "verdict"]
    assert url_filter.judged(frame([], "url string"), (), none).collect() == []


def test_query_over_the_test_data(spark, small):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.op6_url_filter(spark, small).collect()
    assert len(rows) == len(urls)
    for r in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        assert (r.host, r.path) == ((m[1].lower(), m[2]) if m else ("", ""))
        fits = [(len(x), x, v) for v, x in queries.RULES if f".{r.host}".endswith("." + x.split("/")[0]) and r.path.startswith("/" + x.split("/", 1)[1])]
        assert (r.rule, r.verdict) == max(fits)[1:] if fits else r.rule is None and r.verdict in ("allow", "block")
