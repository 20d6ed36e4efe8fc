import duckdb
import numpy as np
import pytest

from eventloom.llm import queries, url_filter
from tests.llm.conftest import SMALL

URLS = [
    "http://a.example.net/en/1?q#f", "https://EXAMPLE.Net/en/", "https://example.net/EN/x", "http://net/", "http://net", "x://org/fr/",
    "http://notexample.net.org/fr/a", "http://example.com/de/", "http://sub.example.com/de", "no scheme", "", None, "a://b://c/d", "http://x.net?a/b",
    "http://x.net#/en/", "://example.net/en/é", "http://example.net/en/\nline",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path
    fits = []
    for rule, _ in queries.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


@pytest.fixture(scope="module")
def rules(spark):
    return url_filter.build_rules(spark.createDataFrame(queries.RULES + queries.RULES, "rule string, verdict string"), shards=2)


def test_judged_like_brute_force(spark, rules):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string")
    verdicts = dict(queries.RULES)
    for r in url_filter.judge(pages, rules).collect():
        host, path, rule = brute(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdicts.get(rule, "allow")), r.url


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    want = sorted(con.execute(queries.SQL["op1_url_filter"]).fetchall())
    assert sorted(map(tuple, queries.op1_url_filter(spark, SMALL).collect())) == want


def test_a_digest_alone_decides_nothing(rules):
    array = url_filter.DigestArray(rules)
    assert array.probe(["net/", "nothing/", "org/fr/"]) == [True, None, False]
    url = "net/"
    shard = array.shard(int(np.searchsorted(array.lows, url_filter.digest(url), side="right")) - 1)
    assert not shard[0].flags.owndata
    other = url_filter.digest
    try:
        url_filter.digest = lambda text: other("net/")  # everything collides
        assert array.probe(["net/", "nothing/"]) == [True, None]
    finally:
        url_filter.digest = other


def test_no_rules_and_no_pages(spark, rules):
    none = url_filter.build_rules(spark.createDataFrame([], "rule string, verdict string"))
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert url_filter.judge(pages, none).first().verdict == "allow"
    assert url_filter.judge(pages.where("false"), rules).count() == 0


def test_long_hosts_make_no_long_candidates(spark, rules):
    """A host of many labels: only suffixes as long as some rule's host are made."""
    host = "a." * 20_000 + "example.net"
    pages = spark.createDataFrame([(1, f"http://{host}/en/x"), (2, f"http://{'.' * 5000}/"), (3, "http://x.net./")], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert found == {1: ("example.net/en/", "allow"), 2: (None, "allow"), 3: (None, "allow")}
    assert len(rules.lengths) == len({(r.index("/"), len(r) - r.index("/")) for r, _ in queries.RULES})


def test_number_of_shards_follows_the_rules(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "RULES_PER_SHARD", 50)
    many = spark.range(400).selectExpr("concat('h', id, '.org/', id % 7, '/') AS rule", "IF(id % 2 = 0, 'block', 'allow') AS verdict")
    files = url_filter.build_rules(many)
    assert len(files.shards) > 4
    pages = spark.range(400).selectExpr("id AS page_id", "concat('x://sub.h', id, '.org/', id % 7, '/p') AS url")
    assert {(r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, files).collect()} == {
        (i, f"h{i}.org/{i % 7}/", "allow" if i % 2 else "block") for i in range(400)
    }
