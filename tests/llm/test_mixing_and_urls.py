from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from storepulse.llm import mixing, url_filter
from storepulse.llm.oracles import ORACLES
from storepulse.llm.queries import QUERIES
from tests.compare import differences
from tests.llm.conftest import AWKWARD, documents

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        database.sql(f"create view {path.stem} as from '{path}'")
    assert differences(QUERIES[name](spark, SMALL).toPandas(), database.sql(ORACLES[name]).df()) == []


def poured(sizes, weights, share, most):
    """Water-filling as it is told: clamp, reshare the excess by weight, again."""
    target = {s: 0.0 for s in sizes}
    left, open_ = share * sum(sizes.values()), set(sizes)
    while open_ and left > 1e-9:
        total = sum(weights[s] for s in open_)
        add = {s: left * weights[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += add[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_targets_by_pouring(spark):
    sizes = {"a": 10, "b": 900, "c": 40, "d": 1000, "e": 5, None: 300}
    order = ["a", "b", "c", "d", "e", None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(totals).collect()}
    expected = poured(sizes, weights, 1.5, 2)
    assert found.keys() == expected.keys()
    for source, target in expected.items():
        assert found[source] == pytest.approx(target)
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_taken_is_near_the_target(spark):
    found = QUERIES["op4_mixing"](spark, SMALL).toPandas()
    again = QUERIES["op4_mixing"](spark, SMALL).toPandas()
    order = ["doc_id"]
    assert found.sort_values(order).taken.tolist() == again.sort_values(order).taken.tolist()
    assert (found.taken <= 2 * found["size"]).all()


def test_awkward_mix(spark, awkward, nothing):
    mixed = mixing.mix(awkward)
    rows = mixed.collect()
    assert len(rows) == len(AWKWARD)
    assert sum(r.taken for r in rows) <= 2 * sum(r["size"] for r in rows)
    again = mixing.repeated(awkward, mixed)
    assert again.columns == awkward.columns
    assert again.count() == sum(r.copies for r in rows)
    assert mixing.mix(nothing).count() == 0
    assert mixing.repeated(nothing, mixing.mix(nothing)).columns == nothing.columns
    nulls = documents(spark, [(1, "a b"), (2, "c")], source=None)
    assert mixing.mix(nulls).filter("target is null").count() == 0


URLS = {
    None: ("", "", None), "no scheme": ("", "", None), "http://": ("", "", None),
    "HTTP://WWW.Example.ORG/es/1?x=/y#z": ("www.example.org", "/es/1", "example.org/es/"),
    "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"),
    "http://example.org": ("example.org", "", None),
    "http://a.org/en/12": ("a.org", "/en/12", "org/"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/"),
    "x://b.com/de/#a://c.org/": ("b.com", "/de/", "com/de/"),
    "x://b.com?u=http://c.org/": ("b.com", "", None), "x://É.com/fr/": ("É.com", "/fr/", "com/fr/"),
}


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, rate string")
    found = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(found) == len(URLS)
    for i, (host, path, rule) in enumerate(URLS.values()):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        if rule:
            assert found[i].verdict == {r.name: r.verdict for r in url_filter.RULES}[rule]
    assert url_filter.judge(pages.limit(0)).count() == 0


LEVELS = {
    "www.bbc.co.uk": ("bbc.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "xco.uk": ("xco.uk", "uk"),
    "a.xco.uk": ("xco.uk", "uk"), "me.github.io": ("me.github.io", "github.io"),
    "x.me.github.io:8080": ("me.github.io", "github.io"), "blog.example.com": ("example.com", "com"),
    "example.com:80": ("example.com", "com"), "u:p@a.example.com:": ("example.com", "com"),
    "10.0.0.1": ("10.0.0.1", "(address)"), "10.0.0.1:99": ("10.0.0.1", "(address)"),
    "[::1]:8080": ("[::1]", "(address)"), "10.0.0.1.com": ("1.com", "com"), "": ("", ""),
    "localhost": ("localhost", "localhost"), "a.com.": ("com.", ""), "a.b\n": ("a.b\n", "b\n"),
    "a." * 5000 + "org": ("a.org", "org"),
}


def test_levels_of_hosts(spark):
    """Also by the SQL that the query is held to."""
    import duckdb
    from pyspark.sql import functions as F

    from storepulse.llm.oracles import OP8

    hosts = spark.createDataFrame([(h,) for h in LEVELS], "host string")
    found = {r.host: (r.domain, r.suffix) for r in hosts.select(
        "host", url_filter.domain_of(F.col("host")).alias("domain"),
        url_filter.suffix_of(F.col("host")).alias("suffix")).collect()}
    assert found == LEVELS
    database = duckdb.connect()
    database.execute("create table pages(page_id bigint, url varchar)")
    database.executemany("insert into pages values (?, ?)",
                         [(i, f"x://{h}/") for i, h in enumerate(LEVELS)])
    sql = OP8[:OP8.index("), s1 as (")] + ") select host, domain, suffix from hosts"
    assert {h: (d, s) for h, d, s in database.sql(sql).fetchall()} == LEVELS


def test_registrants_below_a_shared_suffix_are_apart(spark):
    rows = [("spam.github.io", 200, 0), ("www.spam.github.io", 0, 0), ("docs.github.io", 200, 199),
            ("www.docs.github.io", 0, 0), ("10.0.0.1:80", 50, 0), ("10.0.0.1:81", 0, 0)]
    outcomes = spark.createDataFrame(rows, "host string, pages long, good long")
    found = {r.host: r.rate for r in url_filter.host_reputation(outcomes).collect()}
    assert found["www.spam.github.io"] < 0.3 < 0.7 < found["www.docs.github.io"]
    assert found["10.0.0.1:81"] < 0.5


def test_reputation_shrinks(spark):
    rows = [("bad.site.net", 200, 0), ("worse.site.net", 150, 1), ("new.site.net", 0, 0),
            ("good.other.net", 300, 299), ("one.fresh.net", 1, 0), ("", 0, 0)]
    outcomes = spark.createDataFrame(rows, "host string, pages long, good long")
    found = {r.host: r for r in url_filter.host_reputation(outcomes).collect()}
    assert found["bad.site.net"].upper < 0.5 < found["good.other.net"].rate
    assert found["bad.site.net"].rate < found["new.site.net"].rate < found["one.fresh.net"].rate + 0.5
    assert found["one.fresh.net"].upper > found["worse.site.net"].upper
    assert found[""].upper > 0.5
