import pytest
from pyspark.sql import functions as F

from tessera.llm import url_rules as U

SF = "/root/testdata/sf0.01"


def brute(url):
    """Host, path and the longest stated rule."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    best = None
    for h, p, verdict in U.STATED:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, None))


def test_query_equals_brute_force(spark):
    got = {r["page_id"]: r for r in U.url_query(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        host, path, rule, verdict = brute(p["url"])
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)


ODD = [None, "", "no scheme", "http://", "http://Example.NET/en/x", "http://a.example.net/en", "http://net", "http://net/", "http://xnet/a",
       "http://a.b.example.com/de/?q#f", "http://example.com/de?x", "http://É.ORG/fr/1", "ftp://org/fr/", "http://a://b.net/x",
       "http://h.net?x=/y", "http://h.net#/y", "//x.net/a", "http://.net/a", "http://" + "a." * 5000 + "net/x"]


def test_odd_urls_and_awkward_rows(spark):
    rows = [(i, u, "own") for i, u in enumerate(ODD)] + [(None, "http://a.net/x", "own"), (1, "http://a.net/x", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string").withColumn("host", F.lit("own"))
    labels = spark.createDataFrame([], "page_id long, block boolean")
    rules = spark.createDataFrame(list(U.STATED), "host string, path string, verdict string")
    got = U.judge(pages, labels, rules).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got if r["page_id"] is not None and r["page_id"] != 1}
    for i, u in enumerate(ODD):
        if i != 1:
            host, path, rule, verdict = brute(u)
            r = by_id[i]
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), u
    assert U.judge(pages.limit(0), labels, rules).count() == 0
    assert {r["verdict"] for r in U.judge(pages, labels, rules.limit(0)).collect()} == {"allow"}


@pytest.fixture(scope="module")
def mined(spark):
    """Pages of /ads/ paths on promo hosts are bad, either alone is not."""
    urls = []
    for i in range(600):
        host = f"promo{i % 3}.example.info" if i % 2 else f"news{i % 3}.example.info"
        path = "ads" if i % 3 == 0 else "story"
        urls.append((i, f"https://{host}/{path}/{i}?id={i}", bool(i % 2) and i % 3 == 0))
    pages = spark.createDataFrame(urls, "page_id long, url string, bad boolean")
    labels = pages.where("page_id < 400").select("page_id", F.col("bad").alias("block"))
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    return U.judge(pages, labels, rules).join(pages.select("page_id", "bad"), "page_id").collect()


def test_mined_combinations_block_what_they_should(mined):
    assert all((r["verdict"] == "block") == r["bad"] for r in mined)
    assert all(r["mined_rule"] is not None and r["confidence"] >= U.MIN_CONFIDENCE for r in mined if r["bad"])


def test_pruned_rules_hold_no_rule_that_is_as_confident(spark):
    rows = [(["a", "b"], True)] * 30 + [(["a", "c"], True)] * 30 + [(["c"], False)] * 60
    labelled = spark.createDataFrame(rows, "items array<string>, block boolean")
    rules = {tuple(r["items"]) for r in U.mine(labelled, 0.01, 0.6).collect()}
    assert ("a",) in rules and ("b",) in rules and ("a", "b") not in rules and ("a", "c") not in rules and ("c",) not in rules
