from pyspark.sql import functions as F

from perennial.llm.url_reputation import (
    Reputation,
    domain_of,
    judged_urls,
    keep_allowed,
    reputations,
    suffix_of,
    with_domains,
)

PAGES = "page_id long, url string"
OUTCOMES = "page_id long, good int"


def judge(spark, urls, outcomes=()):
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    rows = judged_urls(pages, spark.createDataFrame(list(outcomes), OUTCOMES)).collect()
    return {urls[r.page_id]: r for r in rows}


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/english": ("example.net", "/english", "net/", "block"),
        "http://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
        "http://net/": ("net", "/", "net/", "block"),
        "https://x.net": ("x.net", "", None, None),
        "https://x.net?a=/en/": ("x.net", "", None, None),
        "ftp://b.example.com/de/1#x": ("b.example.com", "/de/1", "example.com/de/", "block"),
        "http://b.example.com/De/1": ("b.example.com", "/De/1", None, None),
        "http://w.org/fr/": ("w.org", "/fr/", "org/fr/", "allow"),
        "a://b://c/d": ("b:", "//c/d", None, None),
        "no scheme.net/en/": ("", "", None, None),
        "": ("", "", None, None),
        "http://ÄB.org/ü": ("Äb.org", "/ü", None, None),
        "http://x.org\n/fr/": ("x.org\n", "/fr/", None, None),
    }
    got = judge(spark, list(cases))
    for url, (host, path, rule, verdict) in cases.items():
        r = got[url]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict or (verdict is None and r.verdict in ("allow", "block"))


def test_suffixes(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.y.org",), ("org",), ("",)], "h string")
    got = [tuple(r) for r in df.select(domain_of(F.col("h")), suffix_of(F.col("h"))).collect()]
    assert got == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("y.org", "org"), ("org", "org"), ("", "")]


def test_ports_users_and_addresses(spark):
    cases = {
        "b.co.uk:8080": ("b.co.uk", "co.uk"),
        "me:pass@a.x.org": ("x.org", "org"),
        "10.0.0.7": ("10.0.0.7", "[address]"),
        "10.0.0.7:80": ("10.0.0.7", "[address]"),
        "[::1]:80": ("[::1]", "[address]"),
        "1.2.3.4.org": ("4.org", "org"),
        "b:": ("b", "b"),
    }
    hosts = spark.createDataFrame([(h,) for h in cases], "host string")
    for suffixes in (None, spark.createDataFrame([("co.uk",), ("org",)], "suffix string")):
        got = {r.host: (r.domain, r.suffix) for r in with_domains(hosts, suffixes).collect()}
        assert got == cases


def test_a_table_of_suffixes(spark):
    given = ["org", ".GitHub.io", "io", "co.il", "a.b.c.jp", None, "", "org"]
    hosts = ["me.github.io", "x.me.github.io", "github.io", "y.io", "z.q.co.il", "w.a.b.c.jp", "b.c.jp",
             "x.unknown", "", "..", ".".join(["a"] * 3000) + ".org"]

    def brute(host):
        labels, known = host.split("."), {(g or "").lower().lstrip(".") for g in given} - {""}
        long = max([n for n in range(1, len(labels) + 1) if ".".join(labels[-n:]) in known], default=1)
        return ".".join(labels[-long - 1 :]), ".".join(labels[-long:])

    table = spark.createDataFrame([(g,) for g in given], "suffix string")
    frame = spark.createDataFrame([(h, i) for i, h in enumerate(hosts)], "host string, n int")
    got = {r.host: (r.domain, r.suffix) for r in with_domains(frame, table).collect()}
    assert got == {h: brute(h) for h in hosts}
    none = with_domains(frame, table.where("false")).where("host = 'z.q.co.il'").first()
    assert (none.domain, none.suffix) == ("co.il", "il")


def test_a_suffix_table_parts_the_tenants_of_a_shared_host(spark):
    urls = [f"http://good.pages.io/{i}" for i in range(60)] + [f"http://bad.pages.io/{i}" for i in range(60)]
    urls += ["http://www.good.pages.io/", "http://www.bad.pages.io/"]
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    outcomes = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], OUTCOMES)
    table = spark.createDataFrame([("pages.io",), ("io",)], "suffix string")
    got = {r.host: r.verdict for r in judged_urls(pages, outcomes, suffixes=table).collect()}
    assert got["good.pages.io"] == "allow" and got["bad.pages.io"] == got["www.bad.pages.io"] == "block"
    hosts = [("good.pages.io", 60, 60), ("bad.pages.io", 60, 0), ("www.good.pages.io", 0, 0), ("www.bad.pages.io", 0, 0)]
    hosts = spark.createDataFrame(hosts, "host string, n long, good long")
    for suffixes, parted in ((table, True), (None, False)):
        mean = {r.host: r.mean for r in reputations(hosts, suffixes=suffixes).collect()}
        assert (mean["www.good.pages.io"] > mean["www.bad.pages.io"] + 0.2) == parted


def test_shares_are_drawn_towards_the_domain(spark):
    hosts = [(f"h{i}.good.com", 40, 39) for i in range(8)] + [(f"h{i}.bad.com", 40, 2) for i in range(8)]
    hosts += [("new.good.com", 0, 0), ("new.bad.com", 0, 0), ("one.bad.com", 1, 1), ("other.org", 0, 0)]
    rows = {r.host: r for r in reputations(spark.createDataFrame(hosts, "host string, n long, good long")).collect()}
    assert rows["new.good.com"].mean > 0.8 > 0.3 > rows["new.bad.com"].mean
    assert rows["new.bad.com"].mean < rows["one.bad.com"].mean < 0.9
    assert rows["new.good.com"].bound < rows["h0.good.com"].bound < rows["h0.good.com"].mean
    assert 0.2 < rows["other.org"].mean < 0.8


def test_verdicts_follow_the_bound(spark):
    urls = [f"http://good.com/{i}" for i in range(60)] + [f"http://bad.com/{i}" for i in range(60)]
    outcomes = [(i, int(i < 60)) for i in range(120)] + [(None, 1), (5, None), (9999, 1)]
    got = judge(spark, urls, outcomes)
    assert {got[u].verdict for u in urls[:60]} == {"allow"} and {got[u].verdict for u in urls[60:]} == {"block"}
    assert got[urls[0]].host_labelled == 60


def test_nulls_repeats_columns_and_empty_tables(spark):
    none = spark.createDataFrame([], OUTCOMES)
    assert judged_urls(spark.createDataFrame([], PAGES), none).collect() == []
    pages = spark.createDataFrame(
        [(1, None, "a", 1), (None, "http://w.org/fr/", "b", 2), (2, "http://w.org/fr/", "c", 3), (2, "http://w.org/fr/", "c", 3), (3, "x://n.net/", "d", 4)],
        "page_id long, url string, host string, n long",
    )
    assert judged_urls(pages, none).count() == 5
    kept = keep_allowed(pages, none, params=Reputation(min_good=0.99))
    assert kept.columns == pages.columns
    assert sorted((r.n for r in kept.collect())) == [2, 3, 3]
