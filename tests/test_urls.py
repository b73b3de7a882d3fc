from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import urls as U



def test_canonical_table(column):
    table = {
        "HTTP://User:Pw@EXAMPLE.com:80/A/B/?b=2&a=1&UTM_Source=x#f": "http://user:pw@example.com:80/A/B?a=1&b=2",
        "http://h": "http://h/",
        "http://h/": "http://h/",
        "http://h//": "http://h/",
        "http://h/a//": "http://h/a/",
        "http://h/a;x": "http://h/a",
        "http://h/a;x/b;y": "http://h/a;x/b",
        "http://h/a/;x": "http://h/a",
        "http://h/?a=&b&c=1": "http://h/?c=1",
        "http://h/?a=1&a=1&a=0": "http://h/?a=0&a=1&a=1",
        "http://h/?q=a+b%20c*~": "http://h/?q=a+b+c%2A~",
        "http://h/?x=%zz%": "http://h/?x=%25zz%25",
        "http://h/?%41=%e1%88%80": "http://h/?A=%E1%88%80",
        "http://h/?GCLID=1&fbclid=2&utm_term=3": "http://h/",
        "http://h/a b?c d=e f": "http://h/a b?c+d=e+f",
        "mailto:x@y": "",
        "rel/a": "",
        "//h/x": "",
        "ftp://h/": "",
        "": "",
        "   ": "",
        "http:path": "http:path",
        "http:/p": "http:///p",
        "http://[": "",
        "http://[::1]:80/x": "http://[::1]:80/x",
        "  http://h/x \n": "http://h/x",
        "ht\ntp://h/": "http://h/",
        "http://h?x=1": "http://h/?x=1",
        "http://h/?=v": "http://h/?=v",
    }
    assert dict(zip(table, column(list(table), U.canonical_url(F.col("c"))))) == table


WORD = st.text("abz%+&=;/~*.é ሰ?", max_size=8)
URLS = st.tuples(st.sampled_from(["http", "HTTPS"]), st.sampled_from(["h", "A.b:8", "u@É.c"]), WORD, WORD).map(
    lambda p: f"{p[0]}://{p[1]}/{p[2]}?{p[3]}"
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(URLS, min_size=50, max_size=120))
def test_canonical_form_is_stable_and_keeps_the_query(column, urls):
    got = column(urls, U.canonical_url(F.col("c")))
    for url, canonical in zip(urls, got):
        want, have = urlsplit(url.strip()), urlsplit(canonical)
        assert have.netloc == want.netloc.lower() and have.scheme == want.scheme.lower()
        assert have.query == urlencode(sorted(parse_qsl(want.query)))
        assert have.fragment == ""


def test_domain_and_subdomain(spark, column):
    urls = ["http://A.b:80/x", "https://u@c/", "http:///p", "rel", "//D/x"]
    assert column(urls, U.url_domain(F.col("c"))) == ["a.b:80", "u@c", "", "", "d"]
    pairs = spark.createDataFrame([("a.b", "a.b"), ("x.a.b", "a.b"), ("xa.b", "a.b"), ("b", "a.b")], "c string, b string")
    assert [r.o for r in pairs.select(U.is_same_or_subdomain(F.col("c"), F.col("b")).alias("o")).collect()] == [
        True, True, False, False,
    ]


def test_resolve_matches_the_standard_library(spark):
    refs = [
        "/a", "a/b", "../x", "../../../x", "./y", "?q=1", "#f", "//other/x", "http://o/z", "mailto:a",
        "a/./b/../c", "..", ".", "/a/../b/.", "b/..", "/", "x y", "http:foo", "a?b/../c", "...", "a//b", "/a//b",
    ]
    bases = ["http://h/d1/d2/page?k=v", "http://h", "http://h/", "https://h:1/a/b/"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    got = df.select("b", "r", U.resolve_url(F.col("b"), F.col("r")).alias("o")).collect()
    assert [(r.b, r.r, r.o) for r in got] == [(r.b, r.r, urljoin(r.b, r.r)) for r in got]
