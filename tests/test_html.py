import pytest
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.operators.pages import explode_links, explode_sentences, extract


def text_of(html):
    return " ".join(H.read_page(html, "http://h/")[0].split())


@pytest.mark.parametrize("tag", [t for t in H.DROP_TAGS if t != "input"])
def test_dropped_with_content(tag):
    assert text_of(f"<body>a<{tag} x='1'>no</{tag}>b</body>") == "a b"


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>wo<b>rd</b></p>", "wo rd"),
        ("a<!-- x -->b", "a b"),
        ("a<input value='no'>b", "a b"),
        ("<title>no</title><body>yes</body>after", "yes"),
        ("<title>yes</title>", "yes"),
        ("a&nbsp;b &amp c &lt;d&gt; &#4768; &#x12A0;", "a b & c <d> አ አ"),
        ("x &bogus; y", "x &bogus y"),
        ("<nav>no<div>no</nav>yes", "yes"),
        ("<div><nav>no</div>yes", "yes"),
        ("<nav><nav>no</nav>no</nav>yes", "yes"),
        ("a<nav/>b", "a b"),
        ("a<br>b<br/>c", "a b c"),
        ("a</p>b", "a b"),
        ("<body>a<script>if (a<b) '<p>'</script>b", "a b"),
        ("<!DOCTYPE html><body>a", "a"),
        ("a<![CDATA[b]]>c", "a b c"),
        ("a<template>no<i>no</i></template><ruby>b<rp>(</rp><rt>no</rt></ruby>", "a b"),
        ("", ""),
        ("1 < 2", "1 < 2"),
        ("<body>one</body><body>two</body>", "one"),
    ],
)
def test_visible_text(html, text):
    assert text_of(html) == text


def test_unknown_declaration_is_passed_over():
    text, links = H.read_page("<p>before</p><a href=/x>l</a><![foo bar><p>after</p><!bar baz>end", "http://h/")
    assert "before" in text and "after" in text and "end" in text and links == ["http://h/x"]


def test_links_after_removal_in_order_with_repeats():
    html = (
        "<a href='/x'>1</a><nav><a href='/no'>2</a></nav><a>3</a><a href=''>4</a><a href=' y '>5</a>"
        "<template><a href='/t'>6</a></template><a href='/x'>7</a><a href='http://['>8</a><a href='?a=1&amp;b=2'>9</a>"
    )
    assert H.read_page(html, "http://h/d/p")[1] == [
        "http://h/x", "http://h/d/y", "http://h/t", "http://h/x", "http://h/d/p?a=1&b=2",
    ]
    assert "http://h/no" in H.read_page(html, "http://h/d/p", ())[1]


@pytest.fixture
def pages(spark):
    rows = [
        (1, "http://h/a", "<html><head><title>t</title></head><body><nav><a href='/n'>n</a></nav><p>One two. Three&copy;"
                          "<a href=\"b?z=1&y=2\">four</a> five!</p><a href='mailto:x'>m</a></body></html>"),
        (2, "http://h/b/", "<BODY><A HREF='../c/'>c</A> &amp; <Footer>no</Footer>end.</BODY>"),
        (3, "http://h/c", ""),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("native", [False, True])
def test_extract_on_spark(pages, native):
    found = extract(pages, native=native)
    texts = {r.page_id: r.text for r in found.collect()}
    assert texts == {1: "One two. Three© four five! m", 2: "c & end.", 3: ""}
    links = [(r.page_id, r.pos, r.link) for r in explode_links(found).orderBy("page_id", "pos").collect()]
    assert links == [(1, 0, "http://h/b?y=2&z=1"), (2, 0, "http://h/c")]
    sentences = [(r.page_id, r.pos, r.sentence) for r in explode_sentences(found).orderBy("page_id", "pos").collect()]
    assert sentences[:2] == [(1, 0, "One two."), (1, 1, "Three© four five!")]


def test_text_alone_is_one_parse(pages):
    plan = extract(pages).select(F.length("text"), F.size("hrefs"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_native_text_equals_normalized(column):
    assert column(["<b>a</b>\n<!-- <nav> -->b"], H.native_text(F.col("c"))) == ["a b"]
