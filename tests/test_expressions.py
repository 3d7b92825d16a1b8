"""Literal cases from the reference's tests (FIXTURES.md part C) on the column expressions."""

import pytest
from pyspark.sql import functions as F

from notesmith.functions import html as H
from notesmith.functions import replies as R
from notesmith.functions import text as T
from notesmith.functions import urls as U
from notesmith.sources import articles as A


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_url_slash_tracking_fragment(spark):
    h = lambda u: one(spark, U.url_hash, u)
    assert h("https://example.com/page/") == h("https://example.com/page")
    assert h("https://example.com/a?utm_source=rss&fbclid=abc") == h("https://example.com/a")
    assert h("https://example.com/a?gclid=abc123") == h("https://example.com/a")
    assert h("https://example.com/a?q=test") != h("https://example.com/a?q=other")
    assert h("https://example.com/a#section") == h("https://example.com/a")


def test_url_normalize_quirks(spark):
    n = lambda u: one(spark, U.normalize_url, u)
    assert n("https://x.com/p?") == "https://x.com/p?"  # empty query keeps '?'
    assert n("https://x.com/p?utm_x=1#s") == "https://x.com/p"
    assert n("https://x.com/p?a=1&ref=z&b=2") == "https://x.com/p?a=1&b=2"
    assert n("https://x.com/p/#top") == "https://x.com/p"


def test_html_title(spark):
    t = lambda h: one(spark, H.html_title, h)
    assert t("<html><title>My Article - Blog Name</title></html>") == "My Article"
    assert t("<html><title></title><h1>H1 Title</h1></html>") == "H1 Title"
    assert t("<h1><b>Bold</b> head</h1>") == "Bold head"
    assert t("<p>nothing</p>") == ""


def test_title_slug_fallback(spark):
    df = spark.createDataFrame([("", "<p>x</p>", "https://example.com/my-article-title")], "m string, h string, u string")
    assert df.select(H.title_chain("m", "h", "u")).first()[0] == "my article title"
    df = spark.createDataFrame([("", "", "https://example.com/")], "m string, h string, u string")
    assert df.select(H.title_chain("m", "h", "u")).first()[0] == "example.com"


def test_markdown_cases(spark):
    md = lambda h: one(spark, H.html_to_markdown, h)
    assert md('<a href="https://example.com">Click here</a>') == "[Click here](https://example.com)"
    assert md("<b>bold</b>") == "**bold**"
    assert md("<h2>Section Title</h2>") == "## Section Title"
    assert md("Hello&nbsp;&amp;&nbsp;World") == "Hello & World"
    assert md("<body><br>x</body>") == "x"  # <b> does not swallow <body>/<br>
    assert md("caf&#233; &#8364;") == "café €"


def test_footer_removal(spark):
    body = "Main content here.\n\nTo unsubscribe click here.\nhttps://unsubscribe.link"
    out = one(spark, T.remove_footer, body)
    assert out.startswith("Main content") and "unsubscribe" not in out.lower()
    keep = "Line one.\nLine two.\nYou received this email because you asked."
    assert one(spark, T.remove_footer, keep) == "Line one.\nLine two."
    greedy = spark.createDataFrame([(keep,)], "x string").select(T.remove_footer("x", greedy=True)).first()[0]
    assert greedy == "Line one."


def test_whitelist(spark):
    wl = ["newsletter@example.com", "example.org"]
    df = spark.createDataFrame([("newsletter@example.com",), ("a@example.org",), ("x@other.net",)], "a string")
    got = [r[0] for r in df.select(A.sender_allowed("a", wl)).collect()]
    assert got == [True, True, False]
    assert df.select(A.sender_allowed("a", [])).first()[0] is True


def test_doc_id(spark):
    d = lambda u: one(spark, U.doc_id_from_url, u)
    for u in ("https://x.feishu.cn/wiki/ABC123", "https://x.feishu.cn/docx/ABC123", "https://x.feishu.cn/docs/ABC123",
              "https://x.feishu.cn/wiki/ABC123?from=a", "https://x.feishu.cn/wiki/ABC123/"):
        assert d(u) == "ABC123"
    assert d("https://example.com/wiki/ABC123") is None
    assert d("https://x.feishu.cn/other/ABC123") is None


def test_slugs(spark):
    assert one(spark, T.note_slug, "What's new in AI/ML? (2026)") == "whats-new-in-aiml-2026"
    assert len(one(spark, T.note_slug, "A" * 200)) <= 80
    assert one(spark, T.topic_slug, "Hello World") == "Hello-World"
    assert one(spark, T.topic_slug, "") == "untitled"
    assert one(spark, T.topic_slug, "机器学习 / AI") == "机器学习-AI"


def test_wikilink(spark):
    df = spark.createDataFrame([("2-Articles/x/my-article.md", "My Article"), ("", "Untitled")], "p string, t string")
    assert [r[0] for r in df.select(T.wikilink("p", "t")).collect()] == ["[[my-article|My Article]]", "[[Untitled]]"]


@pytest.mark.parametrize("raw,error,score", [
    ('{"relevance_score": 9, "tags": ["ai"]}', None, 9),
    ('Sure: {"relevance_score": 7} done', None, 7),
    ('{"relevance_score": "5"}', None, 5),
    ('{"relevance_score": null}', None, 5),
    ("no object", None, 0),
    ("", None, 0),
    ('{"relevance_score": 7.9}', None, 7),
    ('{"tags": ["x"}', None, 5),
    ('{"relevance_score": "7.5"}', None, 5),
    ('{"tags": []}', None, 0),
    ("{}", "boom", 5),
])
def test_relevance_fallbacks(spark, raw, error, score):
    df = spark.createDataFrame([(raw, error)], "raw string, error string")
    assert df.select(R.relevance_score("raw", "error")).first()[0] == score


def test_tiers(spark):
    df = spark.createDataFrame([(s,) for s in (9, 7, 5, 3, 1)], "s int")
    assert [r[0] for r in df.select(R.assign_tier("s")).collect()] == ["detailed", "detailed", "compressed", "discard",
                                                                        "discard"]


def test_summary_fallbacks(spark):
    rows = [("<think\nmalformed</think\n{\"tldr\": \"test\"}", None), (None, "API down"), ("", None),
            ("plain text", None), ('{"tldr": "T", "summary": "S", "key_points": ["a"]}', None)]
    df = spark.createDataFrame(rows, "raw string, error string")
    got = [r[0] for r in df.select(R.summary_fields("raw", "error")).collect()]
    assert got[0]["summary"].startswith("**TL;DR:** test")
    assert "failed" in got[1]["summary"]
    assert got[2]["summary"] == "[Summary generation returned empty]"
    assert got[3]["summary"] == "plain text"
    assert got[4]["summary"] == "**TL;DR:** T\n\nS" and got[4]["key_points"] == ["a"]


def test_analysis_success_and_failure(spark):
    ok = ('{"concepts": [{"name": "A", "definition": "a"}, {"name": "B", "definition": "b"}, '
          '{"name": "C", "definition": "c"}], "structure_type": "analysis", "key_insight": "K", '
          '"assumptions": ["x"], "position": "p"}')
    df = spark.createDataFrame([(ok, None), ('{"concepts": [{"definition": "d"}]}', None), (None, "down")],
                               "raw string, error string")
    got = [r[0] for r in df.select(R.analysis_fields("raw", "error")).collect()]
    assert got[0]["ok"] and len(got[0]["concepts"]) == 3
    assert "**A**" in got[0]["content_deep"] and "**前提假设:**" in got[0]["content_deep"]
    assert "**作者立场:** p" in got[0]["content_deep"]
    assert not got[1]["ok"] and not got[2]["ok"]


def test_rfc_dates(spark):
    from notesmith.functions import dates as DT
    rows = [("Tue, 05 May 2026 04:15:00 +0000",), ("5 May 2026 04:15:00 GMT",), ("Tue, 5 May 2026 00:15:00 EDT",),
            ("garbage",), ("",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(DT.epoch_seconds(DT.rfc2822_to_timestamp("s"))).collect()]
    assert got[0] == got[1] == got[2] == 1777954500 and got[3] is None and got[4] is None
