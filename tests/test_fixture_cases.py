"""More literal cases from the reference's tests (FIXTURES.md part C)."""

from pyspark.sql import functions as F

from notesmith.operators import levels, maps, topics
from notesmith.sources import articles

REPO_SCHEMA = ("ord long, repo string, description string, topics_csv string, language string, stars int, "
               "fork boolean, readme string")


def test_repo_to_article(spark):
    rows = [(1, "octo/project-alpha", "An AI code reviewer", "ai,code-review,llm", "Python", 10, False, "# Alpha")]
    a = articles.repo_articles(spark.createDataFrame(rows, REPO_SCHEMA), "2026-05-10").first()
    assert a["title"] == "project-alpha: An AI code reviewer"
    assert {"ai", "python", "github"} <= set(a["tags"]) and a["author"] == "octo" and a["source_name"] == "octo/project-alpha"


def test_repo_tag_cap_and_filters(spark):
    rows = [(1, "o/many", "d", "t1,t2,t3,t4,t5,t6,t7", "Rust", 1, False, "r"),
            (2, "o/normal", "d", "", None, 1, False, "r"),
            (3, "o/forked", "d", "", None, 1, True, "r"),
            (4, "o/empty", "", "", None, 1, False, "")]
    got = {r["source_name"]: r for r in articles.repo_articles(spark.createDataFrame(rows, REPO_SCHEMA), "2026-05-10").collect()}
    assert sorted(got) == ["o/many", "o/normal"]
    assert len(got["o/many"]["tags"]) <= 8 and got["o/many"]["tags"][:7] == [f"t{i}" for i in range(1, 8)]
    assert got["o/normal"]["content_raw"] == "r" and got["o/normal"]["tags"] == ["github"]


def test_doc_title_chain(spark):
    rows = [(1, "https://x.feishu.cn/wiki/A1", "Api Title", "# Heading\nbody"),
            (2, "https://x.feishu.cn/docx/B2", "", "# Heading Two\nbody"),
            (3, "https://x.feishu.cn/docs/C3", "", "no heading"),
            (4, "https://x.feishu.cn/docs/D4", "Empty", "")]
    df = spark.createDataFrame(rows, "ord long, url string, api_title string, content string")
    got = {r["url"]: r["title"] for r in articles.doc_articles(df).collect()}
    assert got == {"https://x.feishu.cn/wiki/A1": "Api Title", "https://x.feishu.cn/docx/B2": "Heading Two",
                   "https://x.feishu.cn/docs/C3": "C3"}


def _topic(spark, sizes):
    t_rows, m_rows, o = [], [], 0
    for tid, n in enumerate(sizes):
        t_rows.append((tid, f"T{tid}", n, [f"tag{tid}"], tid + 1))
        for _ in range(n):
            m_rows.append((tid, o, f"n{o}.md", f"Note {o}", o % 10, "src", ["x"]))
            o += 1
    t = spark.createDataFrame(t_rows, "topic_id long, name string, size bigint, core_tags array<string>, topic_order int")
    m = spark.createDataFrame(m_rows, "topic_id long, ord long, path string, title string, relevance int, "
                                      "source_name string, tags array<string>")
    return t, m


def _page(chunks):
    return "\n".join(r["line"] for r in chunks.orderBy("sec", "k1", "k2").collect())


def test_topic_index_totals_and_more_line(spark):
    t, m = _topic(spark, [5, 3])
    text = _page(maps.topic_index(t, m, "2026-05-10"))
    assert "2 个主题" in text and "8 篇文章" in text and "还有" not in text
    t, m = _topic(spark, [10])
    text = _page(maps.topic_index(t, m, "2026-05-10"))
    assert "- *...还有 5 篇文章*" in text
    assert text.count("- [[n") == 5  # five most relevant members only


def test_topic_page_members_by_relevance(spark):
    t, m = _topic(spark, [4])
    page = _page(maps.topic_pages(t, m, "2026-05-10").where("page = 'MOC-T0.md'"))
    lines = [ln for ln in page.split("\n") if ln.startswith("- [[")]
    assert lines[0].startswith("- [[n3|Note 3]]") and lines[-1].startswith("- [[n0|Note 0]]")
    assert "# MOC: T0" in page and "4 篇文章" in page


def test_l3_mixed_success_and_failure(spark):
    arts = spark.createDataFrame([(1, 8, "detailed", "l2"), (2, 9, "detailed", "l2")],
                                 "ord long, relevance_score int, content_tier string, processing_level string")
    ok = '{"concepts": [{"name": "A", "definition": "a"}], "structure_type": "analysis", "key_insight": "K"}'
    replies = spark.createDataFrame([(1, ok, None), (2, None, "API down")], "ord long, raw string, error string")
    got = {r["ord"]: r for r in levels.overlay_l3(arts, replies).collect()}
    assert got[1]["processing_level"] == "l3" and "**核心洞见:** K" in got[1]["content_deep"]
    assert got[2]["processing_level"] == "l2" and got[2]["content_deep"] == "" and got[2]["l3_concepts"] == []


def test_topic_naming(spark):
    notes = spark.createDataFrame([(i, f"n{i}.md", tags) for i, tags in enumerate(
        [["a", "b"], ["b", "c"], ["b", "a"], ["d"]])], "ord long, path string, tags array<string>")
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (3, 1)], "ord long, label int")
    t, _ = topics.assemble_topics(notes, labels)
    got = {r["topic_id"]: r for r in t.collect()}
    assert got[0]["name"] == "b / a / c" and got[1]["name"] == "d" and got[0]["topic_order"] == 1
    untagged = notes.withColumn("tags", F.array().cast("array<string>"))
    t, _ = topics.assemble_topics(untagged, labels)
    assert {r["name"] for r in t.collect()} == {"Topic (3 articles)", "Topic (1 articles)"}
