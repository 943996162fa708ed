"""The weekly chain on a small fixture: three ways for an article, corrections, score tables, references, archive."""

import pytest

from broadsheet.operators import retrieval as rt
from broadsheet.plans import items as it

ARTICLE = "article_id string, title string, url string, author string, publish_time string, content_text string, images array<string>"
PAD = "正文内容" * 30


@pytest.fixture(scope="module")
def inputs(spark):
    raw = "开头。招行新增返现活动。" + PAD + "。农行调整积分规则。" + PAD
    articles = spark.createDataFrame([
        ("a", "总题", "http://u/a", "招商银行信用卡", "2024.06.01", "一、新卡首发 二、返现优惠活动 三、公告", ["1.png"]), ("b", "招商银行返现活动", "http://u/b", "招商银行信用卡", "2024.06.02", "招商银行返现活动，满100元返10元", ["1.png", "2.png"]),
        ("r", "合集", "http://u/r", "", "2024.06.02", raw, ["3.png"]), ("s", "工商银行年费公告", "http://u/s", "", "", "工商银行公告，没有边界", None)], ARTICLE)
    lines = {"a": ["序", "一、新卡首发", "x", "y", "z", "二、返现优惠活动", "x", "y", "z", "三、公告", "x", "y"], "b": ["招商银行返现活动，满100元返10元"]}
    blocks = spark.createDataFrame([(a, k, "article_text", t, False) for a, ts in lines.items() for k, t in enumerate(ts)], "article_id string, pos int, type string, text string, is_heading_like boolean")
    notices = spark.createDataFrame([("系统升级公告", "http://u/n", "系统维护", "公告", "工商银行", "2024.06.03")], "title string, url string, content_text string, category string, bank string, publish_time string")
    pages = spark.createDataFrame([("网页", "http://u/p", " ", "2024.06.03")], "title string, url string, content_text string, publish_time string")
    return articles, notices, pages, blocks


def test_articles_take_three_ways(spark, inputs):
    articles, _, _, blocks = inputs
    whole, items = it.split_articles(spark, articles, blocks)
    assert sorted(r.article_id for r in whole.collect()) == ["b", "s"]  # not a candidate; without boundaries
    got = {r.topic_id: r for r in items.collect()}
    assert sorted(got) == ["a_t1", "a_t2", "a_t3", "r_r1", "r_r2"]
    first = got["r_r1"]
    assert (first.raw_title, first.bank, first.is_split, first.split_confidence, first.images, first.source_article_title, first.author) == ("招行新增返现活动", "招商银行", True, 0.75, ["3.png"], "合集", "未知公众号")
    assert got["a_t1"].split_confidence == 0.8 and got["a_t1"].raw_text == "一、新卡首发\n\nx\n\ny\n\nz" and got["r_r2"].bank == "农业银行"


def test_corrections_make_the_shown_fields_anew(spark, inputs, tmp_path):
    articles, notices, pages, blocks = inputs
    before, _ = it.weekly_run(spark, articles, notices, pages, "W", article_blocks=blocks)
    ids = {(r.url, r.topic_id): r.item_id for r in before.collect()}
    named, moved = ids["http://u/b", None], ids["http://u/r", "r_r1"]
    s = spark.createDataFrame([(named, "不存在", "", "新标题"), (moved, "权益变更", "中信银行", ""), ("zzz", "公告", "", "")], "item_id string, category string, bank string, title string")
    scores = spark.createDataFrame([(1, named, "", "持卡人", ["返10元"], "免年费", "🔴"), (2, "", "系统升级公告", "所有人", [], "", "⚪")], "ord int, item_id string, title string, target_audience string, key_benefits array<string>, fee_assessment string, priority string")
    it.weekly_run(spark, articles, notices, pages, "W", str(tmp_path / "archive"), "2024-06-03 00:00:00", blocks, s, scores)
    got = {r.item_id: r for r in spark.read.parquet(str(tmp_path / "archive")).collect()}
    assert set(got) == set(ids.values())
    b, r = got[named], got[moved]
    assert (b.title, b.category, b.modified, b.evidence["title"], b.confidence.bank) == ("新标题", "活动", True, ["LLM 修正标题: 新标题"], 0.0)
    assert (r.category, r.bank, r.modified, r.evidence["category"][-1], r.evidence["bank"][-1]) == ("权益变更", "中信银行", True, "LLM 修正分类: 权益变更", "LLM 修正银行: 中信银行")
    assert "needs_source_review" in r.review_flags and not got[ids["http://u/n", None]].modified
    assert (b.target_audience, b.key_benefits, b.fee_assessment, b.priority, b.matched) == ("持卡人", ["返10元"], "免年费", "🔴", "id") and "返10元" in b.highlight_summary
    notice = got[ids["http://u/n", None]]
    assert (notice.target_audience, notice.matched) == ("所有人", "title") and got[moved].matched is None


def test_references_of_highlighted_items(spark):
    items = spark.createDataFrame([("i", "活动", "招行", "返现", True), ("j", "活动", "招行", "返现", False)], "item_id string, category string, bank string, title string, is_highlight boolean")
    docs = spark.createDataFrame([(1, "招行 返现 满减"), (2, "无关"), (3, "另一篇")], "doc_id long, text string")
    postings = rt.bm25_postings(docs)
    got = it.references_of(items.union(items), postings, rt.bm25_stats(docs, postings)).collect()
    assert [(r.item_id, r.doc_id, r["rank"]) for r in got] == [("i", 1, 1)]


def test_texts_are_written_once_and_signals_shuffle_once(spark, inputs, tmp_path, monkeypatch):
    """Only flags and the archive are written; a row of no category stays if a correction gives it one."""
    from broadsheet.operators import segment as sg
    from broadsheet.sources import scratch
    articles, _, pages, blocks = inputs
    written, cut = {}, scratch.cut_lineage

    def noted(spark, df, name="cut"):
        written[name] = df.columns
        return cut(spark, df, name)
    monkeypatch.setattr(scratch, "cut_lineage", noted)
    notices = spark.createDataFrame([("甲", "http://u/x", "乙", "其他", "", ""), ("丙", "http://u/y", "丁", "其他", "", "")], "title string, url string, content_text string, category string, bank string, publish_time string")
    key = spark.createDataFrame([("website|http://u/x|甲",)], "k string").selectExpr("substring(md5(k), 1, 12) AS item_id", "'公告' AS category", "'' AS bank", "'' AS title")
    root = str(tmp_path / "archive")
    items, manifest = it.weekly_run(spark, articles, notices, pages, "周/1", root, "2024-06-03 00:00:00", blocks, key)
    assert written == {"signals": ["article_id", "is_candidate"], "corrections": ["item_id", "suggested"]}
    rows = items.collect()
    assert spark.read.parquet(root).count() == len(rows) == manifest.first().total_items > 0
    assert {r.batch_label for r in rows} == {"周/1"}  # the label itself, not its form in the path
    assert [(r.url, r.category, r.modified) for r in rows if r.url in ("http://u/x", "http://u/y")] == [("http://u/x", "公告", True)]
    assert sg.multi_topic_signals(blocks)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_sections_and_runs_count_once(spark):
    from broadsheet.operators import segment as sg
    rows = [("a", 0, "article_text", "活动时间：5月 活动对象：持卡人", None), ("a", 1, "article_text", "一、标题", False), ("a", 2, "article_text", "活动时间：5月", False), ("a", 3, "article_text", "活动对象：持卡人", False),
            ("a", 4, "image_fact", "图", False), ("a", 5, "article_text", "说明", True), ("a", 6, "image_fact", "图", False), ("a", 7, "article_text", "文", False)]
    r = sg.multi_topic_signals(spark.createDataFrame(rows, "article_id string, pos int, type string, text string, is_heading_like boolean")).first()
    assert {"repeated_activity_templates", "multiple_independent_sections"} <= set(r.signals)


def test_strip_takes_every_white_space(spark):
    from broadsheet.functions.expr import WHITE, strip
    from pyspark.sql import functions as F
    assert spark.range(1).select(strip(F.lit(WHITE + "a" + WHITE + "b" + WHITE)).alias("x")).first().x == "a" + WHITE + "b"
