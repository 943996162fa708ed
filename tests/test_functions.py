"""Column functions on small bulletin examples."""

from pyspark.sql import functions as F

from broadsheet.functions import fields as fd
from broadsheet.functions import gates as gt
from broadsheet.functions import labels as lb
from broadsheet.functions import quality as ql
from broadsheet.functions import scoring as sc
from broadsheet.functions import text as tx
from broadsheet.functions import tokens as tk


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(expr.alias("x")).first()["x"] if cols else spark.range(1).select(expr.alias("x")).first()["x"]


def many(spark, fn, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r["x"] for r in spark.createDataFrame(rows, "i int, v string").select("i", fn("v").alias("x")).orderBy("i").collect()]


def test_cleaning(spark):
    assert many(spark, tx.collapse_ws, [" a　 b； ", None]) == ["a b", ""]
    assert many(spark, tx.title_key, ["一、招行 活动（新）", "2. ABC-x"]) == ["招行活动新", "abcx"]
    assert many(spark, tx.normalize_highlight, ["尊敬的客户： 关于新增权益 特此公告。"]) == ["新增权益"]
    assert many(spark, tx.normalize_detail, ["无关\n核心信用卡资讯\n年费100元\n补充说明\n尾巴", "- 卡种：白金卡\n- 银行：招行"]) == ["年费100元", "卡种：白金卡；银行：招行"]
    assert many(spark, tx.trim_marketing_intro, ["说在前头，各位好。好在还有这些可以选择！正文开始"]) == ["正文开始"]
    assert many(spark, tx.strip_markdown, ["---\ntitle: a\n---\n# 题 [链](http://x) ![i](b)"]) == ["题 链"]
    long = "一" * 30 + "。" + "二" * 30
    assert many(spark, lambda v: tx.safe_truncate(v, 40), [long, "短"]) == ["一" * 30 + "。", "短"]
    assert many(spark, tx.clean_card_name, ["重磅 华夏联名卡正式发行！", "！"]) == ["华夏联名卡", "！"]
    assert many(spark, lambda v: tx.drop_title_echo(v, F.lit("标题")), ["标 题\n正文"]) == ["正文"]
    assert many(spark, lambda v: tx.dedup_paragraphs(v, prefix=2), ["甲乙一\n甲乙二\n丙"]) == ["甲乙一\n丙"]


def test_link_segments(spark):
    df = spark.createDataFrame([(1, "题一 http://a.x/1 题二 http://a.x/1 http://b.x/2）尾")], "doc_id int, text string")
    rows = [tuple(r) for r in tx.extract_link_segments(df).select("url", "title").collect()]
    assert rows == [("http://a.x/1", "题一"), ("http://b.x/2", "）尾")]


def test_classifier_tiers(spark):
    def k(t, b):
        return one(spark, lb.classify_3tier("t", "b"), t=t, b=b)
    assert k("招商银行新卡发布", "")["category"] == "新卡" and k("权益调整", "")["candidates"][0]["score"] == 0.88
    assert k("消费优惠返现", "活动 满减")["category"] == "活动"
    low = k("日常", "通知")
    assert low["category"] == "其他" and low["candidates"][0]["category"] == "公告"
    assert k("天气", "晴")["candidates"][0]["category"] == "其他"


def test_resolver_ladder(spark):
    def r(t, a, b, e=""):
        x = one(spark, lb.resolve_bank("t", "a", "b", "e"), t=t, a=a, b=b, e=e)
        return x["bank"], x["confidence"]
    assert r("", "", "", "招行") == ("招商银行", 1.0)
    assert r("", "", "", "火星银行") == ("火星银行", 0.85)
    assert r("", "工银信用卡", "") == ("工商银行", 0.9)
    assert r("", "平安爱好者", "") == ("平安银行", 0.75)
    assert r("农行活动", "", "") == ("农业银行", 0.7)
    assert r("", "", "中信的卡") == ("中信银行", 0.5)
    assert r("", "", "x" * 500 + "中信") == ("未知", 0.0)


def test_fields(spark):
    assert many(spark, fd.extract_time_range, ["即日起2026年5月1日至2026年6月1日有效"]) == ["2026年5月1日至2026年6月1日"]
    assert many(spark, fd.extract_change, ["积分由100分调整为50分。其余不变"]) == ["积分由100分调整为50分"]
    assert many(spark, fd.first_sentence, ["活动时间：2026年5月1日 满减活动开始。后文", "尊敬的客户：您的权益一、细则"]) == ["满减活动开始", "您的权益一、细则"]
    assert many(spark, fd.extract_activity_name, ["一、活动时间：6月1日至6月30日。三、活动内容 世界杯返现。尾"]) == ["世界杯返现"]
    assert many(spark, fd.extract_date, ["见2026年5月2日", "/news_260709.shtml", "无"]) == ["2026-05-02", "2026-07-09", ""]
    assert many(spark, lambda v: fd.extract_date(v, last=True), ["2026-1-2 到 2026年3月4日"]) == ["2026-03-04"]
    kv = many(spark, fd.extract_kv_fields, ["亮点：高\n亮点摘要：低\n年费：\n活动时间: 五月"])[0]
    assert kv == {"卡亮点": "高", "时间": "五月"}
    assert many(spark, lambda v: F.date_format(fd.parse_date_multi(v, 2026), "yyyy-MM-dd HH:mm"), ["（2026年5月2日）", "2026/5/2 08:30", "20260502", "5-2", "x"]) == ["2026-05-02 00:00", "2026-05-02 08:30", "2026-05-02 00:00", "2026-05-02 00:00", None]
    assert many(spark, lambda v: fd.week_label(F.to_date(v)), ["2026-05-01", "2026-05-04", "2026-05-31"]) == ["2026年5月第1周", "2026年5月第2周", "2026年5月第6周"]
    js = many(spark, lambda v: F.try_variant_get(fd.parse_model_json(v), "$.a", "int"), ['{"a": 1}', '说明 ```json\n{"a": 2}\n```', 'x {"a": 3} y', "bad"])
    assert js == [1, 2, 3, None]


def test_titles_and_summary(spark):
    s = F.create_map(F.lit("活动内容"), F.lit("满100元减20元，全年可享"))
    t = one(spark, fd.display_title(F.lit("招商银行"), F.lit("活动"), s, F.lit("五月好消息")))
    assert t["title"] == "招商银行活动：满100元减20元，全年可享" and t["title_source"] == "generated"
    assert one(spark, fd.display_title(F.lit("招商银行"), F.lit("公告"), s, F.lit("通知"))).title == "通知"
    assert one(spark, fd.highlight_summary(F.lit("活动"), s, s, F.lit("题"), F.lit("文"))).startswith("满100元减20元")
    assert one(spark, fd.annual_benefit(F.lit("月上限100元"), F.lit(""), F.array().cast("array<string>"))) == "年约1200元收益"


def test_scores(spark):
    m = F.create_map().cast("map<string,string>")
    assert one(spark, sc.roi_score(F.lit("新卡"), F.lit("免年费返现白金卡"), F.lit(""), m)) == 7.5
    assert one(spark, sc.roi_score(F.lit("权益变更"), F.lit("权益缩水并取消"), F.lit(""), m)) == 2.0
    h = one(spark, sc.highlight_flag(F.lit("权益变更"), F.lit(3.0)))
    assert h["is_highlight"] and h["highlight_reason"] == "严重缩水，需关注"
    assert [one(spark, sc.priority_band(F.lit(k), F.lit(s))) for k, s in (("权益变更", 8.0), ("活动", 7.0), ("活动", 5.0), ("活动", 1.0))] == ["🟢", "🔴", "🟡", "⚪"]


def test_quality(spark):
    c = F.array(F.struct(F.lit("活动").alias("category"), F.lit(0.8).alias("score")), F.struct(F.lit("公告").alias("category"), F.lit(0.75).alias("score")))
    assert abs(one(spark, ql.category_confidence(c)) - 0.75) < 1e-9
    assert one(spark, ql.title_confidence(F.lit("raw"), F.lit("一" * 20))) > 0.89
    assert one(spark, ql.severity(F.array(F.lit("needs_time_review")))) == "low"
    assert one(spark, ql.severity(F.array(F.lit("needs_source_review")))) == "high"


def test_tokens_and_chunks(spark):
    assert many(spark, tk.tokenize_mixed, ["招行Visa卡a 积分"]) == [["招行", "行积", "积分", "招", "行", "积", "分", "visa卡a"]]
    body = "\n\n".join("段" * 200 for _ in range(4))
    chunks = many(spark, tk.chunk_text, ["# 标题\n" + body, "短"])
    assert [c["section"] for c in chunks[0]] == ["标题"] * 3 and [len(c["text"]) for c in chunks[0]] == [405, 302, 302] and chunks[1] == []


def test_gates(spark):
    assert many(spark, lambda v: gt.is_navigation_noise(v), ["\n".join(["菜单"] * 9), "一句话。", ""]) == [True, False, True]
    assert many(spark, lambda v: gt.bad_title_fallback(v, F.lit("列表标题")), ["一、", "活动规则说明书全文", "招商银行信用卡年费调整"]) == ["列表标题", "列表标题", "招商银行信用卡年费调整"]
