"""ROI score, dimensions, bands and advice texts."""

from pyspark.sql import functions as F

from .. import lexicon as lx
from .expr import any_of, c, case, count_hits, field, first_filled, has, has_any, let, text
from .fields import extract_audience, extract_benefits, extract_fee_note

DIMENSION_T = "array<struct<name:string,weight:double,score:double,reason:string>>"
ADVICE_T = "array<struct<icon:string,condition:string,conclusion:string>>"


def _signals(category, title, raw_text, structured):
    """struct(overall, a, b): the score and the two keyword counts of the category."""
    def body(t):
        shine, detail, act = field(structured, "卡亮点"), field(structured, "详情"), field(structured, "活动内容")
        card = (5.0 + count_hits(t, lx.CARD_PLUS) + count_hits(t, lx.CARD_PREMIUM) * 0.5 - count_hits(t, lx.CARD_MINUS) * 2.0
                + count_hits(shine, lx.CARD_PLUS) * 0.5 + count_hits(detail, lx.CARD_PLUS) * 0.3)
        value, risk = count_hits(t, lx.PROMO_VALUE) + count_hits(act, lx.PROMO_VALUE), count_hits(t, lx.PROMO_RISK)
        down, up = count_hits(t, lx.CHANGE_DOWN), count_hits(t, lx.CHANGE_UP)
        pack = lambda s, a, b: F.struct(F.greatest(F.lit(1.0), F.least(F.lit(10.0), s)).alias("overall"), a.cast("int").alias("a"), b.cast("int").alias("b"))
        return case([(c(category) == "新卡", pack(card, F.lit(0), F.lit(0))),
                     (c(category) == "活动", pack(4 + value * 1.5 - risk, value, risk)),
                     (c(category) == "权益变更", pack(5 + up * 1.5 - down * 1.5, down, up))], pack(F.lit(5.0), F.lit(0), F.lit(0)))
    return let(F.concat(text(title), F.lit(" "), text(raw_text)), body)


def roi_score(category, title, raw_text, structured):
    """Keyword score in [1, 10], one decimal."""
    return F.bround(_signals(category, title, raw_text, structured)["overall"], 1)


def roi_dimensions(category, title, raw_text, structured):
    """array of struct(name, weight, score, reason) by category."""
    by_hand, by_word = "需人工判断", "关键词匹配"

    def build(cat, scores):
        return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), s.cast("double").alias("score"), r.alias("reason"))
                         for (n, w), (s, r) in zip(lx.DIMENSIONS[cat], scores)]).cast(DIMENSION_T)

    def body(s):
        o, a, b = s["overall"], s["a"], s["b"]
        hand = (F.lit(5.0), F.lit(by_hand))
        word = lambda v: (v, F.lit(by_word))
        return case([
            (c(category) == "新卡", build("新卡", [word(F.least(F.lit(10.0), o + 1)), word(o), word(F.greatest(F.lit(1.0), o - 1)), hand, hand])),
            (c(category) == "活动", build("活动", [
                (F.least(F.lit(10), 4 + a * 2), F.concat(F.lit("匹配"), a.cast("string"), F.lit("个正向关键词"))),
                (F.greatest(F.lit(1), 7 - b * 2), F.concat(F.lit("匹配"), b.cast("string"), F.lit("个风险关键词"))),
                (F.lit(5.0), F.lit("需人工判断活动时间")), word(F.lit(6.0)), hand])),
            (c(category) == "权益变更", build("权益变更", [
                (o, F.concat(F.lit("降级词"), a.cast("string"), F.lit("个, 升级词"), b.cast("string"), F.lit("个"))), hand, hand, hand])),
        ], build("公告", [hand, hand, hand]))
    return let(_signals(category, title, raw_text, structured), body)


def roi_band(score):
    """struct(overall_roi, recommendation)."""
    s = c(score)
    pack = lambda r, t: F.struct(F.lit(r).alias("overall_roi"), F.lit(t).alias("recommendation"))
    return case([(s >= 7, pack("高", "推荐办理/参与")), (s >= 4, pack("中", "视个人需求决定"))], pack("低", "建议观望/暂不行动"))


def highlight_flag(category, score):
    """struct(is_highlight, highlight_reason) by category thresholds; the score is evaluated once."""
    k = c(category)

    def reason(s):
        return case([((k == "新卡") & (s >= 8), "强烈推荐"), ((k == "新卡") & (s <= 3), "建议避坑"),
                     ((k == "权益变更") & (s <= 4), "严重缩水，需关注"), ((k == "权益变更") & (s >= 8), "重大利好"),
                     ((k == "活动") & (s >= 8), "高价值，建议参加"), ((k == "活动") & (s <= 3), "低价值，建议放弃"),
                     ((k == "公告") & ((s <= 2) | (s >= 9)), "重要公告")], "")
    return let(let(c(score), reason), lambda r: F.struct((r != "").alias("is_highlight"), r.alias("highlight_reason")))


def priority_band(category, score):
    s = c(score)
    return case([((c(category) == "权益变更") & (s >= 7), "🟢"), (s >= 7, "🔴"), (s >= 4, "🟡")], "⚪")


def notes(category, score, title, raw_text):
    k, s = c(category), c(score)
    t = F.concat(text(title), F.lit(" "), text(raw_text))
    return case([
        ((k == "新卡") & has(t, "刚性年费"), "刚性年费卡，确保持卡价值 > 年费支出。注意首年/次年减免条件"),
        ((k == "新卡") & (s >= 7), "关注年费减免条件和刷卡次数要求"),
        ((k == "新卡") & (s <= 3), "权益较为鸡肋，建议谨慎考虑申请"),
        (k == "新卡", "建议根据个人用卡需求评估"),
        ((k == "权益变更") & (s >= 7), "利好变更，建议确认续持并调整刷卡习惯"),
        ((k == "权益变更") & (s <= 3), "缩水严重，建议评估是否销卡或寻找替代卡"),
        (k == "权益变更", "变更影响有限，可继续观察"),
        ((k == "活动") & has_any(t, lx.PROMO_RISK), "有名额限制，建议尽早参与"),
        ((k == "活动") & (s >= 7), "高价值活动，注意参与规则和达标条件"),
        ((k == "活动") & (s <= 3), "价值较低或存在套路风险，建议放弃"),
        (k == "活动", "视个人消费习惯决定是否参与"),
        ((k == "公告") & (s >= 8), "重大公告，建议关注后续影响"),
        (k == "公告", "例行公告，可选择性了解")], "")


def worth_applying(category, score):
    """array of at most one struct(icon, condition, conclusion)."""
    k, s = c(category), c(score)
    row = lambda i, a, b: F.array(F.struct(F.lit(i).alias("icon"), F.lit(a).alias("condition"), F.lit(b).alias("conclusion"))).cast(ADVICE_T)
    return case([((k == "新卡") & (s >= 7), row("✅", "有该卡核心权益需求", "值得关注")), ((k == "新卡") & (s <= 3), row("❌", "权益较鸡肋", "建议观望")),
                 ((k == "活动") & (s >= 7), row("✅", "日常消费可叠加", "建议参与")), ((k == "活动") & (s <= 3), row("❌", "价值低或契约多", "建议放弃")),
                 ((k == "权益变更") & (s >= 7), row("✅", "利好变更", "确认续持")), ((k == "权益变更") & (s <= 3), row("❌", "缩水严重", "建议评估是否销卡"))],
                F.array().cast(ADVICE_T))


def score_items(df):
    """Items plus the evaluation columns: one projection, no shuffle.

    Needs category, bank, title, raw_text, structured. Items outside the four scored categories get 5.0 / 无需评分.
    """
    k = F.col("category")
    scored = k.isin(*lx.DIMENSIONS)
    sig = df.withColumn("_sig", _signals("category", "title", "raw_text", "structured"))
    raw = F.col("_sig.overall")
    empty = F.array().cast("array<string>")
    out = sig.withColumns({
        "_band": roi_band(raw), "_mark": highlight_flag("category", raw),
        "dimensions": F.when(scored, roi_dimensions("category", "title", "raw_text", "structured")).otherwise(F.array().cast(DIMENSION_T)),
        "notes": F.when(scored, notes("category", raw, "title", "raw_text")).otherwise(""),
        "target_audience": F.when(scored, extract_audience("title", "raw_text", "structured", "category", "bank")).otherwise(""),
        "key_benefits": F.when(scored, extract_benefits("raw_text", "structured")).otherwise(empty),
        "fee_assessment": F.when(scored, extract_fee_note("title", "raw_text", "structured")).otherwise(""),
        "worth_applying": F.when(scored, worth_applying("category", raw)).otherwise(F.array().cast(ADVICE_T)),
        "priority": F.when(scored, priority_band("category", raw)).otherwise(""),
    })
    return out.withColumns({
        "overall_score": F.when(scored, F.bround(raw, 1)).otherwise(5.0),
        "overall_roi": F.when(scored, F.col("_band.overall_roi")).otherwise(""),
        "recommendation": F.when(scored, F.col("_band.recommendation")).otherwise("无需评分"),
        "is_highlight": scored & F.col("_mark.is_highlight"),
        "highlight_reason": F.when(scored, F.col("_mark.highlight_reason")).otherwise(""),
        "summary": F.when(scored, F.concat(F.col("_band.recommendation"), F.lit("（关键词评分）"))).otherwise(
            F.substring(field("structured", "消息内容"), 1, 200)),
    }).drop("_sig", "_band", "_mark")
