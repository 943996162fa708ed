"""Scoring queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions.expr import let
from ...functions import scoring as sc
from ...sources import scratch
from .base import notices, q, sql_any, sql_count, sql_list, sql_over_notices
from .fields import STRUCT, WITH_CATEGORY, let1, sql_audience, sql_benefits, sql_fee_note, sql_structured, with_category
from .labels import sql_staged


def scored_input(spark, sf):
    """Items with category, bank, the whole text, and a structured map."""
    return with_category(spark, sf).withColumn("structured", STRUCT()).withColumn("raw_text", F.col("body"))


def sql_scored_input(view="cats"):
    return sql_staged(view, ("structured", sql_structured()), ("raw_text", "body"))


def sql_signals(view):
    """view + overall, sa, sb."""
    f = lambda k: f"coalesce(structured[{q(k)}], '')"
    n = lambda e, w: sql_count(e, w)
    return sql_staged(view, ("st", "title || ' ' || raw_text"),
        ("sa", f"CASE category WHEN '活动' THEN {n('st', lx.PROMO_VALUE)} + {n(f('活动内容'), lx.PROMO_VALUE)} WHEN '权益变更' THEN {n('st', lx.CHANGE_DOWN)} ELSE 0 END"),
        ("sb", f"CASE category WHEN '活动' THEN {n('st', lx.PROMO_RISK)} WHEN '权益变更' THEN {n('st', lx.CHANGE_UP)} ELSE 0 END"),
        ("overall", f"""greatest(1.0::DOUBLE, least(10.0::DOUBLE, CASE category WHEN '新卡' THEN 5.0::DOUBLE + {n('st', lx.CARD_PLUS)} + {n('st', lx.CARD_PREMIUM)} * 0.5::DOUBLE - {n('st', lx.CARD_MINUS)} * 2
          + {n(f('卡亮点'), lx.CARD_PLUS)} * 0.5::DOUBLE + {n(f('详情'), lx.CARD_PLUS)} * 0.3::DOUBLE WHEN '活动' THEN 4 + sa * 1.5::DOUBLE - sb WHEN '权益变更' THEN 5 + sb * 1.5::DOUBLE - sa * 1.5::DOUBLE ELSE 5.0 END))"""))


SCORED = "category IN ('新卡', '权益变更', '活动', '公告')"
BAND = "CASE WHEN overall >= 7 THEN '高' WHEN overall >= 4 THEN '中' ELSE '低' END"
REC = "CASE WHEN overall >= 7 THEN '推荐办理/参与' WHEN overall >= 4 THEN '视个人需求决定' ELSE '建议观望/暂不行动' END"
REASON = """CASE WHEN category = '新卡' AND overall >= 8 THEN '强烈推荐' WHEN category = '新卡' AND overall <= 3 THEN '建议避坑' WHEN category = '权益变更' AND overall <= 4 THEN '严重缩水，需关注'
 WHEN category = '权益变更' AND overall >= 8 THEN '重大利好' WHEN category = '活动' AND overall >= 8 THEN '高价值，建议参加' WHEN category = '活动' AND overall <= 3 THEN '低价值，建议放弃'
 WHEN category = '公告' AND (overall <= 2 OR overall >= 9) THEN '重要公告' ELSE '' END"""
PRIORITY = "CASE WHEN category = '权益变更' AND overall >= 7 THEN '🟢' WHEN overall >= 7 THEN '🔴' WHEN overall >= 4 THEN '🟡' ELSE '⚪' END"
NOTES = f"""CASE category WHEN '新卡' THEN CASE WHEN contains(st, '刚性年费') THEN '刚性年费卡，确保持卡价值 > 年费支出。注意首年/次年减免条件' WHEN overall >= 7 THEN '关注年费减免条件和刷卡次数要求' WHEN overall <= 3 THEN '权益较为鸡肋，建议谨慎考虑申请' ELSE '建议根据个人用卡需求评估' END
 WHEN '权益变更' THEN CASE WHEN overall >= 7 THEN '利好变更，建议确认续持并调整刷卡习惯' WHEN overall <= 3 THEN '缩水严重，建议评估是否销卡或寻找替代卡' ELSE '变更影响有限，可继续观察' END
 WHEN '活动' THEN CASE WHEN {sql_any('st', lx.PROMO_RISK)} THEN '有名额限制，建议尽早参与' WHEN overall >= 7 THEN '高价值活动，注意参与规则和达标条件' WHEN overall <= 3 THEN '价值较低或存在套路风险，建议放弃' ELSE '视个人消费习惯决定是否参与' END
 WHEN '公告' THEN CASE WHEN overall >= 8 THEN '重大公告，建议关注后续影响' ELSE '例行公告，可选择性了解' END ELSE '' END"""
WORTH = """CASE WHEN category = '新卡' AND overall >= 7 THEN '✅有该卡核心权益需求值得关注' WHEN category = '新卡' AND overall <= 3 THEN '❌权益较鸡肋建议观望' WHEN category = '活动' AND overall >= 7 THEN '✅日常消费可叠加建议参与'
 WHEN category = '活动' AND overall <= 3 THEN '❌价值低或契约多建议放弃' WHEN category = '权益变更' AND overall >= 7 THEN '✅利好变更确认续持' WHEN category = '权益变更' AND overall <= 3 THEN '❌缩水严重建议评估是否销卡' ELSE '' END"""


def one_dim(name, weight, score, reason):
    return f"{q(name)} || '|' || {weight} || '|' || printf('%.1f', {score}) || '|' || {reason}"


def sql_dims():
    hand = ("5.0", "'需人工判断'")
    word = lambda e: (e, "'关键词匹配'")
    fills = {"新卡": [word("least(10.0, overall + 1)"), word("overall"), word("greatest(1.0, overall - 1)"), hand, hand],
             "活动": [("least(10, 4 + sa * 2)::DOUBLE", "'匹配' || sa || '个正向关键词'"), ("greatest(1, 7 - sb * 2)::DOUBLE", "'匹配' || sb || '个风险关键词'"), ("5.0", "'需人工判断活动时间'"), word("6.0"), hand],
             "权益变更": [("overall", "'降级词' || sa || '个, 升级词' || sb || '个'"), hand, hand, hand]}
    out = lambda cat, fs: " || chr(10) || ".join(one_dim(n, q(f"{w:.2f}"), s, r) for (n, w), (s, r) in zip(lx.DIMENSIONS[cat], fs))
    return "CASE category " + " ".join(f"WHEN {q(k)} THEN {out(k, v)}" for k, v in fills.items()) + f" ELSE {out('公告', [hand] * 3)} END"


def dims(x):
    return F.array_join(F.transform(x, lambda d: F.concat_ws("|", d["name"], F.format_string("%.2f", d["weight"]), F.format_string("%.1f", d["score"]), d["reason"])), "\n")


def worth(x):
    return F.array_join(F.transform(x, lambda w: F.concat(w["icon"], w["condition"], w["conclusion"])), "|")


def one(expr, sql, num=False):
    """(doc_id, out) from a scoring expression over the scored input."""
    src = f"{sql_signals(sql_scored_input())}"
    return (lambda s, d: scored_input(s, d).select("doc_id", expr().alias("out")),
            sql_over_notices(f"SELECT doc_id, {sql} AS out FROM {src}", WITH_CATEGORY))


SIG = lambda: sc._signals("category", "title", "raw_text", "structured")["overall"]


def scored(spark, sf):
    """The scored items as a written table; the rollups read it. Body and raw_text are the same text: written once."""
    return scratch.stage_once(spark, f"scored|{sf}", lambda: sc.score_items(scored_input(spark, sf)).drop("body")).withColumn("body", F.col("raw_text"))


def q_score_items(spark, sf):
    return sc.score_items(scored_input(spark, sf)).select(
        "doc_id", "category", F.round("overall_score", 1).alias("overall_score"), "overall_roi", "recommendation", "is_highlight", "highlight_reason", "notes", "target_audience",
        F.array_join("key_benefits", "|").alias("key_benefits"), "fee_assessment", worth(F.col("worth_applying")).alias("worth_applying"), "priority", "summary", dims(F.col("dimensions")).alias("dimensions"))


def sql_scored(view):
    """The score_items columns of a view that has category, bank, title, raw_text and structured."""
    return f"""(SELECT *, CASE WHEN {SCORED} THEN round_even(overall, 1) ELSE 5.0 END::DOUBLE AS overall_score, CASE WHEN {SCORED} THEN {BAND} ELSE '' END AS overall_roi, CASE WHEN {SCORED} THEN {REC} ELSE '无需评分' END AS recommendation,
  {SCORED} AND {REASON} <> '' AS is_highlight, CASE WHEN {SCORED} THEN {REASON} ELSE '' END AS highlight_reason, {NOTES} AS notes,
  CASE WHEN {SCORED} THEN {sql_audience('title', 'raw_text', "coalesce(structured['适用人群'], '')")} ELSE '' END AS target_audience,
  CASE WHEN {SCORED} THEN {sql_benefits('raw_text', "coalesce(structured['卡亮点'], '')")} ELSE CAST([] AS VARCHAR[]) END AS key_benefits,
  CASE WHEN {SCORED} THEN {sql_fee_note('title', 'raw_text', "coalesce(structured['详情'], '')")} ELSE '' END AS fee_assessment,
  {WORTH} AS worth_applying, CASE WHEN {SCORED} THEN {PRIORITY} ELSE '' END AS priority,
  CASE WHEN {SCORED} THEN {REC} || '（关键词评分）' ELSE substr(coalesce(structured['消息内容'], ''), 1, 200) END AS summary, CASE WHEN {SCORED} THEN {sql_dims()} ELSE '' END AS dimensions FROM {sql_signals(view)})"""


def sql_scored_select(cols, view=None):
    return f"SELECT {cols} FROM {sql_scored(view or sql_scored_input())}"


ENTRIES = {
    "roi_score": one(lambda: sc.roi_score("category", "title", "raw_text", "structured"), "round_even(overall, 1)::DOUBLE"),
    "roi_dimensions": one(lambda: dims(sc.roi_dimensions("category", "title", "raw_text", "structured")), sql_dims()),
    "roi_band": one(lambda: F.concat_ws("|", sc.roi_band(SIG())["overall_roi"], sc.roi_band(SIG())["recommendation"]), f"{BAND} || '|' || {REC}"),
    "highlight_flag": one(lambda: let(sc.highlight_flag("category", SIG()), lambda h: F.concat_ws("|", h["is_highlight"].cast("string"), h["highlight_reason"])), f"CAST({REASON} <> '' AS VARCHAR) || '|' || {REASON}"),
    "priority_band": one(lambda: sc.priority_band("category", SIG()), PRIORITY),
    "notes": one(lambda: sc.notes("category", SIG(), "title", "raw_text"), NOTES),
    "worth_applying": one(lambda: worth(sc.worth_applying("category", SIG())), WORTH),
    "score_items": (q_score_items, sql_over_notices(sql_scored_select(
        "doc_id, category, overall_score, overall_roi, recommendation, is_highlight, highlight_reason, notes, target_audience, array_to_string(key_benefits, '|') AS key_benefits, fee_assessment, worth_applying, priority, summary, dimensions"), WITH_CATEGORY)),
}
