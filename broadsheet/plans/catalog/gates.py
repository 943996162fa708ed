"""Filter queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions import fields as fd
from ...functions import gates as gt
from ...functions import labels as lb
from .base import column_query, notices, q, sql_any, sql_count, sql_lines, sql_list, sql_map, sql_over_notices, sql_strip
from .labels import sql_classified

DAY = "CASE WHEN publish_time = '' THEN NULL ELSE replace(publish_time, '.', '-') END"


def dated(spark, sf):
    return notices(spark, sf).withColumn("day", F.when(F.col("publish_time") != "", F.replace("publish_time", F.lit("."), F.lit("-"))))


def q_noise(spark, sf):
    d = notices(spark, sf).withColumn("category", lb.classify_3tier("title", "body")["category"]).withColumnRenamed("body", "raw_text")
    return gt.filter_noise(d, words=["满100元", "免年费"]).select("doc_id", "category", "raw_text", "low_value")


SHORT = "body"
ENT2 = "len(list_filter([" + ", ".join(sql_any("b", al) for _, al in lx.KB_BANKS) + "], lambda x: x)) >= 2"
RELATED = f"(list_contains(CASE WHEN lang = 'es' THEN ['信用卡'] ELSE CAST([] AS VARCHAR[]) END, '信用卡') OR {sql_any('title', lx.DOMAIN_TITLE_WORDS)} OR {ENT2})"
TAGS = lambda: F.when(F.col("lang") == "es", F.array(F.lit("信用卡"))).otherwise(F.array().cast("array<string>"))
MAPPED = lambda: F.create_map(F.lit("📋 活动内容"), F.col("title"), F.lit("时间"), F.col("publish_time"), F.concat(F.lit("亮点"), F.col("lang")), F.col("source"))
ids = lambda where: sql_over_notices(f"SELECT doc_id FROM notices WHERE {where}")

ENTRIES = {
    "filter_low_value": ((lambda s, d: gt.filter_low_value(notices(s, d)).select("doc_id")), ids(f"NOT {sql_any(chr(40) + 'title || ' + q(' ') + ' || substr(body, 1, 200))', lx.LOW_VALUE_NOTICE)}")),
    "filter_date_range": ((lambda s, d: gt.filter_date_range(dated(s, d), "day", "2024-03-01", "2024-07-15").select("doc_id", "day")),
                          sql_over_notices(f"SELECT doc_id, day FROM (SELECT doc_id, {DAY} AS day FROM notices) WHERE day IS NULL OR day BETWEEN '2024-03-01' AND '2024-07-15'")),
    "require_date_for": ((lambda s, d: gt.require_date_for(dated(s, d), "day", "source", ["src1", "src5", "src9"]).select("doc_id", "day")),
                         sql_over_notices(f"SELECT doc_id, day FROM (SELECT doc_id, source, {DAY} AS day FROM notices) WHERE NOT (source IN ('src1', 'src5', 'src9') AND day IS NULL)")),
    "is_navigation_noise": column_query(lambda: gt.is_navigation_noise(F.replace(F.replace("body", F.lit("。"), F.lit("\n")), F.lit("，"), F.lit("\n")), ["活动", "优惠", "返现", "首年免", "系统维护", "里程", "贵宾厅", "下调"]),
                                        ("replace(replace(body, '。', chr(10)), '，', chr(10))", sql_lines("t1"),
                                         f"t1 = '' OR {sql_count('t1', ['活动', '优惠', '返现', '首年免', '系统维护', '里程', '贵宾厅', '下调'])} >= 5 OR (len(t2) >= 8 AND len(list_filter(t2, lambda l: length(l) <= 12)) >= 6 AND NOT regexp_matches(t1, '[。；：！？]'))")),
    "filter_noise": (q_noise, sql_over_notices(
        f"SELECT doc_id, category, body AS raw_text, category = '活动' AND (contains(title || ' ' || body, '满100元') OR contains(title || ' ' || body, '免年费')) AS low_value FROM {sql_classified()} WHERE category <> '其他'")),
    "is_pure_ad_or_empty": column_query(lambda: gt.is_pure_ad_or_empty(F.when(F.length("title") < 12, F.concat(F.lit("　以上内容为广告 "), F.substring("publish_time", 1, 0))).otherwise(F.col("title"))),
                                        "length(title) < 12 OR title = ''"),
    "drop_empty_webpage": ((lambda s, d: gt.drop_empty_webpage(notices(s, d).withColumn("body", F.regexp_replace("body", "(?s)^.{0,300}$", "　 "))).select("doc_id")), ids("length(body) > 300")),
    "item_gate": ((lambda s, d: gt.item_gate(notices(s, d), "title", 5, "公告").select("doc_id")), ids(f"length({sql_strip('title')}) >= 5 AND NOT contains(title, '公告')")),
    "is_domain_related": column_query(lambda: gt.is_domain_related("title", "body", TAGS()), (f"{SHORT}", RELATED.replace("contains(b,", "contains(t1,"))),
    "kb_gate": ((lambda s, d: gt.kb_gate(notices(s, d).withColumns({"tags": TAGS(), "draft": F.col("source") == "src7"})).select("doc_id")),
                sql_over_notices(f"SELECT doc_id FROM (SELECT *, body AS b FROM notices) WHERE source <> 'src7' AND length(body) >= 200 AND {RELATED}")),
    "bad_title_fallback": column_query(lambda: gt.bad_title_fallback("title", F.concat("source", F.lit("列表"))),
                                       ("title", f"CASE WHEN length(t1) < 8 OR {sql_any('t1', lx.BAD_TITLE_WORDS)} OR regexp_matches(t1, '^[一二三四五六七八九十0-9]+[、.．]?\\s*$') THEN source || '列表' ELSE t1 END")),
    "needs_refetch": ((lambda s, d: gt.needs_refetch(notices(s, d).withColumn("body", F.regexp_replace("body", "(?s)^.{0,300}$", "　 "))).select("doc_id", "url")), sql_over_notices("SELECT doc_id, url FROM notices WHERE length(body) <= 300")),
    "skip_detail_fields": ((lambda s, d: notices(s, d).select("doc_id", F.explode(gt.skip_detail_fields(MAPPED())).alias("key", "value"))),
                           sql_over_notices("SELECT doc_id, '亮点' || lang AS key, source AS value FROM notices")),
}
