"""Writer and report queries: written to the scratch folder, read back, or given as report lines."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...operators import dedup as dd
from ...operators import review as rv
from ...sources import readers as rd
from ...sources import scratch
from ...sources import sinks as sk
from .base import notices, q, sql_filled, sql_list, sql_map, sql_over_notices, table
from .dedup import COMMENT, KEY, keyed
from .fields import WITH_CATEGORY
from .quality import ASSESSED, assessed
from .rollups import RANK, items as scored_items
from .scoring import sql_scored, sql_scored_input
from .sources import b, items

NORM = f"CASE raw_category WHEN '新卡发布' THEN '新卡' WHEN '优惠活动' THEN '活动' WHEN '权益调整' THEN '权益变更' ELSE '其他' END"


def plain_items(spark, sf):
    d = items(spark, sf)
    cat = F.when(F.col("category") == "新卡发布", "新卡").when(F.col("category") == "优惠活动", "活动").when(F.col("category") == "权益调整", "权益变更").otherwise("其他")
    return d.withColumn("category", cat).withColumn("ord", F.col("item_id").cast("bigint"))


PI = f", pi AS (SELECT *, {NORM} AS category, '批/' || substr(publish_time, 1, 7) AS batch_label, doc_id AS ord, body AS raw_text FROM notices)"


def q_write_json(spark, sf):
    p = scratch.fresh(spark, "batchjson")
    sk.write_batch_json(plain_items(spark, sf), p, "2024-06-01")
    body = spark.read.json(p).groupBy("batch_label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"))
    return body.join(spark.read.json(p + "_headers").select("batch_label", b("total")), "batch_label")


def archive(spark, sf):
    p = scratch.fresh(spark, "archive")
    d = plain_items(spark, sf)
    sk.write_archive(d.filter("publish_time < '2024.06'"), p, "2024-06-01 00:00:00")
    sk.write_archive(d.filter("publish_time >= '2024.06'"), p, "2024-12-01 00:00:00")
    # the second run of the same batches replaces them
    sk.write_archive(d.filter("publish_time >= '2024.06'"), p, "2024-12-01 00:00:00")
    return p


def q_archive(spark, sf):
    a = spark.read.parquet(archive(spark, sf))
    return a.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), "batch_label").agg(F.count(F.lit(1)).alias("n"))


def q_scan(spark, sf):
    return rd.scan_archive(spark, archive(spark, sf), ["批_2024.07", "批_2024.08", "批_2024.02"], 202407).select("item_id", "batch_label")


def q_manifest(spark, sf):
    return sk.archive_manifest(plain_items(spark, sf), "2024-06-01").select("batch_label", "total_items", *[f"n_{i}" for i in range(5)], "banks", "image_count", "archive_time")


MAN = f"SELECT batch_label, count(*) AS total_items, {', '.join(f'count(*) FILTER (category = {q(k)}) AS n_{i}' for i, k in enumerate(lx.CATEGORIES))}, array_to_string(list_sort(list_distinct(list(source))), ',') AS banks, sum(len(images))::BIGINT AS image_count, '2024-06-01' AS archive_time FROM pi GROUP BY batch_label"


def q_index(spark, sf):
    d = plain_items(spark, sf)
    one = sk.archive_manifest(d.filter("publish_time < '2024.06'"), "2024-06-01")
    two = sk.archive_manifest(d.filter("publish_time >= '2024.06'"), "2024-12-01")
    return sk.archive_index(one, two).select("batch_label", "total_items", "archive_time")


def q_digest(spark, sf):
    d = plain_items(spark, sf).withColumn("highlight_summary", F.when(F.col("source") == "en", "").otherwise(F.col("author")))
    d = d.withColumn("structured", F.create_map(F.lit("k"), F.col("author")))
    return sk.digest_markdown(spark, d, "2024").select("section", "ord", F.col("n").cast("bigint").alias("n"), "line")


R = "CASE category WHEN '新卡' THEN 0 WHEN '权益变更' THEN 1 WHEN '活动' THEN 2 WHEN '公告' THEN 3 WHEN '其他' THEN 4 END"
DIGEST = PI + f""", bl AS (SELECT {R} AS section, ord, list_filter(list_concat(list_concat(['### ' || title, CASE WHEN lang <> 'en' AND author <> '' THEN '**亮点：** ' || author END, '银行：' || source || ' | 来源：' || lang, '[原文链接](' || url || ')', '**结构化信息：**', '- **k**：' || author,
  CASE WHEN raw_text <> '' THEN '**原文摘要：**' END, CASE WHEN length(raw_text) > 500 THEN substr(raw_text, 1, 500) || '...' WHEN raw_text <> '' THEN raw_text END], list_transform(images, lambda p: '![' || title || '](' || p || ')')), ['---']), lambda x: x IS NOT NULL) AS ls FROM pi),
 im AS (SELECT row_number() OVER (ORDER BY {R}, ord, i) AS k, category, title, p FROM (SELECT *, unnest(images) AS p, generate_subscripts(images, 1) AS i FROM pi))
 SELECT -1::INTEGER AS section, 0::BIGINT AS ord, 0::BIGINT AS n, '# 信用卡周报 - 2024' AS line UNION ALL SELECT DISTINCT ({R})::INTEGER, -1, 0, '## ' || category FROM pi UNION ALL SELECT section::INTEGER, ord, generate_subscripts(ls, 1) - 1, unnest(ls) FROM bl
 UNION ALL SELECT 99, k, 0, k || '. [' || title || '](' || p || ') — 分类：' || category FROM im"""


def q_queue_md(spark, sf):
    a = assessed(spark, sf)
    qd = rv.review_queue(a)
    return sk.review_queue_markdown(spark, qd, rv.review_meta(a)).select("section", "ord", F.col("n").cast("bigint").alias("n"), "line")


f3 = lambda e: f"printf('%.3f', {e})"
QUEUE = f"""WITH_Q AS (SELECT *, row_number() OVER (ORDER BY c_all, item_id, doc_id) AS k FROM {ASSESSED} WHERE len(flags) > 0), ql AS (SELECT k, ['---', '### ' || k || '. [' || CASE sev WHEN 'high' THEN '!!! 高' WHEN 'medium' THEN '!! 中' ELSE '! 低' END || '] ' || title, '- **银行**: ' || bank, '- **分类**: ' || category, '- **URL**: ' || url,
  '- **审核标记**: ' || array_to_string(flags, ', '), '- **综合置信度**: ' || {f3('c_all')}, '  - 分类: ' || {f3('round_even(c_cat, 3)')} || ' | 银行: ' || {f3('c_bank')} || ' | 标题: ' || {f3('round_even(c_title, 3)')} || ' | 结构化: ' || {f3('round_even(c_str, 3)')}] AS ls FROM qq)
 SELECT -1::INTEGER AS section, 0::BIGINT AS ord, 0::BIGINT AS n, '**总计**: ' || count(*) || ' 条 | **待复核**: ' || count(*) FILTER (len(flags) > 0) || ' 条 | **高优先级**: ' || count(*) FILTER (len(flags) > 0 AND sev = 'high') || ' 条' AS line FROM {ASSESSED}
 UNION ALL SELECT 0, k, generate_subscripts(ls, 1) - 1, unnest(ls) FROM ql""".replace("WITH_Q", "qq")


def q_analysis(spark, sf):
    return sk.analysis_markdown(scored_items(spark, sf)).select("section", "ord", F.col("n").cast("bigint").alias("n"), "line")


SC = WITH_CATEGORY + f", sc AS MATERIALIZED (SELECT *, doc_id AS ord FROM {sql_scored(sql_scored_input())})"
ANALYSIS = SC + f""", al AS (SELECT {R} AS section, ord, list_filter(list_concat(['### ' || bank || ' · ' || title, '原文：' || url, CASE WHEN len(images) > 0 THEN '附图：' || len(images) || ' 张' END, '- ROI 评分：**' || printf('%.1f', overall_score) || '/10**（' || overall_roi || '）— ' || recommendation, CASE WHEN summary <> '' THEN '- 小结：' || summary END],
   CASE WHEN dimensions = '' THEN CAST([] AS VARCHAR[]) ELSE list_transform(string_split(dimensions, chr(10)), lambda d: '  - ' || split_part(d, '|', 1) || '：' || split_part(d, '|', 3) || '/10（权重 ' || CAST(round(split_part(d, '|', 2)::DOUBLE * 100) AS INT) || '%）') END), lambda x: x IS NOT NULL) AS ls FROM sc),
 bs AS (SELECT bank, min(ord) AS o, array_to_string(list_filter([CASE WHEN count(*) FILTER (category = '新卡') > 0 THEN '新卡 ' || count(*) FILTER (category = '新卡') END, CASE WHEN count(*) FILTER (category = '权益变更') > 0 THEN '权益变更 ' || count(*) FILTER (category = '权益变更') END,
   CASE WHEN count(*) FILTER (category = '活动') > 0 THEN '活动 ' || count(*) FILTER (category = '活动') END, CASE WHEN count(*) FILTER (category = '公告') > 0 THEN '公告 ' || count(*) FILTER (category = '公告') END], lambda x: x IS NOT NULL), ' | ') AS c FROM sc GROUP BY bank)
 SELECT ({R})::INTEGER AS section, -1::BIGINT AS ord, 0::BIGINT AS n, '## ' || category || '（共 ' || count(*) || ' 条）' AS line FROM sc GROUP BY category UNION ALL SELECT section::INTEGER, ord, generate_subscripts(ls, 1) - 1, unnest(ls) FROM al
 UNION ALL SELECT 90, o, 0, '### ' || bank || '（' || {sql_filled('c', q('无条目'))} || '）' FROM bs"""


def q_editorial(spark, sf):
    k = keyed(spark, sf)
    m = dd.merge_by_title_key(k)
    return sk.editorial_markdown(m, dd.title_key_sources(k)).select("section", "ord", F.col("n").cast("bigint").alias("n"), "line")


EDIT = f""", mg AS (SELECT key, min(doc_id) AS ord, arg_min(title, doc_id) AS title, arg_min(url, doc_id) AS url, arg_min(raw_category, doc_id) AS category, count(*) AS dc, coalesce(arg_min(cm, doc_id) FILTER (cm <> ''), '') AS comment FROM (SELECT *, {KEY} AS key, {COMMENT} AS cm FROM notices) GROUP BY key),
 el AS (SELECT ord, list_filter(['### ' || title, CASE WHEN category <> '' THEN '**属性**：' || category END, '**来源**：' || url, CASE WHEN comment <> '' THEN comment END, CASE WHEN dc > 1 THEN '> 合并说明：发现 ' || dc || ' 份来源涉及同一事项，已合并展示。' END], lambda x: x IS NOT NULL) AS ls FROM mg)
 SELECT 0::INTEGER AS section, min(ord)::BIGINT AS ord, 0::BIGINT AS n, {sql_filled('category', q('未分类'))} || ' ' || count(*) || ' 条' AS line FROM mg GROUP BY {sql_filled('category', q('未分类'))} """ + "".join(
    f" UNION ALL SELECT 1, ord, 0, '- **' || {q(n)} || '**：' || {q(note)} || '。涉及：' || title FROM mg WHERE regexp_matches(title || chr(10) || comment, {q('(?i)' + p)})" for n, p, note in lx.THEMES) + """
 UNION ALL SELECT 2, ord, generate_subscripts(ls, 1) - 1, unnest(ls) FROM el UNION ALL SELECT 3, min(doc_id), 0, '- ' || source || '（' || count(*) || ' 条）' FROM notices GROUP BY source"""


def q_atomic(spark, sf):
    p = scratch.fresh(spark, "atomic")
    d = plain_items(spark, sf).select("item_id", "title")
    sk.atomic_write(d, p)
    sk.atomic_write(d.withColumn("title", F.concat("title", F.lit("x"))), p)
    return sk.read_atomic(spark, p)


def q_run_log(spark, sf):
    p = scratch.fresh(spark, "runs")
    n = plain_items(spark, sf).count()
    sk.run_log(spark, p, "2024-01-01 00:00:00", 7, n)
    sk.run_log(spark, p, "2024-01-08 00:00:00", 7, n)
    return spark.read.schema("last_run string, bank_days bigint, items bigint").json(p)


ENTRIES = {
    "write_batch_json": (q_write_json, sql_over_notices("SELECT batch_label, count(*) AS n, count(DISTINCT url) AS urls, count(*) AS total FROM pi GROUP BY batch_label", PI)),
    "write_archive": (q_archive, sql_over_notices("SELECT 2024::BIGINT AS year, CASE WHEN publish_time < '2024.06' THEN 6 ELSE 12 END::BIGINT AS month, replace(batch_label, '/', '_') AS batch_label, count(*) AS n FROM pi GROUP BY ALL", PI)),
    "scan_archive": (q_scan, sql_over_notices("SELECT doc_id::VARCHAR AS item_id, replace(batch_label, '/', '_') AS batch_label FROM pi WHERE batch_label IN ('批/2024.07', '批/2024.08')", PI)),
    "archive_manifest": (q_manifest, sql_over_notices(MAN, PI)),
    "archive_index": (q_index, sql_over_notices("SELECT batch_label, count(*) AS total_items, CASE WHEN publish_time < '2024.06' THEN '2024-06-01' ELSE '2024-12-01' END AS archive_time FROM pi GROUP BY ALL", PI)),
    "safe_label": (lambda s, d: notices(s, d).select("doc_id", sk.safe_label("title").alias("out")), sql_over_notices("SELECT doc_id, regexp_replace(title, '[^\\p{L}\\p{N} _.\\-]', '_', 'g') AS out FROM notices")),
    "digest_markdown": (q_digest, sql_over_notices("", DIGEST)),
    "review_queue_markdown": (q_queue_md, sql_over_notices("", ", " + QUEUE)),
    "analysis_markdown": (q_analysis, sql_over_notices("", ANALYSIS)),
    "editorial_markdown": (q_editorial, sql_over_notices("", EDIT)),
    "atomic_write": (q_atomic, sql_over_notices("SELECT doc_id::VARCHAR AS item_id, title || 'x' AS title FROM notices")),
    "run_log": (q_run_log, sql_over_notices("SELECT t AS last_run, 7::BIGINT AS bank_days, (SELECT count(*) FROM notices) AS items FROM (VALUES ('2024-01-01 00:00:00'), ('2024-01-08 00:00:00')) v(t)")),
}
