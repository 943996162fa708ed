"""Confidence, flag and validation queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions import labels as lb
from ...functions import quality as ql
from ...operators import review as rv
from ...sources import scratch
from .base import column_query, notices, q, sql_filled, sql_list, sql_map, sql_over_notices, table
from .fields import STRUCT, WITH_CATEGORY, sql_display, sql_structured, with_category
from .labels import sql_classified, sql_resolved, sql_staged

BE3 = lambda e: f"round_even({e}, 3)"


def assessed(spark, sf):
    """Items with class, bank, structured fields and confidence, as a written table.

    Filters on derived columns would otherwise be pushed below and re-expand the whole expression chain.
    """
    return scratch.stage_once(spark, f"assessed|{sf}", lambda: _assess(spark, sf))


def _assess(spark, sf):
    d = notices(spark, sf).select("*", lb.classify_3tier("title", "body").alias("k"), lb.resolve_bank("title", "author", "body").alias("r"))
    d = d.select("doc_id", "title", "body", "author", "url", "publish_time", "images", "source", "lang", "n_chars", F.col("k.category").alias("category"), F.col("k.candidates").alias("candidates"),
                 F.col("k.evidence").alias("evidence"), F.col("r.bank").alias("bank"), F.col("r.confidence").alias("bank_confidence"))
    d = d.withColumn("structured", STRUCT()).withColumn("title_source", F.when(F.col("lang") == "de", "generated").otherwise("raw"))
    d = d.withColumn("confidence", ql.confidence("candidates", "bank_confidence", "title_source", "title", "structured", "category"))
    d = d.withColumn("item_id", F.substring(F.md5("url"), 1, 6)).withColumns({"is_split": F.col("lang") == "fr", "split_confidence": (F.col("n_chars") % 10) / 10.0})
    d = d.withColumn("images", F.when(F.col("source") == "src9", F.transform("images", lambda i: F.concat(F.lit("x/"), F.col("item_id"), F.lit("/"), i))).otherwise(F.col("images")))
    return d.withColumn("review_flags", ql.review_flags("confidence", "candidates", "title", "title", "structured", "publish_time", "is_split", "split_confidence", "images", "item_id"))


EXPECT = sql_map({})
SHARE = "CASE category " + " ".join(f"WHEN {q(k)} THEN len(list_filter({sql_list(fs)}, lambda f: coalesce(structured[f], '') <> ''))::DOUBLE / {len(fs)}" for k, fs in lx.EXPECTED_FIELDS.items()) + " END"
CATC = "CASE WHEN len(candidates) >= 2 THEN greatest(0.0, least(1.0, candidates[1].score - greatest(0.0, 0.15::DOUBLE - (candidates[1].score - candidates[2].score)) * 0.5::DOUBLE)) ELSE coalesce(candidates[1].score, 0.0) END"


def title_c(source, title):
    return f"""(CASE {source} WHEN 'generated' THEN 0.4::DOUBLE ELSE 0.7::DOUBLE END + CASE WHEN length({title}) >= 10 THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN length({title}) >= 20 THEN 0.1::DOUBLE ELSE 0 END)"""


def sql_confident(view, title_source, title="title"):
    return sql_staged(view, ("c_cat", CATC), ("c_bank", "bank_confidence"), ("c_title", f"least(1.0::DOUBLE, {title_c(title_source, title)})"), ("c_str", f"CASE WHEN cardinality(structured) > 0 THEN {SHARE} ELSE 0.0 END"),
                      ("c_all", BE3("greatest(0.0, least(1.0, 0.35::DOUBLE * c_cat + 0.25::DOUBLE * c_bank + 0.20::DOUBLE * c_str + 0.20::DOUBLE * c_title))")))


def sql_flags(title="title", split="false", sc="0.0", stray="false"):
    r = lambda e: BE3(e)
    rules = [("needs_category_review", f"({r('c_cat')} > 0 AND {r('c_cat')} < 0.7) OR candidates[1].score < 0.5"), ("needs_source_review", f"{r('c_bank')} < 0.5"), ("needs_title_review", f"{r('c_title')} < 0.6 OR length(trim({title})) < 3"),
             ("needs_detail_review", f"{r('c_str')} < 0.5 OR cardinality(structured) = 0"), ("needs_time_review", "publish_time = ''"), ("needs_overall_review", "c_all < 0.5"),
             ("needs_topic_split_review", f"{split} AND {sc} > 0 AND {sc} < 0.6"), ("topic_boundary_low_confidence", f"{split} AND {sc} > 0 AND {sc} < 0.4"), ("needs_image_review", stray)]
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {q(f)} END" for f, c in rules) + "], lambda f: f IS NOT NULL)"


SEV = f"CASE WHEN list_has_any(flags, {sql_list(lx.CRITICAL_FLAGS)}) THEN 'high' WHEN len(flags) >= 3 THEN 'medium' ELSE 'low' END"
SRC = "CASE lang WHEN 'de' THEN 'generated' ELSE 'raw' END"
ASSESSED = sql_staged(sql_confident(sql_staged(sql_resolved(sql_classified("notices")), ("structured", sql_structured())), SRC),
                      ("flags", sql_flags("title", "lang = 'fr'", "((n_chars % 10)::DOUBLE / 10)", "len(images) > 0 AND source <> 'src9'")), ("sev", SEV), ("item_id", "substr(md5(url), 1, 6)"))


def pick(col_name, sql):
    return (lambda s, d: assessed(s, d).select("doc_id", F.col(col_name).alias("out")), sql_over_notices(f"SELECT doc_id, {sql} AS out FROM {ASSESSED}"))


def q_queue(spark, sf):
    r = rv.review_queue(assessed(spark, sf).withColumn("evidence", F.array_join("evidence", ";")))
    return r.select("doc_id", "item_id", "title", "bank", "category", F.array_join("review_flags", ",").alias("flags"), "severity", F.col("confidence.overall").alias("overall"))


def q_queue_meta(spark, sf):
    return rv.review_meta(assessed(spark, sf))


def q_validate(spark, sf):
    d = assessed(spark, sf).withColumn("raw_text", F.when(F.col("source") == "src3", "").otherwise(F.col("body"))).withColumn("url", F.when(F.col("lang") == "es", "").otherwise(F.col("url")))
    meta = images(spark, sf).select("path", "bytes", "width", "height")
    return rv.validate_batch(d, meta, "doc_id").select("doc_id", "issue")


def images(spark, sf):
    """One row per image path of the bulletins, with sizes derived from the path digest."""
    d = notices(spark, sf).select("doc_id", F.posexplode("images").alias("pos", "path"))
    h = F.conv(F.substring(F.md5("path"), 1, 6), 16, 10).cast("bigint")
    d = d.withColumns({"bytes": h % 70000, "width": (h % 997).cast("int"), "height": (h % 613).cast("int"), "stddev": (h % 40) / 1.0})
    return d


SQL_IMG = """, img AS (SELECT *, h % 70000 AS bytes, (h % 997)::INTEGER AS width, (h % 613)::INTEGER AS height, (h % 40)::DOUBLE AS stddev FROM (SELECT *, ('0x' || substr(md5(path), 1, 6))::BIGINT AS h FROM (
 SELECT doc_id, unnest(images) AS path, generate_subscripts(images, 1) - 1 AS pos FROM notices)))"""
AD = "coalesce(least(width, height) = 0 OR (bytes / 1024.0 < 15 AND least(width, height) < 100) OR (CASE WHEN height > 0 THEN width::DOUBLE / height END > 3.5) OR (CASE WHEN height > 0 THEN width::DOUBLE / height END < 0.15 AND width < 200) OR (least(width, height) < 200 AND bytes / 1024.0 < 50), false)"
PLAIN = "bytes < 5120 OR least(width, height) < 30 OR (width < 50 AND height < 50) OR stddev < 8"

SQL_VALIDATE = SQL_IMG + f""", bad AS (SELECT doc_id, CASE WHEN source = 'src3' THEN '' ELSE body END AS rt, CASE WHEN lang = 'es' THEN '' ELSE url END AS u, title, images, source, lang FROM notices)
 SELECT doc_id, 'missing_title' AS issue FROM bad WHERE title = '' UNION ALL SELECT doc_id, 'missing_raw_text' FROM bad WHERE rt = '' UNION ALL SELECT doc_id, 'missing_url' FROM bad WHERE u = ''
 UNION ALL SELECT b.doc_id, CASE WHEN i.path IS NULL THEN 'image_missing:' ELSE 'image_ad_like:' END || regexp_extract(b.p, '[^/]+$') FROM
  (SELECT doc_id, unnest(CASE WHEN source = 'src9' THEN list_transform(images, lambda x: 'x/' || substr(md5(url0), 1, 6) || '/' || x) ELSE images END) AS p FROM (SELECT *, (SELECT any_value(n.url) FROM notices n WHERE n.doc_id = bad.doc_id) AS url0 FROM bad)) b
  LEFT JOIN (SELECT DISTINCT path, bytes, width, height FROM img) i ON i.path = b.p WHERE i.path IS NULL OR {AD.replace('bytes', 'i.bytes').replace('width', 'i.width').replace('height', 'i.height')}"""


def findings(spark, sf):
    """Review findings derived from the events: document, kind A-E, id and texts."""
    e = table(spark, sf, "events")
    kind = F.element_at(F.array(*[F.lit(k) for k in lx.FINDING_KINDS]), (F.col("user_id") % 5 + 1).cast("int"))
    return e.select(F.concat(F.lit("doc"), (F.col("event_id") % 97).cast("string")).alias("doc"), kind.alias("kind"), F.col("event_id").alias("issue_id"), F.col("props").alias("description"))


SQL_FIND = "WITH f AS (SELECT 'doc' || (event_id % 97) AS doc, substr('ABCDE', (user_id % 5 + 1)::INT, 1) AS kind, event_id AS issue_id, props AS description FROM events)"
COUNTS = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k.lower()}" for k in lx.FINDING_KINDS)
TOPK = "CASE greatest(n_a, n_b, n_c, n_d, n_e) " + " ".join(f"WHEN n_{k.lower()} THEN '{k}'" for k in lx.FINDING_KINDS) + " END"


def q_order(spark, sf):
    d = notices(spark, sf).withColumn("actual", F.when(F.col("lang") == "en", F.col("images")).otherwise(F.slice(F.reverse("images"), 1, 2)))
    o = d.select("doc_id", ql.order_check("images", "actual").alias("o"))
    return o.select("doc_id", "o.ok", F.array_join("o.suggestion", ",", "-").alias("suggestion"))


def blocks3():
    return F.transform(F.split("body", "。"), lambda s: F.struct(lb.classify_block(s).alias("type"), s.alias("text")))


ENTRIES = {
    "category_confidence": (lambda s, d: assessed(s, d).select("doc_id", F.bround(ql.category_confidence("candidates"), 4).alias("out")), sql_over_notices(f"SELECT doc_id, round_even({CATC}, 4)::DOUBLE AS out FROM {sql_classified()}")),
    "title_confidence": column_query(lambda: F.bround(ql.title_confidence(F.when(F.col("lang") == "de", "generated").otherwise("raw"), F.col("title")), 4), f"round_even(least(1.0, {title_c(SRC, 'title')}), 4)::DOUBLE"),
    "structured_confidence": (lambda s, d: assessed(s, d).select("doc_id", F.bround(ql.structured_confidence("category", "structured"), 4).alias("out")), sql_over_notices(f"SELECT doc_id, round_even(c_str, 4)::DOUBLE AS out FROM {ASSESSED}")),
    "overall_confidence": pick("confidence.overall", "c_all::DOUBLE"),
    "review_flags": (lambda s, d: assessed(s, d).select("doc_id", F.array_join("review_flags", ",").alias("out")), sql_over_notices(f"SELECT doc_id, array_to_string(flags, ',') AS out FROM {ASSESSED}")),
    "severity": (lambda s, d: assessed(s, d).select("doc_id", ql.severity("review_flags").alias("out")), sql_over_notices(f"SELECT doc_id, sev AS out FROM {ASSESSED}")),
    "review_queue": (q_queue, sql_over_notices(f"SELECT doc_id, item_id, title, bank, category, array_to_string(flags, ',') AS flags, sev AS severity, c_all::DOUBLE AS overall FROM {ASSESSED} WHERE len(flags) > 0")),
    "review_queue_meta": (q_queue_meta, sql_over_notices(f"SELECT count(*) AS total, count(*) FILTER (len(flags) > 0) AS flagged_count, count(*) FILTER (len(flags) > 0 AND sev = 'high') AS high_severity FROM {ASSESSED}")),
    "review_candidates": (lambda s, d: rv.review_candidates(assessed(s, d), 50).select("doc_id", "item_id", "severity"),
                          sql_over_notices(f"SELECT doc_id, item_id, sev AS severity FROM {ASSESSED} WHERE sev IN ('high', 'medium') ORDER BY c_all, item_id, doc_id LIMIT 50")),
    "noise_flags": (lambda s, d: with_category(s, d).select("doc_id", F.array_join(ql.noise_flags(blocks3(), F.when(F.col("source") == "src3", " ").otherwise(F.col("body")), "category"), ",").alias("out")),
                    sql_over_notices("""SELECT doc_id, array_to_string(list_concat(list_filter(k, lambda t: t IN ('ocr_noise', 'image_cta')), list_filter([CASE WHEN list_contains(k, 'ocr_noise') THEN 'has_ocr_noise' END,
      CASE WHEN source = 'src3' AND category <> '其他' THEN 'pure_ad_or_empty' END], lambda x: x IS NOT NULL)), ',') AS out FROM (SELECT *, list_transform(string_split(body, '。'), lambda z: CASE WHEN trim(z, ' ' || chr(10) || chr(12288)) = '' THEN 'ocr_noise'
      WHEN regexp_matches(z, '扫码|申请|下载|点击|立即|开通|办理') THEN 'image_cta' WHEN regexp_matches(lower(z), '图片为|图（|picture|插画|背景图|示意图') OR length(trim(z, ' ' || chr(10) || chr(12288))) < 4 THEN 'ocr_noise' ELSE 'ocr_fact' END) AS k FROM cats)""", WITH_CATEGORY)),
    "validate_batch": (q_validate, sql_over_notices("", SQL_VALIDATE)),
    "order_check": (q_order, sql_over_notices("SELECT doc_id, images = a AS ok, array_to_string(list_transform(images, lambda x: CASE WHEN list_contains(a, x) THEN x ELSE '-' END), ',') AS suggestion FROM (SELECT *, CASE WHEN lang = 'en' THEN images ELSE list_reverse(images)[1:2] END AS a FROM notices)")),
    "findings_rollup": (lambda s, d: rv.findings_rollup(findings(s, d)), SQL_FIND + f" SELECT doc, n_a, n_b, n_c, n_d, n_e, total, {TOPK} AS top_kind, greatest(0, 100 - 5 * total) AS quality_score FROM (SELECT doc, {COUNTS}, count(*) AS total FROM f GROUP BY doc)"),
    "findings_top": (lambda s, d: rv.findings_top(findings(s, d)).select("doc", "kind", "issue_id", F.col("rank").cast("bigint").alias("rank")),
                     SQL_FIND + " SELECT doc, kind, issue_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY strpos('CADEB', kind), issue_id) AS rank FROM f) WHERE rank <= 5"),
    "field_coverage": (lambda s, d: rv.field_coverage(assessed(s, d), {"time": F.col("publish_time") != "", "author": F.col("author") != "", "images": F.size("images") > 0, "bank": F.col("bank") != "未知"}, F.col("confidence.overall"), [0.4, 0.6]),
                       sql_over_notices(f"SELECT count(*) AS total, round(avg((publish_time <> '')::INT), 6) AS share_time, round(avg((author <> '')::INT), 6) AS share_author, round(avg((len(images) > 0)::INT), 6) AS share_images, round(avg((bank <> '未知')::INT), 6) AS share_bank, "
                                        f"count(*) FILTER (c_all < 0.4) AS band_0, count(*) FILTER (c_all >= 0.4 AND c_all < 0.6) AS band_1, count(*) FILTER (c_all >= 0.6) AS band_2 FROM {ASSESSED}")),
    "image_decorative_filter": (lambda s, d: rv.image_decorative_filter(images(s, d), "doc_id", "pos", 3).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "path"),
                                sql_over_notices(f"SELECT doc_id, pos, path FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY bad, pos) AS rn FROM (SELECT *, ({PLAIN}) AS bad FROM img)) WHERE (NOT bad AND rn <= 3) OR rn = 1", SQL_IMG)),
    "image_ad_filter": (lambda s, d: images(s, d).select("doc_id", F.col("pos").cast("bigint").alias("pos"), ql.image_ad_filter("bytes", "width", "height").alias("is_ad")), sql_over_notices(f"SELECT doc_id, pos, {AD} AS is_ad FROM img", SQL_IMG)),
}
