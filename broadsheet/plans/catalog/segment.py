"""Segmentation queries over sentence blocks, conversations and paragraph tables."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions.expr import any_of, strip
from ...operators import segment as sg
from ...sources import scratch
from .base import WS, notices, q, sql_any, sql_count, sql_filled, sql_hits, sql_lines, sql_list, sql_map, sql_over_notices, sql_strip, table

KINDS = "CASE WHEN regexp_matches(t, '^https?:') THEN 'image_caption' WHEN length(t) < 4 THEN 'ocr_noise' ELSE 'article_text' END"


def blocks(spark, sf, only="true"):
    """Sentences of the bulletins (of those that a condition names) as blocks."""
    d = notices(spark, sf).filter(only).select(F.col("doc_id").cast("string").alias("article_id"), F.posexplode(F.split("body", "[。\n]")).alias("pos", "text"))
    t = strip(F.col("text"))
    kind = F.when(F.rlike(t, F.lit("^https?:")), "image_caption").when(F.length(t) < 4, "ocr_noise").otherwise("article_text")
    return d.select("article_id", "pos", kind.alias("type"), "text", F.startswith("text", F.lit("#")).alias("is_heading_like"))


def articles(spark, sf):
    return notices(spark, sf).select(F.col("doc_id").cast("string").alias("article_id"), F.col("title").alias("raw_title"))


TEMPLATE = " OR ".join(f"({sql_count('t', g)} >= 2)" for g in lx.TEMPLATE_GROUPS)
START = f"(hl OR numbered OR {TEMPLATE} OR ({sql_any('t', lx.HINT_BANKS)} AND {sql_any('t', lx.TOPIC_ACTIONS)}))"
def blocks_sql(view="notices"):
    return f""", bk AS (SELECT article_id, pos, t, hl, {KINDS} AS type, regexp_matches(t, {q(lx.NUMBERED_PREFIX)}) AS numbered FROM (SELECT CAST(doc_id AS VARCHAR) AS article_id, i - 1 AS pos, {sql_strip('v')} AS t, starts_with(v, '#') AS hl FROM (
 SELECT doc_id, unnest(ps) AS v, generate_subscripts(ps, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(body, '[。\\n]') AS ps FROM {view}))))"""


SQL_BLOCKS = blocks_sql()

drop = lambda e: f"list_filter({e}, lambda k: k NOT IN ('扫码申卡', '主题信用卡', '信用卡', '银行卡', '借记卡') AND NOT contains(k, '扫码') AND NOT contains(k, '主题'))"
RAWB = r"regexp_extract_all(t, '(?:Visa|MasterCard|银联|JCB|美国运通)[^\s\x0b，。]{0,6}(?:卡|版)')"
PLAIN = drop(r"regexp_extract_all(t, '[^\s\x0b，。]{4,10}(?:卡|版)')")
ACTS = r"list_filter(regexp_extract_all(t, '[^\s\x0b，。]{2,6}(?:活动|优惠|返现|赠)'), lambda a: length(rtrim(a, '活动优惠返现赠')) >= 2)"
FIELDS = sorted({f for g in lx.TEMPLATE_GROUPS for f in g})
SIGNAL_STEPS = f""", tb AS (SELECT *, (hl OR numbered) AS heading, {RAWB} AS rawb, {PLAIN} AS plain, {ACTS} AS acts FROM bk),
 tt AS (SELECT *, list_distinct(list_concat(CASE WHEN len(rawb) > 0 THEN {drop('rawb')} ELSE plain END, acts)) AS terms FROM tb),
 tw AS (SELECT *, sum(heading::INT) OVER (PARTITION BY article_id ORDER BY pos) AS section, coalesce(sum(heading::INT) OVER (PARTITION BY article_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM tt),
 ne AS (SELECT article_id, terms, lag(terms) OVER (PARTITION BY article_id ORDER BY pos) AS prev FROM tt WHERE t <> ''),
 sw AS (SELECT article_id, count(*) FILTER (len(terms) > 0 AND len(prev) > 0 AND NOT list_has_any(terms, prev)) AS n FROM ne GROUP BY article_id),
 se AS (SELECT article_id, count(*) FILTER ({' OR '.join('(' + ' + '.join(f'f{FIELDS.index(f)}' for f in g) + ') >= 2' for g in lx.TEMPLATE_GROUPS)}) AS n FROM (SELECT article_id, section, {', '.join(f"max((type IN ('article_text', 'ocr_fact') AND contains(t, {q(f)}))::INT) AS f{i}" for i, f in enumerate(FIELDS))} FROM tw GROUP BY article_id, section) GROUP BY article_id),
 sq AS (SELECT article_id, count(*) FILTER (img AND txt) AS n FROM (SELECT article_id, before, bool_or(starts_with(type, 'image') AND type <> 'image_cta') AS img, bool_or(type = 'article_text' AND t <> '') AS txt FROM tw WHERE before >= 1 GROUP BY article_id, before) GROUP BY article_id),
 ag AS (SELECT article_id, count(*) FILTER (numbered) AS numbered, count(*) FILTER (heading) AS headings, list_distinct(flatten(list(terms) FILTER (heading))) AS ht, bool_or(len(rawb) > 0) AS brand, flatten(list({drop('rawb')})) AS branded,
   flatten(list(plain)) AS plain, flatten(list(acts)) AS acts, {' + '.join(f"bool_or(contains(t, {q(k)}))::INT" for k in lx.TOPIC_ACTIONS)} AS actions FROM tw GROUP BY article_id),
 fl AS (SELECT ag.article_id, numbered >= 2 AS s1, coalesce(se.n, 0) >= 2 AS s2, headings >= 2 AND len(coalesce(ht, [])) >= 2 AS s3, coalesce(sq.n, 0) >= 2 AS s4, list_distinct(list_concat(CASE WHEN brand THEN branded ELSE plain END, acts)) AS names, actions >= 3 AS w3, coalesce(sw.n, 0) >= 2 AS w4
   FROM ag LEFT JOIN se USING (article_id) LEFT JOIN sq USING (article_id) LEFT JOIN sw USING (article_id)),
 sg AS (SELECT article_id, list_filter([CASE WHEN s1 THEN '{sg.STRONG[0]}' END, CASE WHEN s2 THEN '{sg.STRONG[1]}' END, CASE WHEN s3 THEN '{sg.STRONG[2]}' END, CASE WHEN s4 THEN '{sg.STRONG[3]}' END], lambda x: x IS NOT NULL) AS s,
   list_filter([CASE WHEN len(names) >= 3 THEN '{sg.WEAK[0]}' END, CASE WHEN len(list_filter(names, lambda x: contains(x, '卡') OR contains(x, '版'))) >= 2 THEN '{sg.WEAK[1]}' END, CASE WHEN w3 THEN '{sg.WEAK[2]}' END, CASE WHEN w4 THEN '{sg.WEAK[3]}' END], lambda x: x IS NOT NULL) AS w FROM fl)"""
SIGNALS = SQL_BLOCKS + SIGNAL_STEPS + """
 SELECT article_id, CASE WHEN len(s) > 0 OR len(w) >= 2 THEN array_to_string(list_concat(s, w), ',') ELSE '' END AS signals, len(s) > 0 OR len(w) >= 2 AS is_candidate,
  round(CASE WHEN len(s) > 0 THEN least(0.95, 0.7 + 0.1 * least(len(s), 3)) WHEN len(w) >= 2 THEN least(0.75, 0.5 + 0.1 * least(len(w), 3)) ELSE 0 END::DOUBLE, 4) AS split_confidence FROM sg"""

HINT = f"CASE WHEN {sql_count('bt', lx.HINT_CARD)} >= 2 THEN '新卡' WHEN {sql_count('bt', lx.HINT_PROMO)} >= 2 THEN '活动' WHEN {sql_any('bt', lx.HINT_CHANGE)} THEN '权益变更' WHEN {sql_any('bt', lx.HINT_NOTICE)} THEN '公告' ELSE '' END"
TOPIC_STEPS = f""", st AS (SELECT *, sum({START}::INT) OVER (PARTITION BY article_id ORDER BY pos) AS seg FROM bk),
 sx AS (SELECT article_id, seg, min(pos) AS sb, max(pos) AS eb, count(*) AS n, arg_min(t, pos) AS h, string_agg(t, chr(10) ORDER BY pos) AS bt FROM st WHERE seg > 0 GROUP BY article_id, seg),
 sy AS (SELECT article_id, seg, sb, eb, n, coalesce(nullif(h, ''), a.title) AS headline, {HINT} AS hint, a.title AS title FROM sx JOIN (SELECT CAST(doc_id AS VARCHAR) AS article_id, title FROM notices) a USING (article_id)),
 fo AS (SELECT * FROM (WITH RECURSIVE f(article_id, seg, grp, hint, fresh) AS (SELECT article_id, seg, 1, hint, true FROM sy WHERE seg = 1 UNION ALL
   SELECT y.article_id, y.seg, CASE WHEN m THEN f.grp ELSE f.grp + 1 END, CASE WHEN m THEN f.hint ELSE y.hint END, NOT m FROM f JOIN (SELECT *, true AS one FROM sy) y ON y.article_id = f.article_id AND y.seg = f.seg + 1,
   LATERAL (SELECT (y.n <= 2 OR (y.headline <> '' AND y.headline = y.title) OR (f.hint <> '' AND f.hint = y.hint AND y.n <= 3)) AS m)) SELECT * FROM f)),
 gp AS (SELECT fo.article_id, grp, min(sb) AS start_block, max(eb) AS end_block, arg_min(sy.headline, fo.seg) AS headline, arg_min(sy.hint, fo.seg) AS type_hint, sum(n)::BIGINT AS n_blocks, count(*) - 1 AS merged, any_value(title) AS title FROM fo JOIN sy USING (article_id, seg) GROUP BY fo.article_id, grp),
 cn AS (SELECT n.article_id, n.title, count(gp.grp) AS k, (SELECT count(*) FROM bk WHERE bk.article_id = n.article_id) AS nb FROM (SELECT CAST(doc_id AS VARCHAR) AS article_id, title FROM notices) n LEFT JOIN gp USING (article_id) GROUP BY n.article_id, n.title),
 ou AS (SELECT gp.article_id, gp.article_id || '_t' || grp AS topic_id, start_block, end_block, gp.headline, type_hint, n_blocks, 0.8::DOUBLE AS split_confidence, 'heading_marker' || repeat(',merged', merged::INT) AS signals FROM gp JOIN cn USING (article_id) WHERE k > 1
  UNION ALL SELECT article_id, article_id || '_t1', 0, nb - 1, title, '', nb, 1.0, CASE WHEN k = 0 THEN 'single_topic_fallback:no_topic_starts' ELSE 'single_topic_fallback:merged_to_single' END FROM cn WHERE k <= 1)"""
TOPICS = SQL_BLOCKS + TOPIC_STEPS


def q_signals(spark, sf):
    s = sg.multi_topic_signals(blocks(spark, sf))
    return s.select("article_id", F.array_join("signals", ",").alias("signals"), "is_candidate", F.round("split_confidence", 4).alias("split_confidence"))


def topics(spark, sf):
    return scratch.stage_once(spark, f"topics|{sf}", lambda: sg.segment_topics(blocks(spark, sf), articles(spark, sf)))


def q_topics(spark, sf):
    return topics(spark, sf).select("article_id", "topic_id", "start_block", "end_block", "headline", "type_hint", "n_blocks", "split_confidence", F.array_join("signals", ",").alias("signals"))


def q_merge_small(spark, sf):
    """Conversations: every turn is a topic, folded by the same rule."""
    t = table(spark, sf, "conversations")
    row = F.struct(F.col("turn").alias("start_block"), F.col("turn").alias("end_block"), F.col("text").alias("headline"), F.col("role").alias("type_hint"), F.size(F.split("text", r"\.")).cast("bigint").alias("n_blocks"),
                   F.array().cast("array<struct<pos:bigint,type:string,text:string>>").alias("blocks"), F.lit(0).alias("merged")).cast(sg.TOPIC)
    a = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", row.alias("t")))).alias("ts"))
    k = a.select("conv_id", F.explode(sg.merge_small_topics(F.transform("ts", lambda x: x["t"]), F.lit("?"))).alias("t"))
    return k.select("conv_id", "t.start_block", "t.end_block", "t.headline", "t.n_blocks", F.col("t.merged").cast("bigint").alias("merged"))


SQL_MERGE_SMALL = """WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, text AS h, role AS hint, len(string_split(text, '.')) AS n FROM conversations),
 f AS (SELECT * FROM (WITH RECURSIVE f(conv_id, i, grp, hint) AS (SELECT conv_id, i, 1, hint FROM c WHERE i = 1 UNION ALL SELECT c.conv_id, c.i, CASE WHEN c.n <= 2 OR (f.hint <> '' AND f.hint = c.hint AND c.n <= 3) THEN f.grp ELSE f.grp + 1 END,
   CASE WHEN c.n <= 2 OR (f.hint <> '' AND f.hint = c.hint AND c.n <= 3) THEN f.hint ELSE c.hint END FROM f JOIN c ON c.conv_id = f.conv_id AND c.i = f.i + 1) SELECT * FROM f))
 SELECT conv_id, min(turn) AS start_block, max(turn) AS end_block, arg_min(h, i) AS headline, sum(n)::BIGINT AS n_blocks, count(*) - 1 AS merged FROM f JOIN c USING (conv_id, i) GROUP BY conv_id, grp"""


def paragraphs(spark, sf):
    """Lines of the bulletins as styled paragraphs; a third of the files without first-level headings, a third without any."""
    d = notices(spark, sf).select(F.col("doc_id").cast("string").alias("file"), "lang", F.posexplode(F.split(F.replace(F.replace("body", F.lit("！"), F.lit("\n")), F.lit("；"), F.lit("\n## ")), "\n")).alias("pos", "line"))
    one, two = F.startswith("line", F.lit("# ")), F.startswith("line", F.lit("## "))
    style = F.when(one & (F.col("lang") == "en"), "Heading 1").when(two & F.col("lang").isin("en", "fr"), "Heading 2").when(F.startswith("line", F.lit("- ")), "List Bullet").otherwise("Normal")
    t = F.when(F.col("lang") == "de", F.regexp_replace("line", "^#+ ", "标题：")).when(F.col("lang") == "es", F.regexp_replace("line", "^## ", "银行：")).otherwise(F.regexp_replace("line", "^#+ ", ""))
    return d.select("file", "lang", "pos", style.alias("style"), t.alias("text"), F.col("lang").isin("de", "es").alias("bold"))


SQL_PARA = """, pa AS (SELECT doc_id::VARCHAR AS file, lang, i - 1 AS pos, CASE WHEN starts_with(line, '# ') AND lang = 'en' THEN 'Heading 1' WHEN starts_with(line, '## ') AND lang IN ('en', 'fr') THEN 'Heading 2' WHEN starts_with(line, '- ') THEN 'List Bullet' ELSE 'Normal' END AS style,
  CASE lang WHEN 'de' THEN regexp_replace(line, '^#+ ', '标题：') WHEN 'es' THEN regexp_replace(line, '^## ', '银行：') ELSE regexp_replace(line, '^#+ ', '') END AS text, lang IN ('de', 'es') AS bold
  FROM (SELECT doc_id, lang, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, lang, string_split(replace(replace(body, '！', chr(10)), '；', chr(10) || '## '), chr(10)) AS ls FROM notices)))"""
NAMES = "|".join(lx.FIELD_NAMES)
SQL_MODES = SQL_PARA + f""", md AS (SELECT file, CASE WHEN h1 > 0 THEN 'standard' WHEN h2 > 0 THEN 'announcement' WHEN n > 0 AND fl::DOUBLE / n > 0.2 THEN 'field' ELSE 'standard' END AS mode FROM (SELECT file, count(*) FILTER (x <> '' AND style = 'Heading 1') AS h1, count(*) FILTER (x <> '' AND style = 'Heading 2') AS h2,
  count(*) FILTER (bold AND regexp_matches(x, '^(?:{NAMES})[：:]')) AS fl, count(*) FILTER (x <> '') AS n FROM (SELECT *, {sql_strip('text')} AS x FROM pa) GROUP BY file))"""
SQL_ITEMS = SQL_MODES + f""", p1 AS (SELECT pa.file, pos, style, {sql_strip('text')} AS x, mode FROM pa JOIN md USING (file)),
 p2 AS (SELECT *, CASE WHEN mode = 'field' THEN coalesce(regexp_extract(x, '^({NAMES})[：:]', 1), '') ELSE '' END AS label, {sql_strip("CASE WHEN contains(x, '：') THEN regexp_replace(x, '^[^：]*：', '') ELSE regexp_replace(x, '^[^:]*:', '') END")} AS value FROM p1 WHERE x <> ''),
 p3 AS (SELECT *, CASE mode WHEN 'standard' THEN style = 'Heading 1' WHEN 'field' THEN label IN ('银行', '发卡银行') ELSE false END AS o1, CASE mode WHEN 'field' THEN label = '标题' ELSE style = 'Heading 2' END AS o2r FROM p2),
 p4 AS (SELECT *, max(CASE WHEN o1 THEN pos END) OVER (PARTITION BY file ORDER BY pos) AS h1 FROM p3), p5 AS (SELECT *, o2r AND (mode <> 'standard' OR h1 IS NOT NULL) AS o2 FROM p4),
 p6 AS (SELECT *, max(CASE WHEN o2 THEN pos END) OVER (PARTITION BY file ORDER BY pos) AS h2 FROM p5), p7 AS (SELECT * FROM p6 WHERE h2 IS NOT NULL AND (h1 IS NULL OR h2 > h1)),
 p8 AS (SELECT *, NOT o2 AND NOT (mode = 'field' AND label IN ('原文链接', '发布时间', '作者')) AS body FROM p7),
 fb AS (SELECT file, arg_min(b, pos) AS fb FROM (SELECT file, pos, regexp_extract(x, '({'|'.join(lx.ANNOUNCEMENT_BANKS)})', 1) AS b FROM p8 WHERE body AND mode = 'announcement') WHERE b NOT IN ('', '银行') GROUP BY file),
 it AS (SELECT file, h2 AS ord, any_value(mode) AS mode, max(h1) AS h1, max(CASE WHEN o2 THEN CASE WHEN mode = 'field' THEN {sql_filled('value', 'x')} ELSE x END END) AS title, coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (body), '') AS raw_text,
   coalesce(arg_max(value, pos) FILTER (mode = 'field' AND label = '原文链接'), '') AS url FROM p8 GROUP BY file, h2),
 i2 AS (SELECT it.*, CASE WHEN mode = 'announcement' THEN coalesce(fb, '银行') || '公告' WHEN mode = 'field' THEN coalesce((SELECT any_value({sql_filled('p4.value', q('银行信息'))}) FROM p4 WHERE p4.file = it.file AND p4.pos = it.h1), '微信文章') ELSE (SELECT any_value(p4.x) FROM p4 WHERE p4.file = it.file AND p4.pos = it.h1) END AS ht
   FROM it LEFT JOIN fb USING (file) WHERE length({sql_strip('raw_text')}) >= 5 AND NOT contains(raw_text, '以上内容为广告')),
 kv AS (SELECT file, ord, k, arg_min(v, i) AS v FROM (SELECT file, ord, i, {sql_strip("regexp_extract(l, '^(.{1,16})[：:]\\s*(.+)', 1)")} AS k0, {sql_strip("regexp_extract(l, '^(.{1,16})[：:]\\s*(.+)', 2)")} AS v, coalesce({sql_map(lx.FIELD_ALIASES)}[k0], k0) AS k FROM (SELECT file, ord, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT file, ord, {sql_lines('raw_text')} AS ls FROM i2))
   WHERE regexp_matches(l, '^(.{{1,16}})[：:]\\s*(.+)')) WHERE v <> '' GROUP BY file, ord, k)
 SELECT i2.file, i2.ord, mode, {'CASE ' + ' '.join(f"WHEN contains(ht, {q(k)}) THEN {q(v)}" for k, v in lx.HEADING_CATEGORY.items()) + " ELSE '其他' END"} AS category, title,
  {sql_filled(f"regexp_extract(ht, {q('(' + '|'.join(lx.HEADING_BANKS) + ')')}, 1)", f"regexp_extract(array_to_string(string_split(raw_text, chr(10))[1:5], ' '), {q('(' + '|'.join(lx.HEADING_BANKS) + ')')}, 1)")} AS bank,
  coalesce(nullif(url, ''), (SELECT any_value(v) FROM kv WHERE kv.file = i2.file AND kv.ord = i2.ord AND k = '原文链接'), (SELECT any_value(v) FROM kv WHERE kv.file = i2.file AND kv.ord = i2.ord AND k = '来源'), '') AS url, raw_text,
  (SELECT count(DISTINCT k) FROM kv WHERE kv.file = i2.file AND kv.ord = i2.ord) AS n_fields FROM i2"""


def q_items(spark, sf):
    i = sg.headings_to_items(paragraphs(spark, sf))
    return i.select("file", F.col("ord").cast("bigint").alias("ord"), "mode", "category", "title", "bank", "url", "raw_text", F.size("structured").cast("bigint").alias("n_fields"))


def styled(spark, sf):
    p = paragraphs(spark, sf)
    return p.select("file", "pos", F.replace(F.replace("style", F.lit(" "), F.lit("")), F.lit("Normal"), F.lit("normal")).alias("style"), "text")


def q_styled(spark, sf):
    s = sg.styled_digest_items(styled(spark, sf))
    return s.select("file", F.col("pos").cast("bigint").alias("pos"), "category", "item", "role", "type", "prefix", "body", F.array_join("links", " ").alias("links"))


CLS = f"CASE WHEN regexp_matches(x, '^[▸•📌🗑🟡🔴⚪🆕📊📈🏦]') THEN 'bullet' WHEN regexp_matches(x, '^[^：:\\n]{{2,15}}[：:]') THEN 'semantic' ELSE 'paragraph' END"
LAB = sql_strip("regexp_extract(x, '^([^：:\\n]{2,15})[：:]', 1)")
SQL_STYLED = SQL_PARA + f""", s1 AS (SELECT file, pos, style, text AS x FROM pa), s2 AS (SELECT *, max(CASE WHEN style = 'Heading 1' THEN pos END) OVER w AS h1, max(CASE WHEN style = 'Heading 2' THEN pos END) OVER w AS h2 FROM s1 WINDOW w AS (PARTITION BY file ORDER BY pos)),
 s3 AS (SELECT *, h2 IS NOT NULL AND (h1 IS NULL OR h2 > h1) AS o2, {CLS} AS cls, {LAB} AS lab, {sql_strip("regexp_replace(" + LAB + ", '[🟡🔴⚪💡]', '', 'g')")} AS clean FROM s2 WHERE style NOT IN ('Heading 1', 'Heading 2') AND x <> '')
 SELECT s3.file, s3.pos, (SELECT any_value({sql_strip("regexp_replace(p.x, '[💡🆕📊📈🏦🟡🔴⚪▸🗑📌✅❌⚠️📢🎁]', '', 'g')")}) FROM s1 p WHERE p.file = s3.file AND p.pos = s3.h1) AS category, CASE WHEN o2 THEN (SELECT any_value(p.x) FROM s1 p WHERE p.file = s3.file AND p.pos = s3.h2) END AS item,
  CASE WHEN o2 THEN 'item' WHEN style = 'List Bullet' OR h1 IS NULL THEN 'standalone' ELSE 'preamble' END AS role, CASE WHEN style = 'List Bullet' THEN 'bullet' ELSE cls END AS type,
  CASE WHEN style <> 'List Bullet' AND cls = 'semantic' THEN coalesce({sql_map({k: s for k, s, _ in lx.LABEL_STYLES})}[clean], nullif(clean, ''), lab) ELSE '' END AS prefix,
  CASE WHEN style <> 'List Bullet' AND cls = 'semantic' THEN {sql_strip("regexp_replace(x, '^[^：:\\n]{2,15}[：:]', '')")} ELSE x END AS body,
  array_to_string(list_transform([regexp_extract_all(x, 'https?://[^\\s）)]+')], lambda u: list_filter(u, lambda y, i: list_position(u, y) = i))[1], ' ') AS links FROM s3"""


def four_src(spark, sf):
    d = notices(spark, sf).select(F.col("doc_id").cast("string").alias("file"), F.posexplode(F.split(F.replace(F.replace(F.replace("body", F.lit("适用人群："), F.lit("\n来源：")), F.lit("活动时间："), F.lit("\n核心内容：")), F.lit("权益"), F.lit("\n点评：")), "[！\n]")).alias("pos", "text"))
    return d.withColumn("text", F.when(F.startswith("text", F.lit("由原价")), F.concat(F.lit("本期总结"), "text")).when(F.startswith("text", F.lit("https")), F.concat(F.lit("原始链接"), "text")).otherwise(F.col("text")))


SQL_FOUR = f""", q1 AS (SELECT doc_id::VARCHAR AS file, i - 1 AS pos, {sql_strip("CASE WHEN starts_with(v, '由原价') THEN '本期总结' || v WHEN starts_with(v, 'https') THEN '原始链接' || v ELSE v END")} AS x FROM (SELECT doc_id, unnest(ls) AS v, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(replace(replace(replace(body, '适用人群：', chr(10) || '来源：'), '活动时间：', chr(10) || '核心内容：'), '权益', chr(10) || '点评：'), '[！\\n]') AS ls FROM notices))),
 q2 AS (SELECT *, min(pos) OVER (PARTITION BY file) AS lead, min(CASE WHEN NOT regexp_matches(x, '^(?:来源|核心内容|点评|本期|新卡|卡组织|年费|原始)') THEN pos END) OVER (PARTITION BY file) AS fst FROM q1 WHERE x <> ''),
 q3 AS (SELECT *, max(contains(x, '原始链接')::INT) OVER w AS lk, max(starts_with(x, '本期总结')::INT) OVER w AS su FROM q2 WHERE NOT (pos = lead AND pos = coalesce(fst, -1)) WINDOW w AS (PARTITION BY file ORDER BY pos)),
 q4 AS (SELECT *, coalesce(regexp_extract(x, '^(来源|核心内容|点评)[：:]', 1), '') AS label, {sql_strip("regexp_replace(CASE WHEN contains(x, '：') THEN regexp_replace(x, '(?s)^[^：]*：', '') ELSE x END, '(?s)^[^:]*:', '')")} AS value FROM q3 WHERE lk = 0 AND su = 0),
 q5 AS (SELECT *, sum((label = '')::INT) OVER (PARTITION BY file ORDER BY pos) AS item FROM q4)
 SELECT file, min(pos) AS ord, max(CASE WHEN label = '' THEN x END) AS title, coalesce(arg_max(value, pos) FILTER (label = '来源'), '') AS source, coalesce(arg_max(value, pos) FILTER (label = '核心内容'), '') AS core, coalesce(arg_max(value, pos) FILTER (label = '点评'), '') AS review FROM q5 WHERE item > 0 GROUP BY file, item"""

PUB = lambda: F.when(F.col("lang") == "fr", F.concat(F.lit("前言\n## 二、逐条保留\n"), F.replace("body", F.lit("，"), F.lit("\n### 3. ")))).otherwise(F.replace(F.replace("body", F.lit("！"), F.lit("\n### 4、 ")), F.lit("公告"), F.lit("\n来源：https://c.example.com/z)\n")))
PUB_SQL = "CASE lang WHEN 'fr' THEN '前言' || chr(10) || '## 二、逐条保留' || chr(10) || replace(body, '，', chr(10) || '### 3. ') ELSE replace(replace(body, '！', chr(10) || '### 4、 '), '公告', chr(10) || '来源：https://c.example.com/z)' || chr(10)) END"
SQL_PUB = f""", u1 AS (SELECT doc_id, {PUB_SQL} AS tx FROM notices), u2 AS (SELECT doc_id, CASE WHEN regexp_matches(tx, '(?m)^[ \\t]*## [^\\n]*逐条') THEN regexp_extract(tx, '(?ms)^[ \\t]*## [^\\n]*逐条[^\\n]*\\n(.*)$', 1) ELSE tx END AS tx FROM u1),
 u3 AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(CASE WHEN regexp_matches(tx, '(?m)^[ \\t]*## [^\\n]*逐条') THEN substr(tx, instr(tx, '逐条')) ELSE tx END, chr(10)) AS ls FROM u1)),
 u4 AS (SELECT *, regexp_matches(l, '^[ \\t]*###[ \\t]+\\d+[.、][ \\t]+') AS st, regexp_matches(l, '^[ \\t]*##[ \\t]+') AS h2 FROM u3),
 u5 AS (SELECT *, sum(st::INT) OVER (PARTITION BY doc_id ORDER BY i) AS it FROM u4), u6 AS (SELECT *, max(h2::INT) OVER (PARTITION BY doc_id, it ORDER BY i) AS cut FROM u5 WHERE it > 0),
 u7 AS (SELECT doc_id, it - 1 AS ord, max(CASE WHEN st THEN {sql_strip("regexp_replace(regexp_replace(trim(l), '^###\\s+', ''), '^[一二三四五六七八九十0-9]+[、.．]\\s*', '')")} END) AS title,
   {sql_strip("coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT st AND NOT regexp_matches(" + sql_strip('l') + ", '^\\*{0,2}来源\\*{0,2}\\s*[：:]') AND NOT starts_with(" + sql_strip('l') + ", '**来源')), '')")} AS body,
   coalesce(arg_max(regexp_extract({sql_strip('l')}, '^\\*{{0,2}}来源\\*{{0,2}}\\s*[：:]\\s*(https?://\\S+)', 1), i) FILTER (NOT st AND regexp_matches({sql_strip('l')}, '^\\*{{0,2}}来源\\*{{0,2}}\\s*[：:]\\s*https?://\\S+')), '') AS su FROM u6 WHERE cut = 0 GROUP BY doc_id, it)
 SELECT doc_id, ord::BIGINT AS ord, title, coalesce(nullif({sql_strip("regexp_extract(body, '\\*\\*属性\\*\\*\\s*[：:]\\s*([^｜|\\n]+)', 1)")}, ''), nullif({sql_strip("regexp_extract(body, '\\*\\*类别\\*\\*\\s*[：:]\\s*([^\\n]+)', 1)")}, ''), '其他') AS category, body, rtrim(su, ')') AS source_url FROM u7"""


def q_publish(spark, sf):
    p = sg.extract_publish_items(notices(spark, sf).withColumn("tx", PUB()), "doc_id", "tx")
    return p.withColumn("ord", F.col("ord").cast("bigint"))


def q_raw(spark, sf):
    # sentence starts become institution + action, so that boundaries occur
    d = notices(spark, sf).withColumn("body", F.regexp_replace("body", "。[A-Z][a-z]+ ", "。招行新增"))
    s = sg.split_raw_text(d, "doc_id", "body")
    return s.select("doc_id", "topic_no", "headline", "body", F.array_join("bank_hints", ",").alias("bank_hints"))


WSC = r"[\s\x0b\x85\p{Z}]"
OPENING = f"(?:{any_of(lx.HINT_BANKS)})(?:{any_of(lx.BOUNDARY_ACTIONS)})"


def split_raw_sql(src, name="rw"):
    """CTEs ending in {name}(id, topic_no, headline, body, bank_hints) over src(id, raw); every fold is a list_reduce whose
    accumulator has the type of its elements."""
    gaps = lambda parts: f"list_transform(range(1, len({parts})), lambda i: list_sum(list_transform({parts}[1:i], lambda x: length(x)))::BIGINT)"
    stops = ", ".join(f"instr(snip, {q(m)}) - 1" for m in lx.BOUNDARY_STOPS)
    cut20 = "CASE WHEN length(h) <= 20 THEN h WHEN regexp_matches(substr(h, 20, 1), '[一-鿿]') THEN substr(h, 1, 20) ELSE substr(h, 1, 18) END"
    lead_heading = f"""list_transform([substr(raw, p + 1, 60)], lambda snip: list_transform([rtrim({sql_strip(f"substr(snip, 1, coalesce(list_min(list_filter([{stops}], lambda s: s > 0 AND s >= length(regexp_extract(snip, {q('^' + WSC + '*(' + OPENING + ')')}, 1)) AND s < 60)), CASE WHEN instr(snip, '。') - 1 BETWEEN 1 AND 59 THEN instr(snip, '。') - 1 END, least(30, length(snip))))")}, '。，')], lambda h: {cut20})[1])[1]"""
    found = ", ".join(f"list_transform([string_split(raw, {q(k)})], lambda ps: list_transform({gaps('ps')}, lambda g, i: {{'n': {n}, 'k': {q(k)}, 'p': g + (i - 1) * {len(k)}, 'low': 0::BIGINT, 'bounds': CAST([] AS STRUCT(place BIGINT, heading VARCHAR)[])}}))[1]" for n, k in enumerate(lx.BOUNDARY_HEADINGS))
    low = "(CASE WHEN a.n <> o.n THEN CASE WHEN len(a.bounds) > 0 THEN 100 ELSE 0 END ELSE a.low END)"
    snip = "substr(raw, greatest(0, o.p - 15) + 1, 60)"
    end = f"least(CASE WHEN instr({snip}, '。') > 0 THEN instr({snip}, '。') - 1 ELSE 60 END, CASE WHEN instr({snip}, chr(10)) > 0 THEN instr({snip}, chr(10)) - 1 ELSE 60 END)"
    grown = f"list_sort(list_append(a.bounds, {{'place': greatest(0, o.p - 15), 'heading': CASE WHEN {end} > 0 THEN {sql_strip(f'substr({snip}, 1, {end} + 1)')} ELSE o.k END}}))"
    return f"""{name}1 AS (SELECT id, replace(raw, chr(0), '') AS raw FROM {src}), {name}2 AS (SELECT id, raw, string_split(regexp_replace(raw, {q('([。？！' + chr(10) + '])(' + WSC + '*' + OPENING + ')')}, '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS ps FROM {name}1 WHERE length(raw) >= 200),
 {name}3 AS (SELECT id, raw, list_transform({gaps('ps')}, lambda p: [p]) AS lp FROM {name}2), {name}4 AS (SELECT id, raw, CASE WHEN len(lp) = 0 THEN [] ELSE list_reduce(lp, lambda a, b: CASE WHEN b[1] - a[-1] > 50 THEN list_concat(a, b) ELSE a END) END AS lp FROM {name}3),
 {name}5 AS (SELECT id, raw, list_transform(lp, lambda p: {{'place': p, 'heading': {lead_heading}}}) AS leads, flatten([{found}]) AS fo FROM {name}4),
 {name}6 AS (SELECT id, raw, list_reduce(list_prepend({{'n': -1, 'k': '', 'p': 0::BIGINT, 'low': 0::BIGINT, 'bounds': leads}}, fo), lambda a, o: {{'n': o.n, 'k': o.k, 'p': o.p, 'low': CASE WHEN o.p >= {low} THEN o.p + 100 ELSE {low} END,
   'bounds': CASE WHEN o.p >= {low} AND (len(a.bounds) = 0 OR abs(o.p - a.bounds[-1].place) >= 50) THEN {grown} ELSE a.bounds END}}).bounds AS bs FROM {name}5),
 {name}7 AS (SELECT id, raw, CASE WHEN len(bs) = 0 THEN [] ELSE list_reduce(list_transform(bs, lambda b: [b]), lambda a, b: CASE WHEN b[1].place - a[-1].place > 80 THEN list_concat(a, b) ELSE a END) END AS far FROM {name}6),
 {name}8 AS (SELECT id, list_transform(far, lambda b, i: {{'headline': rtrim({sql_strip('b.heading')}, '。，'), 'body': {sql_strip('substr(raw, b.place + 1, coalesce(far[i + 1].place, length(raw)) - b.place)')}}}) AS pc FROM {name}7 WHERE len(far) >= 2),
 {name}9 AS (SELECT id, list_transform(pc, lambda p: [{{'headline': p.headline, 'body': p.body, 'hints': {sql_hits('substr(p.body, 1, 200)', lx.HINT_BANKS)}}}]) AS pc FROM {name}8),
 {name}10 AS (SELECT id, list_reduce(pc, lambda a, b: CASE WHEN length(b[1].body) < 60 THEN list_append(a[:-2], {{'headline': a[-1].headline, 'body': a[-1].body || chr(10) || b[1].body, 'hints': list_concat(a[-1].hints, list_filter(b[1].hints, lambda h: NOT list_contains(a[-1].hints, h)))}}) ELSE list_concat(a, b) END) AS tp FROM {name}9),
 {name} AS (SELECT id, i::INTEGER AS topic_no, tp[i].headline AS headline, tp[i].body AS body, tp[i].hints AS bank_hints FROM {name}10, unnest(range(1, len(tp) + 1)) AS u(i) WHERE len(tp) >= 2)"""


SQL_RAW = f", rs AS (SELECT doc_id AS id, regexp_replace(body, '。[A-Z][a-z]+ ', '。招行新增', 'g') AS raw FROM notices), {split_raw_sql('rs')} SELECT id AS doc_id, topic_no, headline, body, array_to_string(bank_hints, ',') AS bank_hints FROM rw"

ENTRIES = {
    "topic_starts": (lambda s, d: sg.topic_starts(blocks(s, d)).select("article_id", F.col("pos").cast("bigint").alias("pos"), "is_start"), sql_over_notices(f"SELECT article_id, pos, {START} AS is_start FROM bk", SQL_BLOCKS)),
    "multi_topic_signals": (q_signals, sql_over_notices("", SIGNALS)),
    "segment_topics": (q_topics, sql_over_notices("SELECT * FROM ou", TOPICS)),
    "merge_small_topics": (q_merge_small, SQL_MERGE_SMALL),
    "split_raw_text": (q_raw, sql_over_notices("", SQL_RAW)),
    "headings_to_items": (q_items, sql_over_notices("", SQL_ITEMS)),
    "parse_modes": (lambda s, d: sg.parse_modes(paragraphs(s, d)), sql_over_notices("SELECT file, mode FROM md", SQL_MODES)),
    "styled_digest_items": (q_styled, sql_over_notices("", SQL_STYLED)),
    "four_part_items": (lambda s, d: sg.four_part_items(four_src(s, d)).withColumn("ord", F.col("ord").cast("bigint")), sql_over_notices("", SQL_FOUR)),
    "extract_publish_items": (q_publish, sql_over_notices("", SQL_PUB)),
}
