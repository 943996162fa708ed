"""Reader queries. Files are written from the tables into the scratch folder first and read back by the operator."""

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions.expr import strip
from ...sources import html as hx
from ...sources import readers as rd
from ...sources import scratch
from ...sources import sinks as sk
from .base import WS, notices, q, sql_any, sql_filled, sql_lines, sql_list, sql_over_notices, sql_strip, table
from .texts import ECHO_SQL, PAGE_SQL, TITLE_RULE

b = lambda k: F.col(k).cast("bigint").alias(k)


def items(spark, sf):
    d = notices(spark, sf)
    return d.select(F.col("doc_id").cast("string").alias("item_id"), F.col("lang").alias("source"), F.col("raw_category").alias("category"), F.col("source").alias("bank"), "title", "url", F.col("body").alias("raw_text"), "images",
                    F.create_map(F.lit("k"), F.col("author")).alias("structured"), "author", "publish_time", F.concat(F.lit("批/"), F.substring("publish_time", 1, 7)).alias("batch_label"))


def staged_text(spark, sf, name, build):
    """Text lines written once; returns their folder."""
    key = f"text|{name}|{sf}"
    if key not in _PATHS or _PATHS[key][0] != spark.sparkContext.applicationId:
        path = scratch.fresh(spark, name)
        build().write.text(path)
        _PATHS[key] = (spark.sparkContext.applicationId, path)
    return _PATHS[key][1]


_PATHS = {}


def q_batch(spark, sf):
    path = staged_text(spark, sf, "batches", lambda: sk.batch_documents(items(spark, sf), "2024-06-01T00:00:00"))
    return rd.read_batch_json(spark, path, multi_line=False).select("batch_label", "item_id", "category", "bank", "title", "author", F.size("images").cast("bigint").alias("n_images"))


def q_raw(spark, sf):
    d = notices(spark, sf)
    art = F.struct("title", F.col("body").alias("text"), "author")
    v = (F.when(F.col("lang") == "en", F.to_json(F.array(art.withField("url", F.col("url"))))).when(F.col("lang") == "fr", F.to_json(art.withField("url", F.col("url")))).otherwise(F.to_json(F.create_map("url", art))))
    path = staged_text(spark, sf, "articles", lambda: d.select(v.alias("value")))
    return rd.read_raw_articles(spark, path, whole=False).select("url", "title", "text", "author")


def q_notices(spark, sf):
    d = notices(spark, sf)
    n1 = F.struct("title", "url", F.col("body").alias("content"), F.col("publish_time").alias("date"))
    n2 = F.struct(F.col("title").alias("公告标题"), F.col("url").alias("公告URL"), F.col("body").alias("公告内容"), F.col("publish_time").alias("date_str"))
    v = (F.when(F.col("lang") == "en", F.to_json(F.struct(F.array(n1).alias("items")))).when(F.col("lang") == "fr", F.to_json(F.struct(F.array(n2).alias("announcements")))).when(F.col("lang") == "de", F.to_json(F.array(n2))).otherwise(F.to_json(n1)))
    path = staged_text(spark, sf, "notice-json", lambda: d.select(v.alias("value")))
    return rd.read_notices(spark, path, whole=False).select("title", "url", "content", "publish_time")


def q_api(spark, sf):
    d = notices(spark, sf)
    row = F.struct(F.col("doc_id").cast("string").alias("id"), "title", F.replace("publish_time", F.lit("."), F.lit("-")).alias("time"), F.concat(F.lit("<p>"), "source", F.lit("</p>")).alias("details"))
    v = F.to_json(F.struct(F.struct(F.array(row, row.withField("title", F.lit(""))).alias("list")).alias("data")))
    path = staged_text(spark, sf, "api", lambda: d.select(v.alias("value")))
    r = rd.parse_notice_api(spark.read.text(path), "https://x.example.com/contentDetail")
    return r.select("title", "date", "link", hx.plain("body_html").alias("body"))


def q_decode(spark, sf):
    d = notices(spark, sf)

    def gbk(batches):
        for pdf in batches:
            yield pdf[["doc_id"]].assign(content=[t.encode("gb18030") for t in pdf["t"]])
    t = F.concat(F.lit("银行"), "title", "source", "body")
    bad = d.filter("lang = 'de'").select("doc_id", t.alias("t")).mapInPandas(gbk, "doc_id long, content binary")
    good = d.filter("lang <> 'de'").select("doc_id", F.encode(F.concat(F.when(F.col("lang") == "fr", "﻿").otherwise(""), t), "utf-8").alias("content"))
    return rd.decode_fallback(good.unionByName(bad)).select("doc_id", F.col("text").alias("out"))


def q_md(spark, sf):
    d = notices(spark, sf).select(F.concat(F.lit("f/"), F.col("doc_id").cast("string"), F.lit("_20240101.md")).alias("file"), F.replace("body", F.lit("；"), F.lit("\n## 1、")).alias("content"))
    m = rd.parse_markdown_items(d)
    return m.select("file", "doc_title", b("ord"), "title", "display_title", "key", "category", "source_url", "comment", "source_date", "body", F.array_join("images", ",").alias("images"))


MD = f""", md AS (SELECT 'f/' || doc_id || '_20240101.md' AS file, replace(body, '；', chr(10) || '## 1、') AS t, doc_id || '_20240101' AS stem FROM notices),
 mh AS (SELECT *, CASE WHEN regexp_matches(t, '(?m)^# ') THEN {sql_strip("regexp_extract(t, '(?m)^# (.*)$', 1)")} ELSE stem END AS h FROM md),
 ml AS (SELECT file, h, stem, t, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT *, string_split(t, chr(10)) AS ls FROM mh)),
 ms AS (SELECT *, sum(starts_with(l, '## ')::INT) OVER (PARTITION BY file ORDER BY i) AS s FROM ml),
 mi AS (SELECT file, any_value(h) AS doc_title, any_value(stem) AS stem, any_value(t) AS t, s - 1 AS ord, {sql_strip("regexp_replace(arg_min(l, i), '^##\\s+', '')")} AS title, {sql_strip("coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT starts_with(l, '## ')), '')")} AS body FROM ms WHERE s > 0 GROUP BY file, s),
 mk AS (SELECT *, lower(regexp_replace(regexp_replace(title, '^{WS}*[一二三四五六七八九十0-9]+[、.．]{WS}*', ''), {q(r"""[\s\x0b\x85\p{Z}·•：:，,。！!？?（）()【】\[\]‘’“”"'_-]+""")}, '', 'g')) AS key FROM mi)
 SELECT file, doc_title, ord::BIGINT AS ord, title, regexp_replace(title, '^[一二三四五六七八九十0-9]+[、.．]\\s*', '') AS display_title, key, {sql_strip("regexp_extract(body, '(?i)\\*{0,2}类别\\*{0,2}\\s*[:：]\\s*\\*{0,2}([^\\n]+)', 1)")} AS category,
  {sql_strip("regexp_extract(body, '(?i)\\*{0,2}来源\\*{0,2}\\s*[:：]\\s*\\*{0,2}([^\\n]+)', 1)")} AS source_url, {sql_strip("regexp_extract(regexp_extract(body, '(?ms)^###?\\s*点评\\s*\\n(.*)', 1), '(?ms)\\A(.*?)(?:^#{1,4}\\s|\\z)', 1)")} AS comment,
  {sql_filled("regexp_extract(doc_title || chr(10) || t, '20\\d{2}[.年/-]\\s*\\d{1,2}[.月/-]\\s*\\d{1,2}')", "right(stem, 8)")} AS source_date, body, array_to_string(regexp_extract_all(body, '!\\[[^\\]]*\\]\\(([^)]+)\\)', 1), ',') AS images FROM mk WHERE key NOT IN ('总结', '目录', '参考资料')"""


def q_fm(spark, sf):
    d = notices(spark, sf)
    c = F.concat(F.lit('---\ntitle: "'), F.regexp_replace("title", "[\n\"']", ""), F.lit('"\ndate: '), "publish_time", F.lit('\ntags: ["'), "lang", F.lit('", "'), "source", F.lit('"]\ndraft: '), F.when(F.col("lang") == "es", "True").otherwise("false"), F.lit("\n---\n"), "body")
    f = rd.parse_front_matter(d.select("doc_id", c.alias("content")))
    return f.select("doc_id", "title", "date", F.array_join("tags", ",").alias("tags"), "draft")


def q_rss(spark, sf):
    """Every file part is one well-formed feed."""
    d = notices(spark, sf)
    safe = lambda x: F.regexp_replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    item = F.concat(F.lit("<item><title>"), safe(F.concat(F.col("doc_id").cast("string"), F.lit(" "), "source")), F.lit("</title><link>"), "url", F.lit("</link><pubDate>"), "publish_time", F.lit("</pubDate><description>"), safe(F.col("body")), F.lit("</description><guid>"), F.col("doc_id").cast("string"), F.lit("</guid></item>"))

    def feed(batches):
        yield pd.DataFrame({"value": ["<rss><channel>"]})
        for pdf in batches:
            yield pdf[["value"]]
        yield pd.DataFrame({"value": ["</channel></rss>"]})
    path = staged_text(spark, sf, "rss", lambda: d.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").select(item.alias("value")).mapInPandas(feed, "value string"))
    return rd.read_rss_items(spark, path).select("title", "url", "pub_date", "guid", F.coalesce("description", F.lit("")).alias("description"))


def q_kb(spark, sf):
    d = notices(spark, sf)
    e = F.struct(F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("article_id"), F.col("body").alias("text"), F.col("title"), F.array("lang").alias("banks"))
    path = staged_text(spark, sf, "kbjson", lambda: d.select(F.to_json(F.struct(F.array(e).alias("entries"))).alias("value")))
    return rd.read_kb(spark, path, multi_line=False).select("id", "article_id", "text", "title")


def q_pages_text(spark, sf):
    return hx.html_pages_to_text(scratch.spread(spark, table(spark, sf, "pages")))


def unesc(e):
    for a, v in (("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", chr(160)), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        e = f"replace({e}, {q(a)}, {q(v)})"
    return e


def gone(e, tags):
    for t in tags:
        e = f"regexp_replace({e}, '(?s)<{t}[ >].*?</{t}>', chr(10), 'g')"
    return e


TXT = gone("regexp_replace(html, '(?s)<!--.*?-->', chr(10), 'g')", ["script", "style", "nav", "header", "footer", "aside", "noscript", "title"])
PT = f"(SELECT page_id, {sql_strip(unesc(chr(114) + 'egexp_extract(html, ' + q('(?s)<title>(.*?)</title>') + ', 1)'))} AS title, array_to_string({sql_lines(unesc('regexp_replace(' + TXT + ', ' + q('<[^>]*>') + ', chr(10), ' + q('g') + ')'))}, chr(10)) AS body FROM pages)"


def staged_sql(view, stages):
    for i, e in enumerate(stages, 1):
        view = f"(SELECT *, {e} AS t{i} FROM {view})"
    return view


SQL_PAGES = f"SELECT page_id, title, t4 AS text FROM {staged_sql('(SELECT page_id, title, t3 AS body FROM ' + staged_sql(PT, PAGE_SQL) + ')', tuple(e.replace('ttl', 'title') for e in ECHO_SQL))}"


def shaped(spark, sf):
    """Pages with the ids of an article page and a lazily loaded image per page."""
    d = scratch.spread(spark, table(spark, sf, "pages"))
    h = F.replace(F.replace(F.replace("html", F.lit("<h1>"), F.lit('<h1 class="rich_media_title">')), F.lit("<article>"), F.concat(F.lit('<div id="js_content"><img data-src="https://i.example.com/'), F.col("page_id").cast("string"), F.lit('.png" src="data:x"><img src="data:y">'))), F.lit("</article>"), F.lit("</div>"))
    return d.select("page_id", "url", h.alias("html"))


def q_fields(spark, sf):
    return hx.html_article_fields(shaped(spark, sf)).select("page_id", "title", "text", F.array_join("images", ",").alias("images"))


ART = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
flat_text = lambda e: sql_strip(f"regexp_replace({unesc('regexp_replace(' + e + ', ' + q('<[^>]*>') + ', ' + q(' ') + ', ' + q('g') + ')')}, '{WS}+', ' ', 'g')")
SQL_FIELDS = f"SELECT page_id, {sql_strip(unesc('regexp_extract(html, ' + q('(?s)<h1>(.*?)</h1>') + ', 1)'))} AS title, {flat_text(ART)} AS text, 'https://i.example.com/' || page_id || '.png' AS images FROM pages"


def q_detail(spark, sf):
    p = shaped(spark, sf).withColumn("source", F.when(F.contains("url", F.lit("/en/")), "a").otherwise("b"))
    rules = spark.range(2).select(F.when(F.col("id") == 0, "a").otherwise("b").alias("source"), F.when(F.col("id") == 0, "h1").otherwise("h6").alias("title_sel"), F.lit(".date").alias("date_sel"), F.when(F.col("id") == 0, "#js_content").otherwise(".none").alias("content_sel"),
                                  F.array(F.lit("b"), F.lit("h1")).alias("remove_sel"), F.array().cast("array<string>").alias("start_markers"), F.array(F.lit("©")).alias("end_markers"))
    return hx.html_detail_fields(p, rules)


def q_links(spark, sf):
    return hx.html_links(table(spark, sf, "pages")).select("page_id", b("pos"), "title", "link", "date")


BASE = "regexp_replace(url, '[?#].*$', '')"
HREFS = """SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS inner_html, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>(.*?)</a>')))) AS pos FROM pages"""
FULL = f"CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN starts_with(href, '/') THEN regexp_extract({BASE}, '^(https?://[^/]+)', 1) || href ELSE regexp_extract({BASE}, '^(https?://[^/]+/(?:.*/)?)', 1) || href END"
SQL_LINKS = f"SELECT page_id, min(pos) AS pos, arg_min(title, pos) AS title, link, '' AS date FROM (SELECT page_id, pos, trim({flat_text('inner_html')}, ' ·∙•●◦') AS title, {FULL} AS link, href FROM ({HREFS})) WHERE href <> '' AND NOT regexp_matches(href, '(?i)^(#|javascript)') AND length(title) >= 1 GROUP BY page_id, link"


def q_rows(spark, sf):
    return hx.html_list_rows(table(spark, sf, "pages"), lengths=(3, 120)).select("page_id", b("pos"), "title", "link", "date")


SQL_ROWS = SQL_LINKS.replace("length(title) >= 1", "length(title) BETWEEN 3 AND 120 AND rtrim(link, '/') <> rtrim(regexp_replace(url, '', ''), '/')").replace("AS link, href FROM", "AS link, href, url FROM")

# ---- Word packages built from the bulletins ------------------------------------------

PNG = bytes.fromhex("89504e470d0a1a0a")


def packages(spark, sf):
    """One small Word package per bulletin: its lines as paragraphs, a table, two images (equal for equal titles)."""
    d = notices(spark, sf).select("doc_id", F.col("source"), F.split(F.regexp_replace("body", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), "\n").alias("ls"), F.col("title"), "url")

    schema = rd.arrow_schema("path string, content binary")

    def package(r):
        ps = []
        for l in r["ls"]:
            style = "Heading1" if l.startswith("# ") else "Heading2" if l.startswith("## ") else "ListBullet" if l.startswith("- ") else ""
            ps.append("<w:p>" + (f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else "") + f'<w:r><w:t xml:space="preserve">{escape(l)}</w:t></w:r></w:p>')
        ps.append(f'<w:p><w:hyperlink r:id="rId9"><w:r><w:t>原文</w:t></w:r></w:hyperlink></w:p>')
        cell = lambda t: f"<w:tc><w:tcx><w:r><w:t>{escape(t)}</w:t></w:r></w:tcx></w:tc>"
        tbl = f"<w:tbl><w:tr>{cell(r['source'])}{cell(str(r['doc_id']))}</w:tr><w:tr>{cell('')}{cell('')}</w:tr></w:tbl>"
        rel = f'<Relationships><Relationship Id="rId9" Target="{escape(r["url"])}"/><Relationship Id="rId2" Target="media/a.png"/><Relationship Id="rId3" Target="media/b.bin"/></Relationships>'
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("word/document.xml", "<w:document>" + "".join(ps) + tbl + "</w:document>")
            z.writestr("word/_rels/document.xml.rels", rel)
            z.writestr("word/media/a.png", PNG + r["title"].encode())
            z.writestr("word/media/b.bin", b"GIF89a" + r["source"].encode())
        return str(r["doc_id"]), buf.getvalue()

    def build(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            yield from rd.in_parts((package({k: v[i].as_py() for k, v in columns.items()}) for i in range(len(batch))), schema)
    return d.mapInArrow(build, "path string, content binary")


def q_docx(spark, sf):
    p = rd.read_docx_paragraphs(packages(spark, sf))
    return p.select("path", b("pos"), "style", "text", F.array_join(F.transform("links", lambda l: l["url"]), ",").alias("links"), "has_img")


DOCX = f""", dl AS (SELECT doc_id, url, i, l FROM (SELECT doc_id, url, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, url, list_concat(string_split(body, chr(10)), ['原文']) AS ls FROM notices)) WHERE {sql_strip('l')} <> ''),
 dp AS (SELECT doc_id::VARCHAR AS path, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, CASE WHEN l = '原文' THEN 'normal' WHEN starts_with(l, '# ') THEN 'Heading1' WHEN starts_with(l, '## ') THEN 'Heading2' WHEN starts_with(l, '- ') THEN 'ListBullet' ELSE 'normal' END AS style, {sql_strip('l')} AS text, CASE WHEN l = '原文' AND i = max(i) OVER (PARTITION BY doc_id) THEN url ELSE '' END AS links FROM dl)"""


def q_docx_tables(spark, sf):
    return rd.read_docx_tables(packages(spark, sf)).select("path", b("tbl"), b("row"), b("cell"), "text")


def q_docx_images(spark, sf):
    return rd.read_docx_images(packages(spark, sf)).select("path", "rid", "name", "digest")


def q_stats(spark, sf):
    p = scratch.stage_once(spark, f"docx|{sf}", lambda: packages(spark, sf))
    return rd.docx_stats(rd.read_docx_paragraphs(p), rd.read_docx_tables(p), rd.read_docx_images(p)).select("path", "paragraphs", "heading", "listbullet", "normal", "tables", "images")


def q_image(spark, sf):
    """A header per bulletin: PNG, JPEG with two segments before its frame, extended WebP, GIF, by language."""
    d = notices(spark, sf)
    w, h = (F.col("n_chars") % 65535 + 1).cast("int"), (F.col("doc_id") % 4000 + 1).cast("int")
    hx = lambda v, n: F.lpad(F.hex(v), 2 * n, "0")
    le = lambda v, n: F.concat(*[F.substring(hx(v, n), 2 * i + 1, 2) for i in reversed(range(n))])
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), hx(w, 4), hx(h, 4), F.lit("0802000000"))
    jpeg = F.concat(F.lit("FFD8FFE000104A46494600010100000100010000FFFFDB0004C0FFFFC2001108"), hx(h, 2), hx(w, 2), F.lit("03011100021100031100FFDA"))
    webp = F.concat(F.lit("524946460000000057454250565038580A00000010000000"), le(w - 1, 3), le(h - 1, 3))
    gif = F.concat(F.lit("474946383961"), le(w, 2), le(h, 2), F.lit("00"))
    bytes_ = F.when(F.col("lang") == "en", png).when(F.col("lang") == "fr", jpeg).when(F.col("lang") == "de", webp).otherwise(gif)
    m = rd.image_meta(d.select("doc_id", F.unhex(bytes_).alias("content")))
    return m.select("doc_id", "format", "mode", "width", "height", F.col("bytes").cast("int").alias("bytes"))


def q_tables(spark, sf):
    d = notices(spark, sf).select("doc_id", F.replace(F.replace("body", F.lit("，"), F.lit(" | ")), F.lit("。"), F.lit("\n|---|---|\n")).alias("content"))
    return rd.markdown_tables(d).select("doc_id", b("line"), "is_header", F.array_join("cells", "¦").alias("cells"))


SQL_TABLES = f""", tl AS (SELECT doc_id, unnest(ls) AS t, generate_subscripts(ls, 1) - 1 AS line FROM (SELECT doc_id, string_split(replace(replace(body, '，', ' | '), '。', chr(10) || '|---|---|' || chr(10)), chr(10)) AS ls FROM notices)),
 tm AS (SELECT *, contains(t, '|') AND trim(t) <> '' AS piped, coalesce(regexp_matches(lead(t) OVER (PARTITION BY doc_id ORDER BY line), '^\\s*\\|?\\s*:?-{{3,}}'), false) AS nx FROM tl),
 tn AS (SELECT *, max(CASE WHEN piped AND nx THEN line END) OVER w AS h, max(CASE WHEN NOT piped THEN line END) OVER w AS gap FROM tm WINDOW w AS (PARTITION BY doc_id ORDER BY line))
 SELECT doc_id, line, piped AND nx AS is_header, array_to_string(list_transform(string_split(trim({sql_strip('t')}, '|'), '|'), lambda x: {sql_strip('x')}), '¦') AS cells FROM tn WHERE h IS NOT NULL AND piped AND coalesce(gap, -1) < h AND line <> h + 1"""

ENTRIES = {
    "read_batch_json": (q_batch, sql_over_notices("SELECT '批/' || substr(publish_time, 1, 7) AS batch_label, doc_id::VARCHAR AS item_id, raw_category AS category, source AS bank, title, author, len(images) AS n_images FROM notices")),
    "read_raw_articles": (q_raw, sql_over_notices("SELECT url, title, body AS text, author FROM notices")),
    "read_notices": (q_notices, sql_over_notices("SELECT title, url, body AS content, publish_time FROM notices")),
    "read_notice_api_json": (q_api, sql_over_notices(f"SELECT {TITLE_RULE(sql_strip('regexp_replace(title, ' + q(WS + '+') + ', ' + q(' ') + ', ' + q('g') + ')'))} AS title, replace(publish_time, '.', '-') AS date, 'https://x.example.com/contentDetail?id=' || doc_id || '&menuId=9999&listId=9999' AS link, source AS body FROM notices WHERE title <> '' AND publish_time <> ''")),
    "decode_fallback": (q_decode, sql_over_notices("SELECT doc_id, '银行' || title || source || body AS out FROM notices")),
    "read_markdown_items": (q_md, sql_over_notices("", MD)),
    "read_front_matter": (q_fm, sql_over_notices(f"SELECT doc_id, {'regexp_replace(title, ' + q('[' + chr(10) + chr(34) + chr(39) + ']') + ', ' + q('') + ', ' + q('g') + ')'} AS title, publish_time AS date, lang || ',' || source AS tags, lang = 'es' AS draft FROM notices")),
    "read_rss_items": (q_rss, sql_over_notices("SELECT doc_id || ' ' || source AS title, url, publish_time AS pub_date, doc_id::VARCHAR AS guid, regexp_replace(regexp_replace(body, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS description FROM notices")),
    "read_kb": (q_kb, sql_over_notices("SELECT 'a' || doc_id AS id, source AS article_id, body AS text, title FROM notices")),
    "html_pages_to_text": (q_pages_text, SQL_PAGES),
    "html_article_fields": (q_fields, SQL_FIELDS),
    "html_detail_fields": (q_detail, None),
    "html_links": (q_links, SQL_LINKS),
    "html_list_rows": (q_rows, SQL_ROWS),
    "read_docx_paragraphs": (q_docx, sql_over_notices("SELECT path, pos, style, text, links, false AS has_img FROM dp", DOCX)),
    "read_docx_tables": (q_docx_tables, sql_over_notices("SELECT doc_id::VARCHAR AS path, 0::BIGINT AS tbl, 0::BIGINT AS row, c::BIGINT AS cell, CASE c WHEN 0 THEN source ELSE doc_id::VARCHAR END AS text FROM notices, (VALUES (0), (1)) t(c)")),
    "read_docx_images": (q_docx_images, sql_over_notices("SELECT path, rid, substr(digest, 1, 12) || CASE rid WHEN 'rId2' THEN '.png' ELSE '.gif' END AS name, digest FROM (SELECT doc_id::VARCHAR AS path, 'rId2' AS rid, md5(unhex('89504e470d0a1a0a') || encode(title)) AS digest FROM notices UNION ALL SELECT doc_id::VARCHAR, 'rId3', md5('GIF89a' || source) FROM notices)")),
    "docx_stats": (q_stats, sql_over_notices("SELECT path, count(*) AS paragraphs, count(*) FILTER (starts_with(style, 'Heading')) AS heading, count(*) FILTER (style = 'ListBullet') AS listbullet, count(*) FILTER (style = 'normal') AS normal, 1::BIGINT AS tables, 2::BIGINT AS images FROM dp GROUP BY path", DOCX)),
    "image_meta": (q_image, sql_over_notices("SELECT doc_id, CASE lang WHEN 'en' THEN 'PNG' WHEN 'fr' THEN 'JPEG' WHEN 'de' THEN 'WEBP' ELSE 'GIF' END AS format, CASE lang WHEN 'en' THEN 'RGB' WHEN 'fr' THEN 'RGB' WHEN 'de' THEN 'RGBA' ELSE 'P' END AS mode, "
                                             "(n_chars % 65535 + 1)::INTEGER AS width, (doc_id % 4000 + 1)::INTEGER AS height, CASE lang WHEN 'en' THEN 29 WHEN 'fr' THEN 48 WHEN 'de' THEN 30 ELSE 11 END::INTEGER AS bytes FROM notices")),
    "markdown_tables": (q_tables, sql_over_notices("", SQL_TABLES)),
}
