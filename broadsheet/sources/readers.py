"""Readers: JSON shapes, notices, Markdown, front matter, feeds, archives, encodings, Word packages, images."""

import io
import re
import zipfile
from html import unescape
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import lexicon as lx
from ..functions.expr import c, first_filled, lit_map, nz, strip, text
from ..functions.fields import doc_meta_values, extract_comment, extract_date, extract_date_loose
from ..functions.text import clean_title, strip_heading_prefix, title_key

ITEM = ("item_id string, source string, category string, bank string, title string, url string, raw_text string, images array<string>, structured map<string,string>, "
        "author string, publish_time string")
BATCH = f"schema_version string, generated_at string, batch_label string, total bigint, items array<struct<{re.sub(r'(\w+) ', r'\1:', ITEM)}>>"
ARTICLE = "url string, title string, original_title string, text string, full_text string, content_text string, summary string, author string, account_name string, publish_time string, category string, bank string, images array<string>"


def read_batch_json(spark, path, multi_line=True):
    """Item rows of batch files {header, items[]}; missing fields become defaults."""
    b = spark.read.schema(BATCH).option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)
    i = b.select("batch_label", F.posexplode("items").alias("pos", "i")).select("batch_label", "pos", "i.*")
    return with_defaults(i)


def with_defaults(items):
    """Empty texts, lists and maps for missing ones; a deterministic item_id."""
    ident = F.substring(F.md5(F.concat_ws("|", text("source"), text("url"), text("title"))), 1, 12)
    fill = {k: text(k) for k in ("source", "category", "bank", "title", "url", "raw_text", "author", "publish_time")}
    fill["images"] = F.coalesce("images", F.array().cast("array<string>"))
    fill["structured"] = F.coalesce("structured", F.create_map().cast("map<string,string>"))
    return items.withColumns({**fill, "item_id": first_filled("item_id", ident)})


def parse_raw_articles(df, value="value"):
    """Article rows from one JSON text per row: a list, a single object, or a {url: object} map."""
    v = strip(text(value))
    flat = re.sub(r"(\w+) ", r"\1:", ARTICLE)
    as_list = F.when(F.startswith(v, F.lit("[")), F.from_json(v, f"array<struct<{flat}>>"))
    one = F.from_json(v, ARTICLE)
    single = F.coalesce(*[one[k] for k in ("title", "original_title", "text", "full_text", "content_text", "summary", "url")]).isNotNull()
    entries = F.transform(F.map_entries(F.from_json(v, f"map<string,struct<{flat}>>")), lambda e: e["value"].withField("url", F.coalesce(nz(e["value"]["url"]), e["key"])))
    arts = F.coalesce(as_list, F.when(single, F.array(one)), entries)
    return df.select(*[k for k in df.columns if k != value], F.posexplode(arts).alias("pos", "a")).select(*[k for k in df.columns if k != value], "pos", "a.*")


def read_raw_articles(spark, path, whole=True):
    return parse_raw_articles(spark.read.option("wholetext", whole).text(path))


# fixed values: alternative keys of notice fields, in precedence order
NOTICE_KEYS = {"title": ["title", "公告标题"], "url": ["url", "公告URL"], "content": ["content", "message", "公告内容", "raw_text"], "bank": ["bank"], "publish_time": ["publish_time", "date", "date_str"], "category": ["category"], "author": ["author"]}


def parse_notices(df, value="value"):
    """Notice rows from {items} / {announcements} / list / single JSON texts with alternative keys."""
    v = F.try_parse_json(text(value))
    arr = "array<variant>"
    rows = F.coalesce(F.try_variant_get(v, "$.items", arr), F.try_variant_get(v, "$.announcements", arr), F.try_variant_get(v, "$", arr), F.array(v))
    keep = [k for k in df.columns if k != value]
    e = df.select(*keep, F.posexplode(rows).alias("pos", "n"))
    return e.select(*keep, "pos", *[first_filled(*[F.try_variant_get("n", f"$['{k}']", "string") for k in ks]).alias(name) for name, ks in NOTICE_KEYS.items()])


def read_notices(spark, path, whole=True):
    return parse_notices(spark.read.option("wholetext", whole).text(path))


def parse_notice_api(df, base, value="value"):
    """(title, date, link, body_html) rows of API payloads data.list[]; rows without title, date or id are dropped."""
    row = "struct<id:string,noticeId:string,title:string,summaryMsg:string,time:string,publishTime:string,details:string>"
    d = df.select(*[k for k in df.columns if k != value], F.explode(F.from_json(text(value), f"data struct<list:array<{row}>>")["data"]["list"]).alias("r"))
    ident = first_filled("r.id", "r.noticeId")
    out = d.select(*[k for k in df.columns if k != value], clean_title(first_filled("r.title", "r.summaryMsg")).alias("title"), extract_date(first_filled("r.time", "r.publishTime")).alias("date"), ident.alias("notice_id"),
                   F.concat(F.lit(base + "?id="), ident, F.lit("&menuId=9999&listId=9999")).alias("link"), text("r.details").alias("body_html"))
    return out.filter("title <> '' AND date <> '' AND notice_id <> ''")


def read_notice_api_json(spark, path, base):
    return parse_notice_api(spark.read.option("wholetext", True).text(path), base)


def decode_fallback(df, content="content", encodings=("utf-8-sig", "gb18030", "gbk")):
    """df with `text`: valid UTF-8 is decoded by the engine, only the other rows go through Python.

    The first encoding that decodes and yields CJK text wins, else UTF-8 with replacement characters.
    """
    keep = [k for k in df.columns if k != content]
    bom = lambda t: F.regexp_replace(t, "^﻿", "")
    good = df.filter(F.is_valid_utf8(c(content).cast("string"))).select(*keep, bom(F.decode(content, "utf-8")).alias("text"))
    bad = df.filter(~F.is_valid_utf8(c(content).cast("string")))
    cjk = re.compile("[一-鿿]")

    def one(b):
        for e in encodings:
            try:
                t = bytes(b).decode(e)
            except UnicodeDecodeError:
                continue
            if cjk.search(t):
                return t
        return bytes(b).decode("utf-8", "replace")

    def run(batches):
        for pdf in batches:
            yield pdf[keep].assign(text=[one(b) for b in pdf[content]])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in keep)
    return good.unionByName(bad.mapInPandas(run, f"{fields}, text string"))


def parse_markdown_items(df, file="file", content="content"):
    """(file, doc_title, ord, title, display_title, key, category, priority, source_url, comment, source_date, body, images) by '## ' heading."""
    t = F.regexp_replace(F.regexp_replace(text(content), "^﻿", ""), "\r\n?", "\n")
    stem = F.regexp_replace(F.substring_index(c(file), "/", -1), r"\.[^.]*$", "")
    h1 = F.regexp_extract(t, r"(?m)^# (.*)$", 1)
    title1 = F.when(F.rlike(t, F.lit("(?m)^# ")), strip(h1)).otherwise(stem)
    day = extract_date_loose(F.concat(title1, F.lit("\n"), t), stem)
    d = df.select(c(file).alias("file"), title1.alias("doc_title"), day.alias("source_date"), F.posexplode(F.filter(F.split(t, r"(?m)(?=^## )"), lambda s: F.startswith(s, F.lit("## ")))).alias("ord", "s"))
    head = F.substring_index("s", "\n", 1)
    body = strip(F.when(F.contains("s", F.lit("\n")), F.regexp_replace("s", r"^[^\n]*\n", "")).otherwise(""))
    d = d.select("file", "doc_title", "source_date", "ord", strip(F.regexp_replace(head, r"^##\s+", "")).alias("title"), body.alias("body")).withColumn("key", title_key("title"))
    d = d.filter(~F.col("key").isin(*lx.MD_SKIP_TITLES))
    return d.select("file", "doc_title", "ord", "title", F.regexp_replace("title", r"^[一二三四五六七八九十0-9]+[、.．]\s*", "").alias("display_title"), "key", doc_meta_values("body", "类别").alias("category"), doc_meta_values("body", "优先级").alias("priority"),
                    doc_meta_values("body", "来源").alias("source_url"), extract_comment("body").alias("comment"), "source_date", "body", F.regexp_extract_all("body", F.lit(r"!\[[^\]]*\]\(([^)]+)\)"), 1).alias("images"))


def read_markdown_items(spark, path):
    return parse_markdown_items(spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content")))


def parse_front_matter(df, content="content"):
    """df plus title, date, tags, draft of the YAML-like header."""
    h = F.regexp_extract(text(content), r"(?s)^---\s*\n(.*?)\n---", 1)
    line = lambda k: strip(F.regexp_extract(h, rf"(?m)^\s*{k}:(.*)$", 1))
    return df.withColumns({"title": F.regexp_replace(F.regexp_replace(line("title"), '^"+|"+$', ""), "^'+|'+$", ""), "date": line("date"),
                           "tags": F.regexp_extract_all(line("tags"), F.lit('"([^"]+)"'), 1), "draft": F.contains(F.lower(line("draft")), F.lit("true"))})


def read_front_matter(spark, path):
    return parse_front_matter(spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content")))


RSS = "title string, link string, pubDate string, description string, guid string, author string"


def read_rss_items(spark, path, limit=None):
    """(feed, title, url, pub_date, description, guid, author): <item> rows; with a limit the first so many per feed file, with their pos."""
    r = spark.read.format("xml").option("rowTag", "item").schema(RSS).load(path)
    r = r.select(F.input_file_name().alias("feed"), F.monotonically_increasing_id().alias("_i"), "title", F.col("link").alias("url"), F.col("pubDate").alias("pub_date"), "description", "guid", "author")
    if not limit:
        return r.drop("_i")
    w = W.partitionBy("feed").orderBy("_i")
    return r.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= limit).drop("_i")


def read_kb(spark, path, multi_line=True):
    """Chunk rows of knowledge-base files {entries[]} (one document per file, or per line)."""
    s = "entries array<struct<id:string,article_id:string,section:string,text:string,char_count:int,title:string,date:string,card_related:boolean,categories:map<string,int>,labels:array<string>,banks:array<string>>>"
    return spark.read.schema(s).option("multiLine", multi_line).json(path).select(F.explode("entries").alias("e")).select("e.*")


def scan_archive(spark, root, labels=None, since=None):
    """Archived items, pruned by batch label and month through the partition directories."""
    a = spark.read.parquet(root)
    if labels is not None:
        a = a.filter(F.col("batch_label").isin(*labels))
    if since is not None:
        a = a.filter((F.col("year") * 100 + F.col("month")) >= since)
    return a


# ---- Word packages ------------------------------------------------------------------

def _unpack(b):
    z = zipfile.ZipFile(io.BytesIO(bytes(b)))
    names = set(z.namelist())
    xml = z.read("word/document.xml").decode("utf-8", "replace") if "word/document.xml" in names else ""
    rels = z.read("word/_rels/document.xml.rels").decode("utf-8", "replace") if "word/_rels/document.xml.rels" in names else ""
    return z, names, xml, {m.group(1): m.group(2) for m in re.finditer(r'<Relationship\b[^>]*?Id="([^"]+)"[^>]*?Target="([^"]+)"', rels)}


def _text(xml):
    return unescape("".join(re.findall(r"<w:t(?:\s[^>]*)?>(.*?)</w:t>", xml, re.S))).strip()


# rows of an Arrow batch that a task gives on at once
OUT_ROWS = 1024


def arrow_schema(ddl):
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def in_parts(rows, schema):
    """Arrow batches of at most OUT_ROWS rows from an iterator of tuples."""
    while part := list(islice(rows, OUT_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*part), schema.types)], schema=schema)


def _explode(df, file, content, schema, rows):
    """One task-side pass over the packages: rows(bytes) -> list of tuples. A task holds one unpacked package and one part
    of its rows besides the Arrow batch."""
    out = f"{file} {dict(df.dtypes)[file]}, {schema}"
    arrow = arrow_schema(out)

    def run(batches):
        for batch in batches:
            f, b = batch.column(0), batch.column(1)
            yield from in_parts(((f[i].as_py(), *r) for i in range(len(batch)) for r in rows(b[i].as_py())), arrow)
    return df.select(file, content).mapInArrow(run, out)


def read_docx_paragraphs(df, file="path", content="content"):
    """(file, pos, style, text, links, has_img, bold) of every paragraph with text, link or image; df as from binaryFile."""
    def rows(b):
        _, _, xml, rels = _unpack(b)
        out = []
        for p in re.findall(r"<w:p\b[^>]*>.*?</w:p>", xml, re.S):
            style = re.search(r'<w:pStyle w:val="([^"]+)"', p)
            links = [{"url": rels[m.group(1)], "text": _text(m.group(0))} for m in re.finditer(r'<w:hyperlink\b[^>]*?r:id="([^"]+)"[^>]*>.*?</w:hyperlink>', p, re.S) if m.group(1) in rels]
            img, t = "<w:drawing" in p or "<w:blip" in p, _text(p)
            if t or links or img:
                out.append((len(out), style.group(1) if style else "normal", t, links, img, "<w:b/>" in p))
        return out
    return _explode(df, file, content, "pos int, style string, text string, links array<struct<url:string,text:string>>, has_img boolean, bold boolean", rows)


def read_docx_tables(df, file="path", content="content"):
    """(file, tbl, row, cell, text, images) of every table; rows without text and image are dropped."""
    def rows(b):
        _, _, xml, _ = _unpack(b)
        out = []
        for ti, t in enumerate(re.findall(r"<w:tbl>.*?</w:tbl>", xml, re.S)):
            for ri, r in enumerate(re.findall(r"<w:tr\b[^>]*>.*?</w:tr>", t, re.S)):
                cells = [(_text(x), re.findall(r'r:embed="([^"]+)"', x)) for x in re.findall(r"<w:tc>.*?</w:tc>", r, re.S)]
                if any(a or i for a, i in cells):
                    out += [(ti, ri, ci, a, i) for ci, (a, i) in enumerate(cells)]
        return out
    return _explode(df, file, content, "tbl int, row int, cell int, text string, images array<string>", rows)


def image_ext(x):
    """File extension by magic bytes."""
    h = F.hex(F.substring(c(x), 1, 4))
    return (F.when(F.startswith(h, F.lit("FFD8FF")), ".jpg").when(h == "89504E47", ".png").when(h == "47494638", ".gif").when(h == "52494646", ".webp").otherwise(".png"))


def read_docx_images(df, file="path", content="content"):
    """(file, rid, name, bytes, digest) of embedded images; equal bytes share one name (digest + extension)."""
    def rows(b):
        z, names, _, rels = _unpack(b)
        return [(rid, z.read("word/" + t)) for rid, t in sorted(rels.items()) if "word/" + t in names and t.startswith("media/")]
    i = _explode(df, file, content, "rid string, data binary", rows)
    return i.select(file, "rid", F.concat(F.substring(F.md5("data"), 1, 12), image_ext("data")).alias("name"), F.octet_length("data").alias("bytes"), F.md5("data").alias("digest"))


def style_type(x):
    s = F.regexp_replace(text(x), r"\s", "")
    return (F.when(F.startswith(s, F.lit("Heading")), "Heading").when(F.contains(s, F.lit("List")) & F.contains(s, F.lit("Number")), "ListNumber").when(F.rlike(s, F.lit("List|Numbering")), "ListBullet")
            .when(F.rlike(s, F.lit("Quote|Citation")), "Quote").otherwise("Normal"))


def docx_stats(paragraphs, tables, images, file="path"):
    """Per file: paragraphs by style type, tables and images."""
    k = style_type("style")
    p = paragraphs.groupBy(file).agg(F.count(F.lit(1)).alias("paragraphs"), *[F.count_if(k == t).alias(t.lower()) for t in ("Heading", "ListBullet", "ListNumber", "Quote", "Normal")])
    t = tables.groupBy(file).agg(F.countDistinct("tbl").alias("tables"))
    i = images.groupBy(file).agg(F.count(F.lit(1)).alias("images"))
    return p.join(t, file, "left").join(i, file, "left").na.fill(0, ["tables", "images"])


# ---- images ---------------------------------------------------------------------------

JPEG_FRAMES = [f"C{k}" for k in "012356789ABDEF"]  # start-of-frame markers
JPEG_BARE = ["01", "D8", *[f"D{k}" for k in range(8)]]  # markers without a length
JPEG_ENDS = ["D9", "DA"]  # behind these come pixels, or nothing
PNG_MODES, JPEG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}, {1: "L", 3: "RGB", 4: "CMYK"}


def _jpeg(x):
    """struct(width, height, parts) of the first frame: a walk over the segments, a step per possible marker."""
    at_hex = lambda at, n: F.hex(F.substring(x, at, F.lit(n)))
    be2 = lambda at: F.conv(at_hex(at, 2), 16, 10).cast("int")
    start = F.struct(F.lit(1).alias("at"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("int").alias("parts"), F.lit(False).alias("done"))

    def step(s, _):
        at = s["at"]
        mark = at_hex(at + 1, 1)
        frame, none = mark.isin(*JPEG_FRAMES), F.lit(None).cast("int")
        size = F.when(mark == "FF", 1).when(mark.isin(*JPEG_BARE), 2).otherwise(2 + F.coalesce(be2(at + 2), F.lit(0)))
        over = (at_hex(at, 1) != "FF") | frame | mark.isin(*JPEG_ENDS) | (at + 4 > F.octet_length(x))
        return F.when(s["done"], s).otherwise(F.struct((at + size).alias("at"), F.when(frame, be2(at + 7)).otherwise(none).alias("width"), F.when(frame, be2(at + 5)).otherwise(none).alias("height"),
                                                       F.when(frame, F.conv(at_hex(at + 9, 1), 16, 10).cast("int")).otherwise(none).alias("parts"), over.alias("done")))
    # every segment starts with a byte FF; runs of F hold at least as many pairs as such bytes
    markers = F.floor((2 * F.octet_length(x) - F.length(F.replace(F.hex(x), F.lit("FF"), F.lit("")))) / 2).cast("int")
    return F.aggregate(F.sequence(F.lit(0), markers), start, step)


def image_meta(df, content="content"):
    """df plus format, mode, width, height, bytes from the header bytes (PNG, GIF, BMP, JPEG, WebP); no decoding.

    Unknown or cut content has format '' or null sizes; mode is null where the header does not tell."""
    x = c(content)
    number = lambda h: F.conv(h, 16, 10).cast("int")
    be = lambda at, n=4: number(F.hex(F.substring(x, at, n)))
    le = lambda at, n: number(F.concat(*[F.hex(F.substring(x, at + i, 1)) for i in reversed(range(n))]))
    h = F.hex(F.substring(x, 1, 4))
    webp = (h == "52494646") & (F.hex(F.substring(x, 9, 4)) == "57454250")
    kind = F.when(h == "89504E47", "PNG").when(h == "47494638", "GIF").when(F.startswith(h, F.lit("424D")), "BMP").when(F.startswith(h, F.lit("FFD8FF")), "JPEG").when(webp, "WEBP").otherwise("")
    chunk = F.substring(x, 13, 4).cast("string")  # VP8 lossy, VP8L lossless, VP8X extended
    low14 = lambda v: v.bitwiseAND(F.lit(0x3FFF)).cast("int")
    wide = F.when(chunk == "VP8 ", low14(le(27, 2))).when(chunk == "VP8L", low14(le(22, 2)) + 1).when(chunk == "VP8X", le(25, 3) + 1)
    tall = F.when(chunk == "VP8 ", low14(le(29, 2))).when(chunk == "VP8L", F.shiftright(le(23, 3), 6).bitwiseAND(F.lit(0x3FFF)) + 1).when(chunk == "VP8X", le(28, 3) + 1)
    alpha = F.when(chunk == "VP8 ", F.lit(False)).when(chunk == "VP8L", be(25, 1).bitwiseAND(F.lit(0x10)) > 0).when(chunk == "VP8X", be(21, 1).bitwiseAND(F.lit(0x10)) > 0)
    out = df.withColumn("_j", F.when(kind == "JPEG", _jpeg(x)))
    mode = F.when(kind == "PNG", F.try_element_at(lit_map(PNG_MODES), be(26, 1))).when(kind == "GIF", "P").when(kind == "JPEG", F.try_element_at(lit_map(JPEG_MODES), F.col("_j.parts"))).when(
        kind == "WEBP", F.when(alpha, "RGBA").otherwise("RGB")).when(kind == "BMP", F.when(le(29, 2) == 24, "RGB").when(le(29, 2) == 32, "RGBA").when(le(29, 2) == 8, "P"))
    out = out.withColumns({"format": kind, "mode": mode, "width": F.when(kind == "PNG", be(17)).when(kind == "GIF", le(7, 2)).when(kind == "BMP", le(19, 4)).when(kind == "JPEG", F.col("_j.width")).when(kind == "WEBP", wide),
                           "height": F.when(kind == "PNG", be(21)).when(kind == "GIF", le(9, 2)).when(kind == "BMP", le(23, 4)).when(kind == "JPEG", F.col("_j.height")).when(kind == "WEBP", tall), "bytes": F.octet_length(x)})
    return out.drop("_j")


def read_image_meta(spark, path):
    """(path, mode, width, height, stddev) through the built-in image source; the grey spread runs on Arrow batches."""
    i = spark.read.format("image").load(path).select("image.origin", "image.width", "image.height", "image.nChannels", "image.data")

    def run(batches):
        import numpy as np
        for pdf in batches:
            sd = []
            for n, b in zip(pdf["nChannels"], pdf["data"]):
                a = np.frombuffer(bytes(b), dtype=np.uint8).reshape(-1, n).astype(float)
                sd.append(float(a[:, 0].std() if n == 1 else (a[:, :3] @ np.array([0.114, 0.587, 0.299])).std()))
            yield pd.DataFrame({"path": pdf["origin"], "mode": ["L" if n == 1 else "RGB" if n == 3 else "RGBA" for n in pdf["nChannels"]], "width": pdf["width"], "height": pdf["height"], "stddev": sd})
    return i.mapInPandas(run, "path string, mode string, width int, height int, stddev double")


def markdown_tables(df, id_col="doc_id", content="content"):
    """(id, line, is_header, cells) of pipe tables: a header is a piped line above a dashed one, rows follow until a gap."""
    l = df.select(id_col, F.posexplode(F.split(text(content), "\n")).alias("line", "t"))
    w = W.partitionBy(id_col).orderBy("line")
    rule = F.rlike("t", F.lit(r"^\s*\|?\s*:?-{3,}"))
    piped = F.contains("t", F.lit("|")) & (F.trim("t") != "")
    l = l.withColumns({"header": piped & F.coalesce(F.rlike(F.lead("t").over(w), F.lit(r"^\s*\|?\s*:?-{3,}")), F.lit(False)), "piped": piped})
    run = w.rowsBetween(W.unboundedPreceding, 0)
    l = l.withColumns({"h": F.last(F.when(F.col("header"), F.col("line")), ignorenulls=True).over(run), "gap": F.last(F.when(~F.col("piped"), F.col("line")), ignorenulls=True).over(run)})
    inside = F.col("h").isNotNull() & F.col("piped") & (F.coalesce("gap", F.lit(-1)) < F.col("h")) & (F.col("line") != F.col("h") + 1)
    cells = F.transform(F.split(F.regexp_replace(strip(F.col("t")), r"^\|+|\|+$", ""), r"\|"), strip)
    return l.filter(inside).select(id_col, "line", F.col("header").alias("is_header"), cells.alias("cells"))
