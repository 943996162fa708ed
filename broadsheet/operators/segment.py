"""Topic segmentation over ordered block tables, and document-shaped paragraph tables to items.

A block table is (article_id, pos, type, text, is_heading_like). Everything is ordered inside one article or file, so
windows and folds are bounded by the size of one document.
"""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions.expr import any_of, c, case, count_hits, first_filled, has, has_any, head, hits, let, lines, nz, quote, rstrip_set, strip, text
from ..functions.fields import extract_kv_fields, numbered_prefix, term_names
from ..functions.gates import item_gate
from ..functions.labels import categorize_heading, classify_paragraph, first_entity_regex, guess_topic_type
from ..functions.text import strip_heading_prefix


def template_group(x, groups=lx.TEMPLATE_GROUPS):
    """Two or more field names of one template occur."""
    return reduce(lambda a, b: a | b, [count_hits(x, g) >= 2 for g in groups])


def topic_start(x, heading_like):
    """The block opens a topic: heading, numbering, template fields, or institution plus action word."""
    t = strip(text(x))
    return c(heading_like) | numbered_prefix(t) | template_group(t) | (
        F.rlike(t, F.lit(any_of(lx.HINT_BANKS))) & F.rlike(t, F.lit(any_of(lx.TOPIC_ACTIONS))))


def topic_starts(blocks):
    return blocks.withColumn("is_start", topic_start("text", "is_heading_like"))


def _bits(t, words):
    """A bit per word that occurs."""
    return reduce(lambda x, y: x + y, [F.when(has(t, k), 1 << i).otherwise(0) for i, k in enumerate(words)])


STRONG = ["multiple_numbered_headings", "repeated_activity_templates", "multiple_distinct_topics", "multiple_independent_sections"]
WEAK = ["multiple_activity_names", "multiple_card_names", "action_word_switching", "topic_keyword_switch"]


def multi_topic_signals(blocks):
    """(article_id, signals, is_candidate, split_confidence): four strong and four weak signals per article.

    One shuffle by article_id serves the windows and the aggregation.
    """
    w = W.partitionBy("article_id").orderBy("pos")
    t = strip(text("text"))
    fields = sorted({f for g in lx.TEMPLATE_GROUPS for f in g})
    image = F.startswith("type", F.lit("image")) & (F.col("type") != "image_cta")
    # flags, bits and terms are shuffled, texts are not
    b = blocks.select("article_id", "pos", numbered_prefix(t).alias("numbered"), F.coalesce(c("is_heading_like") | numbered_prefix(t), F.lit(False)).alias("heading"), (t != "").alias("filled"), image.alias("image"),
                      ((F.col("type") == "article_text") & (t != "")).alias("words"), F.when(F.col("type").isin(*lx.FACT_TYPES), _bits(t, fields)).otherwise(0).alias("fields"), _bits(t, lx.TOPIC_ACTIONS).alias("actions"), term_names(t).alias("n"))
    b = b.withColumn("terms", F.array_union(F.when(F.col("n.has_brand"), F.col("n.branded")).otherwise(F.col("n.plain")), F.col("n.acts")))
    n_before = F.coalesce(F.sum(F.col("heading").cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    prev = F.last(F.when(F.col("filled"), F.col("terms")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    b = b.withColumns({"section": F.sum(F.col("heading").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)), "before": n_before, "prev": prev,
                       "first": F.row_number().over(w) == 1, "after_heading": F.coalesce(F.lag("heading").over(w), F.lit(False))})
    b = b.withColumn("switch", F.col("filled") & (F.size("terms") > 0) & (F.coalesce(F.size("prev"), F.lit(0)) > 0) & ~F.coalesce(F.arrays_overlap("terms", "prev"), F.lit(True)))
    # a section (and a run up to a heading) counts at its first block
    every = lambda k: W.partitionBy("article_id", k)
    group_hit = reduce(lambda x, y: x | y, [F.bit_count(F.col("all_fields").bitwiseAND(F.lit(sum(1 << fields.index(f) for f in g)))) >= 2 for g in lx.TEMPLATE_GROUPS])
    b = b.withColumns({"opens": F.col("heading") | F.col("first"), "begins": F.col("first") | F.col("after_heading"), "all_fields": F.bit_or("fields").over(every("section")),
                       "img": F.bool_or("image").over(every("before")), "txt": F.bool_or("words").over(every("before"))})
    merged = lambda k: F.array_distinct(F.flatten(F.collect_list(k)))
    a = b.groupBy("article_id").agg(
        F.count_if("numbered").alias("numbered"), F.count_if("heading").alias("headings"), merged(F.when(F.col("heading"), F.col("terms"))).alias("head_terms"),
        F.bool_or("n.has_brand").alias("brand"), merged("n.branded").alias("branded"), merged("n.plain").alias("plain"), merged("n.acts").alias("acts"),
        F.bit_count(F.bit_or("actions")).alias("actions"), F.count_if("switch").alias("switches"),
        F.count_if(F.col("opens") & group_hit).alias("templates"), F.count_if(F.col("begins") & (F.col("before") >= 1) & F.col("img") & F.col("txt")).alias("sequences"))
    names = F.array_union(F.when(F.col("brand"), F.col("branded")).otherwise(F.col("plain")), F.col("acts"))
    a = a.withColumn("names", names)
    cards = F.size(F.filter("names", lambda x: has(x, "卡") | has(x, "版")))
    strong = [F.col("numbered") >= 2, F.col("templates") >= 2, (F.col("headings") >= 2) & (F.size("head_terms") >= 2), F.col("sequences") >= 2]
    weak = [F.size("names") >= 3, cards >= 2, F.col("actions") >= 3, F.col("switches") >= 2]
    pick = lambda conds, labels: F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(k)) for cond, k in zip(conds, labels)]))
    a = a.select("article_id", pick(strong, STRONG).alias("s"), pick(weak, WEAK).alias("w"))
    ns, nw = F.size("s"), F.size("w")
    return a.select("article_id", F.when((ns > 0) | (nw >= 2), F.concat("s", "w")).otherwise(F.array().cast("array<string>")).alias("signals"), ((ns > 0) | (nw >= 2)).alias("is_candidate"),
                    F.when(ns > 0, F.least(F.lit(0.95), 0.7 + 0.1 * F.least(ns, F.lit(3)))).when(nw >= 2, F.least(F.lit(0.75), 0.5 + 0.1 * F.least(nw, F.lit(3)))).otherwise(0.0).alias("split_confidence"))


TOPIC = "struct<start_block:bigint,end_block:bigint,headline:string,type_hint:string,n_blocks:bigint,blocks:array<struct<pos:bigint,type:string,text:string>>,merged:int>"


def merge_small_topics(topics, title):
    """Array of topics with short or headless ones folded into the topic before them."""
    def step(kept, t):
        def fold(prev):
            small = (t["n_blocks"] <= 2) | ((t["headline"] != "") & (t["headline"] == title)) | (
                (prev["type_hint"] != "") & (prev["type_hint"] == t["type_hint"]) & (t["n_blocks"] <= 3))
            joined = F.struct(prev["start_block"].alias("start_block"), t["end_block"].alias("end_block"), first_filled(prev["headline"], t["headline"]).alias("headline"), prev["type_hint"].alias("type_hint"),
                              (prev["n_blocks"] + t["n_blocks"]).alias("n_blocks"), F.concat(prev["blocks"], t["blocks"]).alias("blocks"), (prev["merged"] + 1).alias("merged")).cast(TOPIC)
            return F.when(small, F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(joined))).otherwise(F.concat(kept, F.array(t)))
        return F.when(F.size(kept) == 0, F.concat(kept, F.array(t))).otherwise(let(F.element_at(kept, -1), fold))
    return F.aggregate(c(topics), F.array().cast(f"array<{TOPIC}>"), step)


def segment_topics(blocks, articles):
    """(article_id, topic_id, start_block, end_block, headline, type_hint, n_blocks, split_confidence, signals, blocks).

    Gaps and islands over topic starts, then merge_small_topics; articles with fewer than two topics come out whole.
    articles: (article_id, raw_title).
    """
    w = W.partitionBy("article_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    b = topic_starts(blocks).withColumn("seg", F.sum(F.col("is_start").cast("int")).over(w))
    row = F.struct(F.col("pos").cast("bigint").alias("pos"), "type", strip(text("text")).alias("text"))
    seg = b.groupBy("article_id", "seg").agg(F.array_sort(F.collect_list(row)).alias("blocks"))
    bl = F.col("blocks")
    body = F.array_join(F.transform(bl, lambda x: x["text"]), "\n")
    topic = F.struct(bl[0]["pos"].alias("start_block"), F.element_at(bl, -1)["pos"].alias("end_block"), bl[0]["text"].alias("headline"), guess_topic_type(body).alias("type_hint"),
                     F.size(bl).cast("bigint").alias("n_blocks"), bl.alias("blocks"), F.lit(0).alias("merged")).cast(TOPIC)
    art = seg.select("article_id", "seg", topic.alias("t")).groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct("seg", "t"))).alias("ts"))
    art = art.join(articles.select("article_id", text("raw_title").alias("raw_title")), "article_id")
    all_blocks = F.flatten(F.transform("ts", lambda s: s["t"]["blocks"]))
    real = F.transform(F.filter("ts", lambda s: s["seg"] > 0), lambda s: F.struct(*[(first_filled(s["t"][k], F.col("raw_title")) if k == "headline" else s["t"][k]).alias(k)
                       for k in ("start_block", "end_block", "headline", "type_hint", "n_blocks", "blocks", "merged")]).cast(TOPIC))
    art = art.withColumns({"kept": merge_small_topics(real, F.col("raw_title")), "n_real": F.size(real), "all": all_blocks})
    whole = F.struct(F.lit(0).alias("start_block"), (F.size("all") - 1).alias("end_block"), F.col("raw_title").alias("headline"), F.lit("").alias("type_hint"), F.size("all").alias("n_blocks"),
                     F.col("all").alias("blocks"), F.lit(0).alias("merged")).cast(TOPIC)
    single = F.size("kept") <= 1
    out = art.select("article_id", "raw_title", single.alias("single"), "n_real", F.posexplode(F.when(single, F.array(whole)).otherwise(F.col("kept"))).alias("i", "t"))
    why = F.when(F.col("n_real") == 0, "single_topic_fallback:no_topic_starts").otherwise("single_topic_fallback:merged_to_single")
    return out.select("article_id", F.concat("article_id", F.lit("_t"), (F.col("i") + 1).cast("string")).alias("topic_id"), "t.start_block", "t.end_block", "t.headline", "t.type_hint", "t.n_blocks",
                      F.when(F.col("single"), 1.0).otherwise(0.8).alias("split_confidence"),
                      F.when(F.col("single"), F.array(why)).otherwise(F.concat(F.array(F.lit("heading_marker")), F.array_repeat(F.lit("merged"), F.col("t.merged")))).alias("signals"),
                      F.col("raw_title").alias("source_article_title"), "t.blocks", (~F.col("single")).alias("is_split"))


def _positions(parts):
    """0-based offsets of the gaps between the parts of a split text (parts joined by nothing)."""
    n = F.transform(parts, lambda p: F.length(p))
    sums = F.aggregate(n, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return F.slice(sums, F.lit(2), F.greatest(F.size(sums) - 2, F.lit(0)))


BOUND = "struct<at:int,heading:string>"


def split_raw_text(df, id_col="doc_id", text_col="text"):
    """(id, topic_no, headline, body, bank_hints) for texts with two or more topics; others give no row.

    Boundaries: an institution plus action word behind a sentence end, and heading phrases; spacing, merging of short
    pieces and the 200-character minimum as parameters of the rules. A fold inside each text, no shuffle.
    """
    # outer explode: no size() filter is inferred, so the fold runs once per text
    out = df.select(id_col, F.posexplode_outer(raw_topics(text_col)).alias("i", "t")).filter("i IS NOT NULL")
    return out.select(id_col, (F.col("i") + 1).alias("topic_no"), "t.headline", "t.body", "t.bank_hints")


def raw_topics(x):
    """array<struct(headline, body, bank_hints)>: the two or more topics of a text; empty for others."""
    return let(F.replace(text(x), F.lit("\0"), F.lit("")), lambda raw: F.when(F.length(raw) >= 200, _raw_topics(raw)))


def _raw_topics(raw):
    banks, acts = any_of(lx.HINT_BANKS), any_of(lx.BOUNDARY_ACTIONS)
    lead = rf"(?U)(?<=[。？！\n])\s*(?:{banks})(?:{acts})"
    sub = lambda at, n: F.substring(raw, at + 1, F.lit(n))

    def heading(at):
        def body(v):
            snip, first = v["snip"], v["first"]
            stops = F.array_min(F.filter(F.array(*[F.locate(m, snip, 1) - 1 for m in lx.BOUNDARY_STOPS]), lambda p: (p > 0) & (p >= first) & (p < 60)))
            dot = F.instr(snip, "。") - 1
            end = F.coalesce(stops, F.when((dot > 0) & (dot < 60), dot), F.least(F.lit(30), F.length(snip)))
            h = rstrip_set(strip(F.substring(snip, F.lit(1), end)), "。，")
            return let(h, lambda x: F.when(F.length(x) <= 20, x).when(F.rlike(F.substring(x, 20, 1), F.lit("[一-鿿]")), F.substring(x, 1, 20)).otherwise(F.substring(x, 1, 18)))
        snip = sub(at, 60)
        return let(F.struct(snip.alias("snip"), F.length(F.regexp_extract(snip, rf"(?U)^\s*((?:{banks})(?:{acts}))", 1)).alias("first")), body)

    mk = lambda at, h: F.array(F.struct(at.cast("int").alias("at"), h.alias("heading")).cast(BOUND))
    none = F.array().cast(f"array<{BOUND}>")
    last_at = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1))["at"], F.lit(-999))

    lead_at = _positions(F.split(F.regexp_replace(raw, f"({lead})", "\0$1"), "\0"))
    leads = F.aggregate(lead_at, none, lambda a, p: F.when((F.size(a) == 0) | (p - last_at(a) > 50), F.concat(a, mk(p, F.lit("")))).otherwise(a))
    leads = F.transform(leads, lambda b: F.struct(b["at"].alias("at"), heading(b["at"]).alias("heading")).cast(BOUND))

    # heading phrases, one phrase after the other; after a find the search goes on 100 characters later
    tagged = lambda n, k: lambda p: F.struct(F.lit(n).alias("n"), F.lit(k).alias("k"), p.alias("p"))
    found = F.flatten(F.array(*[F.transform(_positions(F.split(F.replace(raw, F.lit(k), F.lit("\0" + k)), "\0")),
                                            tagged(n, k)) for n, k in enumerate(lx.BOUNDARY_HEADINGS)]))

    def phrase(acc, o):
        low = F.when(acc["n"] != o["n"], F.when(F.size(acc["bounds"]) > 0, 100).otherwise(0)).otherwise(acc["low"])
        seen = o["p"] >= low
        take = seen & ((F.size(acc["bounds"]) == 0) | (F.abs(o["p"] - last_at(acc["bounds"])) >= 50))
        begin = F.greatest(F.lit(0), o["p"] - 15)
        snip = sub(begin, 60)
        ends = lambda m: F.when(F.instr(snip, m) > 0, F.instr(snip, m) - 1).otherwise(60)
        end = F.least(ends("。"), ends("\n"))
        h = F.when(end > 0, strip(F.substring(snip, F.lit(1), end + 1))).otherwise(o["k"])
        grown = F.array_sort(F.concat(acc["bounds"], mk(begin, h)), lambda x, y: F.when(x["at"] < y["at"], -1).when(x["at"] > y["at"], 1).otherwise(0))
        return F.struct(o["n"].alias("n"), F.when(seen, o["p"] + 100).otherwise(low).alias("low"), F.when(take, grown).otherwise(acc["bounds"]).alias("bounds"))

    def spaced(bounds):
        return F.aggregate(bounds, none, lambda a, b: F.when((F.size(a) == 0) | (b["at"] - last_at(a) > 80), F.concat(a, F.array(b))).otherwise(a))

    def cut(far):
        nxt = lambda i: F.coalesce(F.try_element_at(far, i + 2)["at"], F.length(raw))
        piece = F.transform(far, lambda b, i: F.struct(rstrip_set(strip(b["heading"]), "。，").alias("headline"), strip(F.substring(raw, b["at"] + 1, nxt(i) - b["at"])).alias("body")))
        return F.transform(piece, lambda p: F.struct(p["headline"].alias("headline"), p["body"].alias("body"), hits(F.substring(p["body"], 1, 200), lx.HINT_BANKS).alias("bank_hints")))

    def merge(a, p):
        def glue(prev):
            return F.struct(prev["headline"].alias("headline"), F.concat(prev["body"], F.lit("\n"), p["body"]).alias("body"), F.array_union(prev["bank_hints"], p["bank_hints"]).alias("bank_hints"))
        return F.when((F.size(a) > 0) & (F.length(p["body"]) < 60), F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(glue(F.try_element_at(a, F.lit(-1)))))).otherwise(F.concat(a, F.array(p)))

    topic_t = "array<struct<headline:string,body:string,bank_hints:array<string>>>"
    two = lambda a: F.when(F.size(a) >= 2, a).otherwise(F.array().cast(topic_t))
    merged = lambda pieces: F.aggregate(pieces, F.array().cast(topic_t), merge)
    return let(leads, lambda ls: let(
        F.aggregate(found, F.struct(F.lit(-1).alias("n"), F.lit(0).alias("low"), ls.alias("bounds")), phrase, lambda a: a["bounds"]),
        lambda bs: let(spaced(bs), lambda far: F.when(F.size(far) >= 2, let(merged(cut(far)), two)).otherwise(F.array().cast(topic_t)))))


# ---- paragraph tables -------------------------------------------------------------

def parse_modes(paragraphs):
    """(file, mode): standard with Heading 1, announcement with only Heading 2, field when bold labels exceed 20 %."""
    filled = strip(text("text")) != ""
    label = F.rlike(strip(text("text")), F.lit(f"^(?:{any_of(lx.FIELD_NAMES)})[：:]"))
    g = paragraphs.groupBy("file").agg(F.count_if(filled & (F.col("style") == "Heading 1")).alias("h1"), F.count_if(filled & (F.col("style") == "Heading 2")).alias("h2"),
                                       F.count_if(filled & label & F.col("bold")).alias("fields"), F.count_if(filled).alias("n"))
    return g.select("file", case([(F.col("h1") > 0, "standard"), (F.col("h2") > 0, "announcement"), (F.col("fields") / F.nullif("n", F.lit(0)) > 0.2, "field")], "standard").alias("mode"))


def headings_to_items(paragraphs):
    """(file, ord, mode, category, title, bank, url, raw_text, structured) from (file, pos, style, text, bold).

    Heading 1 is the category, Heading 2 the item; announcement files have one implied section, field files are led by
    labels. Windows per file; text is kept whole.
    """
    w = W.partitionBy("file").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    t = strip(text("text"))
    p = paragraphs.withColumn("text", t).filter("text <> ''").join(parse_modes(paragraphs), "file")
    label = F.regexp_extract("text", f"^({any_of(lx.FIELD_NAMES)})[：:]", 1)
    colon = F.when(F.contains("text", F.lit("：")), F.regexp_replace("text", "^[^：]*：", "")).otherwise(F.regexp_replace("text", "^[^:]*:", ""))
    p = p.withColumns({"label": F.when(F.col("mode") == "field", label).otherwise(""), "value": strip(colon)})
    opens1 = case([(F.col("mode") == "standard", F.col("style") == "Heading 1"), (F.col("mode") == "field", F.col("label").isin("银行", "发卡银行"))], F.lit(False))
    opens2 = case([(F.col("mode") == "field", F.col("label") == "标题")], F.col("style") == "Heading 2")
    p = p.withColumns({"o1": opens1, "o2": opens2})
    p = p.withColumns({"h1": F.last(F.when(F.col("o1"), F.col("pos")), ignorenulls=True).over(w),
                       "t1": F.last(F.when(F.col("o1"), F.when(F.col("mode") == "field", first_filled("value", F.lit("银行信息"))).otherwise(F.col("text"))), ignorenulls=True).over(w)})
    p = p.withColumn("o2", F.col("o2") & ((F.col("mode") != "standard") | F.col("h1").isNotNull()))
    p = p.withColumn("h2", F.last(F.when(F.col("o2"), F.col("pos")), ignorenulls=True).over(w))
    p = p.filter(F.col("h2").isNotNull() & (F.col("h1").isNull() | (F.col("h2") > F.col("h1"))))
    meta = (F.col("mode") == "field") & F.col("label").isin("原文链接", "发布时间", "作者")
    body = ~F.col("o2") & ~meta
    bank = F.when(body & (F.col("mode") == "announcement"), F.regexp_extract("text", f"({any_of(lx.ANNOUNCEMENT_BANKS)})", 1))
    bank = F.when(~bank.isin("", "银行"), bank)
    items = p.withColumn("_bank", bank).groupBy("file", "h2").agg(
        F.first("mode").alias("mode"), F.max("t1").alias("t1"), F.max(F.when(F.col("o2"), F.when(F.col("mode") == "field", first_filled("value", "text")).otherwise(F.col("text")))).alias("title"),
        F.array_sort(F.collect_list(F.when(body, F.struct("pos", "text")))).alias("body"), F.max_by("value", F.when((F.col("mode") == "field") & (F.col("label") == "原文链接"), F.col("pos"))).alias("url"),
        F.min(F.when(F.col("_bank").isNotNull(), F.struct("pos", "_bank"))).alias("b"))
    named = items.groupBy("file").agg(F.min("b").alias("fb"))
    items = items.join(named, "file")
    h1 = case([(F.col("mode") == "announcement", F.concat(F.coalesce("fb._bank", F.lit("银行")), F.lit("公告"))), (F.col("mode") == "field", F.coalesce("t1", F.lit("微信文章")))], F.col("t1"))
    items = items.select("file", F.col("h2").alias("ord"), "mode", h1.alias("h1"), "title", F.array_join(F.transform("body", lambda x: x["text"]), "\n").alias("raw_text"), F.coalesce("url", F.lit("")).alias("url"))
    items = item_gate(items, "raw_text")
    items = items.withColumn("structured", extract_kv_fields("raw_text"))
    return items.select("file", "ord", "mode", categorize_heading("h1").alias("category"), "title", first_entity_regex("h1", "raw_text").alias("bank"),
                        first_filled("url", F.try_element_at("structured", F.lit("原文链接")), F.try_element_at("structured", F.lit("来源"))).alias("url"), "raw_text", "structured")


def styled_digest_items(paragraphs):
    """(file, pos, category, item, role, type, prefix, body, links): styled paragraphs placed under category and item.

    role: item block, preamble (category without item) or standalone.
    """
    w = W.partitionBy("file").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    p = paragraphs.withColumn("h1", F.last(F.when(F.col("style") == "Heading1", F.col("pos")), ignorenulls=True).over(w))
    p = p.withColumns({"category": F.last(F.when(F.col("style") == "Heading1", strip(F.regexp_replace("text", "[💡🆕📊📈🏦🟡🔴⚪▸🗑📌✅❌⚠️📢🎁‍]", ""))), ignorenulls=True).over(w),
                       "h2": F.last(F.when(F.col("style") == "Heading2", F.col("pos")), ignorenulls=True).over(w), "item": F.last(F.when(F.col("style") == "Heading2", F.col("text")), ignorenulls=True).over(w)})
    open2 = F.col("h2").isNotNull() & (F.col("h1").isNull() | (F.col("h2") > F.col("h1")))
    body = p.filter(~F.col("style").isin("Title", "Heading1", "Heading2") & (text("text") != ""))
    k = classify_paragraph("text")
    bullet = F.col("style") == "ListBullet"
    role = F.when(open2, "item").when(bullet | F.col("h1").isNull(), "standalone").otherwise("preamble")
    return body.select("file", "pos", "category", F.when(open2, F.col("item")).alias("item"), role.alias("role"), F.when(bullet, "bullet").otherwise(k["type"]).alias("type"),
                       F.when(bullet, "").otherwise(k["prefix"]).alias("prefix"), F.when(bullet, F.col("text")).otherwise(k["body"]).alias("body"),
                       F.array_distinct(F.regexp_extract_all("text", F.lit(r"https?://[^\s）)]+"), 0)).alias("links"))


def four_part_items(paragraphs):
    """(file, ord, title, source, core, review) items, with the summary and link sections left out.

    The article title is the first line without a reserved opening; later labels of an item overwrite earlier ones.
    """
    w = W.partitionBy("file").orderBy("pos")
    p = paragraphs.select("file", "pos", strip(text("text")).alias("text")).filter("text <> ''")
    reserved = F.rlike("text", F.lit("^(?:来源|核心内容|点评|本期|新卡|卡组织|年费|原始)"))
    first = F.min(F.when(~reserved, F.col("pos"))).over(W.partitionBy("file"))
    p = p.withColumns({"lead": F.min("pos").over(W.partitionBy("file")), "first": first})
    p = p.filter(~((F.col("pos") == F.col("lead")) & (F.col("pos") == F.col("first"))))
    run = w.rowsBetween(W.unboundedPreceding, 0)
    p = p.withColumns({"links": F.max(has(F.col("text"), "原始链接").cast("int")).over(run), "summary": F.max(F.startswith("text", F.lit("本期总结")).cast("int")).over(run)})
    p = p.filter("links = 0 AND summary = 0")
    label = F.regexp_extract("text", "^(来源|核心内容|点评)[：:]", 1)
    wide = F.when(F.contains("text", F.lit("：")), F.regexp_replace("text", "(?s)^[^：]*：", "")).otherwise(F.col("text"))
    value = strip(F.regexp_replace(wide, "(?s)^[^:]*:", ""))
    p = p.withColumns({"label": label, "value": value}).withColumn("item", F.sum((F.col("label") == "").cast("int")).over(run)).filter("item > 0")
    pick = lambda k: F.coalesce(F.max_by("value", F.when(F.col("label") == k, F.col("pos"))), F.lit(""))
    return p.groupBy("file", "item").agg(F.min("pos").alias("ord"), F.max(F.when(F.col("label") == "", F.col("text"))).alias("title"), pick("来源").alias("source"), pick("核心内容").alias("core"), pick("点评").alias("review")).drop("item")


def extract_publish_items(df, id_col="doc_id", text_col="text"):
    """(id, ord, title, category, body, source_url) of '### N.' sections; only behind a '逐条' heading when there is one."""
    t = F.regexp_replace(text(text_col), "\r\n", "\n")
    behind = F.regexp_extract(t, r"(?ms)^[ \t]*## [^\n]*逐条[^\n]*\n(.*)\z", 1)
    area = F.when(F.rlike(t, F.lit(r"(?m)^[ \t]*## [^\n]*逐条")), behind).otherwise(t)
    parts = F.filter(F.split(area, r"(?m)^(?=[ \t]*###[ \t]+\d+[.、][ \t]+)"), lambda x: F.rlike(x, F.lit(r"^[ \t]*###[ \t]+\d+[.、][ \t]+")))
    s = df.select(id_col, F.posexplode(parts).alias("ord", "part"))
    part = F.regexp_replace("part", r"(?ms)\n[ \t]*##[ \t]+.*\z", "")
    s = s.withColumn("part", part).withColumns({"first": F.substring_index("part", "\n", 1), "rest": F.split("part", "\n")})
    src = r"^\*{0,2}来源\*{0,2}\s*[：:]\s*(https?://\S+)"
    rest = F.slice("rest", F.lit(2), F.size("rest"))
    urls = F.filter(F.transform(rest, lambda l: F.regexp_extract(strip(l), src, 1)), lambda u: u != "")
    kept = F.filter(rest, lambda l: ~F.rlike(strip(l), F.lit(r"^\*{0,2}来源\*{0,2}\s*[：:]")) & ~F.startswith(strip(l), F.lit("**来源")))
    s = s.withColumn("body", strip(F.array_join(kept, "\n")))
    kind = first_filled(strip(F.regexp_extract("body", r"\*\*属性\*\*\s*[：:]\s*([^｜|\n]+)", 1)), strip(F.regexp_extract("body", r"\*\*类别\*\*\s*[：:]\s*([^\n]+)", 1)), F.lit(lx.OTHER))
    return s.select(id_col, "ord", strip_heading_prefix(F.regexp_replace(strip(F.col("first")), r"^###\s+", "")).alias("title"), kind.alias("category"), "body",
                    F.coalesce(F.regexp_replace(F.try_element_at(urls, F.lit(-1)), r"\)+$", ""), F.lit("")).alias("source_url"))
