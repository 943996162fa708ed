"""Composed jobs: raw rows to items, topics to items, scored context, and the weekly run."""

from functools import reduce

from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions import fields as fd
from ..functions import gates as gt
from ..functions import labels as lb
from ..functions import quality as ql
from ..functions import text as tx
from ..functions.expr import c, first_filled, nz, strip, text
from ..functions.scoring import score_items
from ..operators import joins as jn
from ..operators import retrieval as rt
from ..operators import review as rv
from ..operators import rollups as ru
from ..operators import segment as sg
from ..sources import scratch
from ..sources import sinks as sk

STRINGS = "array<string>"
BLOCKS = "array<struct<pos:bigint,type:string,text:string>>"


def _column(df, name, default):
    return F.col(name) if name in df.columns else default


def _raw_article(df, limit):
    """Columns of a raw article by name: aliases coalesced, advertisement text blanked, see normalize_raw_article."""
    s = lambda k: text(_column(df, k, F.lit("")))
    title = first_filled(s("title"), s("original_title"), s("name"), F.lit("无标题"))
    body = first_filled(s("content_text"), s("text"), s("full_text"), s("summary"))
    body = F.when(strip(body).isin(*lx.AD_DISCLAIMERS), "").otherwise(body)
    images = F.slice(F.coalesce(_column(df, "images", F.lit(None)).cast(STRINGS), F.array().cast(STRINGS)), 1, limit)
    body = F.when((body == "") & (F.size(images) > 0), title).otherwise(body)
    extra = {k: F.col(k) for k in ("ord", "blocks", "publish_time", "source") if k in df.columns}
    return {"url": s("url"), "title": title, "account_name": first_filled(s("account_name"), s("author"), s("biz_name"), F.lit("未知公众号")), "content_text": body, "images": images} | extra


def normalize_raw_article(df, limit=3):
    """(url, title, account_name, content_text, images, blocks): aliases coalesced, advertisement text blanked,
    the title as text when only images are left, at most `limit` images.
    """
    return df.select(*[v.alias(k) for k, v in _raw_article(df, limit).items()])


TRACE = ("ord", "doc_id", "article_id", "topic_id", "is_split", "split_confidence", "source_article_title", "batch_label")


def _item_rows(df, source="", bank="", skip_auto_classify=False):
    """Raw rows in the one shape that the rules read: raw columns, types of the blocks, item_id. clean_text is null where it
    is the raw text, so that a text travels once; raw_category is blank where the rules decide."""
    s = lambda *ks: first_filled(*[text(_column(df, k, F.lit(""))) for k in ks])
    none = F.array().cast(STRINGS)
    blocks = _column(df, "blocks", F.array().cast(BLOCKS))
    from_blocks = F.array_join(F.transform(F.filter(blocks, lambda b: b["type"].isin(*lx.FACT_TYPES) & (F.coalesce(b["text"], F.lit("")) != "")), lambda b: b["text"]), "\n\n")
    keep = [k for k in TRACE if k in df.columns]
    raw = first_filled(s("content_text", "raw_text", "full_text", "text"), from_blocks)
    clean = first_filled(from_blocks, s("content_text", "full_text"))
    d = df.select(*keep, s("title").alias("raw_title"), s("url").alias("url"), s("author", "account_name").alias("author"), s("publish_time", "pub_date", "publish_date").alias("publish_time"),
                  raw.alias("raw_text"), F.when(clean != raw, clean).alias("clean_text"),
                  F.coalesce(_column(df, "images", none).cast(STRINGS), none).alias("images"), (s("category") if skip_auto_classify else F.lit("")).alias("raw_category"), first_filled(F.lit(bank), s("bank")).alias("explicit"),
                  F.coalesce(_column(df, "structured", F.create_map().cast("map<string,string>")), F.create_map().cast("map<string,string>")).alias("given"), F.transform(blocks, lambda b: F.struct(b["type"].alias("type"))).alias("blocks"),
                  (s("source") if "source" in df.columns and not source else F.lit(source)).alias("source"))
    return d.withColumn("item_id", F.substring(F.md5(F.concat_ws("|", "source", "url", "raw_title", *[k for k in ("topic_id",) if k in keep])), 1, 12))


def _classified(d):
    """_item_rows plus category and candidates with their evidence."""
    d = d.withColumn("clean_text", F.coalesce("clean_text", "raw_text"))
    kept = F.struct(F.col("raw_category").alias("category"), F.array().cast(lb.CANDIDATES).alias("candidates"), F.array(F.concat(F.lit("保留原始分类: "), "raw_category")).alias("evidence"))
    d = d.withColumn("_k", F.when(F.col("raw_category") != "", kept).otherwise(lb.classify_3tier("raw_title", first_filled("clean_text", "raw_text"))))
    return d.withColumns({"category": F.when(F.col("_k.category").isin(*lx.CATEGORIES), F.col("_k.category")).otherwise(lb.normalize_category("_k.category")), "candidates": F.col("_k.candidates")})


def _normalized(d):
    """_classified rows to full item rows; further columns pass through."""
    keep = [k for k in d.columns if k in (*TRACE, "suggested")]
    body = first_filled("clean_text", "raw_text")
    d = d.withColumn("_b", lb.resolve_bank("raw_title", "author", body, F.col("explicit")))
    d = d.withColumns({"bank": F.col("_b.bank"), "publisher_name": F.col("_b.publisher_name"), "source_name": F.col("_b.source_name")})
    ocr = (strip(F.col("clean_text")) == "") & (F.size("images") > 0)
    built = F.when(ocr, fd.build_structured_from_ocr("category", "raw_title", "raw_text")).otherwise(fd.build_structured("category", "raw_title", "clean_text", "raw_text", "author", "url"))
    d = d.withColumn("structured", F.when(F.size("given") > 0, F.col("given")).otherwise(built))
    clean = tx.clean_structured_map("structured")
    named = F.when(F.col("source_name") != lx.UNKNOWN_BANK, F.map_concat(F.map_filter(clean, lambda k, v: k != "来源"), F.create_map(F.lit("来源"), F.col("source_name")))).otherwise(clean)
    d = d.withColumn("structured_clean", named)
    d = d.withColumns({"_d": fd.display_title("bank", "category", "structured", "raw_title"), "highlight_summary": fd.highlight_summary("category", "structured", "structured_clean", "raw_title", body, "bank")})
    d = d.withColumns({"title": F.col("_d.title"), "title_source": F.col("_d.title_source"), "confidence": ql.confidence("candidates", F.col("_b.confidence"), F.col("_d.title_source"), "raw_title", "structured", "category")})
    d = d.withColumns({"noise_flags": ql.noise_flags("blocks", "raw_text", "category"),
                       "evidence": F.create_map(F.lit("bank"), F.col("_b.evidence"), F.lit("category"), F.col("_k.evidence")),
                       "source_type": F.when(F.col("source") == "wechat", "公众号文章").when(F.col("source") == "website", "官网公告").otherwise(F.col("source"))})
    split = {"is_split": F.col("is_split"), "split_confidence": F.col("split_confidence")} if "is_split" in keep else {"is_split": None, "split_confidence": None}
    d = d.withColumn("review_flags", ql.review_flags("confidence", "candidates", "title", "raw_title", "structured", "publish_time", **split))
    return d.select(*keep, "item_id", "source", "source_type", "category", "candidates", "bank", "publisher_name", "source_name", "title", "raw_title", "title_source", "highlight_summary", "url", "raw_text", "images", "structured", "structured_clean",
                    "author", "publish_time", "confidence", "evidence", "noise_flags", "review_flags")


def normalize_items(df, source="", bank="", skip_auto_classify=False):
    """Raw rows to full item rows, as staged projections without a shuffle; write the result before filtering on it.

    Reads title, url, author / account_name, publish_time, content_text / raw_text / full_text / text, category, bank,
    structured, images and blocks where present.
    """
    return _normalized(_classified(_item_rows(df, source, bank, skip_auto_classify)))


def normalize_batch(df, label, source="", bank="", skip_auto_classify=False):
    """normalize_items with a batch label; `bank` is the default for rows without their own."""
    d = df.withColumn("bank", first_filled(text(_column(df, "bank", F.lit(""))), F.lit(bank)))
    return normalize_items(d, source, "", skip_auto_classify).withColumn("batch_label", F.lit(label))


def articles_to_items(articles):
    """Article map rows to items: mapped category, resolved bank, structured fields without empties, bracket marks removed."""
    s = lambda *ks: first_filled(*[text(_column(articles, k, F.lit(""))) for k in ks])
    d = articles.select(s("url").alias("url"), s("title", "original_title").alias("title"), s("text", "summary").alias("body"), s("author").alias("author"), s("publish_time").alias("publish_time"), s("bank").alias("_bank"),
                        lb.normalize_category(s("category")).alias("category"), F.coalesce(_column(articles, "images", F.lit(None)).cast(STRINGS), F.array().cast(STRINGS)).alias("images"))
    d = d.withColumn("bank", first_filled("_bank", lb.extract_bank_name("title", "body"))).withColumn("structured", fd.build_structured("category", "title", "body"))
    return d.select(F.lit("wechat").alias("source"), "category", "bank", "title", "url", tx.strip_bracket_marks("body").alias("raw_text"), "images", F.map_filter("structured", lambda k, v: (v != "") & (v != "[]")).alias("structured"), "author", "publish_time")


def notices_to_items(notices, since=None, until=None, low_value=lx.LOW_VALUE_NOTICE, year=None, skips=None):
    """Notice rows (title, url, content, bank, publish_time, category) to items: low-value and date filters, class, fields.

    skips, an Observation, gets low_value and out_of_range: how many rows each filter drops, counted in the same pass."""
    n = notices.withColumns({"_low": gt.is_low_value("title", "content", low_value), "_day": fd.parse_date_multi("publish_time", year)})
    if skips is not None:
        n = n.observe(skips, F.count_if("_low").alias("low_value"), F.count_if(~F.col("_low") & _outside("_day", since, until)).alias("out_of_range"))
    n = n.filter(~F.col("_low")).drop("_low")
    n = gt.filter_date_range(n, "_day", since and F.lit(since).cast("timestamp"), until and F.lit(until).cast("timestamp")) if (since or until) else n
    raw = text(_column(notices, "category", F.lit("")))
    n = n.withColumns({"category": F.when(raw == "", lb.classify_3tier("title", "content")["category"]).otherwise(lb.normalize_category(raw)),
                       "bank": first_filled(text(_column(notices, "bank", F.lit(""))), lb.extract_bank_name("title", "content"))})
    return n.select(F.lit("website").alias("source"), "category", "bank", "title", "url", F.col("content").alias("raw_text"), fd.build_structured_notice("category", "title", "content", "publish_time", "bank").alias("structured"), "publish_time")


def _outside(day, since, until):
    out = F.lit(False)
    if since:
        out = out | (F.col(day) < F.lit(since).cast("timestamp"))
    if until:
        out = out | (F.col(day) > F.lit(until).cast("timestamp"))
    return F.coalesce(out, F.lit(False))


def scrape_rows_to_items(list_rows, details, since=None, until=None, strict=lx.STRICT_DATE_SOURCES, low_value=lx.LOW_VALUE_LIST):
    """List rows (source, title, url, date_str) and detail rows (url, title, date_str, content) to items.

    The list is date-filtered before the join; the detail date decides after it; strict sources need a date.
    """
    win = lambda df, k: gt.filter_date_range(df, k, since and F.lit(since).cast("timestamp"), until and F.lit(until).cast("timestamp"))
    l = win(list_rows.select("source", F.col("title").alias("list_title"), "url", fd.parse_date_multi("date_str").alias("_ld")), "_ld")
    j = l.join(details.select("url", F.col("title").alias("detail_title"), F.col("date_str").alias("_ds"), "content"), "url")
    j = j.withColumn("title", gt.bad_title_fallback("detail_title", "list_title"))
    j = j.filter(~gt.has_any(F.when(text("title") != "", F.col("title")).otherwise(F.substring("content", 1, 200)), low_value))
    day = F.when(text("_ds") != "", fd.parse_date_multi("_ds")).otherwise(F.col("_ld"))
    j = win(gt.require_date_for(j.withColumn("_day", day), "_day", "source", strict), "_day")
    j = j.withColumns({"category": lb.classify_3tier("title", "content")["category"], "publish_time": F.coalesce(F.date_format("_day", "yyyy.MM.dd"), F.lit("")), "bank": F.col("source")})
    return j.select(F.lit("website").alias("source"), "category", "bank", "title", "url", F.col("content").alias("raw_text"), fd.build_structured_notice("category", "title", "content", "publish_time", "bank", True).alias("structured"), F.col("bank").alias("author"), "publish_time")


def _source_rows(notices, webpages, *articles):
    """Rows of all sources in one shape, so that the rules stand in the plan once."""
    rows = [_item_rows(notices, source="website", skip_auto_classify=True), _item_rows(gt.drop_empty_webpage(webpages, "content_text"), source="website")]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [*articles, *rows])


def union_sources(articles, notices, webpages):
    """Articles, notices and web pages as item rows of one table; every source keeps its own rules.

    Articles: auto-classified. Notices: keep their category. Pages: blank ones dropped, auto-classified.
    """
    return _normalized(_classified(_source_rows(notices, webpages, _item_rows(normalize_raw_article(articles), source="wechat"))))


def _topic_rows(topics, articles):
    meta = articles.select("article_id", text("url").alias("url"), text("publisher_name").alias("author"), text("publish_time").alias("publish_time"))
    t = topics.join(meta, "article_id").withColumn("title", first_filled("headline", "source_article_title"))
    return _item_rows(t.select("article_id", "topic_id", "source_article_title", "title", "url", "author", "publish_time", "blocks", "is_split", "split_confidence"), source="wechat")


def topic_items(topics, articles):
    """Topics (segment_topics) to items with trace fields; split confidence below 0.6 is flagged."""
    return _normalized(_classified(_topic_rows(topics, articles)))


def build_context(spark, items, focus=None):
    """(scored, category rollup, institution rollup, totals); items are scored once into a written table."""
    d = items.filter(F.col("category") == focus) if focus else items
    scored = scratch.cut_lineage(spark, score_items(d), "scored")
    return scored, ru.category_counts(scored), ru.bank_summary(scored), ru.batch_totals(scored)


def _bare_rows(pieces, confidence=lx.RAW_SPLIT_CONFIDENCE):
    """Item rows of _pieces: a whole article, or title, text and institution of a topic with the article's envelope."""
    cut = F.col("piece").isNotNull()
    whole = _raw_article(pieces, 3)
    images = F.coalesce(_column(pieces, "images", F.lit(None)).cast(STRINGS), F.array().cast(STRINGS))
    topic = {"title": F.col("piece.headline"), "content_text": F.col("piece.body"), "images": images, "publish_time": text("publish_time"),
             "account_name": first_filled(text(_column(pieces, "account_name", F.lit(""))), text("author"), F.lit("未知公众号"))}
    own = {k: F.when(cut, topic[k]).otherwise(v) if k in topic else F.when(~cut, v) if k in ("ord", "blocks", "source") else v for k, v in whole.items()}
    trace = {"article_id": F.col("article_id"), "topic_id": F.concat("article_id", F.lit("_r"), (F.col("piece_no") + 1).cast("string")), "source_article_title": text("title"),
             "bank": F.coalesce(F.try_element_at("piece.bank_hints", F.lit(1)), F.lit("")), "is_split": F.lit(True), "split_confidence": F.lit(confidence)}
    return _item_rows(pieces.select(*[v.alias(k) for k, v in own.items()], *[F.when(cut, v).alias(k) for k, v in trace.items()]), source="wechat")


def _split(spark, articles, article_blocks):
    """(pieces, topics): the articles that are no candidates, each once or, without blocks, by the topics of its text
    (piece_no, piece; null for a whole one); the topics of the candidates as item rows.

    Only one flag per article is written between the steps; texts are neither written nor looked up again.
    """
    signs = scratch.cut_lineage(spark, sg.multi_topic_signals(article_blocks).select("article_id", "is_candidate"), "signals")
    some = article_blocks.join(signs.filter("is_candidate"), "article_id", "left_semi")
    envelope = articles.select("article_id", text("title").alias("raw_title"), "url", text("author").alias("publisher_name"), "publish_time")
    body = first_filled(*[text(_column(articles, k, F.lit(""))) for k in ("content_text", "full_text", "text")])
    a = articles.join(signs, "article_id", "left").filter("NOT coalesce(is_candidate, false)").withColumn("_bare", F.when(F.col("is_candidate").isNull(), body).otherwise(""))
    # outer explode: a whole article stays one row, and the fold runs once per text
    pieces = a.select(*articles.columns, F.posexplode_outer(sg.raw_topics("_bare")).alias("piece_no", "piece"))
    return pieces, _topic_rows(sg.segment_topics(some, envelope), envelope)


def split_articles(spark, articles, article_blocks):
    """(articles that stay whole, items of the others' topics).

    Articles with blocks are cut at topic starts where the signals make them candidates; articles without blocks at
    boundaries of their text. articles: article_id, title, url, author, publish_time, content_text, images.
    """
    pieces, topics = _split(spark, articles, article_blocks)
    cut = topics.unionByName(_bare_rows(pieces.filter("piece IS NOT NULL")), allowMissingColumns=True)
    return pieces.filter("piece IS NULL").select(*articles.columns), _normalized(_classified(cut))


def corrected(items):
    """Items after their accepted corrections (suggested: category, bank, title): what shows them is made anew for the changed ones.

    Title (unless it was corrected itself), summary, confidence and flags follow the new category and bank; the bank counts
    as unconfirmed.
    """
    own = [k for k in items.columns if k != "suggested"]
    d = jn.accepted(items.select(*own, *[F.col(f"suggested.{k}").alias(f"_{k}") for k in ("category", "bank", "title")]), own)
    items = items.select(*own)
    d = d.withColumn("_d", F.when(F.col("modified"), fd.display_title("bank", "category", "structured", "raw_title")))
    own = F.try_element_at("evidence", F.lit("title")).isNotNull()
    d = d.withColumns({"_title": F.when(own, F.col("title")).otherwise(F.col("_d.title")), "_confidence": ql.confidence("candidates", F.lit(0.0), F.col("_d.title_source"), "raw_title", "structured", "category")})
    split = {k: _column(d, k, None) for k in ("is_split", "split_confidence")}
    new = {"title": F.col("_title"), "title_source": F.col("_d.title_source"), "confidence": F.col("_confidence"),
           "highlight_summary": fd.highlight_summary("category", "structured", "structured_clean", "raw_title", first_filled("raw_text"), "bank"),
           "review_flags": ql.review_flags("_confidence", "candidates", "_title", "raw_title", "structured", "publish_time", **split)}
    return d.select(*[F.when(F.col("modified"), new[k]).otherwise(F.col(k)).alias(k) if k in new else F.col(k) for k in [*items.columns, "modified"]])


def enriched(scored, scores, fields=("target_audience", "key_benefits", "fee_assessment", "priority")):
    """Scored items with the fields of a score table (item_id, title, ord, fields) where it has them: by id, else by title."""
    found = jn.enrich_from_scores(scored.drop(*fields), scores, fields)
    both = found.select(F.col("item_id").alias("_id"), F.col("title").alias("_title"), *[F.col(k).alias(f"_{k}") for k in fields], "matched").distinct()
    j = scored.join(both, (F.col("item_id") == F.col("_id")) & F.col("title").eqNullSafe(F.col("_title")))
    filled = lambda k: F.size(f"_{k}") > 0 if k == "key_benefits" else text(f"_{k}") != ""
    return j.select(*[F.when(filled(k), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) if k in fields else F.col(k) for k in scored.columns], "matched")


def weekly_run(spark, articles, notices, webpages, label, archive_root=None, archive_time=None, article_blocks=None, corrections=None, scores=None):
    """The whole chain: split topics, union, correct, score, enrich, noise filter, manifest, archive. Returns (items, manifest).

    article_blocks (article_id, pos, type, text, is_heading_like) lets articles with several topics become several items,
    those without blocks by their text; corrections (item_id, category, bank, title) are accepted review suggestions;
    scores overrides the rules' score fields. review_of(items) gives the review queue, references_of(items, ...) the
    knowledge-base references. Rows of category 其他 leave as soon as their category is known. Items are written once, as
    the archive if there is one, which the returned table and the manifest read.
    """
    own = _item_rows(normalize_raw_article(articles), source="wechat") if article_blocks is None else None
    if own is None:
        pieces, topics = _split(spark, articles, article_blocks)
        own = _bare_rows(pieces).unionByName(topics, allowMissingColumns=True)
    rows = _source_rows(notices, webpages, own).withColumn("batch_label", F.lit(label))
    if corrections is not None:
        # written, so that Spark picks the join from its real size; raw rows are joined, before anything is derived from them
        s = scratch.cut_lineage(spark, corrections.select("item_id", F.struct("category", "bank", "title").alias("suggested")), "corrections")
        rows = rows.join(s, "item_id", "left")
    d = _classified(rows)
    category = F.col("category") if corrections is None else jn.accepted_category("suggested.category")
    # a generated column: the filter stays above the classification instead of evaluating it once more
    d = d.select("*", F.explode_outer(F.array(category)).alias("_category")).filter(F.col("_category") != lx.OTHER).drop("_category")
    items = _normalized(d)
    scored = score_items(items if corrections is None else corrected(items))
    if scores is not None:
        scored = scratch.cut_lineage(spark, enriched(scratch.cut_lineage(spark, scored, "scored"), scores), "enriched")
    rich = scored.withColumn("highlight_summary", first_filled(
        fd.highlight_summary("category", "structured", "structured", "raw_title", "raw_text", "bank", "key_benefits", "fee_assessment"), F.array_join(F.slice("key_benefits", 1, 3), "、"), F.substring("title", 1, 80)))
    final = rich.withColumn("low_value", gt.low_value())
    final = sk.write_archive(final, archive_root, archive_time, label) if archive_root else scratch.cut_lineage(spark, final, "final")
    return final, sk.archive_manifest(final, archive_time or "")


def references_of(items, postings, stats, k=3):
    """(item_id, rank, doc_id, score, step): knowledge-base references of the highlighted items."""
    asked = items.filter("is_highlight").groupBy("item_id").agg(F.min(F.struct("category", "bank", "title")).alias("i")).select(F.col("item_id").alias("qid"), "i.*")
    return rt.suggestion_query(asked, postings, stats, k).select(F.col("qid").alias("item_id"), "rank", "doc_id", "score", "step")


def review_of(items):
    """The review queue of a run's items."""
    return rv.review_queue(items)
