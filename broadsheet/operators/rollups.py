"""Counts and rollups by category, institution, theme and list. Members stay rows: no group is collected whole."""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions.expr import any_of, c, case, count_hits, has, has_any, let, strip, text
from ..functions.fields import annual_benefit
from ..functions.labels import theme_tag
from ..functions.text import strip_control_chars
from ..sources import scratch

label = lambda: F.concat(F.col("bank"), F.lit(" · "), F.col("title"))


def category_rank(x, order=lx.CATEGORIES):
    return case([(c(x) == k, i) for i, k in enumerate(order)], len(order))


def category_counts(df, order=lx.CATEGORIES):
    """(category, n, rank) for the categories present, in report order."""
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", category_rank("category", order)).orderBy("rank", "category")


def with_group_count(df, key, name="count"):
    """Rows plus the size of their group: aggregate and join back, no window over a whole group."""
    return df.join(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key)


def category_summary(df, columns=("item_id", "title", "bank")):
    """(category, count, item columns): item rows of each category with the category's size."""
    return with_group_count(df, "category").select("category", "count", *columns)


def nest_by_category(df):
    """(batch_label, category, section, title, content, url): item rows under numbered category sections."""
    first = df.groupBy("batch_label", "category").agg(F.min("ord").alias("first"))
    w = W.partitionBy("batch_label").orderBy("first")
    sections = first.withColumn("section", F.row_number().over(w)).drop("first")
    return df.join(sections, ["batch_label", "category"]).select("batch_label", "category", "section", "title", F.col("raw_text").alias("content"), "url", "ord")


def bank_summary(df):
    """Per institution the four category counts; more promotions and new cards first."""
    n = lambda k: F.count_if(F.col("category") == k)
    g = df.groupBy(F.when(text("bank") == "", "未知银行").otherwise(F.col("bank")).alias("bank")).agg(
        n("新卡").alias("new_card_count"), n("权益变更").alias("change_count"), n("活动").alias("activity_count"), n("公告").alias("announcement_count"), F.min("ord").alias("first_ord"))
    return g.orderBy(F.desc(F.col("activity_count") + F.col("new_card_count")), "first_ord")


def batch_totals(df, scorer="keyword"):
    return df.agg(F.count(F.lit(1)).alias("total_items"), F.countDistinct(F.when(text("bank") == "", "未知银行").otherwise(F.col("bank"))).alias("bank_count")).withColumn("scorer", F.lit(scorer))


def theme_rollup(df, themes=lx.THEMES):
    """(theme, note, n): items per theme; theme_tag gives the titles as rows."""
    return theme_tag(df, themes=themes).groupBy("theme", "note").agg(F.count(F.lit(1)).alias("n"))


def overview_stats(df):
    """(category, n, total)."""
    g = df.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("total", df.agg(F.count(F.lit(1)).alias("t")).scalar())


def scene_comparison(df, scenes=lx.SCENES, score=7, least=2):
    """(scene, n): scenes with two or more high-scoring cards or promotions."""
    good = df.filter(F.col("category").isin("新卡", "活动") & (F.col("overall_score") >= score))
    t = F.concat_ws("\n", F.array_join("key_benefits", " "), "title")
    tags = F.array_compact(F.array(*[F.when(has(t, s), F.lit(s)) for s in scenes]))
    return good.select(F.explode(tags).alias("scene")).groupBy("scene").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def advice_lists(df):
    """(list, label, ord): recommend, watch, join, adjust (highlighted items) and cancel (all); a label once per list."""
    k, s, hl = F.col("category"), F.col("overall_score"), F.col("is_highlight")
    four = k.isin("新卡", "权益变更", "活动", "公告")
    lists = F.array_compact(F.array(
        F.when(hl & (k == "新卡") & (s >= 7), F.lit("recommend")), F.when(hl & (k == "权益变更") & (s <= 4), F.lit("watch")),
        F.when(hl & (k == "活动") & (s >= 7), F.lit("join")), F.when(hl & four & s.between(4, 6), F.lit("adjust")),
        F.when(k.isin("权益变更", "活动", "新卡") & (s <= 3), F.lit("cancel"))))
    return df.select(F.explode(lists).alias("list"), label().alias("label"), "ord").groupBy("list", "label").agg(F.min("ord").alias("ord"))


def highlighted_banks(df):
    return df.filter(F.col("is_highlight") & (text("bank") != "")).select("bank").distinct().orderBy("bank")


def holistic_keywords(df, key="batch_label"):
    """Per batch: which actions, risks and highlights its texts call for."""
    any_ = lambda *ws: F.max(has_any(text("raw_text"), list(ws)))
    return df.groupBy(key).agg(any_("免年费").alias("fee_free_action"), any_("返现").alias("cashback_action"), any_("缩水", "取消").alias("downgrade_risk"), any_("升级", "新增").alias("upgrade_highlight"))


def publish_overview(df, themes=lx.OVERVIEW_THEMES):
    """One row: total, the theme booleans and the automatic title (first two themes, points before AI before young)."""
    t = F.concat(text("title"), text("body"))
    a = df.agg(F.count(F.lit(1)).alias("total"), *[F.coalesce(F.bool_or(F.rlike(t, F.lit(pat))), F.lit(False)).alias(name) for name, pat, _ in themes])
    names = {n: note for n, _, note in themes}
    found = F.array_compact(F.array(*[F.when(F.col(n), F.lit(names[n])) for n in ("has_points", "has_ai", "has_young")]))
    return a.withColumn("title", F.concat(F.lit("信用卡资讯精选｜"), F.when(F.size(found) > 0, F.array_join(F.slice(found, 1, 2), "与")).otherwise("本期重点")))


def report_title(df, base="本期信用卡"):
    """One row per batch: base label plus its two leading distinct titles (category first, then length)."""
    t = F.regexp_replace(strip(strip_control_chars("title")), r"[：:]\s*公告$", "")
    d = df.select("batch_label", strip(t).alias("title"), category_rank("category", lx.CATEGORIES[:4]).alias("rank"), F.length(strip_control_chars("title")).alias("n"), "ord").filter("title <> ''")
    d = d.withColumn("rank", F.when(F.col("rank") > 3, 9).otherwise(F.col("rank")))
    key = F.struct("rank", (-F.col("n")).alias("n"), "ord")
    g = d.groupBy("batch_label", "title").agg(F.min(key).alias("k"))
    w = W.partitionBy("batch_label").orderBy("k")
    top = g.withColumn("rn", F.row_number().over(w)).filter("rn <= 2")
    named = top.groupBy("batch_label").agg(F.max(F.when(F.col("rn") == 1, F.col("title"))).alias("a"), F.max(F.when(F.col("rn") == 2, F.col("title"))).alias("b"))
    out = df.select("batch_label").distinct().join(named, "batch_label", "left")
    return out.select("batch_label", F.when(F.col("a").isNull(), F.lit(base + "周报")).otherwise(F.concat_ws("", F.lit(base + "亮点："), "a", F.concat(F.lit("、"), "b"))).alias("report_title"))


def suggested_days(runs, now, last_run="last_run", window="bank_days"):
    """Days to look back: since the last run, the last window, at least one."""
    d = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col(last_run).cast("timestamp"))) / 86400)
    return runs.withColumn("suggested", F.greatest(d, F.col(window).cast("bigint"), F.lit(1)).cast("bigint"))


def number_rows(spark, df, order, name="rank"):
    """1, 2, 3, ... over a total order without a global window: range partitions plus their offsets."""
    cols = [order] if isinstance(order, str) else list(order)
    p = df.repartitionByRange(*[c(k) for k in cols]).withColumn("_p", F.spark_partition_id())
    p = scratch.cut_lineage(spark, p, "ranged")
    local = p.withColumn("_loc", F.row_number().over(W.partitionBy("_p").orderBy(*[c(k) for k in cols])))
    # one row per range partition: bounded by the number of shuffle partitions
    sizes = p.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offs = sizes.select("_p", before.alias("_off"))
    return local.join(offs, "_p").withColumn(name, F.col("_loc") + F.col("_off")).drop("_p", "_loc", "_off")


def rank_recommendations(spark, df):
    """(rank, label, benefit): numbered new cards worth applying for, in item order."""
    d = df.filter((F.col("category") == "新卡") & F.col("is_highlight") & (F.col("overall_score") >= 7))
    d = d.select("ord", label().alias("label"), annual_benefit("recommendation", "summary", "key_benefits").alias("benefit"))
    return number_rows(spark, d, "ord").select("rank", "label", "benefit")


def topk_per_group(df, group, order, k):
    """First k rows per group; each task keeps at most k rows per group before the shuffle."""
    group = [group] if isinstance(group, str) else list(group)
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def latest_n_batches(items, manifest, current, n=3):
    """Items of the n newest archived batches other than the current one (a top-n over the small manifest)."""
    # the index is cut to n + 1 entries before the current label is dropped
    last = manifest.orderBy(F.desc("archive_time"), "batch_label").limit(n + 1).filter(F.col("batch_label") != current).orderBy(F.desc("archive_time"), "batch_label").limit(n)
    return items.join(last.select("batch_label"), "batch_label", "left_semi")


def adjacent_switch(df, key, order, terms="terms"):
    """Rows plus `switched`: filled term set disjoint from the previous row's filled set."""
    prev = F.lag(terms).over(W.partitionBy(key).orderBy(order))
    return df.withColumn("switched", F.coalesce((F.size(terms) > 0) & (F.size(prev) > 0) & ~F.arrays_overlap(c(terms), prev), F.lit(False)))


def period_trend(current, history, words=lx.TREND_WORDS, limit=5):
    """First distinct trend lines: weak highlighted items of now, then archived items with a downgrade word."""
    now = current.filter((F.col("overall_score") <= 3) & (F.col("highlight_reason") != "")).select(
        F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("age"), "ord", F.concat(F.col("bank"), F.lit(" "), F.col("title"), F.lit("：")  , F.col("highlight_reason")).alias("trend"))
    t = F.concat_ws(" ", text("title"), text("raw_text"))
    word = F.coalesce(*[F.when(has(t, w), F.lit(w)) for w in words])
    old = history.select("age", "ord", "bank", "title", word.alias("word")).filter("word IS NOT NULL").select(
        F.lit(1).alias("part"), F.col("age").cast("bigint").alias("age"), "ord", F.concat(F.col("bank"), F.lit(" "), F.col("title"), F.lit("（历史）："), F.col("word")).alias("trend"))
    g = now.unionByName(old).groupBy("trend").agg(F.min(F.struct("part", "age", "ord")).alias("k"))
    return g.orderBy("k").limit(limit).select("trend", F.col("k.part").alias("part"))
