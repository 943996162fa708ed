"""Writers: batch JSON, partitioned archive and its manifest, report lines, run log.

Reports are tables of lines with a sort key (section, ord, n): they stay distributed until written as text.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions.expr import c, case, first_filled, head, text
from ..operators.rollups import bank_summary, category_rank, number_rows, theme_rollup, with_group_count
from ..functions.labels import theme_tag


def write_batch_json(items, path, generated_at, version="1.0"):
    """Items as JSON lines under batch_label=..., plus one header row per batch under <path>_headers."""
    items.write.mode("overwrite").partitionBy("batch_label").json(path)
    h = items.groupBy("batch_label").agg(F.count(F.lit(1)).alias("total"))
    h.select(F.lit(version).alias("schema_version"), F.lit(generated_at).alias("generated_at"), "batch_label", "total").write.mode("overwrite").json(path + "_headers")


def batch_documents(items, generated_at, size=200, version="1.0"):
    """One JSON text per batch part {header, items[]}, at most `size` items each, for consumers of single documents."""
    # parts are dealt by hash into groups of some 50 documents, however large a batch is
    groups = items.groupBy("batch_label").agg(F.ceil(F.count(F.lit(1)) / (50 * size)).alias("_groups"))
    d = items.join(groups, "batch_label").withColumn("_group", F.pmod(F.xxhash64("item_id"), F.col("_groups"))).drop("_groups")
    w = W.partitionBy("batch_label", "_group").orderBy("item_id")
    part = d.withColumn("_part", F.concat_ws("-", F.col("_group").cast("string"), F.floor((F.row_number().over(w) - 1) / size).cast("string"))).drop("_group")
    row = F.struct(*[k for k in items.columns if k != "batch_label"])
    g = part.groupBy("batch_label", "_part").agg(F.collect_list(row).alias("items"))
    return g.select(F.to_json(F.struct(F.lit(version).alias("schema_version"), F.lit(generated_at).alias("generated_at"), "batch_label", F.size("items").alias("total"), "items")).alias("value"))


def safe_label(x):
    return F.regexp_replace(c(x), r"[^\p{L}\p{N} _.\-]", "_")


def write_archive(items, root, archive_time, label=None):
    """Items under year / month / batch_label; a re-run replaces only the partitions it writes.

    With the label of their one batch it returns the items as the archive holds them."""
    t = F.lit(archive_time).cast("timestamp")
    a = items.withColumns({"year": F.year(t), "month": F.month(t), "batch_label": safe_label("batch_label")})
    a.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "month", "batch_label").parquet(root)
    if label is None:
        return None
    batch = (F.col("year") == F.year(t)) & (F.col("month") == F.month(t)) & (F.col("batch_label") == safe_label(F.lit(label)))
    return items.sparkSession.read.schema(a.schema).parquet(root).filter(batch).withColumn("batch_label", F.lit(label)).select(*items.columns)


def archive_manifest(items, archive_time, key="batch_label"):
    """Per batch: total, count of every category, distinct banks (sorted text), images."""
    n = [F.count_if(F.col("category") == k).alias(f"n_{i}") for i, k in enumerate(lx.CATEGORIES)]
    g = items.groupBy(key).agg(F.count(F.lit(1)).alias("total_items"), *n, F.array_join(F.array_sort(F.collect_set(F.when(text("bank") != "", F.col("bank")))), ",").alias("banks"), F.sum(F.size("images")).alias("image_count"))
    return g.withColumn("archive_time", archive_time if not isinstance(archive_time, str) else F.lit(archive_time))


def archive_index(*manifests):
    """All manifests, newest first."""
    out = manifests[0]
    for m in manifests[1:]:
        out = out.unionByName(m)
    return out.orderBy(F.desc("archive_time"), "batch_label")


def _lines(df, section, ord_, lines):
    """(section, ord, n, line) rows from an array column of lines; NULL lines are left out."""
    return df.select(section.cast("int").alias("section"), ord_.cast("bigint").alias("ord"), F.posexplode(F.array_compact(lines)).alias("n", "line"))


def digest_markdown(spark, items, title, images=True):
    """Digest lines: a section per category, the items in order, an image index."""
    rank = category_rank("category")
    top = spark.range(1).select(F.lit(-1).alias("section"), F.lit(0).cast("bigint").alias("ord"), F.lit(0).alias("n"), F.lit(f"# 信用卡周报 - {title}").alias("line"))
    heads = items.select("category").distinct().select(rank.alias("section"), F.lit(-1).cast("bigint").alias("ord"), F.lit(0).alias("n"), F.concat(F.lit("## "), "category").alias("line"))
    sn = F.when(F.length("raw_text") > 500, F.concat(head("raw_text", 500), F.lit("..."))).otherwise(text("raw_text"))
    kv = F.transform(F.map_entries("structured"), lambda e: F.concat(F.lit("- **"), e["key"], F.lit("**："), e["value"]))
    link = F.transform("images", lambda p: F.concat(F.lit("!["), "title", F.lit("]("), p, F.lit(")")))
    opt = lambda cond, l: F.when(cond, l)
    body = F.concat(F.array(F.concat(F.lit("### "), "title"), opt(text("highlight_summary") != "", F.concat(F.lit("**亮点：** "), "highlight_summary")),
                            opt((text("bank") != "") | (text("source") != ""), F.concat_ws(" | ", opt(text("bank") != "", F.concat(F.lit("银行："), "bank")), opt(text("source") != "", F.concat(F.lit("来源："), "source")))),
                            opt(text("url") != "", F.concat(F.lit("[原文链接]("), "url", F.lit(")"))), opt(F.size("structured") > 0, F.lit("**结构化信息：**"))), kv,
                    F.array(opt(sn != "", F.lit("**原文摘要：**")), opt(sn != "", sn)), link, F.array(F.lit("---")))
    out = top.unionByName(heads).unionByName(_lines(items, rank, F.col("ord"), body))
    if not images:
        return out
    im = items.select(rank.alias("_r"), "ord", "category", "title", F.posexplode("images").alias("pos", "p"))
    im = number_rows(spark, im, ["_r", "ord", "pos"])
    line = F.concat(F.col("rank").cast("string"), F.lit(". ["), "title", F.lit("]("), "p", F.lit(") — 分类："), "category")
    return out.unionByName(im.select(F.lit(99).alias("section"), F.col("rank").cast("bigint").alias("ord"), F.lit(0).alias("n"), line.alias("line")))


def review_queue_markdown(spark, queue, meta):
    """Review list lines: the counts, then one numbered block per item in queue order."""
    m = meta.select(F.lit(-1).alias("section"), F.lit(0).cast("bigint").alias("ord"), F.lit(0).alias("n"), F.concat(F.lit("**总计**: "), F.col("total").cast("string"), F.lit(" 条 | **待复核**: "), F.col("flagged_count").cast("string"), F.lit(" 条 | **高优先级**: "), F.col("high_severity").cast("string"), F.lit(" 条")).alias("line"))
    q = number_rows(spark, queue.withColumn("_o", F.col("confidence.overall")), ["_o", "item_id", "doc_id"] if "doc_id" in queue.columns else ["_o", "item_id"])
    f3 = lambda k: F.format_string("%.3f", F.col(f"confidence.{k}"))
    sev = case([(F.col("severity") == "high", "!!! 高"), (F.col("severity") == "medium", "!! 中")], "! 低")
    lines = F.array(F.lit("---"), F.concat(F.lit("### "), F.col("rank").cast("string"), F.lit(". ["), sev, F.lit("] "), "title"), F.concat(F.lit("- **银行**: "), "bank"), F.concat(F.lit("- **分类**: "), "category"), F.concat(F.lit("- **URL**: "), first_filled("url", F.lit("无"))),
                    F.concat(F.lit("- **审核标记**: "), F.array_join("review_flags", ", ")), F.concat(F.lit("- **综合置信度**: "), f3("overall")),
                    F.concat(F.lit("  - 分类: "), f3("category"), F.lit(" | 银行: "), f3("bank"), F.lit(" | 标题: "), f3("title"), F.lit(" | 结构化: "), f3("structured")))
    return m.unionByName(_lines(q, F.lit(0), F.col("rank"), lines))


def analysis_markdown(scored):
    """Analysis lines: items per category with score and dimensions, then the institutions with their counts."""
    rank = category_rank("category")
    heads = scored.groupBy("category").agg(F.count(F.lit(1)).alias("k")).select(rank.cast("int").alias("section"), F.lit(-1).cast("bigint").alias("ord"), F.lit(0).alias("n"), F.concat(F.lit("## "), "category", F.lit("（共 "), F.col("k").cast("string"), F.lit(" 条）")).alias("line"))
    num = lambda x: F.format_string("%.1f", x)
    dims = F.transform("dimensions", lambda d: F.concat(F.lit("  - "), d["name"], F.lit("："), num(d["score"]), F.lit("/10（权重 "), F.round(d["weight"] * 100, 0).cast("int").cast("string"), F.lit("%）")))
    body = F.concat(F.array(F.concat(F.lit("### "), "bank", F.lit(" · "), "title"), F.when(text("url") != "", F.concat(F.lit("原文："), "url")), F.when(F.size("images") > 0, F.concat(F.lit("附图："), F.size("images").cast("string"), F.lit(" 张"))),
                            F.concat(F.lit("- ROI 评分：**"), num(F.col("overall_score")), F.lit("/10**（"), "overall_roi", F.lit("）— "), "recommendation"), F.when(text("summary") != "", F.concat(F.lit("- 小结："), "summary"))), dims)
    b = bank_summary(scored)
    part = lambda k, name: F.when(F.col(k) > 0, F.concat(F.lit(name + " "), F.col(k).cast("string")))
    counts = F.concat_ws(" | ", part("new_card_count", "新卡"), part("change_count", "权益变更"), part("activity_count", "活动"), part("announcement_count", "公告"))
    banks = b.select(F.lit(90).alias("section"), F.col("first_ord").cast("bigint").alias("ord"), F.lit(0).alias("n"), F.concat(F.lit("### "), "bank", F.lit("（"), first_filled(counts, F.lit("无条目")), F.lit("）")).alias("line"))
    return heads.unionByName(_lines(scored, rank, F.col("ord"), body)).unionByName(banks)


def editorial_markdown(merged, sources):
    """Editorial lines: categories, themes with their items, the merged items, the source list."""
    at = lambda s, o, line: (F.lit(s).alias("section"), o.cast("bigint").alias("ord"), F.lit(0).alias("n"), line.alias("line"))
    cats = merged.groupBy(first_filled(text("category"), F.lit("未分类")).alias("k")).agg(F.count(F.lit(1)).alias("v"), F.min("ord").alias("o")).select(*at(0, F.col("o"), F.concat("k", F.lit(" "), F.col("v").cast("string"), F.lit(" 条"))))
    tagged = theme_tag(merged.select("ord", "title", F.col("comment").alias("body")))
    themes = tagged.select(*at(1, F.col("ord"), F.concat(F.lit("- **"), "theme", F.lit("**："), "note", F.lit("。涉及："), "title")))
    note = F.when(F.col("duplicate_count") > 1, F.concat(F.lit("> 合并说明：发现 "), F.col("duplicate_count").cast("string"), F.lit(" 份来源涉及同一事项，已合并展示。")))
    items = _lines(merged, F.lit(2), F.col("ord"), F.array(F.concat(F.lit("### "), "title"), F.when(text("category") != "", F.concat(F.lit("**属性**："), "category")), F.when(text("url") != "", F.concat(F.lit("**来源**："), "url")), F.when(text("comment") != "", F.col("comment")), note))
    src = sources.groupBy("file").agg(F.count(F.lit(1)).alias("v"), F.min("ord").alias("o")).select(*at(3, F.col("o"), F.concat(F.lit("- "), "file", F.lit("（"), F.col("v").cast("string"), F.lit(" 条）"))))
    return cats.unionByName(themes).unionByName(items).unionByName(src)


def write_lines(lines, path):
    """Report lines as text files in report order (range-partitioned sort)."""
    lines.orderBy("section", "ord", "n").select("line").write.mode("overwrite").text(path)


def atomic_write(df, path, fmt="parquet"):
    """Replace a table whole or not at all: write a fresh sibling folder, then point to it.

    The table is the folder that the newest complete pointer names (read_atomic follows it). A failing write leaves an
    unused folder and the pointer as it was; a reader sees the old rows or the new ones, never a mixture."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.format(fmt).save(f"{path}/data-{name}")
    number = (_pointer(spark, path) or (0, None))[0] + 1
    spark.createDataFrame([(number, f"data-{name}")], "number long, folder string").coalesce(1).write.mode("append").json(f"{path}/pointers")


def _pointer(spark, path):
    """(number, folder) of the newest pointer, None before the first write."""
    try:
        newest = spark.read.schema("number long, folder string").json(f"{path}/pointers").agg(F.max(F.struct("number", "folder")).alias("p")).first().p
    except AnalysisException:  # no pointer folder yet
        return None
    return tuple(newest) if newest else None


def read_atomic(spark, path, fmt="parquet"):
    """The rows of the last complete atomic_write."""
    found = _pointer(spark, path)
    if not found:
        raise FileNotFoundError(path)
    return spark.read.format(fmt).load(f"{path}/{found[1]}")


def run_log(spark, path, last_run, bank_days, count):
    """Append one run row."""
    spark.range(1).select(F.lit(last_run).alias("last_run"), F.lit(bank_days).alias("bank_days"), F.lit(count).cast("bigint").alias("items")).write.mode("append").json(path)
