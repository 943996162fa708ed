"""Confidence scores, review flags and severity."""

from pyspark.sql import functions as F

from .. import lexicon as lx
from .expr import c, case, first_filled, has, let, lit_array, nz, strip, text


def category_confidence(candidates):
    """Top candidate score, reduced when the second is close; 0 without candidates."""
    def body(k):
        top, second = F.try_element_at(k, F.lit(1))["score"], F.try_element_at(k, F.lit(2))["score"]
        close = F.greatest(F.lit(0.0), 0.15 - (top - second)) * 0.5
        return F.when(F.size(k) >= 2, F.greatest(F.lit(0.0), F.least(F.lit(1.0), top - close))).otherwise(F.coalesce(top, F.lit(0.0)))
    return let(F.coalesce(c(candidates), F.array().cast("array<struct<category:string,score:double>>")), body)


def title_confidence(title_source, raw_title):
    n = F.length(text(raw_title))
    base = F.when(c(title_source) == "generated", 0.4).otherwise(0.7)
    one = F.when(n >= 10, F.least(F.lit(1.0), base + 0.1)).otherwise(base)
    return F.when(n >= 20, F.least(F.lit(1.0), one + 0.1)).otherwise(one)


def structured_confidence(category, structured, expected=lx.EXPECTED_FIELDS):
    """Filled share of the fields the category expects."""
    m = c(structured)
    share = lambda fs: F.size(F.filter(lit_array(fs), lambda f: F.coalesce(F.try_element_at(m, f), F.lit("")) != "")) / F.lit(float(len(fs)))
    value = case([(c(category) == k, share(fs)) for k, fs in expected.items() if k != lx.OTHER], share(expected[lx.OTHER]))
    return F.when(F.coalesce(F.size(m), F.lit(0)) > 0, value).otherwise(0.0)


def overall_confidence(category, bank, structured, title):
    s = 0.35 * c(category) + 0.25 * c(bank) + 0.20 * c(structured) + 0.20 * c(title)
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 3)


def confidence(candidates, bank_confidence, title_source, raw_title, structured, category):
    """struct(overall, category, bank, title, structured), three decimals each."""
    def body(v):
        r = lambda k: F.bround(v[k], 3).alias(k)
        return F.struct(overall_confidence(v["category"], v["bank"], v["structured"], v["title"]).alias("overall"),
                        r("category"), r("bank"), r("title"), r("structured"))
    return let(F.struct(category_confidence(candidates).alias("category"), c(bank_confidence).cast("double").alias("bank"),
                        title_confidence(title_source, raw_title).alias("title"), structured_confidence(category, structured).alias("structured")), body)


def review_flags(conf, candidates, title, raw_title, structured, publish_time, is_split=None, split_confidence=None, images=None, item_id=None):
    """Distinct flags in a fixed order; see the thresholds below."""
    k = c(conf)
    top = F.try_element_at(c(candidates), F.lit(1))["score"]
    shown = first_filled(text(title), text(raw_title))
    split = c(is_split) if is_split is not None else F.lit(False)
    sc = c(split_confidence) if split_confidence is not None else F.lit(0.0)
    stray = F.exists(c(images), lambda p: ~F.contains(p, c(item_id))) if images is not None else F.lit(False)
    rules = [
        ("needs_category_review", ((k["category"] > 0) & (k["category"] < 0.7)) | (top < 0.5)),
        ("needs_source_review", k["bank"] < 0.5),
        ("needs_title_review", (k["title"] < 0.6) | (F.length(strip(shown)) < 3)),
        ("needs_detail_review", (k["structured"] < 0.5) | (F.coalesce(F.size(c(structured)), F.lit(0)) <= 0)),
        ("needs_time_review", text(publish_time) == ""),
        ("needs_overall_review", k["overall"] < 0.5),
        ("needs_topic_split_review", split & (sc < 0.6) & (sc > 0)),
        ("topic_boundary_low_confidence", split & (sc < 0.4) & (sc > 0)),
        ("needs_image_review", stray),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(flag)) for flag, cond in rules]))


def severity(flags, critical=lx.CRITICAL_FLAGS):
    f = c(flags)
    return case([(F.arrays_overlap(f, lit_array(critical)), "high"), (F.size(f) >= 3, "medium")], "low")


def noise_flags(blocks, body, category):
    """Marks from the block types plus the empty / advertisement check."""
    b = c(blocks)
    kinds = F.filter(F.transform(b, lambda x: x["type"]), lambda t: t.isin("ocr_noise", "image_cta"))
    tail = F.array_compact(F.array(
        F.when(F.exists(b, lambda x: x["type"] == "ocr_noise"), F.lit("has_ocr_noise")),
        F.when(strip(text(body)).isin(*lx.AD_TEXTS) & (c(category) != lx.OTHER), F.lit("pure_ad_or_empty"))))
    return F.concat(F.coalesce(kinds, F.array().cast("array<string>")), tail)


def order_check(expected, actual):
    """struct(ok, suggestion): equal sequences, else the actual entries in expected order (NULL = missing)."""
    e, a = c(expected), c(actual)
    return F.struct((e == a).alias("ok"), F.transform(e, lambda x: F.when(F.array_contains(a, x), x)).alias("suggestion"))


def image_is_decorative(bytes_, width, height, stddev):
    w, h = c(width), c(height)
    return (c(bytes_) < 5 * 1024) | (F.least(w, h) < 30) | ((w < 50) & (h < 50)) | (c(stddev) < 8)


def image_ad_filter(bytes_, width, height):
    """TRUE for banner, strip and follow-us images; unreadable sizes are kept."""
    kb, w, h = c(bytes_) / 1024, c(width), c(height)
    ratio, short = w / F.nullif(h, F.lit(0)), F.least(w, h)
    return F.coalesce((short == 0) | ((kb < 15) & (short < 100)) | (ratio > 3.5) | ((ratio < 0.15) & (w < 200)) | ((short < 200) & (kb < 50)), F.lit(False))
