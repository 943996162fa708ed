"""Row predicates and the filters built on them."""

from pyspark.sql import functions as F

from .. import lexicon as lx
from .expr import any_of, c, count_hits, has_any, head, lines, lit_array, nz, strip, text
from .labels import extract_entities


def is_low_value(title, body, words=lx.LOW_VALUE_NOTICE):
    return has_any(F.concat(text(title), F.lit(" "), head(text(body), 200)), words)


def filter_low_value(df, title="title", body="body", words=lx.LOW_VALUE_NOTICE):
    """Drop rows whose title or first 200 body characters hold a low-value word."""
    return df.filter(~is_low_value(title, body, words))


def filter_date_range(df, day, since=None, until=None):
    """Keep rows dated inside the window; undated rows stay."""
    d = c(day)
    keep = F.lit(True)
    if since is not None:
        keep = keep & (d >= F.lit(since))
    if until is not None:
        keep = keep & (d <= F.lit(until))
    return df.filter(d.isNull() | keep)


def require_date_for(df, day, source="source", sources=lx.STRICT_DATE_SOURCES):
    """Strict sources must carry a date."""
    return df.filter(~(c(source).isin(*sources) & c(day).isNull()))


def is_navigation_noise(x, words=lx.NAV_WORDS_5, need=5, shape=True):
    """Menu-like text: many menu words, or many short lines without sentence marks."""
    t = text(x)
    noisy = count_hits(t, words) >= need
    if shape:
        ls = lines(t)
        short = F.size(F.filter(ls, lambda l: F.length(l) <= 12))
        noisy = noisy | ((F.size(ls) >= 8) & (short >= 6) & ~has_any(t, ["。", "；", "：", "！", "？"])) | (t == "")
    return noisy


def low_value(words=lx.LOW_VALUE_DIGEST):
    """A promotion whose title or text holds one of the words."""
    return (F.col("category") == "活动") & has_any(F.concat_ws(" ", text("title"), text("raw_text")), words)


def filter_noise(df, words=lx.LOW_VALUE_DIGEST, limit=None):
    """Drop category 其他, mark low-value promotions; with a limit, cut longer texts to it."""
    kept = df.filter(F.col("category") != lx.OTHER).withColumn("low_value", low_value(words))
    if limit is None:
        return kept
    return kept.withColumn("raw_text", F.when(F.length("raw_text") > limit, F.concat(head("raw_text", limit), F.lit("..."))).otherwise(F.col("raw_text")))


def is_pure_ad_or_empty(x, ads=lx.AD_TEXTS):
    return strip(text(x)).isin(*ads)


def drop_empty_webpage(df, body="body"):
    return df.filter(strip(text(body)) != "")


def item_gate(df, body="body", shortest=5, ad="以上内容为广告"):
    """Merge-document rows need some text and must not be advertisements."""
    return df.filter((F.length(strip(text(body))) >= shortest) & ~F.contains(text(body), F.lit(ad)))


def is_domain_related(title, body, tags, banks=lx.KB_BANKS):
    """Domain tag, or a domain word in the title, or two banks in the text."""
    return (F.coalesce(F.array_contains(c(tags), lx.DOMAIN_TAG), F.lit(False)) | has_any(text(title), lx.DOMAIN_TITLE_WORDS)
            | (F.size(extract_entities(body, banks)) >= 2))


def kb_gate(df, title="title", body="body", tags="tags", draft="draft", shortest=200, related=True):
    """Articles fit for the knowledge base: published, long enough and about the domain."""
    keep = ~F.coalesce(c(draft), F.lit(False)) & (F.length(text(body)) >= shortest)
    return df.filter(keep & is_domain_related(title, body, tags)) if related else df.filter(keep)


def bad_title_fallback(title, list_title):
    """Detail title unless it is missing, short, a template word or a bare ordinal."""
    t = text(title)
    bad = (F.length(t) < 8) | F.rlike(t, F.lit(any_of(lx.BAD_TITLE_WORDS))) | F.rlike(t, F.lit(r"(?U)^[一二三四五六七八九十0-9]+[、.．]?\s*$"))
    return F.when(bad & nz(text(list_title)).isNotNull(), text(list_title)).otherwise(t)


def needs_refetch(df, body="body"):
    """Rows to fetch again: no text."""
    return df.filter(strip(text(body)) == "")


def skip_detail_fields(m, prefixes=lx.SKIP_DETAIL_FIELDS):
    """Digest fields without the long detail ones; decorative marks in keys are ignored."""
    clean = lambda k: strip(F.regexp_replace(k, "[✨📋📝🔄📅🌐👥💰💳📨✅💡⚠️]", ""))
    return F.map_filter(c(m), lambda k, v: ~F.array_contains(lit_array(prefixes), clean(k)))
