"""Field extraction: dates, ranges, key-value pairs, titles, summaries, model responses."""

from pyspark.sql import functions as F

from .. import lexicon as lx
from .expr import (any_of, c, case, field, first_filled, first_match, has, has_any, head, hits, let, lines, lit_array,
                   lit_map, nz, quote, rstrip_set, strip, strip_set, text)
from .gates import is_navigation_noise
from .text import clean_card_name, collapse_ws, safe_truncate, strip_marketing_tail, trim_marketing_intro

KV = "array<struct<key:string,value:string>>"


def doc_meta_values(x, label):
    """Value of '**label**: value' on its line, '' when absent."""
    return strip(F.regexp_extract(text(x), rf"(?i)\*{{0,2}}{quote(label)}\*{{0,2}}\s*[:：]\s*\*{{0,2}}([^\n]+)", 1))


def extract_comment(x):
    """Body of the comment section (heading form first, then the bold form)."""
    heading = r"(?ms)^###?\s*点评\s*\n(.*?)(?=^#{1,4}\s|\z)"
    bold = r"(?ms)^\*\*点评：\*\*\s*\n?(.*?)(?=^#{1,4}\s|\z)"
    t = text(x)
    return strip(F.when(F.rlike(t, F.lit(heading)), F.regexp_extract(t, heading, 1)).otherwise(F.regexp_extract(t, bold, 1)))


def _first_per_key(entries):
    """Array of key/value structs to a map; per key the first non-empty value (else '')."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(
        k.alias("key"), F.coalesce(F.try_element_at(F.transform(
            F.filter(entries, lambda e: (e["key"] == k) & (e["value"] != "")), lambda e: e["value"]), F.lit(1)), F.lit("")).alias("value"))))


def extract_kv_fields(x, aliases=lx.FIELD_ALIASES, longest=None):
    """map of 'name：value' lines; names through the alias table, first value wins; values over longest (if given) are left out."""
    pat = r"^(.{1,16})[：:]\s*(.+)"
    table = lit_map(aliases)

    def entry(l):
        name = strip(F.regexp_extract(l, pat, 1))
        return F.struct(F.coalesce(F.try_element_at(table, name), name).alias("key"), strip(F.regexp_extract(l, pat, 2)).alias("value"))
    found = F.filter(lines(text(x)), lambda l: F.rlike(l, F.lit(pat)))
    entries = F.transform(found, entry)
    if longest is not None:
        entries = F.filter(entries, lambda e: F.length(e["value"]) <= longest)
    return let(entries, _first_per_key)


def rename_fields(m, aliases=lx.REPORT_ALIASES):
    """Map with aliased keys; a filled target keeps its value."""
    table = lit_map(aliases)
    entries = F.transform(F.map_entries(c(m)), lambda e: F.struct(
        F.coalesce(F.try_element_at(table, e["key"]), e["key"]).alias("key"), F.coalesce(e["value"], F.lit("")).alias("value")))
    return let(entries, _first_per_key)


def promote_url(url, structured, fields=lx.LINK_FIELDS):
    return first_filled(text(url), *[field(structured, k) for k in fields])


# ---- structured fields by category --------------------------------------------

def _by_category(category, templates):
    return case([(c(category) == cat, F.create_map(*[e for k, v in fields for e in (F.lit(k), v)]))
                 for cat, fields in templates if cat], F.create_map(*[e for k, v in templates[-1][1] for e in (F.lit(k), v)]))


def build_structured(category, title, body, raw_text=None, author=None, url=None):
    """Template of the category filled from title and body (safe cuts at 500 / 300 characters)."""
    raw = first_filled(text(raw_text) if raw_text is not None else F.lit(""), text(title))
    t = text(title)

    def fill(src):
        cut = lambda n: F.when(src != "", safe_truncate(src, n)).otherwise(t)
        author_or_url = first_filled(*[text(v) for v in (author, url) if v is not None])
        e = F.lit("")
        return _by_category(category, [
            ("新卡", [("卡种", clean_card_name(t)), ("卡亮点", e), ("适用人群", F.lit(lx.DEFAULT_AUDIENCE)), ("来源", author_or_url), ("详情", cut(500))]),
            ("活动", [("活动内容", cut(300)), ("活动时间", e), ("适用人群", F.lit(lx.DEFAULT_AUDIENCE))]),
            ("权益变更", [("消息时间", e), ("影响范围", e), ("变更内容", cut(500)), ("变更分析", e)]),
            ("公告", [("消息内容", cut(500)), ("点评", e)]),
            (None, [("详细内容", cut(500))])])
    return let(F.when(strip(text(body)) != "", text(body)).otherwise(trim_marketing_intro(raw)), fill)


def build_structured_notice(category, title, body, publish_time, bank, scraped=False):
    """Notice templates; scraped=True uses the list/detail variant (600-character activity text)."""
    t, b, p = text(title), text(body), text(publish_time)
    holders, e = F.concat(text(bank), F.lit("信用卡持卡人")), F.lit("")
    window = extract_activity_window(b)
    activity = F.when(F.length(b) > F.length(t), head(b, 600)).otherwise(t) if scraped else t
    when_ = p if scraped else first_filled(window, p)
    notice = [("消息内容", head(b, 300)), ("点评", e)]
    return _by_category(category, [
        ("新卡", [("卡种", t), ("卡亮点", e), ("适用人群", e), ("来源", text(bank)), ("详情", head(b, 300))]),
        ("权益变更", [("消息时间", p), ("影响范围", holders), ("变更内容", head(b, 500)), ("变更分析", e)]),
        ("活动", [("活动内容", activity), ("活动时间", when_), ("适用人群", holders)]),
        ("公告", notice),
        (None, notice if scraped else [("详细内容", first_filled(head(b, 300), t))])])


def build_structured_article(category, title, body):
    """Article templates: 300-character summary, first ISO-like date as activity time."""
    t, e = text(title), F.lit("")
    s = head(text(body), 300)
    day = F.regexp_extract(text(body), r"(\d{4}[-.]\d{1,2}[-.]\d{1,2})", 1)
    return _by_category(category, [
        ("活动", [("活动内容", s), ("活动时间", day), ("适用人群", e)]),
        ("新卡", [("卡种", t), ("卡亮点", e), ("适用人群", e), ("来源", e), ("详情", s)]),
        ("权益变更", [("消息时间", e), ("影响范围", e), ("变更内容", s), ("变更分析", e)]),
        ("公告", [("消息内容", s), ("点评", e)]),
        (None, [("详细内容", first_filled(s, t))])])


def _ocr_values(matches):
    kept = F.filter(F.transform(matches, strip), lambda v: ~v.isin(*lx.OCR_EMPTY_VALUES))
    return F.array_join(F.array_distinct(F.transform(kept, lambda v: rstrip_set(v, "。，"))), "；")


def build_structured_from_ocr(category, title, ocr):
    """Templates filled from labelled lines of recognised image text."""
    t = text(title)

    def fill(o):
        labelled = lambda labels: _ocr_values(F.regexp_extract_all(o, F.lit(f"(?:{labels})[：:]\\s*(.*)"), 1))
        # a price label counts at a line start, or when no amount follows on its line; linear in the text
        label = "(?:(?:适用)?价格|优惠价格)"
        price = F.regexp_extract_all(o, F.lit(rf"(?m)(?:^{label}|{label}(?=[：:](?![^\n]*\d元)))[：:]\s*.*|\d+元[^。\n]*"), 0)
        price = F.transform(price, lambda p: F.when(F.rlike(p, F.lit("^(?:适用|优惠)?价格[：:]")), F.regexp_extract(p, r"^(?:适用|优惠)?价格[：:]\s*(.*)", 1))
                            .otherwise(F.regexp_extract(p, r"(\d+元[^。\n]*)", 1)))
        return let(F.struct(
            labelled("卡种[名称]*").alias("card"), labelled("银行[名称]*").alias("bank"),
            labelled("(?:核心)?权益|核心|活动内容|优惠内容").alias("benefit"), _ocr_values(price).alias("price"),
            labelled("活动时间|有效期|时间").alias("time"), labelled("适用条件|适用人群").alias("who"),
            F.array_join(F.transform(F.regexp_extract_all(o, F.lit(r"(?:核心权益|优惠内容|活动简介)[：:]\s*.*"), 0), strip), "\n").alias("brief")),
            lambda v: let(first_filled(F.array_join(F.filter(F.array(v["benefit"], v["price"]), lambda b: b != ""), "；"), v["brief"]),
                          lambda gain: templates(o, v, gain)))

    def templates(o, v, gain):
        e, who = F.lit(""), first_filled(v["who"], F.lit(lx.DEFAULT_AUDIENCE))
        full = first_filled(head(o, 500), t)
        return _by_category(category, [
            ("新卡", [("卡种", first_filled(v["card"], t)), ("卡亮点", head(gain, 200)), ("适用人群", who), ("来源", first_filled(v["bank"], t)), ("详情", full)]),
            ("活动", [("活动内容", first_filled(head(gain, 300), t)), ("活动时间", first_filled(v["time"], F.lit("详见活动说明"))), ("适用人群", who)]),
            ("权益变更", [("消息时间", v["time"]), ("影响范围", who), ("变更内容", first_filled(head(gain, 500), t)), ("变更分析", e)]),
            ("公告", [("消息内容", first_filled(head(gain, 300), t)), ("点评", e)]),
            (None, [("详细内容", full)])])
    return let(text(ocr), fill)


# ---- dates ----------------------------------------------------------------------

def parse_date_multi(x, year=None):
    """TIMESTAMP from the many date spellings, NULL when none fits.

    year: the year for month-day dates (the run date's year); without it they stay NULL.
    """
    t = F.regexp_replace(strip(text(x)), r"[()（）【】\[\]{}<>]", "")
    t = F.translate(t, "年月时", "--:")
    t = strip(F.regexp_replace(t, "[日号分秒]", ""))
    parts = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?: (\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$"
    p2 = lambda v: F.lpad(v, 2, "0")

    def stamp(y, mo, d, h="0", mi="0", s="0"):
        lit = lambda v: F.lit(v) if isinstance(v, str) else v
        return F.try_to_timestamp(F.concat(y, F.lit("-"), p2(mo), F.lit("-"), p2(d), F.lit(" "), p2(lit(h)), F.lit(":"), p2(lit(mi)), F.lit(":"), p2(lit(s))),
                                  F.lit("yyyy-MM-dd HH:mm:ss"))

    def body(s):
        g = lambda pat, i: F.regexp_extract(s, pat, i)
        z = lambda i: first_filled(g(parts, i), F.lit("0"))
        loose = r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"
        md = r"^(\d{1,2})[-/](\d{1,2})$"
        out = [F.when(F.rlike(s, F.lit(parts)), stamp(g(parts, 1), g(parts, 3), g(parts, 4), z(5), z(6), z(7))),
               F.when(F.rlike(s, F.lit(r"^\d{8}$")), stamp(s.substr(1, 4), s.substr(5, 2), s.substr(7, 2)))]
        if year is not None:
            out.append(F.when(F.rlike(s, F.lit(md)), stamp(F.lit(str(year)), g(md, 1), g(md, 2))))
        out.append(F.when(F.rlike(s, F.lit(loose)), stamp(g(loose, 1), g(loose, 2), g(loose, 3))))
        return F.coalesce(*out)
    return let(t, body)


def extract_date(x, last=False):
    """yyyy-MM-dd of the first date (by pattern order) or of the last one (by position)."""
    def iso(s, pat, at):
        y = F.regexp_extract(s, pat, at)
        y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
        p2 = lambda i: F.lpad(F.regexp_extract(s, pat, i).cast("int").cast("string"), 2, "0")
        return F.concat_ws("-", y, p2(at + 1), p2(at + 2))
    if not last:
        return let(text(x), lambda s: F.coalesce(*[F.when(F.rlike(s, F.lit(p)), iso(s, p, 1)) for p in lx.DAY_PATTERNS], F.lit("")))
    tails = [f"(?s)^(.*){p}" for p in lx.DAY_PATTERNS]
    return let(text(x), lambda s: F.coalesce(F.array_max(F.array_compact(F.array(*[
        F.when(F.rlike(s, F.lit(p)), F.struct(F.length(F.regexp_extract(s, p, 1)).alias("at"), F.lit(-i).alias("o"), iso(s, p, 2).alias("day")))
        for i, p in enumerate(tails)])))["day"], F.lit("")))


def extract_date_loose(x, stem):
    return first_filled(F.regexp_extract(text(x), r"20\d{2}[.年/-]\s*\d{1,2}[.月/-]\s*\d{1,2}", 0), F.right(text(stem), F.lit(8)))


def extract_time_range(x):
    return collapse_ws(first_match(text(x), lx.TIME_PATTERNS))


def extract_activity_window(x, chars=500):
    """'A ~ B' for the first 'A 至 B' pair of full dates in the opening."""
    pat = r"(\d{4}年\d{1,2}月\d{1,2}日)\s*[-至~]\s*(\d{4}年?\d{1,2}月\d{1,2}日)"
    t = head(text(x), chars)
    return F.when(F.rlike(t, F.lit(pat)), F.concat(F.regexp_extract(t, pat, 1), F.lit(" ~ "), F.regexp_extract(t, pat, 2))).otherwise("")


def extract_scope(x):
    """'... holders' by pattern order; only texts with the words are searched, each pattern on a window around its first core."""
    needs = [lambda t: has(t, "所有") & has(t, "持卡人"), lambda t: has(t, "持卡人"), lambda t: has_any(t, lx.SCOPE_ENDS)]

    def body(t):
        found = zip(needs, lx.SCOPE_CORES, lx.SCOPE_PATTERNS)
        return F.coalesce(*[F.when(need(t), let(_first_window(t, core, p), nz)) for need, core, p in found], F.lit(""))
    return collapse_ws(let(text(x), body))


def first_sentence(x, markers=lx.SENTENCE_MARKERS):
    """First meaningful sentence: cut at Chinese numbering, peel up to five 'label + value' openings."""
    opening = f"^(?:{any_of(markers)})"
    s = F.split(text(x), "[。；]")[0]
    number = r"(?s)^(.*?)(?:^|[：:\s])[一二三四五六七八九十]+、.*$"
    s = let(s, lambda v: F.when(F.rlike(v, F.lit(number)), strip(F.regexp_extract(v, number, 1))).otherwise(v))

    def peel(v):
        rest = F.regexp_replace(v, opening, "")
        for p in (r"^[：:\s]+", r"^[\d\-/.~至到年月日号]*[年月日号]", r"^\s*\d+[：:点时分]\d*\s*", r"^起至\s*"):
            rest = F.regexp_replace(rest, p, "")
        return let(strip(rest), lambda r: F.when(F.rlike(v, F.lit(opening)) & (r != ""), r).otherwise(v))
    for _ in range(5):
        s = let(s, peel)
    return strip(F.regexp_replace(s, r"^(尊敬的客户[：:]?|您好[！!]?|感谢您[^，,]*[，,]?)\s*", ""))


def _first_window(t, core, pattern, before=30, reach=140):
    """Group 1 of the leftmost match of pattern, '' without one. pattern is up to `before` characters and then core.

    The first place where core matches is looked for from its literal on; the leftmost match starts at most `before`
    characters ahead of it and ends within `reach`, so pattern runs on this window only: linear in the text."""
    ahead = F.length(F.regexp_replace(t, f"(?s)(?:{core}).*$", ""))
    window = let(ahead, lambda n: F.when(n < F.length(t), F.substring(t, F.greatest(F.lit(1), n + 1 - before), F.lit(reach))).otherwise(""))
    return F.regexp_extract(window, pattern, 1)


def extract_change(x):
    """'from ... to ...' wording by pattern order, else the first sentence; only texts with the words are searched."""
    needs = [lambda t: has(t, "由") & has(t, "调整为"), lambda t: has(t, "从") & has(t, "调整为"), lambda t: has(t, "调整为"), lambda t: F.lit(True)]

    def body(t):
        found = zip(needs, lx.CHANGE_CORES, lx.CHANGE_PATTERNS)
        hit = F.coalesce(*[F.when(need(t), nz(_first_window(t, core, p))) for need, core, p in found], F.lit(""))
        return first_filled(collapse_ws(hit), first_sentence(t))
    return let(collapse_ws(x), body)


def extract_activity_core(x):
    return let(collapse_ws(x), lambda t: first_filled(collapse_ws(first_match(t, lx.ACTIVITY_PATTERNS)), first_sentence(t)))


def extract_fee(x):
    return collapse_ws(first_match(text(x), lx.FEE_PATTERNS))


def _is_fragment(s):
    """Only a date or an amount."""
    return F.rlike(s, F.lit(r"^[\d\-/.~至到年月日号]+$")) | F.rlike(s, F.lit(r"^[\d.]+\s*[元点%]$"))


def extract_activity_name(x, boilerplate=lx.ACTIVITY_BOILERPLATE):
    """First sentence that is neither boilerplate nor a bare date; else the longest sentence."""
    opening = f"^({any_of(boilerplate)})"
    rest = F.regexp_replace(text(x), opening + r"[：: \n]*", "")

    def name(part):
        label = F.regexp_extract(part, opening, 1)
        inner = strip(F.regexp_replace(part, opening + r"[：: \n]*", ""))
        return (F.when((part == "") | _is_fragment(part), F.lit(None).cast("string"))
                .when(label == "", part)
                .when(has(label, "活动内容") & (inner != "") & ~_is_fragment(inner), inner))

    def pick(parts):
        named = F.array_compact(F.transform(parts, name))
        longest = F.array_max(F.transform(parts, lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("i"), p.alias("p"))))["p"]
        return F.coalesce(F.try_element_at(named, F.lit(1)), longest)
    return let(F.transform(F.split(rest, "。"), strip), pick)


# ---- display fields ---------------------------------------------------------------

def report_prefix_cut(title):
    """Drop a site greeting in front of 关于."""
    t = strip(text(title))
    at = F.instr(t, "关于")
    return F.when(has(t, "欢迎您") & (at > 1) & (at < 41), F.substring(t, at, F.length(t))).otherwise(t)


def generate_title(bank, category, structured, fallback=None):
    """Subject-verb-object title by category; the fallback title when the bank is unknown."""
    fb = text(fallback) if fallback is not None else F.lit("")
    b = first_filled(text(bank), fb, F.lit("银行"))
    f = lambda k: strip(field(structured, k))
    card, activity, change = f("卡种"), f("活动内容"), f("变更内容")
    keep_change = (fb != "") & F.rlike(fb, F.lit(any_of(lx.ACTION_WORDS_BY_CATEGORY["权益变更"])))
    name = let(activity, lambda a: safe_truncate(first_filled(extract_activity_name(a), a), 30))
    return case([
        (b.isin("未知", "银行"), first_filled(fb, F.concat(b, F.lit("推出优惠活动")))),
        ((c(category) == "新卡") & (card != ""), F.concat(b, F.lit("发布"), card)),
        (c(category) == "新卡", F.concat(b, F.lit("发布新卡"))),
        ((c(category) == "活动") & (activity != ""), F.concat(b, F.lit("活动："), name)),
        (c(category) == "活动", F.concat(b, F.lit("推出优惠活动"))),
        ((c(category) == "权益变更") & keep_change, F.concat(b, F.lit("权益调整："), head(fb, 30))),
        ((c(category) == "权益变更") & (change != ""), F.concat(b, F.lit("权益调整："), head(change, 30))),
        (c(category) == "权益变更", F.concat(b, F.lit("调整信用卡权益"))),
    ], first_filled(fb, F.concat(b, text(category))))


def display_title(bank, category, structured, raw_title):
    """struct(title, title_source): the raw title when it says what happened, else a generated one."""
    def body(t):
        words = lx.ACTION_WORDS_BY_CATEGORY
        acts = case([(c(category) == k, F.rlike(t, F.lit(any_of(w)))) for k, w in words.items()], F.lit(True))
        made = F.when(t.isin("无标题", "图片", ""), generate_title(bank, category, structured)).when(
            ~acts, generate_title(bank, category, structured, t))
        notice = c(category) == "公告"
        title = F.when(notice, first_filled(t, F.concat(text(bank), F.lit("公告")))).otherwise(F.coalesce(made, t))
        generated = ~notice & made.isNotNull() & (t.isin("无标题", "图片", "") | (made != t))
        return F.struct(title.alias("title"), F.when(generated, "generated").otherwise("raw").alias("title_source"))
    return let(report_prefix_cut(raw_title), body)


def _card_summary(g, raw_title, bank):
    detail, highlight, card = g("详情"), g("卡亮点"), g("卡种")
    def body(v):
        fee = let(first_filled(v["detail"], v["highlight"]), extract_fee)
        base = F.array_join(F.filter(F.array(v["card"], head(v["highlight"], 50)), lambda p: p != ""), "；")
        with_fee = let(F.struct(base.alias("b"), fee.alias("f")), lambda s: F.when(
            (s["f"] != "") & ~F.contains(s["b"], s["f"]), F.array_join(F.filter(F.array(s["b"], s["f"]), lambda p: p != ""), "；")).otherwise(s["b"]))
        return first_filled(head(with_fee, 120), head(first_filled(text(raw_title), v["detail"]), 100))
    return let(F.struct(card.alias("card"), highlight.alias("highlight"), detail.alias("detail")), body)


def _joined(parts, n, raw_title):
    return first_filled(head(F.array_join(F.array_distinct(F.filter(F.array(*parts), lambda p: p != "")), "；"), n), head(text(raw_title), 100))


def _no_nav(x):
    return let(x, lambda t: F.when(is_navigation_noise(t, lx.NAV_WORDS_4, 4, shape=False), "").otherwise(t))


def _activity_summary(g, raw_title):
    return let(F.struct(_no_nav(g("活动内容")).alias("a"), g("活动时间").alias("t"), g("适用人群").alias("w")), lambda v: _joined(
        [extract_scope(first_filled(v["w"], v["a"])), first_filled(v["t"], extract_time_range(v["a"])),
         head(extract_activity_core(v["a"]), 50)], 120, raw_title))


def _change_summary(g, raw_title):
    return let(F.struct(_no_nav(g("变更内容")).alias("a"), g("消息时间").alias("t"), g("影响范围").alias("w")), lambda v: _joined(
        [first_filled(v["t"], extract_time_range(v["a"])), v["w"],
         first_filled(head(extract_change(v["a"]), 60), head(text(raw_title), 40))], 140, raw_title))


def highlight_summary(category, structured, cleaned, raw_title, raw_text, bank=None, benefits=None, fee=None):
    """Per-category summary, without promotional tail; enriched with benefits or the fee note when given."""
    g = lambda k: collapse_ws(first_filled(field(cleaned, k), field(structured, k)))
    notice = first_filled(field(cleaned, "消息内容"), field(structured, "消息内容"))
    base = strip_marketing_tail(case([
        (c(category) == "新卡", _card_summary(g, raw_title, bank)), (c(category) == "活动", _activity_summary(g, raw_title)),
        (c(category) == "权益变更", _change_summary(g, raw_title)), (c(category) == "公告", head(notice, 200))],
        head(first_filled(text(raw_text), text(raw_title)), 200)))
    if benefits is None:
        return base

    def enrich(s):
        kb, note = c(benefits), text(fee) if fee is not None else F.lit("")
        short = F.array_join(F.slice(kb, 1, 2), "、")
        some = F.coalesce(F.size(kb), F.lit(0)) > 0
        add = lambda v: F.concat(s, F.lit("（"), v, F.lit("）"))
        return case([(some & (s == ""), F.array_join(F.slice(kb, 1, 3), "、")),
                     (some, F.when(F.contains(s, short), s).otherwise(add(short))),
                     ((note != "") & (s != "") & ~F.contains(s, note), add(note))], s)
    return let(base, enrich)


# ---- score-side extractors ----------------------------------------------------------

def extract_audience(title, raw_text, structured, category, bank):
    """Structured audience unless it is the default, then two text patterns, then the new-card template."""
    all_ = F.concat(text(title), F.lit(" "), text(raw_text))
    given = strip(field(structured, "适用人群"))
    given = F.when(given.isin(lx.DEFAULT_AUDIENCE, "持卡人"), "").otherwise(given)
    labelled = strip(F.regexp_extract(all_, r"适用人群[：:]\s*(.+?)(?:\n|$)", 1))
    worded = strip(F.regexp_extract(all_, r"(?:适合|推荐给|面向)(.{3,30}?)(?:[，。；\n]|$)", 1))
    template = F.when((c(category) == "新卡") & (text(title) != ""), F.when(text(bank) != "", F.concat(F.lit("持有"), text(bank), F.lit("信用卡的用户"))).otherwise("信用卡申请人")).otherwise("")
    return first_filled(head(given, 50), head(labelled, 50), head(worded, 50), template)


def extract_benefits(raw_text, structured):
    """Up to five bullets, else sentences of the highlight section, else the structured highlight."""
    t = text(raw_text)
    bullets = F.transform(F.slice(F.regexp_extract_all(t, F.lit(r"[•\-*]\s*(.{5,60}?)(?:\n|$)"), 1), 1, 5), strip)
    section = F.regexp_extract(t, r"(?s)(?:亮点|核心权益|优势)[：:]\s*(.+?)(?:\n\n|\z)", 1)
    sentences = F.slice(F.filter(F.transform(F.split(section, "[。；\n]"), strip), lambda s: F.length(s).between(5, 60)), 1, 5)
    given = head(field(structured, "卡亮点"), 60)
    return let(bullets, lambda b: F.when(F.size(b) > 0, b).otherwise(
        let(sentences, lambda s: F.when(F.size(s) > 0, s).when(given != "", F.array(given)).otherwise(F.array().cast("array<string>")))))


def extract_fee_note(title, raw_text, structured):
    """Fee sentence of the text, then of the structured detail, then the stock phrases."""
    def body(t):
        sentence = strip(F.regexp_extract(t, r"(?:^|[，。\s])年费[：:]*\s*(.{5,60}?)(?:[。\n]|$)", 1))
        detail = strip(F.regexp_extract(strip(field(structured, "详情")), r"年费[：:]*\s*(.{3,40})", 1))
        amount = F.regexp_extract(t, r"年费[^\d]*(\d+)元", 1)
        stock = case([(has(t, "免年费"), "免年费，零持卡成本"), (has(t, "首年免"), "首年免年费"),
                      (has(t, "刷卡免") | has(t, "刷卡6次免"), "刷卡免年费"),
                      (has(t, "刚性年费") & (amount != ""), F.concat(F.lit("刚性年费"), amount, F.lit("元")))], "")
        return first_filled(sentence, detail, stock)
    return let(F.concat(text(title), F.lit(" "), text(raw_text)), body)


def annual_benefit(recommendation, summary, benefits):
    """Yearly worth in words: monthly cap x 12, a yearly amount or 'no fee'."""
    t = F.concat_ws(" ", text(recommendation), text(summary), F.array_join(c(benefits), " "))

    def body(s):
        month = F.regexp_extract(s, r"月[上限]*[^\d]*(\d+)(?:元|返利金|返现)", 1)
        year = F.regexp_extract(s, r"年[返省赚]*[^\d]*(\d+)元", 1)
        return case([(month != "", F.concat(F.lit("年约"), (month.cast("decimal(30,0)") * 12).cast("decimal(38,0)").cast("string"), F.lit("元收益"))),
                     (year != "", F.concat(F.lit("年"), year, F.lit("元"))),
                     (has(s, "免年费") | has(s, "0年费"), "免年费")], "")
    return let(t, body)


def extract_time_nodes(df, limit=5, order="ord"):
    """First `limit` distinct 'day — title' lines of highlighted items, in item order."""
    t = F.concat_ws(" ", text("notes"), text("recommendation"))
    days = F.regexp_extract_all(t, F.lit(r"(\d{1,2}[.月]\d{1,2}[日号]?)"), 1)
    nodes = (df.filter("is_highlight").select(F.col(order), "title", F.posexplode(days).alias("pos", "day"))
             .select(F.concat(F.col("day"), F.lit(" — "), F.col("title")).alias("node"), F.struct(order, "pos").alias("at")))
    return nodes.groupBy("node").agg(F.min("at").alias("at")).orderBy("at").limit(limit).select("node", F.col(f"at.{order}").alias(order))


# ---- model responses ------------------------------------------------------------------

def parse_model_json(x):
    """VARIANT from plain JSON, a code fence or the outermost braces; NULL when all fail."""
    t = text(x)
    fence = F.regexp_extract(t, r"(?s)```(?:json)?\s*\n?(.*?)\n?```", 1)
    brace = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    return F.coalesce(F.try_parse_json(nz(t)), F.try_parse_json(nz(fence)), F.try_parse_json(nz(brace)))


def review_payload(title, category, bank, summary, confidence, flags):
    return F.to_json(F.struct(text(title).alias("title"), text(category).alias("category"), text(bank).alias("bank"),
                              head(text(summary), 150).alias("summary"), c(confidence).alias("confidence"), c(flags).alias("flags")))


def url_param(x, name="__biz", chars="A-Za-z0-9="):
    return F.regexp_extract(text(x), f"{quote(name)}=([{chars}]+)", 1)


def week_label(day):
    """'Y年M月第N周', N counted from the week of the first of the month (Monday first)."""
    d = c(day)
    n = F.floor((F.dayofmonth(d) + F.weekday(F.trunc(d, "MM"))) / 7) + 1
    return F.concat(F.year(d).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月第"), n.cast("string"), F.lit("周"))


def numbered_prefix(x):
    return F.rlike(text(x), F.lit(lx.NUMBERED_PREFIX))


def term_names(t):
    """struct(has_brand, branded, plain, acts): candidate card and activity names of a text.

    No match crosses white space, a comma or a full stop, so only the runs between them that hold a word which every match
    needs are scanned."""
    card = lambda ks: F.filter(ks, lambda k: ~k.isin(*lx.NOT_CARD_NAMES) & ~has_any(k, lx.NOT_IN_CARD_NAMES))
    ends = lx.CARD_ENDS + lx.ACTIVITY_ENDS
    runs = F.when(has_any(t, ends), F.filter(F.split(t, r"[\s，。]+"), lambda r: has_any(r, ends))).otherwise(F.array().cast("array<string>"))

    def body(runs):
        scan = lambda p, words: F.flatten(F.transform(F.filter(runs, lambda r: has_any(r, words)), lambda r: F.regexp_extract_all(r, F.lit(p), 0)))
        acts = F.filter(scan(lx.NAMED_ACTIVITY, lx.ACTIVITY_ENDS), lambda a: F.length(rstrip_set(a, lx.ACTIVITY_END_CHARS)) >= 2)
        return let(scan(lx.BRANDED_CARD, lx.CARD_BRANDS), lambda branded: F.struct(
            (F.size(branded) > 0).alias("has_brand"), card(branded).alias("branded"), card(scan(lx.PLAIN_CARD, lx.CARD_ENDS)).alias("plain"), acts.alias("acts")))
    return let(runs, body)


def named_terms(x):
    """Distinct card and activity names in the text, noise words left out; plain cards only where none carries a brand."""
    return let(term_names(text(x)), lambda n: F.array_union(F.when(n["has_brand"], n["branded"]).otherwise(n["plain"]), n["acts"]))
