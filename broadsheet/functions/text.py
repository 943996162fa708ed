"""Text cleaning: string in, string out, as built-in expressions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lexicon as lx
from .expr import (any_of, c, count_hits, first_filled, has, has_any, head, let, lines, lit_array, nz, pos, rstrip_set,
                   strip, strip_set, text)

NUMBERING = r"[一二三四五六七八九十0-9]+[、.．]\s*"


def collapse_ws(x, ends="；，,。 "):
    """White-space runs to one blank, then strip the end punctuation."""
    return strip_set(F.regexp_replace(text(x), r"(?U)\s+", " "), ends)


def normalize_highlight(x, prefixes=lx.HIGHLIGHT_PREFIXES):
    """Drop image marks, greeting and section prefixes and the closing formula."""
    t = F.regexp_replace(text(x), r"(?U)\[图片核心内容\s*-\s*[^\]]+\]", " ")
    t = strip(F.regexp_replace(t, r"(?U)\s+", " "))
    t = F.regexp_replace(t, "^" + "".join(f"(?:{p}\\s*)?" for p in map(any_of, [[p] for p in prefixes])), "")
    t = F.regexp_replace(t, "^关于(?=启用新版|新增)", "")
    t = strip(F.replace(t, F.lit("特此公告。"), F.lit("")))
    return collapse_ws(t, " ：:;；，,。")


def normalize_detail(x):
    """Keep core-section lines, labelled lines and numbered fields; else the first long line."""
    numbered = f"^\\d+\\.\\s*({any_of(lx.DETAIL_NUMBERED)})"

    def step(acc, line):
        noise = (F.startswith(line, F.lit("[图片核心内容 - ")) | has(line, "未包含任何信用卡相关信息")
                 | has(line, "仅显示一个用于申卡的微信二维码"))
        opens = has(line, "核心信用卡资讯")
        closes = has(line, "补充说明") | (has(line, "_") & has(F.lower(line), "image_description"))
        labelled = F.rlike(line, F.lit("^(" + any_of(lx.DETAIL_LINE_PREFIXES) + ")"))
        kept = (F.when(noise | opens | closes, F.lit(None).cast("string"))
                .when(acc["core"], line)
                .when(labelled, strip(F.regexp_replace(line, "^[- ]+", "")))
                .when(F.rlike(line, F.lit(numbered)), F.regexp_replace(line, r"^\d+\.\s*", ""))
                .when((F.size(acc["kept"]) == 0) & (F.length(line) >= 8) & ~has(line, "二维码"), line))
        return F.struct(
            F.concat(acc["kept"], F.array_compact(F.array(kept))).alias("kept"),
            F.when(noise, acc["core"]).when(opens, True).when(closes, False).otherwise(acc["core"]).alias("core"))

    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("core"))
    kept = F.aggregate(lines(text(x)), start, step, lambda a: a["kept"])
    return let(kept, lambda k: F.when(F.size(k) > 0, F.array_join(F.slice(k, 1, 6), "；")).otherwise(normalize_highlight(x)))


def trim_marketing_intro(x, openers=lx.INTRO_OPENERS):
    """Remove leading promotional sentences, as many as follow each other."""
    return F.regexp_replace(text(x), f"(?sU)^(?:(?:{any_of(openers)}).*?[。！\\n]\\s*)+", "")


def strip_marketing_tail(x):
    t = strip(F.regexp_replace(text(x), "珍藏周边礼等你领.*$", ""))
    return strip(F.regexp_replace(t, "【[^】]+】$", ""))


def clean_card_name(x):
    """Card name without promotional affixes; the title itself when nothing is left."""
    t = F.regexp_replace(strip(text(x)), f"(?:{any_of(lx.CARD_SUFFIXES)})+$", "")
    t = strip(F.regexp_replace(t, f"(?U)\\s*(?:{any_of(lx.CARD_MIDDLES)})\\s*", " "))
    t = F.regexp_replace(t, r"(?U)【[^】]+】\s*$|\|\s*[^|]+$", "")
    t = F.regexp_replace(t, f"(?U)^(?:{any_of(lx.CARD_PREFIXES)})\\s*", "")
    return first_filled(strip_set(t, " ，,。.、；;！!"), text(x))


def clean_title(x):
    """One line, no site greeting before 关于, no bullets."""
    t = strip(F.regexp_replace(text(x), r"(?U)\s+", " "))
    at = F.instr(t, "关于")
    cut = has(t, "欢迎您") & (at > 1) & (at < 41)
    return strip_set(F.when(cut, F.substring(t, at, F.length(t))).otherwise(t), " ·∙•●◦")


def title_key(x):
    """Dedup key: no numbering, no white space or punctuation, lower case."""
    t = F.regexp_replace(text(x), r"(?U)^\s*[一二三四五六七八九十0-9]+[、.．]\s*", "")
    return F.lower(F.regexp_replace(t, r"""(?U)[\s·•：:，,。！!？?（）()【】\[\]‘’“”"'_-]+""", ""))


def strip_heading_prefix(x):
    return strip(F.regexp_replace(text(x), "(?U)^" + NUMBERING, ""))


def strip_markdown(x):
    """Plain text of a Markdown file: no front matter, images, link targets or markup."""
    t = F.regexp_replace(text(x), r"(?smU)^---.*?---\s*", "")
    t = F.regexp_replace(t, r"!\[.*?\]\(.*?\)", "")
    t = F.regexp_replace(t, r"\[([^\]]+)\]\([^)]+\)", "$1")
    t = F.regexp_replace(t, r"[#*>`~_]", "")
    return strip(F.regexp_replace(t, r"(?U)\n\s*\n\s*\n", "\n\n"))


def safe_truncate(x, n=500):
    """Cut at the last sentence mark past half of n, else the last blank, else hard."""
    def body(s):
        first = head(s, n)

        def last(mark):
            at = F.instr(F.reverse(first), mark)
            return F.when(at > 0, n - at).otherwise(-1)
        best = F.greatest(*[F.when(last(m) > n * 0.5, last(m)).otherwise(-1) for m in "。！？\n"])
        blank = last(" ")
        return (F.when(F.length(s) <= n, s).when(best >= 0, F.substring(s, 1, best + 1))
                .when(blank > 10, F.concat(F.substring(s, 1, blank), F.lit("…")))
                .otherwise(F.concat(first, F.lit("…"))))
    return let(text(x), body)


def cut_from_marker(x, markers, low, high):
    """Start x at the first marker (in list order) found at a 0-based position in [low, high)."""
    at = F.filter(F.transform(markers, lambda m: F.when(m != "", pos(x, m) - 1).otherwise(-1)),
                  lambda i: (i >= low) & (i < high))
    return F.substring(x, F.coalesce(F.try_element_at(at, F.lit(1)) + 1, F.lit(1)), F.length(x))


def cut_at_marker(x, markers):
    """End x before the earliest of the markers."""
    at = F.array_min(F.filter(F.transform(markers, lambda m: F.when(m != "", pos(x, m)).otherwise(0)), lambda i: i > 0))
    return F.substring(x, F.lit(1), F.coalesce(at - 1, F.length(x)))


def _skip_breadcrumb(t):
    """Start at the first real line behind a breadcrumb marker in the first 200 characters."""
    found = F.filter(lit_array(lx.HEADER_MARKERS), lambda m: (pos(t, m) > 0) & (pos(t, m) <= 200))

    def behind(marker):
        rest = F.substring(t, pos(t, marker) + F.length(marker), F.length(t))
        real = F.filter(lines(rest), lambda l: (F.length(l) >= 8) & F.rlike(l, F.lit("[一-龥]")))
        return F.when(F.size(real) > 0, F.substring(t, pos(t, real[0]), F.length(t))).otherwise(t)
    return F.when(F.size(found) > 0, let(found[0], behind)).otherwise(t)


def clean_body_lines(x, title=None, start_markers=None, end_markers=None):
    """Detail-page body without navigation, breadcrumb, hotline and footer lines.

    start_markers / end_markers are array columns (per source), usually joined from a rule table.
    """
    title = text(title) if title is not None else F.lit("")
    start_markers = start_markers if start_markers is not None else lit_array([])
    end_markers = end_markers if end_markers is not None else lit_array([])
    noise = lit_array(lx.BODY_NOISE_LINES)
    hotline = r"(?s)^(?:客服电话|信用卡热线|(?:\d+小时)?客服热线)\s*[:：].*$"
    steps = [
        lambda t: F.when((title != "") & (pos(t, title) > 0), F.substring(t, pos(t, title), F.length(t))).otherwise(t),
        _skip_breadcrumb,
        lambda t: cut_at_marker(t, lit_array(lx.FOOTER_MARKERS)),
        lambda t: F.array_join(F.filter(lines(t), lambda l: ~F.array_contains(noise, l) & ~has_any(l, lx.BODY_NOISE)
                                        & ~F.rlike(l, F.lit(hotline))), "\n"),
        lambda t: cut_from_marker(t, start_markers, 0, 500),
        lambda t: cut_at_marker(t, end_markers),
        lambda t: cut_from_marker(t, F.concat(F.array(title), lit_array(lx.BODY_START_MARKERS)), 1, 400),
        lambda t: cut_at_marker(t, lit_array(lx.LATE_FOOTER_MARKERS)),
        lambda t: F.array_join(lines(t), "\n"),
    ]
    t = F.array_join(lines(text(x)), "\n")
    for step in steps:
        t = let(t, step)
    return t


def clean_page_lines(x):
    """Generic page text: drop menu words, bare dates and hints; start at the first content line."""
    nav = lit_array(lx.PAGE_NAV_WORDS)
    kept = F.filter(lines(text(x)), lambda l: ~((F.length(l) <= 6) & F.array_contains(nav, l))
                    & ~F.rlike(l, F.lit(r"^\d{4}[/-]\d{1,2}[/-]\d{1,2}$"))
                    & ~(has(l, "IPv6") & (F.length(l) < 40))
                    & ~(F.rlike(l, F.lit(r"^[\s>›»]+")) & (F.length(l) < 20)))

    def body(ls):
        start = F.array_position(F.transform(ls, lambda l: F.rlike(l, F.lit(lx.PAGE_START)) | (F.length(l) > 30)), True)
        return F.array_join(F.slice(ls, F.greatest(start, F.lit(1)).cast("int"), F.greatest(F.size(ls), F.lit(1))), "\n")
    return let(kept, body)


def drop_title_echo(body, title):
    """Remove the first line when it only repeats the title."""
    b = text(body)
    first = F.regexp_replace(F.substring_index(b, "\n", 1), r"(?U)\s+", "")
    t = F.regexp_replace(text(title), r"(?U)\s+", "")
    echo = (first != "") & (t != "") & ((first == t) | ((F.length(first) > 10) & F.startswith(t, first)))
    rest = F.when(pos(b, F.lit("\n")) > 0, F.substring(b, pos(b, F.lit("\n")) + 1, F.length(b))).otherwise("")
    return F.when(echo, F.regexp_replace(rest, r"^\n+", "")).otherwise(b)


def strip_control_chars(x):
    return F.regexp_replace(c(x), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def sanitize_nested(x, dtype):
    """strip_control_chars through strings inside arrays, maps and structs of the given type."""
    x = c(x)
    if isinstance(dtype, T.StringType):
        return strip_control_chars(x)
    if isinstance(dtype, T.ArrayType):
        return F.transform(x, lambda e: sanitize_nested(e, dtype.elementType))
    if isinstance(dtype, T.MapType):
        m = F.transform_values(x, lambda k, v: sanitize_nested(v, dtype.valueType))
        return F.transform_keys(m, lambda k, v: sanitize_nested(k, dtype.keyType))
    if isinstance(dtype, T.StructType):
        return F.when(x.isNotNull(), F.struct(*[sanitize_nested(x[f.name], f.dataType).alias(f.name) for f in dtype]))
    return x


def strip_bracket_marks(x, words=None, blank=None):
    """Text without [...] marks inside a line, only those of the given words if any; `blank` (default: x) where nothing is left."""
    # (?d): only \n ends a line, as in the rule's own engine
    mark = r"(?d)\[.*?\]" if words is None else rf"\[(?:{any_of(words)})\]"
    return F.coalesce(nz(strip(F.regexp_replace(text(x), mark, ""))), text(x if blank is None else blank))


def dedup_paragraphs(x, prefix=None, cap=None):
    """Keep the first of equal paragraphs; with a prefix, of those that begin alike; with a cap, cut the result to it."""
    whole = lambda ps: F.array_join(ps, "\n") if cap is None else head(F.array_join(ps, "\n"), cap)
    if prefix is None:
        return whole(F.array_distinct(lines(text(x))))

    def step(acc, p):
        key = head(p, prefix)
        new = ~F.array_contains(acc["seen"], key)
        return F.struct(F.when(new, F.array_append(acc["seen"], key)).otherwise(acc["seen"]).alias("seen"),
                        F.when(new, F.array_append(acc["kept"], p)).otherwise(acc["kept"]).alias("kept"))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(lines(text(x)), F.struct(empty.alias("seen"), empty.alias("kept")), step, lambda a: a["kept"])
    return whole(kept)


def clean_structured_map(m):
    """Every value without intro, image and advertisement marks; deep-cleaned by key; empties dropped."""
    def value(k, v):
        v = trim_marketing_intro(v)
        v = strip(F.regexp_replace(v, r"(?U)\[图片核心内容\s*-\s*[^\]]*\]", ""))
        v = strip(F.replace(v, F.lit("（以上内容为广告）"), F.lit("")))
        return (F.when(k == "详情", normalize_detail(v))
                .when(k.isin("变更内容", "活动内容", "消息内容", "详细内容"), normalize_highlight(v)).otherwise(v))
    return F.map_filter(F.transform_values(c(m), value), lambda k, v: v != "")


def report_title_line(title, bank, category, structured):
    """Printable title: one line, no section suffix; dated or quota titles become bank + card."""
    t = strip(F.regexp_replace(F.replace(text(title), F.lit("\n"), F.lit(" ")), "\r", ""))
    t = F.regexp_replace(t, r"(?s) ?二、活动对象.*$", "")
    t = F.regexp_replace(t, r"(?s) ?三、活动内容.*$", "")
    t = F.replace(t, F.lit("农业银行活动活动："), F.lit(""))

    def rescued(s):
        bad = F.rlike(s, F.lit("^\\d{4}[年/-]")) | has(s, "活动名额")
        card = first_filled(F.try_element_at(c(structured), F.lit("卡种")),
                            head(F.try_element_at(c(structured), F.lit("活动内容")), 20))
        return (F.when(bad & (card != ""), strip(F.concat_ws(" ", text(bank), card)))
                .when(bad & (text(bank) != ""), F.concat(text(bank), F.lit(" "), text(category), F.lit("活动")))
                .otherwise(s))

    def tailed(s):
        s = rstrip_set(s, ". 。，；：、")
        for tail in (" 二、", "二、", " 一、", "一、", " 三、", "三、"):
            s = F.regexp_replace(s, quote_tail(tail), "")
        return s

    def shortened(s):
        cuts = [F.locate(p, s, 11) for p in ("：", "，", "、", "。", " ")]
        cut = F.coalesce(*[F.when((at > 11) & (at <= 50), at) for at in cuts])
        return (F.when(F.length(s) <= 50, s).when(cut.isNotNull(), F.substring(s, F.lit(1), cut - 1))
                .otherwise(F.concat(head(s, 50), F.lit("..."))))
    return let(let(let(t, rescued), tailed), shortened)


def quote_tail(tail):
    return tail + "$"


LINK = r"https?://[^\s）)]+"


def extract_link_segments(df, id_col="doc_id", text_col="text"):
    """(id, pos, url, title): URLs paired with the text next to them, first occurrence per row and URL.

    The pairing is a left-to-right fold inside one text; no shuffle.
    """
    # URLs are fenced with NUL, so that split() alternates text, url, text, ...
    fenced = F.regexp_replace(F.replace(text(text_col), F.lit("\0"), F.lit("")), f"({LINK})", "\0$1\0")
    pieces = F.filter(F.transform(F.split(fenced, "\0"), lambda p, i: F.struct(
        F.when(i % 2 == 1, "url").otherwise("text").alias("kind"), strip(p).alias("value"))), lambda s: s["value"] != "")
    pair_t = "array<struct<url:string,title:string>>"

    def pair(url, title):
        return F.array(F.struct(url.alias("url"), title.alias("title")))

    def step(acc, s):
        held = acc["held"]
        joined = held.isNotNull() & (held["kind"] != s["kind"])
        bare = held.isNotNull() & (held["kind"] == "url") & (s["kind"] == "url")
        out = (F.when(joined & (s["kind"] == "text"), F.concat(acc["out"], pair(held["value"], s["value"])))
               .when(joined, F.concat(acc["out"], pair(s["value"], held["value"])))
               .when(bare, F.concat(acc["out"], pair(held["value"], F.lit("")))).otherwise(acc["out"]))
        return F.struct(F.when(~joined, s).alias("held"), out.alias("out"))

    def done(acc):
        tail = acc["held"].isNotNull() & (acc["held"]["kind"] == "url")
        return F.when(tail, F.concat(acc["out"], pair(acc["held"]["value"], F.lit("")))).otherwise(acc["out"])

    start = F.struct(F.lit(None).cast("struct<kind:string,value:string>").alias("held"), F.array().cast(pair_t).alias("out"))
    pairs = F.aggregate(pieces, start, step, done)
    links = df.select(id_col, pairs.alias("links"))
    first = F.filter(F.col("links"), lambda p, i: F.array_position(F.transform(F.col("links"), lambda q: q["url"]), p["url"]) == i + 1)
    return links.select(id_col, F.posexplode(first).alias("pos", "link")).select(id_col, "pos", "link.url", "link.title")
