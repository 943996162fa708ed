"""Category classification and institution resolution as Column expressions."""

from pyspark.sql import functions as F

from .. import lexicon as lx
from .expr import (any_of, c, case, count_hits, first_filled, has, has_any, head, hits, let, lines, lit_array, lit_map,
                   nz, strip, text)

CANDIDATES = "array<struct<category:string,score:double>>"


def normalize_category(x, mapping=lx.CATEGORY_MAP, standard=lx.CATEGORIES):
    """Standard names pass, known variants map, the rest becomes 其他."""
    return F.when(c(x).isin(*standard), c(x)).otherwise(
        F.coalesce(F.try_element_at(lit_map(mapping), c(x)), F.lit(lx.OTHER)))


def _candidate_list(pairs):
    return F.array(*[F.struct(F.lit(k).alias("category"), s.cast("double").alias("score")) for k, s in pairs])


def _scored(title, body, words, title_weight, body_weight):
    """Per category: score in [0,1], title hits and the body hits the title does not have."""
    out = []
    for order, (cat, title_words, body_words) in enumerate(words):
        in_title = hits(title, title_words)
        in_body = F.array_compact(F.array(*[F.when(has(body, w) & ~has(title, w), F.lit(w)) for w in body_words]))
        raw = F.size(in_title) * title_weight + F.size(in_body) * body_weight
        out.append(F.struct((-F.least(raw / 5.0, F.lit(1.0))).alias("neg"), F.lit(order).alias("order"),
                            F.lit(cat).alias("category"), in_title.alias("title_hits"), in_body.alias("body_hits")))
    return F.array_sort(F.array(*out))


def classify_3tier(title, body, rules=lx.TITLE_RULES, words=lx.CATEGORY_WORDS, title_weight=2.0, body_weight=1.0,
                   body_chars=500, accept=lx.ACCEPT_SCORE, close=lx.CLOSE_GAP):
    """struct(category, candidates, evidence): title rules, then weighted words, then the low-score decision."""
    t = strip(text(title))
    b = head(strip(text(body)), body_chars)

    def two(x):
        return F.format_string("%.2f", x)

    def decide(ranked):
        top, second = ranked[0], ranked[1]
        score = -top["neg"]
        positive = F.filter(ranked, lambda r: r["neg"] < 0)
        as_pairs = lambda rs: F.transform(rs, lambda r: F.struct(r["category"].alias("category"), (-r["neg"]).alias("score")))
        all_pos = as_pairs(positive)
        top3 = as_pairs(F.slice(positive, 1, 3))
        low = score < accept
        near = (score + second["neg"]) < close
        why = F.array_compact(F.array(
            F.when(F.size(top["title_hits"]) > 0, F.concat(F.lit("标题匹配: "), F.array_join(top["title_hits"], ", "))),
            F.when(F.size(top["body_hits"]) > 0, F.concat(F.lit("正文匹配: "), F.array_join(top["body_hits"], ", ")))))
        return F.struct(
            F.when(low, F.lit(lx.OTHER)).otherwise(top["category"]).alias("category"),
            F.when(low & (F.size(positive) == 0), _candidate_list([(lx.OTHER, F.lit(0.5))]).cast(CANDIDATES))
             .when(low, all_pos).otherwise(top3).cast(CANDIDATES).alias("candidates"),
            F.when(low, F.array(F.concat(F.lit("最高分"), top["category"], F.lit("="), two(score), F.lit(f"<{accept}，降级为其他"))))
             .when(near, F.array(F.concat(F.lit("前两名接近: "), top["category"], F.lit("="), two(score), F.lit(" vs "),
                                          second["category"], F.lit("="), two(-second["neg"]))))
             .otherwise(why).alias("evidence"))

    strong = case([(F.rlike(t, F.lit(any_of(kws))),
                    F.struct(F.lit(cat).alias("category"),
                             _candidate_list([(cat, F.lit(conf))]).cast(CANDIDATES).alias("candidates"),
                             F.array(F.lit(f"强规则: 标题含{cat}关键词")).alias("evidence"))) for cat, conf, kws in rules])
    scored = let(F.struct(t.alias("t"), b.alias("b")),
                 lambda s: let(_scored(s["t"], s["b"], words, title_weight, body_weight), decide))
    return F.coalesce(strong, scored)


def classify_rules_ordered(title, body, rules=lx.CARD_FIRST_RULES, default="公告", body_chars=500):
    """First keyword list that matches wins."""
    t = F.concat(text(title), F.lit(" "), head(text(body), body_chars))
    return case([(F.rlike(t, F.lit(any_of(kws))), cat) for cat, kws in rules], default)


def classify_multilabel(title, body, words=lx.KB_CATEGORY_WORDS):
    """map(category -> number of its words found); {其他: 1} when none."""
    t = F.concat(text(title), F.lit(" "), text(body))
    def pick(s):
        m = F.map_filter(F.create_map(*[e for cat, kws in words.items() for e in (F.lit(cat), count_hits(s, kws))]), lambda k, v: v > 0)
        return let(m, lambda x: F.when(F.size(x) > 0, x).otherwise(F.create_map(F.lit(lx.OTHER), F.lit(1))))
    return let(t, pick)


def categorize_heading(x, mapping=lx.HEADING_CATEGORY):
    return case([(has(text(x), k), v) for k, v in mapping.items()], lx.OTHER)


def bank_in_text(x, canonical=lx.CANONICAL_BANKS, aliases=lx.BANK_ALIASES):
    """Longest full name in the text, then the earliest; else the first alias of the table. NULL when none."""
    def body(t):
        full = F.array_min(F.array_compact(F.array(*[
            F.when(has(t, b), F.struct(F.lit(-len(b)).alias("n"), F.instr(t, b).alias("at"), F.lit(b).alias("bank")))
            for b in canonical])))
        return F.coalesce(full["bank"], case([(has(t, a), b) for a, b in aliases.items()]))
    return let(text(x), body)


def resolve_bank(title, author, body, explicit=None, canonical=lx.CANONICAL_BANKS, aliases=lx.BANK_ALIASES,
                 authors=lx.AUTHOR_BANKS, body_chars=500):
    """struct(bank, publisher_name, source_name, confidence, evidence) from the strongest signal present.

    explicit > author table > author text > title > body prefix > 未知.
    """
    exp = text(explicit) if explicit is not None else F.lit("")
    auth = text(author)
    named = F.coalesce(F.try_element_at(lit_map(aliases), exp), exp)

    def signal(bank, conf, label, detail):
        return F.when(bank.isNotNull(), F.struct(bank.alias("bank"), F.lit(conf).alias("confidence"),
                                                 F.concat(F.lit(label), detail).alias("evidence")))
    known = named.isin(*canonical)
    by_table = F.try_element_at(lit_map(authors), auth)
    by_author, by_title = bank_in_text(auth), bank_in_text(title)
    by_body = bank_in_text(head(text(body), body_chars))
    best = F.coalesce(
        signal(F.when(known, named), 1.0, "bank: 指定参数: ", exp),
        signal(F.when(exp != "", named), 0.85, "bank: 指定参数(非标准): ", exp),
        signal(by_table, 0.9, "bank: 公众号映射: ", F.concat(auth, F.lit(" → "), by_table)),
        signal(by_author, 0.75, "bank: 作者名包含: ", by_author),
        signal(by_title, 0.7, "bank: 标题包含: ", by_title),
        signal(by_body, 0.5, "bank: 正文包含: ", by_body),
        F.struct(F.lit(lx.UNKNOWN_BANK).alias("bank"), F.lit(0.0).alias("confidence"), F.lit("bank: 未识别到银行信息").alias("evidence")))

    def out(b):
        found = b["bank"] != lx.UNKNOWN_BANK
        return F.struct(
            b["bank"].alias("bank"),
            F.when((auth != "") & ~auth.isin(*lx.ANONYMOUS_AUTHORS), auth).when(found, b["bank"]).otherwise("").alias("publisher_name"),
            F.when(found, b["bank"]).otherwise(first_filled(auth, F.lit(lx.UNKNOWN_BANK))).alias("source_name"),
            b["confidence"].alias("confidence"), F.array(b["evidence"]).alias("evidence"))
    return let(best, out)


def extract_entities(x, table=lx.KB_BANKS):
    """All entities of which some alias occurs, in table order."""
    return let(text(x), lambda t: F.array_compact(F.array(*[
        F.when(has_any(t, al), F.lit(name)) for name, al in table])))


def first_entity_regex(heading, body, names=lx.HEADING_BANKS, n_lines=5):
    """Leftmost name in the heading, else in the first lines of the body."""
    pat = f"({any_of(names)})"
    front = F.array_join(F.slice(F.split(text(body), "\n"), 1, n_lines), " ")
    return first_filled(F.regexp_extract(text(heading), pat, 1), F.regexp_extract(front, pat, 1))


def topic_entity_hints(blocks, words=lx.HINT_BANKS):
    """Distinct entity words over the texts of an array of blocks."""
    return F.array_distinct(F.flatten(F.transform(c(blocks), lambda b: hits(text(b["text"]), words))))


def resolve_source_name(bank, author, source):
    return first_filled(F.nullif(c(bank), F.lit(lx.UNKNOWN_BANK)), author, source, F.lit(lx.UNKNOWN_BANK))


def extract_bank_name(title, body):
    return F.coalesce(F.nullif(resolve_bank(title, F.lit(""), body)["bank"], F.lit(lx.UNKNOWN_BANK)), F.lit(""))


def guess_topic_type(x):
    """新卡 / 活动 need two signals, 权益变更 / 公告 one; else ''."""
    return let(text(x), lambda t: case([
        (count_hits(t, lx.HINT_CARD) >= 2, "新卡"), (count_hits(t, lx.HINT_PROMO) >= 2, "活动"),
        (has_any(t, lx.HINT_CHANGE), "权益变更"), (has_any(t, lx.HINT_NOTICE), "公告")], ""))


def classify_block(x):
    """ocr_fact, ocr_noise or image_cta for a recognised text line."""
    t = strip(text(x))
    return case([(t == "", "ocr_noise"), ((F.length(t) < 40) & has_any(t, lx.CTA_WORDS), "image_cta"),
                 (has_any(F.lower(t), lx.IMAGE_NOISE_WORDS), "ocr_noise"), (F.length(t) < 4, "ocr_noise")], "ocr_fact")


def classify_paragraph(x, styles=lx.LABEL_STYLES):
    """struct(type, prefix, body, is_block): bullet, 'label：value' (semantic) or plain paragraph."""
    t = text(x)
    label = strip(F.regexp_extract(t, r"(?s)^([^：:\n]{2,15})[：:]\s*(.*)$", 1))
    value = strip(F.regexp_extract(t, r"(?sU)^([^：:\n]{2,15})[：:]\s*(.*)$", 2))
    clean = strip(F.regexp_replace(label, "[🟡🔴⚪💡]", ""))
    semantic = F.rlike(t, F.lit(r"^[^：:\n]{2,15}[：:]"))
    bullet = F.rlike(t, F.lit("^[▸•📌🗑🟡🔴⚪🆕📊📈🏦]"))
    kind = F.when(bullet, "bullet").when(semantic, "semantic").otherwise("paragraph")
    shown = F.coalesce(F.try_element_at(lit_map({k: s for k, s, _ in styles}), clean), nz(clean), label)
    wide = clean.isin(*[k for k, _, w in styles if w])
    return F.struct(kind.alias("type"), F.when(kind == "semantic", shown).otherwise("").alias("prefix"),
                    F.when(kind == "semantic", value).otherwise(t).alias("body"),
                    ((kind == "semantic") & wide).alias("is_block"))


def detect_doc_type(name, body, external=lx.EXTERNAL_DOC_WORDS, internal=lx.INTERNAL_DOC_WORDS, chars=2000):
    """External, internal or mixed document by the words of its name and opening."""
    t = F.concat(text(name), F.lit("\n"), head(text(body), chars))
    return let(t, lambda s: let(F.struct(count_hits(s, external).alias("e"), count_hits(s, internal).alias("i")),
               lambda h: case([(h["e"] >= 2, "对外文档"), ((h["e"] >= 1) & (h["i"] == 0), "混合型"), (h["i"] >= 2, "纯内部技术文档")], "混合型")))


def theme_tag(df, title="title", body="body", themes=lx.THEMES):
    """One row per item and theme whose pattern matches; conditions are evaluated in place, no join."""
    t = F.concat(text(title), F.lit("\n"), text(body))
    found = let(t, lambda s: F.array_compact(F.array(*[
        F.when(F.rlike(s, F.lit("(?i)" + pat)), F.struct(F.lit(name).alias("theme"), F.lit(note).alias("note"))) for name, pat, note in themes])))
    cols = df.columns
    return df.select(*cols, F.explode(found).alias("hit")).select(*cols, "hit.theme", "hit.note")
