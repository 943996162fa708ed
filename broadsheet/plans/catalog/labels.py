"""Classification and institution queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions import labels as lb
from ...functions.expr import any_of, lines
from .base import (SQL_NOTICES, WS, column_query, notices, q, sql_any, sql_count, sql_filled, sql_hits, sql_lines, sql_list, sql_map,
                   sql_over_notices, sql_strip)


def sql_staged(view, *stages):
    inner = view
    for name, e in stages:
        inner = f"(SELECT *, {e} AS {name} FROM {inner})"
    return inner


def sql_classified(view="notices", title="title", body="body"):
    """view + category, candidates (list of structs), evidence (list)."""
    rows = []
    for i, (cat, tw, bw) in enumerate(lx.CATEGORY_WORDS):
        th, bh = sql_hits("ct", tw), f"list_filter({sql_list(bw)}, lambda k: contains(cb, k) AND NOT contains(ct, k))"
        rows.append(f"{{'neg': -least((len({th}) * 2.0 + len({bh}) * 1.0)::DOUBLE / 5.0, 1.0), 'o': {i}, 'cat': {q(cat)}, 'th': {th}, 'bh': {bh}}}")
    strong = " ".join(f"WHEN {sql_any('ct', kws)} THEN " + "{}" for _, _, kws in lx.TITLE_RULES)
    case = lambda f: "CASE " + " ".join(f"WHEN {sql_any('ct', kws)} THEN {f(cat, conf)}" for cat, conf, kws in lx.TITLE_RULES)
    two = lambda e: f"printf('%.2f', {e})"
    pairs = lambda e: f"list_transform({e}, lambda r: {{'category': r.cat, 'score': -r.neg}})"
    return sql_staged(view, ("ct", sql_strip(title)), ("cb", f"substr({sql_strip(body)}, 1, 500)"), ("rk", f"list_sort([{', '.join(rows)}])"),
        ("pos", "list_filter(rk, lambda r: r.neg < 0)"), ("sc", "-rk[1].neg"), ("sc2", "-rk[2].neg"),
        ("category", case(lambda cat, conf: q(cat)) + " WHEN sc < 0.5 THEN '其他' ELSE rk[1].cat END"),
        ("candidates", case(lambda cat, conf: f"[{{'category': {q(cat)}, 'score': {conf}::DOUBLE}}]")
         + f" WHEN sc < 0.5 AND len(pos) = 0 THEN [{{'category': '其他', 'score': 0.5::DOUBLE}}] WHEN sc < 0.5 THEN {pairs('pos')} ELSE {pairs('pos[1:3]')} END"),
        ("evidence", case(lambda cat, conf: f"['强规则: 标题含{cat}关键词']")
         + f" WHEN sc < 0.5 THEN ['最高分' || rk[1].cat || '=' || {two('sc')} || '<0.5，降级为其他'] WHEN sc - sc2 < 0.15 THEN ['前两名接近: ' || rk[1].cat || '=' || {two('sc')} || ' vs ' || rk[2].cat || '=' || {two('sc2')}]"
         " ELSE list_filter([CASE WHEN len(rk[1].th) > 0 THEN '标题匹配: ' || array_to_string(rk[1].th, ', ') END, CASE WHEN len(rk[1].bh) > 0 THEN '正文匹配: ' || array_to_string(rk[1].bh, ', ') END], lambda x: x IS NOT NULL) END"))


SQL_CANDS = "array_to_string(list_transform(candidates, lambda c: c.category || '=' || printf('%.2f', c.score)), ',')"


def cands(x):
    return F.array_join(F.transform(x, lambda c: F.concat(c["category"], F.lit("="), F.format_string("%.2f", c["score"]))), ",")


def sql_bank_in(e):
    full = f"list_filter({sql_list(lx.CANONICAL_BANKS)}, lambda b: contains({e}, b))"
    best = f"list_sort(list_transform({full}, lambda b: {{'n': -length(b), 'p': instr({e}, b), 'b': b}}))[1].b"
    alias = f"{sql_map(lx.BANK_ALIASES)}[list_filter({sql_list(list(lx.BANK_ALIASES))}, lambda a: contains({e}, a))[1]]"
    return f"coalesce({best}, {alias})"


def sql_resolved(view, title="title", author="author", body="body", explicit="''"):
    """view + bank, bank_confidence, bank_evidence, publisher_name, source_name."""
    return sql_staged(view, ("bx", f"coalesce({sql_map(lx.BANK_ALIASES)}[{explicit}], {explicit})"), ("b1", f"{sql_map(lx.AUTHOR_BANKS)}[{author}]"), ("b2", sql_bank_in(author)),
        ("b3", sql_bank_in(title)), ("b4", sql_bank_in(f"substr({body}, 1, 500)")),
        ("bank", "CASE WHEN bx <> '' THEN bx ELSE coalesce(b1, b2, b3, b4, '未知') END"),
        ("bank_confidence", f"CASE WHEN bx <> '' THEN CASE WHEN list_contains({sql_list(lx.CANONICAL_BANKS)}, bx) THEN 1.0 ELSE 0.85 END WHEN b1 IS NOT NULL THEN 0.9 WHEN b2 IS NOT NULL THEN 0.75 WHEN b3 IS NOT NULL THEN 0.7 WHEN b4 IS NOT NULL THEN 0.5 ELSE 0.0 END::DOUBLE"),
        ("bank_evidence", f"CASE WHEN bx <> '' THEN CASE WHEN bank_confidence = 1.0 THEN 'bank: 指定参数: ' ELSE 'bank: 指定参数(非标准): ' END || {explicit} WHEN b1 IS NOT NULL THEN 'bank: 公众号映射: ' || {author} || ' → ' || b1 "
         "WHEN b2 IS NOT NULL THEN 'bank: 作者名包含: ' || b2 WHEN b3 IS NOT NULL THEN 'bank: 标题包含: ' || b3 WHEN b4 IS NOT NULL THEN 'bank: 正文包含: ' || b4 ELSE 'bank: 未识别到银行信息' END"),
        ("publisher_name", f"CASE WHEN {author} <> '' AND NOT list_contains({sql_list(lx.ANONYMOUS_AUTHORS)}, {author}) THEN {author} WHEN bank <> '未知' THEN bank ELSE '' END"),
        ("source_name", f"CASE WHEN bank <> '未知' THEN bank ELSE {sql_filled(author, q('未知'))} END"))


EXPLICIT = "CASE lang WHEN 'de' THEN '招行' WHEN 'es' THEN '某地银行' ELSE '' END"


def explicit():
    return F.when(F.col("lang") == "de", "招行").when(F.col("lang") == "es", "某地银行").otherwise("")


def q_classify(spark, sf):
    k = lb.classify_3tier("title", "body")
    return notices(spark, sf).select("doc_id", k.alias("k")).select("doc_id", "k.category", cands("k.candidates").alias("candidates"), F.array_join("k.evidence", "; ").alias("evidence"))


def q_resolve(spark, sf):
    r = notices(spark, sf).select("doc_id", lb.resolve_bank("title", "author", "body", explicit()).alias("r"))
    return r.select("doc_id", "r.bank", "r.publisher_name", "r.source_name", F.col("r.confidence").alias("bank_confidence"), F.array_join("r.evidence", "; ").alias("bank_evidence"))


def q_multilabel(spark, sf):
    m = notices(spark, sf).select("doc_id", F.explode(lb.classify_multilabel("title", "body")).alias("category", "n"))
    return m.select("doc_id", "category", F.col("n").cast("bigint").alias("n"))


SQL_MULTI = ("SELECT doc_id, c.category AS category, c.n AS n FROM (SELECT doc_id, unnest(CASE WHEN len(found) > 0 THEN found ELSE [{'category': '其他', 'n': 1::BIGINT}] END) AS c FROM ("
             "SELECT doc_id, list_filter([" + ", ".join("{" + f"'category': {q(k)}, 'n': {sql_count('tt', w)}::BIGINT" + "}" for k, w in lx.KB_CATEGORY_WORDS.items())
             + "], lambda x: x.n > 0) AS found FROM (SELECT doc_id, title || ' ' || body AS tt FROM notices)))")

ordered = lambda e, rules, default: "CASE " + " ".join(f"WHEN {sql_any(e, w)} THEN {q(k)}" for k, w in rules) + f" ELSE {q(default)} END"
leftmost = lambda e: f"coalesce(regexp_extract({e}, {q('(' + '|'.join(lx.HEADING_BANKS) + ')')}, 1), '')"


def blocks():
    """The stripped lines of the body as blocks."""
    return F.transform(lines("body"), lambda l: F.struct(F.lit("article_text").alias("type"), l.alias("text")))


def q_paragraph(spark, sf):
    d = notices(spark, sf).select("doc_id", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    d = d.select("doc_id", "pos", lb.classify_paragraph("line").alias("p"))
    return d.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "p.type", "p.prefix", "p.body", "p.is_block")


SQL_PARAGRAPH = f""", l AS (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) - 1 AS pos FROM (SELECT doc_id, string_split(body, chr(10)) AS ls FROM notices)),
 k AS (SELECT doc_id, pos, raw AS line, {sql_strip("regexp_extract(raw, '(?s)^([^：:\\n]{2,15})[：:]', 1)")} AS label FROM l),
 m AS (SELECT *, CASE WHEN regexp_matches(line, '^[▸•📌🗑🟡🔴⚪🆕📊📈🏦]') THEN 'bullet' WHEN regexp_matches(line, '^[^：:\\n]{{2,15}}[：:]') THEN 'semantic' ELSE 'paragraph' END AS type,
   {sql_strip("regexp_replace(label, '[🟡🔴⚪💡]', '', 'g')")} AS clean FROM k)
 SELECT doc_id, pos::BIGINT AS pos, type, CASE WHEN type = 'semantic' THEN coalesce({sql_map({k: s for k, s, _ in lx.LABEL_STYLES})}[clean], nullif(clean, ''), label) ELSE '' END AS prefix,
   CASE WHEN type = 'semantic' THEN {sql_strip("regexp_replace(line, '(?s)^[^：:\\n]{2,15}[：:]' || '" + WS + "*', '')")} ELSE line END AS body,
   type = 'semantic' AND list_contains({sql_list([k for k, _, w in lx.LABEL_STYLES if w])}, clean) AS is_block FROM m"""

THEMES_SQL = ("SELECT doc_id, x.theme AS theme, x.note AS note FROM (SELECT doc_id, unnest(list_filter([" + ", ".join(
    "{" + f"'theme': {q(n)}, 'note': {q(note)}, 'hit': regexp_matches(title || chr(10) || body, {q('(?i)' + p)})" + "}" for n, p, note in lx.THEMES)
    + "], lambda t: t.hit)) AS x FROM notices)")

ENTRIES = {
    "normalize_category": column_query(lambda: lb.normalize_category("raw_category"),
                                       f"CASE WHEN list_contains({sql_list(lx.CATEGORIES)}, raw_category) THEN raw_category ELSE coalesce({sql_map(lx.CATEGORY_MAP)}[raw_category], '其他') END"),
    "classify_3tier": (q_classify, sql_over_notices(f"SELECT doc_id, category, {SQL_CANDS} AS candidates, array_to_string(evidence, '; ') AS evidence FROM {sql_classified()}")),
    "classify_rules_ordered": column_query(lambda: F.concat_ws("|", lb.classify_rules_ordered("title", "body"), lb.classify_rules_ordered("title", F.col("body"), lx.CHANGE_FIRST_RULES)),
                                           ("title || ' ' || substr(body, 1, 500)", "title || ' ' || substr(body, 1, 500)",
                                            ordered("t1", lx.CARD_FIRST_RULES, "公告") + " || '|' || " + ordered("t2", lx.CHANGE_FIRST_RULES, "公告"))),
    "classify_multilabel": (q_multilabel, sql_over_notices(SQL_MULTI)),
    "categorize_heading": column_query(lambda: lb.categorize_heading("title"), ordered("title", [(v, [k]) for k, v in lx.HEADING_CATEGORY.items()], "其他")),
    "resolve_bank": (q_resolve, sql_over_notices(f"SELECT doc_id, bank, publisher_name, source_name, bank_confidence, bank_evidence FROM {sql_resolved('notices', explicit=EXPLICIT)}")),
    "extract_entities": column_query(lambda: F.array_join(lb.extract_entities("body"), ","),
                                     "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {sql_any('body', al)} THEN {q(n)} END" for n, al in lx.KB_BANKS) + "], lambda x: x IS NOT NULL), ',')"),
    "first_entity_regex": column_query(lambda: lb.first_entity_regex("title", "body"),
                                       sql_filled(leftmost("title"), leftmost("array_to_string(string_split(body, chr(10))[1:5], ' ')"))),
    "topic_entity_hints": column_query(lambda: F.array_join(F.array_sort(lb.topic_entity_hints(blocks())), ","),
                                       f"array_to_string(list_sort({sql_hits('body', lx.HINT_BANKS)}), ',')"),
    "resolve_source_name": column_query(lambda: lb.resolve_source_name(lb.resolve_bank("title", "author", F.lit(""))["bank"], "author", "source"),
                                        f"list_transform([coalesce({sql_map(lx.AUTHOR_BANKS)}[author], {sql_bank_in('author')}, {sql_bank_in('title')})], lambda b: {sql_filled('b', 'author', 'source', q('未知'))})[1]"),
    "extract_bank_name": column_query(lambda: lb.extract_bank_name("title", "body"), f"coalesce({sql_bank_in('title')}, {sql_bank_in('substr(body, 1, 500)')}, '')"),
    "guess_topic_type": column_query(lambda: lb.guess_topic_type("body"),
                                     ("body", f"CASE WHEN {sql_count('t1', lx.HINT_CARD)} >= 2 THEN '新卡' WHEN {sql_count('t1', lx.HINT_PROMO)} >= 2 THEN '活动' WHEN {sql_any('t1', lx.HINT_CHANGE)} THEN '权益变更' WHEN {sql_any('t1', lx.HINT_NOTICE)} THEN '公告' ELSE '' END")),
    "classify_block": column_query(lambda: lb.classify_block(F.concat("body", F.when(F.col("lang") == "fr", "立即").when(F.col("lang") == "es", "示意图").otherwise(""))),
                                   (sql_strip("body || CASE lang WHEN 'fr' THEN '立即' WHEN 'es' THEN '示意图' ELSE '' END"),
                                    f"CASE WHEN t1 = '' THEN 'ocr_noise' WHEN length(t1) < 40 AND {sql_any('t1', lx.CTA_WORDS)} THEN 'image_cta' WHEN {sql_any('lower(t1)', lx.IMAGE_NOISE_WORDS)} OR length(t1) < 4 THEN 'ocr_noise' ELSE 'ocr_fact' END")),
    "classify_paragraph": (q_paragraph, sql_over_notices("", SQL_PARAGRAPH)),
    "detect_doc_type": column_query(lambda: lb.detect_doc_type("source", "body", external=["优惠", "返现", "积分"], internal=["系统", "公告"]),
                                    ("source || chr(10) || substr(body, 1, 2000)", f"{{'e': {sql_count('t1', ['优惠', '返现', '积分'])}, 'i': {sql_count('t1', ['系统', '公告'])}}}",
                                     "CASE WHEN t2.e >= 2 THEN '对外文档' WHEN t2.e >= 1 AND t2.i = 0 THEN '混合型' WHEN t2.i >= 2 THEN '纯内部技术文档' ELSE '混合型' END")),
    "theme_tag": ((lambda s, d: lb.theme_tag(notices(s, d).select("doc_id", "title", "body")).select("doc_id", "theme", "note")), sql_over_notices(THEMES_SQL)),
}
