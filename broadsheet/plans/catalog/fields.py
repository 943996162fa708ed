"""Field extraction queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions import fields as fd
from ...functions import labels as lb
from ...functions.expr import any_of, lines
from .base import (WS, column_query, notices, q, sql_any, sql_count, sql_filled, sql_hits, sql_lines, sql_list, sql_map, sql_over_notices,
                   sql_strip, table)
from .labels import sql_classified, sql_resolved, sql_staged
from .texts import collapse, sql_card_name, sql_intro, sql_truncate

TRIMS = "；，,。 "
first = lambda e, pats: sql_filled(*[f"regexp_extract({e}, {q(p)}, 1)" for p in pats])
tidy = lambda e: collapse(e, TRIMS)


def sql_first_sentence(e):
    """Nested single-element list transforms, so that every step is written once."""
    opening = "^(?:" + any_of(lx.SENTENCE_MARKERS) + ")"
    number = r"(?:^|[：:\s])[一二三四五六七八九十]+、"
    s = f"regexp_extract({e}, '^[^。；]*')"
    s = f"list_transform([{s}], lambda v: CASE WHEN regexp_matches(v, {q(number)}) THEN {sql_strip('regexp_extract(v, ' + q('(?s)^(.*?)' + number) + ', 1)')} ELSE v END)"
    rest = f"regexp_replace(v, {q(opening)}, '')"
    for p in (r"^[：:\s]+", r"^[\d\-/.~至到年月日号]*[年月日号]", r"^\s*\d+[：:点时分]\d*\s*", r"^起至\s*"):
        rest = f"regexp_replace({rest}, {q(p)}, '')"
    for _ in range(5):
        s = f"list_transform({s}, lambda v: CASE WHEN regexp_matches(v, {q(opening)}) AND {sql_strip(rest)} <> '' THEN {sql_strip(rest)} ELSE v END)"
    return sql_strip(f"regexp_replace({s}[1], {q('^(尊敬的客户[：:]?|您好[！!]?|感谢您[^，,]*[，,]?)' + WS + '*')}, '')")


def let1(e, body, var="lv"):
    return f"list_transform([{e}], lambda {var}: {body})[1]"


def sql_change(e):
    return let1(tidy(e), sql_filled(tidy(first("lv", lx.CHANGE_PATTERNS)), sql_first_sentence("lv")))


def sql_activity(e):
    return let1(tidy(e), sql_filled(tidy(first("lv", lx.ACTIVITY_PATTERNS)), sql_first_sentence("lv")))


def sql_activity_name(e):
    opening = "^(" + any_of(lx.ACTIVITY_BOILERPLATE) + ")"
    frag = lambda x: f"(regexp_matches({x}, {q('^[0-9' + chr(92) + '-/.~至到年月日号]+$')}) OR regexp_matches({x}, {q('^[0-9.]+' + chr(92) + 's*[元点%]$')}))"
    inner = sql_strip(f"regexp_replace(p, {q(opening + '[：: ' + chr(10) + ']*')}, '')")
    parts = f"list_transform(string_split(regexp_replace({e}, {q(opening + '[：: ' + chr(10) + ']*')}, ''), '。'), lambda p: {sql_strip('p')})"
    named = (f"list_filter(list_transform(ps, lambda p: CASE WHEN p = '' OR {frag('p')} THEN NULL WHEN NOT regexp_matches(p, {q(opening)}) THEN p "
             f"WHEN contains(regexp_extract(p, {q(opening)}, 1), '活动内容') AND {inner} <> '' AND NOT {frag(inner)} THEN {inner} END), lambda p: p IS NOT NULL)[1]")
    longest = "list_sort(list_transform(ps, lambda p, i: {'n': -length(p), 'i': i, 'p': p}))[1].p"
    return let1(parts, f"coalesce({named}, {longest})", "ps")


def sql_structured(cat="category", title="title", body="body", raw="body", author="author", url="url"):
    """MAP per category, as build_structured."""
    src = f"CASE WHEN {sql_strip(body)} <> '' THEN {body} ELSE {sql_intro(sql_filled(raw, title), lx.INTRO_OPENERS)} END"
    cut = lambda n: f"CASE WHEN sx <> '' THEN {sql_truncate('sx', n)} ELSE {title} END"
    m = lambda d: "MAP {" + ", ".join(f"{q(k)}: {v}" for k, v in d.items()) + "}"
    return let1(src, f"""CASE {cat} WHEN '新卡' THEN {m({'卡种': sql_card_name(title), '卡亮点': "''", '适用人群': "'信用卡持卡人'", '来源': sql_filled(author, url), '详情': cut(500)})}
      WHEN '活动' THEN {m({'活动内容': cut(300), '活动时间': "''", '适用人群': "'信用卡持卡人'"})}
      WHEN '权益变更' THEN {m({'消息时间': "''", '影响范围': "''", '变更内容': cut(500), '变更分析': "''"})}
      WHEN '公告' THEN {m({'消息内容': cut(500), '点评': "''"})} ELSE {m({'详细内容': cut(500)})} END""", "sx")


STRUCT_KEYS = ["卡种", "卡亮点", "适用人群", "来源", "详情", "活动内容", "活动时间", "消息时间", "影响范围", "变更内容", "变更分析", "消息内容", "点评", "详细内容"]


def flat(m):
    """A map as 'key=value' lines in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(m)), lambda k: F.concat(k, F.lit("="), F.element_at(m, k))), "\n")


def sql_flat(m):
    return f"array_to_string(list_transform(list_sort(map_keys({m})), lambda k: k || '=' || {m}[k]), chr(10))"


def with_category(spark, sf):
    d = notices(spark, sf)
    cat = F.when(F.col("n_chars") % 6 == 0, "公告").when(F.col("n_chars") % 6 == 1, "新卡").when(F.col("n_chars") % 6 == 2, "权益变更").when(
        F.col("n_chars") % 6 == 3, "其他").otherwise("活动")
    return d.withColumn("category", cat).withColumn("bank", F.when(F.col("lang") == "fr", "未知").otherwise(F.concat("source", F.lit("银行"))))


WITH_CATEGORY = """, cats AS (SELECT *, CASE n_chars % 6 WHEN 0 THEN '公告' WHEN 1 THEN '新卡' WHEN 2 THEN '权益变更' WHEN 3 THEN '其他' ELSE '活动' END AS category,
  CASE lang WHEN 'fr' THEN '未知' ELSE source || '银行' END AS bank FROM notices)"""


def cat_query(expr, sql):
    return column_query(expr, sql, src=with_category, view="cats", extra=WITH_CATEGORY)


def notice_sql(scraped):
    m = lambda d: "MAP {" + ", ".join(f"{q(k)}: {v}" for k, v in d.items()) + "}"
    pat = r"(\d{4}年\d{1,2}月\d{1,2}日)\s*[-至~]\s*(\d{4}年?\d{1,2}月\d{1,2}日)"
    win = f"CASE WHEN regexp_matches(substr(nb, 1, 500), {q(pat)}) THEN regexp_extract(substr(nb, 1, 500), {q(pat)}, 1) || ' ~ ' || regexp_extract(substr(nb, 1, 500), {q(pat)}, 2) ELSE '' END"
    act = "CASE WHEN length(nb) > length(title) THEN substr(nb, 1, 600) ELSE title END" if scraped else "title"
    notice = m({"消息内容": "substr(nb, 1, 300)", "点评": "''"})
    return f"""CASE category WHEN '新卡' THEN {m({'卡种': 'title', '卡亮点': "''", '适用人群': "''", '来源': 'bank', '详情': 'substr(nb, 1, 300)'})}
     WHEN '权益变更' THEN {m({'消息时间': 'publish_time', '影响范围': "bank || '信用卡持卡人'", '变更内容': 'substr(nb, 1, 500)', '变更分析': "''"})}
     WHEN '活动' THEN {m({'活动内容': act, '活动时间': 'publish_time' if scraped else sql_filled(win, 'publish_time'), '适用人群': "bank || '信用卡持卡人'"})}
     WHEN '公告' THEN {notice} ELSE {notice if scraped else m({'详细内容': sql_filled('substr(nb, 1, 300)', 'title')})} END"""


RANGED = "replace(body, '2024年3月5日', '2024年3月5日至2024年4月1日')"
ranged = lambda: F.replace("body", F.lit("2024年3月5日"), F.lit("2024年3月5日至2024年4月1日"))

ocr_vals = lambda matches: (f"array_to_string(list_distinct_ordered({matches}), '；')")


def sql_ocr_values(ms):
    kept = f"list_filter(list_transform({ms}, lambda z: {sql_strip('z')}), lambda z: NOT list_contains({sql_list(lx.OCR_EMPTY_VALUES)}, z))"
    cut = f"list_transform({kept}, lambda z: rtrim(z, '。，'))"
    return let1(cut, "array_to_string(list_filter(zs, lambda z, i: list_position(zs, z) = i), '；')", "zs")


def sql_ocr():
    lab = lambda labels: sql_ocr_values(f"regexp_extract_all(ob, {q('(?:' + labels + ')[：:]' + chr(92) + 's*(.*)')}, 1)")
    price_all = f"regexp_extract_all(ob, {q('(?:适用)?价格[：:]' + chr(92) + 's*.*|优惠价格[：:]' + chr(92) + 's*.*|.*?[0-9]+元[^。' + chr(92) + 'n]*')})"
    price = f"list_transform({price_all}, lambda y: CASE WHEN regexp_matches(y, '^(?:适用|优惠)?价格[：:]') THEN regexp_extract(y, '^(?:适用|优惠)?价格[：:]\\s*(.*)', 1) ELSE regexp_extract(y, '([0-9]+元[^。\\n]*)', 1) END)"
    m = lambda d: "MAP {" + ", ".join(f"{q(k)}: {v}" for k, v in d.items()) + "}"
    who, full = sql_filled("o_who", "'信用卡持卡人'"), sql_filled("substr(ob, 1, 500)", "title")
    brief = "array_to_string(list_transform(regexp_extract_all(ob, '(?:核心权益|优惠内容|活动简介)[：:]\\s*.*'), lambda y: " + sql_strip("y") + "), chr(10))"
    return sql_staged("cats", ("ob", "replace(body, '，', chr(10))"), ("o_card", lab("卡种[名称]*")), ("o_bank", lab("银行[名称]*")), ("o_gain", lab("(?:核心)?权益|核心|活动内容|优惠内容")),
        ("o_price", sql_ocr_values(price)), ("o_time", lab("活动时间|有效期|时间")), ("o_who", lab("适用条件|适用人群")),
        ("gain", sql_filled("array_to_string(list_filter([o_gain, o_price], lambda b: b <> ''), '；')", brief)),
        ("m", f"""CASE category WHEN '新卡' THEN {m({'卡种': sql_filled('o_card', 'title'), '卡亮点': 'substr(gain, 1, 200)', '适用人群': who, '来源': sql_filled('o_bank', 'title'), '详情': full})}
         WHEN '活动' THEN {m({'活动内容': sql_filled('substr(gain, 1, 300)', 'title'), '活动时间': sql_filled('o_time', q('详见活动说明')), '适用人群': who})}
         WHEN '权益变更' THEN {m({'消息时间': 'o_time', '影响范围': who, '变更内容': sql_filled('substr(gain, 1, 500)', 'title'), '变更分析': "''"})}
         WHEN '公告' THEN {m({'消息内容': sql_filled('substr(gain, 1, 300)', 'title'), '点评': "''"})} ELSE {m({'详细内容': full})} END"""))


# ---- dates over the fact tables ---------------------------------------------------
SPELLINGS = ["yyyy-MM-dd", "yyyy/M/d", "yyyy.MM.dd", "yyyyMMdd", "（yyyy年M月d日）", "yyyy年M月d日 HH时mm分", "发布 yyyy/MM/dd 起", "M-d", "日期不详"]


def q_parse_date(spark, sf):
    """Every order date, spelled in one of nine ways, parsed back."""
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("timestamp")
    k = F.col("o_custkey") % 9
    spelled = F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
    for i, f in enumerate(SPELLINGS[1:-1], 1):
        spelled = spelled.when(k == i, F.date_format(d, "'" + f.replace("yyyy", "'yyyy'").replace("MM", "'MM'").replace("dd", "'dd'").replace("HH", "'HH'").replace("mm", "'mm'")
                                                     .replace("M月", "'M'月").replace("d日", "'d'日") + "'" if "年" in f or "起" in f else f))
    spelled = spelled.otherwise("日期不详")
    return o.select(F.col("o_orderkey").alias("doc_id"), F.date_format(fd.parse_date_multi(spelled, year=1996), "yyyy-MM-dd HH:mm:ss").alias("out"))


SQL_PARSE_DATE = """SELECT o_orderkey AS doc_id, CASE WHEN o_custkey % 9 = 8 THEN NULL WHEN o_custkey % 9 = 7 THEN '1996-' || strftime(o_orderdate, '%m-%d') || ' 00:00:00'
 WHEN o_custkey % 9 = 5 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') || ':00' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' END AS out FROM orders"""

URLS = lambda: F.concat("url", F.lit("?p="), F.regexp_replace("publish_time", r"\.", "/"), F.when(F.col("lang") == "de", "/news_260709.shtml").otherwise(""))
URLS_SQL = "url || '?p=' || replace(publish_time, '.', '/') || CASE lang WHEN 'de' THEN '/news_260709.shtml' ELSE '' END"
DAYTEXT = "publish_time || ' ' || body"


def iso(y, m, d):
    return f"CASE WHEN length({y}) = 2 THEN '20' || {y} ELSE {y} END || '-' || lpad(CAST(CAST({m} AS INT) AS VARCHAR), 2, '0') || '-' || lpad(CAST(CAST({d} AS INT) AS VARCHAR), 2, '0')"


def sql_date(e, last):
    pats = [r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", r"(\d{4})年(\d{1,2})月(\d{1,2})日?", r"(\d{4})\.(\d{1,2})\.(\d{1,2})", r"(?:news[_-])?(\d{2})(\d{2})(\d{2})\.(?:shtml|html)(?:$|[?#])"]
    g = lambda p, i: f"regexp_extract({e}, {q(p)}, {i})"
    if not last:
        return "CASE " + " ".join(f"WHEN regexp_matches({e}, {q(p)}) THEN {iso(g(p, 1), g(p, 2), g(p, 3))}" for p in pats) + " ELSE '' END"
    deep = ["(?s)^(.*)" + p for p in pats]
    return ("coalesce(list_sort(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({e}, {q(p)}) THEN {{'at': -length({g(p, 1)}), 'o': {i}, 'd': {iso(g(p, 2), g(p, 3), g(p, 4))}}} END"
            for i, p in enumerate(deep)) + "], lambda z: z IS NOT NULL))[1].d, '')")


SQL_KV = f""", l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, {sql_lines("replace(body, '，', chr(10))")} AS ls FROM notices)),
 e AS (SELECT doc_id, i, {sql_strip("regexp_extract(line, '^(.{1,16})[：:]\\s*(.+)', 1)")} AS k, {sql_strip("regexp_extract(line, '^(.{1,16})[：:]\\s*(.+)', 2)")} AS v FROM l WHERE regexp_matches(line, '^(.{{1,16}})[：:]\\s*(.+)')),
 s AS (SELECT doc_id, i, coalesce({sql_map(lx.FIELD_ALIASES)}[k], k) AS key, v FROM e)
 SELECT doc_id, key, coalesce(arg_min(v, i) FILTER (v <> ''), '') AS value FROM s GROUP BY doc_id, key"""

RENAME = lambda: F.create_map(F.lit("亮点"), F.lit(""), F.lit("卡亮点"), F.col("title"), F.lit("生效日期"), F.col("publish_time"), F.lit("时间"), F.col("source"), F.concat(F.lit("其他"), F.col("lang")), F.col("lang"))

pay = lambda: fd.review_payload("title", "category", "bank", "body", F.col("n_chars"), F.array(F.lit("a"), F.col("lang")))

MODEL = {0: lambda b: F.concat(F.lit("{\"category\": \""), b, F.lit("\"}"))}


def q_model_json(spark, sf):
    """Event properties wrapped as plain, fenced, prefixed or broken answers, then read back."""
    e = table(spark, sf, "events")
    k = F.col("user_id") % 4
    raw = (F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("答：```json\n"), F.col("props"), F.lit("\n```")))
           .when(k == 2, F.concat(F.lit("结果 "), F.col("props"), F.lit(" 完"))).otherwise(F.concat(F.lit("broken {"), F.col("event_type"))))
    v = fd.parse_model_json(raw)
    return e.select(F.col("event_id").alias("doc_id"), F.try_variant_get(v, "$.k", "bigint").alias("out"))


LABELS5 = ["TPL"]
AUD_TEXT = lambda: F.replace("body", F.lit("；"), F.lit("适合"))
BULLETS = lambda: F.replace(F.replace("body", F.lit("，"), F.lit("\n- ")), F.lit("权益"), F.lit("亮点："))


def q_benefits(spark, sf):
    d = notices(spark, sf).withColumn("m", F.create_map(F.lit("卡亮点"), F.col("title")))
    t = F.when(F.col("lang") == "en", F.replace("body", F.lit("，"), F.lit("\n- "))).otherwise(F.replace(F.replace("body", F.lit("-"), F.lit("")), F.lit("*"), F.lit("")))
    return d.select("doc_id", F.array_join(fd.extract_benefits(t, "m"), "|").alias("out"))


BENEFITS_SQL = ("CASE WHEN lang = 'en' THEN replace(body, '，', chr(10) || '- ') ELSE replace(replace(body, '-', ''), '*', '') END",
                f"list_transform(regexp_extract_all(t1, '[•\\-*]\\s*(.{{5,60}}?)(?:\\n|$)', 1)[1:5], lambda y: {sql_strip('y')})",
                f"list_filter(list_transform(regexp_split_to_array(regexp_extract(t1, '(?s)(?:亮点|核心权益|优势)[：:]\\s*(.+?)(?:\\n\\n|$)', 1), '[。；\\n]'), lambda y: {sql_strip('y')}), lambda y: length(y) BETWEEN 5 AND 60)[1:5]",
                "CASE WHEN len(t2) > 0 THEN array_to_string(t2, '|') WHEN len(t3) > 0 THEN array_to_string(t3, '|') ELSE substr(title, 1, 60) END")


def sql_audience(title="title", raw="body", given="''", cat="category", bank="bank"):
    t = f"({title} || ' ' || {raw})"
    g = let1(sql_strip(given), "CASE WHEN gv IN ('信用卡持卡人', '持卡人') THEN '' ELSE gv END", "gv")
    lab = sql_strip(f"regexp_extract({t}, {q('适用人群[：:]' + chr(92) + 's*(.+?)(?:' + chr(92) + 'n|$)')}, 1)")
    word = sql_strip(f"regexp_extract({t}, {q('(?:适合|推荐给|面向)(.{3,30}?)(?:[，。；' + chr(92) + 'n]|$)')}, 1)")
    return sql_filled(f"substr({g}, 1, 50)", f"substr({lab}, 1, 50)", f"substr({word}, 1, 50)",
                      f"CASE WHEN {cat} = '新卡' AND {title} <> '' THEN CASE WHEN {bank} <> '' THEN '持有' || {bank} || '信用卡的用户' ELSE '信用卡申请人' END ELSE '' END")


def sql_fee_note(title="title", raw="body", detail="''"):
    t = f"({title} || ' ' || {raw})"
    s = sql_strip(f"regexp_extract({t}, {q('(?:^|[，。' + chr(92) + 's])年费[：:]*' + chr(92) + 's*(.{5,60}?)(?:[。' + chr(92) + 'n]|$)')}, 1)")
    d = sql_strip(f"regexp_extract({sql_strip(detail)}, {q('年费[：:]*' + chr(92) + 's*(.{3,40})')}, 1)")
    amount = f"regexp_extract({t}, {q('年费[^0-9]*([0-9]+)元')}, 1)"
    stock = f"CASE WHEN contains({t}, '免年费') THEN '免年费，零持卡成本' WHEN contains({t}, '首年免') THEN '首年免年费' WHEN contains({t}, '刷卡免') OR contains({t}, '刷卡6次免') THEN '刷卡免年费' WHEN contains({t}, '刚性年费') AND {amount} <> '' THEN '刚性年费' || {amount} || '元' ELSE '' END"
    return sql_filled(s, d, stock)


def sql_title_made(bank, cat, m, fb):
    f = lambda k: sql_strip(f"coalesce({m}[{q(k)}], '')")
    b = sql_filled(bank, fb, "'银行'")
    act = let1(f("活动内容"), sql_truncate(let1("av", sql_filled(sql_activity_name("aw"), "aw"), "aw"), 30), "av")
    act = let1(let1(f("活动内容"), sql_filled(sql_activity_name("av"), "av"), "av"), sql_truncate("tv", 30), "tv")
    return let1(b, f"""CASE WHEN bn IN ('未知', '银行') THEN {sql_filled(fb, "bn || '推出优惠活动'")}
      WHEN {cat} = '新卡' THEN CASE WHEN {f('卡种')} <> '' THEN bn || '发布' || {f('卡种')} ELSE bn || '发布新卡' END
      WHEN {cat} = '活动' THEN CASE WHEN {f('活动内容')} <> '' THEN bn || '活动：' || {act} ELSE bn || '推出优惠活动' END
      WHEN {cat} = '权益变更' THEN CASE WHEN {fb} <> '' AND {sql_any(fb, lx.ACTION_WORDS_BY_CATEGORY['权益变更'])} THEN bn || '权益调整：' || substr({fb}, 1, 30)
        WHEN {f('变更内容')} <> '' THEN bn || '权益调整：' || substr({f('变更内容')}, 1, 30) ELSE bn || '调整信用卡权益' END
      ELSE {sql_filled(fb, f"bn || {cat}")} END""", "bn")


def sql_summary(cat, m, mc, raw_title, raw_text):
    g = lambda k: tidy(sql_filled(f"coalesce({mc}[{q(k)}], '')", f"coalesce({m}[{q(k)}], '')"))
    no_nav = lambda e: let1(e, f"CASE WHEN {sql_count('nv', lx.NAV_WORDS_4)} >= 4 THEN '' ELSE nv END", "nv")
    join = lambda ps, n: let1(f"list_filter([{', '.join(ps)}], lambda y: y <> '')", f"{sql_filled(f'substr(array_to_string(list_filter(js, lambda y, i: list_position(js, y) = i), {q(chr(0xff1b))}), 1, {n})', f'substr({raw_title}, 1, 100)')}", "js")
    fee = tidy(first("fs", lx.FEE_PATTERNS))
    base = f"array_to_string(list_filter([{g('卡种')}, substr({g('卡亮点')}, 1, 50)], lambda y: y <> ''), '；')"
    card = let1(base, let1(let1(sql_filled(g("详情"), g("卡亮点")), fee, "fs"),
                           f"{sql_filled(f'substr(CASE WHEN fv <> {q(chr(32))[:1]}{q(chr(32))[:1]} AND NOT contains(bs, fv) THEN array_to_string(list_filter([bs, fv], lambda y: y <> {q(chr(32))[:1]}{q(chr(32))[:1]}), {q(chr(0xff1b))}) ELSE bs END, 1, 120)', f'substr({sql_filled(raw_title, g(chr(0x8be6) + chr(0x60c5)))}, 1, 100)')}", "fv"), "bs")
    scope = lambda e: tidy(first(e, lx.SCOPE_PATTERNS))
    time = lambda e: tidy(first(e, lx.TIME_PATTERNS))
    act = let1(no_nav(g("活动内容")), join([let1(sql_filled(g("适用人群"), "aa"), scope("sv"), "sv"), sql_filled(g("活动时间"), time("aa")), f"substr({sql_activity('aa')}, 1, 50)"], 120), "aa")
    chg = let1(no_nav(g("变更内容")), join([sql_filled(g("消息时间"), time("aa")), g("影响范围"), sql_filled(f"substr({sql_change('aa')}, 1, 60)", f"substr({raw_title}, 1, 40)")], 140), "aa")
    raw_notice = sql_filled(f"coalesce({mc}['消息内容'], '')", f"coalesce({m}['消息内容'], '')")
    s = f"CASE {cat} WHEN '新卡' THEN {card} WHEN '活动' THEN {act} WHEN '权益变更' THEN {chg} WHEN '公告' THEN substr({raw_notice}, 1, 200) ELSE substr({sql_filled(raw_text, raw_title)}, 1, 200) END"
    tail = sql_strip("regexp_replace(hs, '珍藏周边礼等你领.*$', '')")
    return let1(s, sql_strip(f"regexp_replace({tail}, '【[^】]+】$', '')"), "hs")


STRUCT = lambda: fd.build_structured("category", "title", "body", "body", "author", "url")


def q_titles(spark, sf):
    d = with_category(spark, sf).withColumn("m", STRUCT())
    t = F.when(F.col("source") == "src6", "").otherwise(F.col("title"))
    return d.select("doc_id", fd.generate_title("bank", "category", "m", t).alias("made"), fd.display_title("bank", "category", "m", t).alias("x")).select(
        "doc_id", "made", "x.title", "x.title_source")


def sql_display(cat, bank, m, raw, cut="欢迎您"):
    """(title, title_source) expressions of display_title; raw is a column name."""
    acts = f"CASE {cat} " + " ".join(f"WHEN {q(k)} THEN {sql_any(raw, w)}" for k, w in lx.ACTION_WORDS_BY_CATEGORY.items()) + " ELSE true END"
    made = f"CASE WHEN {raw} IN ('无标题', '图片', '') THEN {sql_title_made(bank, cat, m, q(''))} WHEN NOT ({acts}) THEN {sql_title_made(bank, cat, m, raw)} END"
    return made


SQL_TITLES = f""", ms AS (SELECT *, CASE WHEN source = 'src6' THEN '' ELSE {sql_strip('title')} END AS rt, {sql_structured()} AS m FROM cats),
 mk AS (SELECT *, {sql_title_made('bank', 'category', 'm', 'rt')} AS made, {sql_display('category', 'bank', 'm', 'rt')} AS redo FROM ms)
 SELECT doc_id, CASE WHEN source = 'src6' OR rt = title THEN made ELSE {sql_title_made('bank', 'category', 'm', 'title')} END AS made,
  CASE WHEN category = '公告' THEN {sql_filled('rt', "bank || '公告'")} ELSE coalesce(redo, rt) END AS title,
  CASE WHEN category <> '公告' AND redo IS NOT NULL AND (rt IN ('无标题', '图片', '') OR redo <> rt) THEN 'generated' ELSE 'raw' END AS title_source FROM mk"""


def q_summary(spark, sf):
    d = with_category(spark, sf).withColumn("m", STRUCT()).withColumn("kb", fd.extract_benefits("body", "m")).withColumn("fee", fd.extract_fee_note("title", "body", "m"))
    return d.select("doc_id", fd.highlight_summary("category", "m", "m", "title", "body", "bank").alias("plain"),
                    fd.highlight_summary("category", "m", "m", "title", "body", "bank", "kb", "fee").alias("rich"))


def sql_benefits(text, given):
    b = f"list_transform(regexp_extract_all({text}, '[•\\-*]\\s*(.{{5,60}}?)(?:\\n|$)', 1)[1:5], lambda y: {sql_strip('y')})"
    s = f"list_filter(list_transform(regexp_split_to_array(regexp_extract({text}, '(?s)(?:亮点|核心权益|优势)[：:]\\s*(.+?)(?:\\n\\n|$)', 1), '[。；\\n]'), lambda y: {sql_strip('y')}), lambda y: length(y) BETWEEN 5 AND 60)[1:5]"
    return let1(b, f"CASE WHEN len(bb) > 0 THEN bb ELSE {let1(s, f'CASE WHEN len(ss) > 0 THEN ss WHEN {given} <> {q(chr(32))[:1]}{q(chr(32))[:1]} THEN [substr({given}, 1, 60)] ELSE CAST([] AS VARCHAR[]) END', 'ss')} END", "bb")


def sql_enrich(plain, kb, fee):
    short = f"array_to_string({kb}[1:2], '、')"
    return (f"CASE WHEN len({kb}) > 0 AND {plain} = '' THEN array_to_string({kb}[1:3], '、') WHEN len({kb}) > 0 THEN CASE WHEN contains({plain}, {short}) THEN {plain} ELSE {plain} || '（' || {short} || '）' END "
            f"WHEN {fee} <> '' AND {plain} <> '' AND NOT contains({plain}, {fee}) THEN {plain} || '（' || {fee} || '）' ELSE {plain} END")


SQL_SUMMARY = f""", ms AS (SELECT *, {sql_structured()} AS m FROM cats),
 kb AS (SELECT *, {sql_benefits('body', "coalesce(m['卡亮点'], '')")} AS k, {sql_fee_note('title', 'body', "coalesce(m['详情'], '')")} AS fee, {sql_summary('category', 'm', 'm', 'title', 'body')} AS plain FROM ms)
 SELECT doc_id, plain, {sql_enrich('plain', 'k', 'fee')} AS rich FROM kb"""


def q_time_nodes(spark, sf):
    d = notices(spark, sf).select(F.col("doc_id").alias("ord"), "title", F.col("body").alias("notes"), F.lit("").alias("recommendation"),
                                  (F.col("lang") == "en").alias("is_highlight"))
    return fd.extract_time_nodes(d).select("node", "ord")


SQL_NODES = """SELECT node, ord FROM (SELECT node, min({'o': doc_id, 'i': i}) AS mn, min(doc_id) AS ord FROM (SELECT doc_id, unnest(ds) || ' — ' || title AS node, generate_subscripts(ds, 1) AS i
 FROM (SELECT doc_id, title, regexp_extract_all(body || ' ', '\\d{1,2}[.月]\\d{1,2}[日号]?') AS ds FROM notices WHERE lang = 'en')) GROUP BY node) ORDER BY mn LIMIT 5"""

NAMED_SQL = (r"regexp_extract_all(body, '(?:Visa|MasterCard|银联|JCB|美国运通)[^\s\x0b，。]{0,6}(?:卡|版)')", r"regexp_extract_all(body, '[^\s\x0b，。]{4,10}(?:卡|版)')",
             "list_filter(CASE WHEN len(t1) > 0 THEN t1 ELSE t2 END, lambda k: k NOT IN ('扫码申卡', '主题信用卡', '信用卡', '银行卡', '借记卡') AND NOT contains(k, '扫码') AND NOT contains(k, '主题'))",
             r"list_filter(regexp_extract_all(body, '[^\s\x0b，。]{2,6}(?:活动|优惠|返现|赠)'), lambda a: length(rtrim(a, '活动优惠返现赠')) >= 2)",
             "array_to_string(list_sort(list_distinct(list_concat(t3, t4))), ',')")


def q_annual(spark, sf):
    return notices(spark, sf).select("doc_id", fd.annual_benefit(F.concat(F.lit("月上限"), F.replace("body", F.lit("调整"), F.lit("年返"))), "title", F.array("source")).alias("out"))


SQL_ANNUAL = ("'月上限' || replace(body, '调整', '年返') || ' ' || title || ' ' || source", "regexp_extract(t1, '月[上限]*[^\\d]*(\\d+)(?:元|返利金|返现)', 1)", "regexp_extract(t1, '年[返省赚]*[^\\d]*(\\d+)元', 1)",
              "CASE WHEN t2 <> '' THEN '年约' || CAST(CAST(t2 AS HUGEINT) * 12 AS VARCHAR) || '元收益' WHEN t3 <> '' THEN '年' || t3 || '元' WHEN contains(t1, '免年费') OR contains(t1, '0年费') THEN '免年费' ELSE '' END")

ENTRIES = {
    "doc_meta_values": column_query(lambda: F.concat_ws("|", fd.doc_meta_values("body", "类别"), fd.doc_meta_values("body", "适用人群")),
                                    " || '|' || ".join(sql_strip(f"regexp_extract(body, {q('(?i)' + chr(92) + '*{0,2}' + k + chr(92) + '*{0,2}' + chr(92) + 's*[:：]' + chr(92) + 's*' + chr(92) + '*{0,2}([^' + chr(92) + 'n]+)')}, 1)") for k in ("类别", "适用人群"))),
    "extract_comment": column_query(lambda: fd.extract_comment("body"), (r"regexp_extract(body, '(?ms)^###?\s*点评\s*\n(.*)', 1)", sql_strip(r"regexp_extract(t1, '(?ms)\A(.*?)(?:^#{1,4}\s|\z)', 1)"))),
    "extract_kv_fields": ((lambda s, d: notices(s, d).select("doc_id", F.explode(fd.extract_kv_fields(F.replace("body", F.lit("，"), F.lit("\n")))).alias("key", "value"))), sql_over_notices("", SQL_KV)),
    "rename_fields": ((lambda s, d: notices(s, d).select("doc_id", F.explode(fd.rename_fields(RENAME())).alias("key", "value"))),
                      sql_over_notices(f"SELECT doc_id, x.k AS key, x.v AS value FROM (SELECT doc_id, unnest([{{'k': '卡亮点', 'v': title}}, {{'k': '时间', 'v': {sql_filled('publish_time', 'source')}}}, {{'k': '其他' || lang, 'v': lang}}]) AS x FROM notices)")),
    "promote_url": column_query(lambda: fd.promote_url(F.when(F.col("lang") == "en", "").otherwise(F.col("url")), F.create_map(F.lit("来源"), F.col("author"), F.lit("原文链接"), F.when(F.col("source") == "src2", F.col("url")).otherwise(""))),
                                "CASE WHEN lang <> 'en' OR source = 'src2' THEN url ELSE author END"),
    "build_structured": cat_query(lambda: flat(STRUCT()), (sql_structured(), sql_flat("t1"))),
    "build_structured_notice": cat_query(lambda: F.concat_ws("\n#\n", flat(fd.build_structured_notice("category", "title", ranged(), "publish_time", "bank")), flat(fd.build_structured_notice("category", "title", ranged(), "publish_time", "bank", True))),
                                         (f"list_transform([{RANGED}], lambda nb: {notice_sql(False)})[1]", f"list_transform([{RANGED}], lambda nb: {notice_sql(True)})[1]", sql_flat("t1") + " || chr(10) || '#' || chr(10) || " + sql_flat("t2"))),
    "build_structured_article": cat_query(lambda: flat(fd.build_structured_article("category", "title", "body")),
        ("substr(body, 1, 300)", "regexp_extract(body, '(\\d{4}[-.]\\d{1,2}[-.]\\d{1,2})', 1)",
         "CASE category WHEN '活动' THEN MAP {'活动内容': t1, '活动时间': t2, '适用人群': ''} WHEN '新卡' THEN MAP {'卡种': title, '卡亮点': '', '适用人群': '', '来源': '', '详情': t1} WHEN '权益变更' THEN MAP {'消息时间': '', '影响范围': '', '变更内容': t1, '变更分析': ''} "
         f"WHEN '公告' THEN MAP {{'消息内容': t1, '点评': ''}} ELSE MAP {{'详细内容': {sql_filled('t1', 'title')}}} END", sql_flat("t3"))),
    "build_structured_from_ocr": ((lambda s, d: with_category(s, d).select("doc_id", flat(fd.build_structured_from_ocr("category", "title", F.replace("body", F.lit("，"), F.lit("\n")))).alias("out"))),
                                  sql_over_notices(f"SELECT doc_id, {sql_flat('m')} AS out FROM {sql_ocr()}", WITH_CATEGORY)),
    "parse_date_multi": (q_parse_date, SQL_PARSE_DATE),
    "extract_date": column_query(lambda: F.concat_ws("|", fd.extract_date(F.concat("publish_time", F.lit(" "), F.col("body"))), fd.extract_date("body", last=True), fd.extract_date(URLS(), last=True)),
                                 (DAYTEXT, "body", URLS_SQL, f"{sql_date('t1', False)} || '|' || {sql_date('t2', True)} || '|' || {sql_date('t3', True)}")),
    "extract_date_loose": column_query(lambda: fd.extract_date_loose("body", "url"), sql_filled("regexp_extract(body, '20\\d{2}[.年/-]\\s*\\d{1,2}[.月/-]\\s*\\d{1,2}')", "right(url, 8)")),
    "extract_time_range": column_query(lambda: fd.extract_time_range("body"), tidy(first("body", lx.TIME_PATTERNS))),
    "extract_activity_window": column_query(lambda: fd.extract_activity_window(ranged()), (f"substr({RANGED}, 1, 500)", "CASE WHEN contains(t1, '2024年3月5日至2024年4月1日') THEN '2024年3月5日 ~ 2024年4月1日' ELSE '' END")),
    "extract_scope": column_query(lambda: fd.extract_scope("body"), tidy(first("body", lx.SCOPE_PATTERNS))),
    "extract_change": column_query(lambda: fd.extract_change("body"), sql_change("body")),
    "extract_activity_core": column_query(lambda: fd.extract_activity_core(F.replace("body", F.lit("满100元"), F.lit("消费"))), sql_activity("replace(body, '满100元', '消费')")),
    "extract_fee": column_query(lambda: fd.extract_fee("body"), tidy(first("body", lx.FEE_PATTERNS))),
    "first_sentence": column_query(lambda: fd.first_sentence(F.concat(F.lit("活动时间：2024年3月5日"), "body")), sql_first_sentence("'活动时间：2024年3月5日' || body")),
    "extract_activity_name": column_query(lambda: fd.extract_activity_name(F.concat(F.lit("一、活动时间："), "body")), sql_activity_name("'一、活动时间：' || body")),
    "generate_title": (q_titles, sql_over_notices("", WITH_CATEGORY + SQL_TITLES)),
    "highlight_summary": (q_summary, sql_over_notices("", WITH_CATEGORY + SQL_SUMMARY)),
    "extract_audience": cat_query(lambda: fd.extract_audience("title", AUD_TEXT(), F.create_map(F.lit("适用人群"), F.when(F.col("lang") == "es", F.col("source")).otherwise("持卡人")), "category", "bank"),
                                  sql_audience("title", "replace(body, '；', '适合')", "CASE lang WHEN 'es' THEN source ELSE '持卡人' END")),
    "extract_benefits": (q_benefits, column_query(lambda: F.lit(1), BENEFITS_SQL)[1]),
    "extract_fee_note": column_query(lambda: fd.extract_fee_note("title", F.col("body"), F.create_map(F.lit("详情"), F.col("body"))), sql_fee_note("title", "body", "body")),
    "annual_benefit": (q_annual, column_query(lambda: F.lit(1), SQL_ANNUAL)[1]),
    "extract_time_nodes": (q_time_nodes, sql_over_notices(SQL_NODES)),
    "parse_model_json": (q_model_json, "SELECT event_id AS doc_id, CASE WHEN user_id % 4 < 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS out FROM events"),
    "review_payload": cat_query(pay, "to_json({'title': title, 'category': category, 'bank': bank, 'summary': substr(body, 1, 150), 'confidence': n_chars, 'flags': ['a', lang]})::VARCHAR"),
    "url_param": ((lambda s, d: table(s, d, "pages").select("page_id", F.concat(fd.url_param("url", "page"), F.lit("|"), fd.url_param("url", "ref")).alias("out"))),
                  "SELECT page_id, regexp_extract(url, 'page=([A-Za-z0-9=]+)', 1) || '|' || regexp_extract(url, 'ref=([A-Za-z0-9=]+)', 1) AS out FROM pages"),
    "week_label": ((lambda s, d: table(s, d, "events").select("event_id", fd.week_label("ts").alias("out"))),
                   "SELECT event_id, year(ts) || '年' || month(ts) || '月第' || CAST((day(ts) + isodow(date_trunc('month', ts)) - 1) // 7 + 1 AS VARCHAR) || '周' AS out FROM events"),
    "numbered_prefix": ((lambda s, d: notices(s, d).select("doc_id", F.posexplode(lines("body")).alias("pos", "l")).select("doc_id", F.col("pos").cast("bigint").alias("pos"), fd.numbered_prefix("l").alias("out"))),
                        sql_over_notices(f"SELECT doc_id, pos, regexp_matches(l, {q(lx.NUMBERED_PREFIX)}) AS out FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) - 1 AS pos FROM (SELECT doc_id, {sql_lines('body')} AS ls FROM notices))")),
    "named_terms": column_query(lambda: F.array_join(F.array_sort(fd.named_terms("body")), ","), NAMED_SQL),
}
