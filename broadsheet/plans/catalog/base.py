"""Shared inputs of the catalogue: the document table rendered as bulletins, in Spark and in SQL.

The test documents are invented Latin-script prose, while the default dictionaries are Chinese. A chain of literal
replacements turns frequent words into bulletin phrases, so that the default rules meet real work on every row.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from ... import lexicon as lx
from ...sources import scratch

# word of the test prose -> bulletin phrase (literal, in this order)
PHRASES = [
    (". ", "。"), (", ", "，"), ("! ", "！"), (" | ", "："),
    ("\nThe ", "\n一、"), ("\nAnd ", "\n2. "), ("\nOf ", "\n## "), ("\nIn ", "\n# "), ("\nTo ", "\n### 点评\n"), ("\nA ", "\n- 卡种："),
    ("\nIs ", "\n活动时间："), ("\nIt ", "\n\n"), ("\nOn ", "\n### 3. "), ("\nThat ", "\n**类别**：活动 "),
    ("\nWas ", "\n**来源**：https://a.example.com/p/"), ("\nFor ", "\n核心信用卡资讯\n"), ("\nBy ", "\n首页\n"), ("\nDe ", "\n二、"),
    ("\nLa ", "\n（1）"), ("\nDer ", "\n卡种："), ("\nLe ", "\n权益："),
    (" with ", "招行"), (" from ", "建设银行"), (" this ", "农业银行信用卡"), (" von ", "中信"), (" que ", "平安银行"), (" et ", "浦发"),
    (" por ", "工行"), (" are ", "调整"), (" by ", "返现"), (" for ", "优惠"), (" was ", "积分"), (" as ", "活动时间："), (" at ", "年费"),
    (" an ", "新卡"), (" it ", "公告"), (" on ", "满100元减20元"), (" be ", "2024年3月5日"), (" is ", "信用卡持卡人"), (" th ", "贵宾厅"),
    (" re ", "缩水"), (" ed ", "取消"), (" er ", "升级"), (" ha ", "免年费"), (" nd ", "限量"), (" ou ", "适用人群："), (" st ", "白金卡"),
    (" ing ", "权益"), (" ti ", "名额有限"), (" he ", "由原价调整为半价"), (" es ", "2024-5-6"), (" or ", "系统维护"), (" tion ", "客服热线："),
    (" ea ", " https://b.example.com/x?__biz=Mz "), (" der ", "卡种："), (" die ", "活动"), (" und ", "系统升级"), (" den ", "通知"),
    (" zu ", "首年免"), (" la ", "活动内容："), (" en ", "里程"), (" un ", "立减"), (" les ", "返现"), (" des ", "取消"), (" du ", "积分"),
    (" el ", "首发"), (" los ", "权益亮点："), (" y ", "下调"), (" del ", "升级"), (" se ", "由一倍调整为两倍"), (" of ", "，"), (" to ", "\u3000"),
    (" and ", "；"),
]


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def render(x):
    """The phrases replaced one after the other, from Arrow batches: a chain of Spark expressions is slower on long texts."""
    phrases = PHRASES

    @F.arrow_udf("string")
    def bulletins(texts: pa.Array) -> pa.Array:
        def one(t):
            for word, phrase in phrases:
                t = t.replace(word, phrase)
            return t
        return pa.array((None if t is None else one(t) for t in texts.to_pylist()), pa.string())
    return bulletins(x)


def notices(spark, sf):
    """doc_id, source, lang, title, headline, body, url, author, publish_time, raw_category, images, n_chars (of the raw text).

    headline is the whole first sentence, title the first 40 characters of it.

    Rendered once per application into a written table, so that every query starts from a pruned columnar scan.
    """
    return scratch.stage_once(spark, f"notices|{sf}", lambda: rendered(spark, sf))


def rendered(spark, sf, only=None):
    """The rows of notices, not written: for queries that take few columns, or few rows (only: a table of their doc_id)."""
    d = table(spark, sf, "documents")
    d = scratch.spread(spark, d) if only is None else d.join(only.select("doc_id"), "doc_id", "left_semi")
    d = d.select("doc_id", "source", "lang", "n_chars", "text", render(F.col("text")).alias("body"))
    first = F.split(F.split("body", "\n")[0], "。")[0]
    n = F.col("n_chars")
    p2 = lambda x: F.lpad(x.cast("string"), 2, "0")
    digest = F.md5("text")
    return d.select(
        "doc_id", "source", "lang", "n_chars", F.substring(first, 1, 40).alias("title"), first.alias("headline"), "body",
        F.concat(F.lit("https://"), "source", F.lit(".example.com/n/"), F.substring(digest, 1, 8)).alias("url"),
        F.when(F.col("source") == "src1", "招商银行信用卡").when(F.col("source") == "src2", "工银信用卡")
         .when(F.col("source") == "src3", "平安信用卡小助手").when(F.col("source") == "src4", "未知公众号").otherwise("").alias("author"),
        F.when(n % 5 == 0, "").otherwise(F.concat(F.lit("2024."), p2(n % 12 + 1), F.lit("."), p2(n % 28 + 1))).alias("publish_time"),
        F.when(n % 4 == 0, "新卡发布").when(n % 4 == 1, "优惠活动").when(n % 4 == 2, "权益调整").otherwise("").alias("raw_category"),
        F.transform(F.when(n % 4 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), (n % 4).cast("int"))),
                    lambda i: F.concat(F.lit("images/"), F.substring(digest, 1, 6), F.lit("_"), i.cast("string"), F.lit(".png"))).alias("images"))


# ---- SQL side -----------------------------------------------------------------

def q(s):
    return "'" + s.replace("'", "''") + "'"


def sql_list(words):
    return "[" + ", ".join(q(w) for w in words) + "]" if words else "CAST([] AS VARCHAR[])"


def sql_map(d):
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in d.items()) + "}"


WS = r"[\s\x0b\x85\p{Z}]"


def sql_strip(e):
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def sql_any(e, words):
    return f"list_has_any(list_transform({sql_list(words)}, lambda k: contains({e}, k)), [true])"


def sql_hits(e, words):
    return f"list_filter({sql_list(words)}, lambda k: contains({e}, k))"


def sql_count(e, words):
    return f"len(list_filter({sql_list(words)}, lambda k: contains({e}, k)))"


def sql_lines(e):
    return f"list_filter(list_transform(string_split({e}, chr(10)), lambda l: {sql_strip('l')}), lambda l: l <> '')"


def sql_filled(*es):
    return "coalesce(" + ", ".join(f"nullif({e}, '')" for e in es) + ", '')"


def _sql_render(e):
    for a, b in PHRASES:
        e = f"replace({e}, {q(a)}, {q(b)})"
    return e


SQL_NOTICES = f"""notices AS (
 SELECT doc_id, source, lang, n_chars, substr(string_split(string_split(body, chr(10))[1], '。')[1], 1, 40) AS title, string_split(string_split(body, chr(10))[1], '。')[1] AS headline, body,
  'https://' || source || '.example.com/n/' || substr(md5(text), 1, 8) AS url,
  CASE source WHEN 'src1' THEN '招商银行信用卡' WHEN 'src2' THEN '工银信用卡' WHEN 'src3' THEN '平安信用卡小助手' WHEN 'src4' THEN '未知公众号' ELSE '' END AS author,
  CASE WHEN n_chars % 5 = 0 THEN '' ELSE '2024.' || lpad(CAST(n_chars % 12 + 1 AS VARCHAR), 2, '0') || '.' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0') END AS publish_time,
  CASE n_chars % 4 WHEN 0 THEN '新卡发布' WHEN 1 THEN '优惠活动' WHEN 2 THEN '权益调整' ELSE '' END AS raw_category,
  list_transform(range(1, n_chars % 4 + 1), lambda i: 'images/' || substr(md5(text), 1, 6) || '_' || i || '.png') AS images
 FROM (SELECT *, {_sql_render('text')} AS body FROM documents))"""


def sql_over_notices(select, more=""):
    return f"WITH {SQL_NOTICES}{more} {select}"


ENTRIES = {}


def column_query(expr, sql, src=notices, sql_src=SQL_NOTICES, view="notices", extra=""):
    """(doc_id, out) over the bulletin rows: a Column function and its SQL expression.

    `sql` may be a tuple of staged expressions; stage i is visible to later ones as t1, t2, ...
    """
    stages = (sql,) if isinstance(sql, str) else sql
    inner = view
    for i, e in enumerate(stages, 1):
        inner = f"(SELECT *, {e} AS t{i} FROM {inner})"
    text = f"WITH {sql_src}{extra} SELECT doc_id, t{len(stages)} AS out FROM {inner}"
    return (lambda spark, sf: src(spark, sf).select("doc_id", expr().alias("out"))), text
