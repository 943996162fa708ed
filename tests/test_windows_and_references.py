"""Closed and unclosed references, windows of patterns, bigrams of long texts."""

import io
import re
import time
import zipfile

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet import lexicon as lx
from broadsheet.functions import fields as fd
from broadsheet.functions import labels as lb
from broadsheet.operators import similarity as sm
from broadsheet.sources import html as hx
from broadsheet.sources import readers as rd
from broadsheet.streaming import jobs

CUT = '<title>A &amp; B &amp</title><body><h1 class="rich_media_title">A &lt; B &amp</h1><div id="js_content">x&copy &copy;&unk; &#39;y&#39 <img src="u?a=1&amp;b=2&lt=3"></div></body>'


def test_article_references_need_their_semicolon(spark):
    r = hx.html_article_fields(spark.createDataFrame([(1, CUT)], "page_id int, html string")).first()
    assert (r.title, r.text, r.images) == ("A < B &amp", "x&copy ©&unk; 'y&#39", ["u?a=1&b=2&lt=3"])


def test_page_references_need_their_semicolon(spark):
    page = "<title>Rates &amp; fees &am</title><body><script>if (a&&b) x</script><p>Opening hours &amp</p><p>&lt;b&gt; &amp;amp; more of it</p></body>"
    r = hx.html_pages_to_text(spark.createDataFrame([(1, page), (2, CUT)], "page_id int, html string")).orderBy("page_id").collect()
    assert (r[0].title, r[0].text) == ("Rates & fees &am", "Opening hours &amp\n<b> &amp; more of it")
    assert r[1].title == "A & B &amp"


def seconds(run):
    t0 = time.time()
    run()
    return time.time() - t0


SCOPES = ["", "持卡人", "持卡人持卡人", "甲持卡人", "甲乙持卡人", "所有持卡人持卡人", "无，所有白金级持卡人，别的持卡人", "a" * 50 + "持卡人持卡人", "首行\n甲持卡人\n乙丙白金卡和金卡。", "客户客户客户主卡，金卡",
          "𝒳𝒴持卡人", "x" * 28 + "金卡白金卡" + "y" * 40 + "客户", "长" * 400 + "，短信用卡", "，".join(["甲乙"] * 300) + "，新老客户与信用卡客户", None]


def test_scope_windows_find_what_the_patterns_find(spark):
    def plain(t):
        found = (re.search(p, t or "") for p in lx.SCOPE_PATTERNS)
        return next((m[1] for m in found if m), "")
    d = spark.createDataFrame(list(enumerate(SCOPES)), "i long, t string").select("i", fd.extract_scope("t").alias("o"))
    assert [r.o for r in d.orderBy("i").collect()] == [plain(t) for t in SCOPES]


def test_scope_of_long_texts_is_linear(spark):
    d = spark.range(200).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit(" words without an end, that go on and on ")), 4000).alias("t"))
    d = d.select(F.max(fd.extract_scope("t")).alias("o"))
    assert seconds(d.collect) < 12


def test_bigrams_of_long_texts_are_linear(spark):
    d = spark.range(4).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit("é b")), 40000).alias("t"))
    d = d.select(sm.set_overlap(sm.title_bigrams("t"), sm.title_bigrams(F.lit("é b"))).alias("o")).select("o.*")
    rows = []
    assert seconds(lambda: rows.extend(d.collect())) < 12
    assert {tuple(r) for r in rows} == {(1, 3, True)}


@pytest.mark.parametrize("t, want", [(None, []), ("", []), ("a", []), ("a b", ["a "]), ("  a", []), ("𝒳y𝒳y", ["𝒳y", "y𝒳"]), ("a\nb", ["a\n", "\nb"])])
def test_bigrams(spark, t, want):
    assert spark.createDataFrame([(t,)], "t string").select(sm.title_bigrams("t").alias("g")).first().g == want


TERMS = "申领Visa白金卡，尊享新卡版 买一送一优惠。Visa 卡\n超长的名字里有很多很多很多的主题卡和借记卡　满减活动赠活动\tJCB卡 无"


def test_terms_of_runs_are_terms_of_the_text(spark):
    every = lambda p: re.findall(p.replace(r"\s", " \t\n\x0b\f\r"), TERMS)
    r = spark.createDataFrame([(TERMS,), ("",), ("x" * 50,)], "t string").select(fd.term_names(F.col("t")).alias("n")).select("n.*").collect()
    fine = lambda ks: [k for k in ks if k not in lx.NOT_CARD_NAMES and not any(w in k for w in lx.NOT_IN_CARD_NAMES)]
    assert (r[0].has_brand, r[0].branded, r[0].plain) == (True, fine(every(lx.BRANDED_CARD)), fine(every(lx.PLAIN_CARD)))
    assert r[0].acts == [a for a in every(lx.NAMED_ACTIVITY) if len(a.rstrip(lx.ACTIVITY_END_CHARS)) >= 2]
    assert tuple(r[1]) == tuple(r[2]) == (False, [], [], [])


def test_terms_of_long_texts(spark):
    d = spark.range(800).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit(" words that go on without 返现 a name ")), 2000).alias("t"))
    d = d.select(F.max(F.size(fd.named_terms(F.concat("t", F.lit("新卡"))))).alias("o"))
    assert seconds(d.collect) < 12


def package(paragraphs, cells):
    p = "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in paragraphs)
    t = "<w:tbl>" + "".join(f"<w:tr><w:tc><w:r><w:t>{x}</w:t></w:r></w:tc></w:tr>" for x in cells) + "</w:tbl>"
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", p + t)
    return b.getvalue()


def test_packages_give_rows_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(rd, "OUT_ROWS", 3)
    parts = list(rd.in_parts(((i, [str(i)]) for i in range(8)), rd.arrow_schema("a int, b array<string>")))
    assert [len(p) for p in parts] == [3, 3, 2] and parts[2].to_pylist()[-1] == {"a": 7, "b": ["7"]}
    many = [f"p{i}" for i in range(2500)]
    d = spark.createDataFrame([("a", package(many, ["x", "", "y"])), ("b", package([], [])), ("c", package(["z"], []))], "path string, content binary").coalesce(1)
    p = rd.read_docx_paragraphs(d).collect()
    assert [(r.path, r.pos, r.text, r.links) for r in p] == [("a", i, t, []) for i, t in enumerate(many)] + [("c", 0, "z", [])]
    assert [(r.path, r.tbl, r.row, r.cell, r.text) for r in rd.read_docx_tables(d).collect()] == [("a", 0, 0, 0, "x"), ("a", 0, 2, 0, "y")]
    assert rd.read_docx_images(d).count() == 0
    s = rd.docx_stats(rd.read_docx_paragraphs(d), rd.read_docx_tables(d), rd.read_docx_images(d)).orderBy("path").collect()
    assert [(r.path, r.paragraphs, r.tables, r.images) for r in s] == [("a", 2500, 1, 0), ("c", 1, 0, 0)]


def test_banks_are_looked_for_as_plain_words(spark):
    d = spark.range(800).select(F.concat(F.repeat(F.lit("no bank is named in this long text "), 4000), F.col("id").cast("string"), F.lit("农业银行(x)与工行")).alias("t"))
    rows = []
    assert seconds(lambda: rows.extend(d.select(lb.extract_entities("t").alias("e")).distinct().collect())) < 12
    assert [r.e for r in rows] == [["工商银行", "农业银行"]]


class Held:
    """A map state that counts its calls."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def __getattr__(self, name):
        def call(*a):
            self.calls += 1
            return {"containsKey": lambda k: k in self.rows, "getValue": lambda k: self.rows.get(k), "updateValue": lambda k, v: self.rows.__setitem__(k, v),
                    "removeKey": lambda k: self.rows.pop(k), "iterator": lambda: iter(list(self.rows.items()))}[name](*a)
        return call


def test_history_calls_its_state_as_often_as_it_holds_rows():
    p = jobs.NewestUrls(10)
    p.seen = p.size = Held()
    p.size = type("Size", (), {"exists": lambda s: hasattr(s, "n"), "get": lambda s: s.n, "update": lambda s, v: setattr(s, "n", v)})()
    for start in (0, 3000, 5990):
        rows = [pd.DataFrame({"url_md5": [f"u{i % 5000}" for i in range(k, k + 1500)], "seq": range(k, k + 1500)}) for k in (start, start + 1500)]
        p.seen.calls = 0
        out = next(p.handleInputRows(("f", 0), iter(rows), None))
        assert p.seen.calls <= 30
        assert p.seen.rows == {(f"u{i % 5000}",): (i,) for i in range(start + 2990, start + 3000)}
        # 10 rows are held from the call before
        assert (len(out), out["seq"].min()) == {0: (3000, 0), 3000: (3000, 3000), 5990: (2990, 6000)}[start]


def test_pages_leave_a_task_in_bounded_parts(spark):
    class Pages:
        schema = spark.createDataFrame([], "page_id int, html string").schema
        mapInArrow = staticmethod(lambda run, ddl: run)
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(2500)), "html": ["<p>x</p>"] * 2500}, schema=rd.arrow_schema("page_id int, html string"))
    parts = list(hx._parsed(Pages, ["page_id"], "t string", lambda r: (r.html,))(iter([batch])))
    assert [len(p) for p in parts] == [1024, 1024, 452] and parts[2].to_pylist()[-1] == {"page_id": 2499, "t": "<p>x</p>"}
