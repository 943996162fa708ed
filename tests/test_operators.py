"""Table operators: small fixtures, brute force, partition invariance."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import dedup as dd
from broadsheet.operators import retrieval as rt
from broadsheet.operators import rollups as ru
from broadsheet.operators import segment as sg
from broadsheet.operators import similarity as sm
from broadsheet.plans import items as it
from broadsheet.sources import html as hx
from broadsheet.sources import readers as rd

TITLES = ["招商银行白金卡年费调整公告", "招商银行白金卡年费调整公告", "招商银行白金卡年费调整的公告", "农行满减活动", "农行满减活动五月", "", "", "单"]


def jac(a, b):
    x, y = ({t[i:i + 2] for i in range(len(t) - 1) if t[i] != " "} for t in (a, b))
    return len(x & y) / len(x | y) if x and y else 0.0


@pytest.mark.parametrize("th", [0.3, 0.6, 0.85])
def test_pairs_match_brute_force(spark, th):
    words = ["积分", "调整", "公告", "活动", "返现", "白金", "年费", "升级"]
    titles = sorted({"".join(words[(i * k + k) % 8] for k in range(1, 5)) for i in range(40)} | set(TITLES))
    df = spark.createDataFrame([(i, t, "b") for i, t in enumerate(titles)], "ord long, title string, bank string")
    got = {tuple(sorted((r.title_a, r.title_b))) for r in sm.title_similarity_pairs(df, th).collect()}
    assert got == {tuple(sorted(p)) for p in combinations(titles, 2) if jac(*p) >= th - 1e-9}


def test_near_dup_merge_keeps_longest_and_everything(spark):
    df = spark.createDataFrame([(i, t, "b", "x" * (i + 1)) for i, t in enumerate(TITLES)], "ord long, title string, bank string, raw_text string")
    for parts in (1, 7):
        m = sm.near_dup_merge(spark, df.repartition(parts), 0.7).collect()
        # empty and one-character titles have no bigrams and stay alone
        assert sorted((r.ord, r.members) for r in m) == [(2, 3), (4, 2), (5, 1), (6, 1), (7, 1)]
        assert sum(r.members for r in m) == len(TITLES)


def test_hot_key_dedup(spark):
    df = spark.range(3000).select(F.col("id").alias("ord"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"), F.lit("t").alias("title"))
    out = dd.dedup_url_first(df.repartition(5))
    assert out.count() == 2001 and out.filter("url = 'hot'").first()["ord"] == 0
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_merge_by_title_key(spark):
    df = spark.createDataFrame([(0, "一、同题", "a", "u1", ""), (1, "2. 同题", "b", "u2", "好"), (2, "别题", "c", "u3", "")], "ord long, title string, file string, url string, comment string")
    r = {x.key: x for x in dd.merge_by_title_key(df).collect()}
    assert r["同题"].duplicate_count == 2 and r["同题"].comment == "好" and r["同题"].file == "a"


def test_match_original_steps(spark):
    o = spark.createDataFrame([(0, "招行白金卡权益", "招行"), (1, "农行满减活动细则说明", "农行"), (2, "工行返现", "工行")], "ord long, title string, bank string")
    q = spark.createDataFrame([("a", "招行白金卡权益", "招行"), ("b", "招行白金卡权益", "别"), ("c", "招行白金卡权益x", ""), ("d", "细则", "农行"), ("e", "无", "无")], "qid string, title string, bank string")
    assert sorted(tuple(r) for r in sm.match_original(q, o).collect()) == [("a", 1, 0), ("b", 2, 0), ("c", 3, 0), ("d", 4, 1)]


def blocks(spark, texts, heads=()):
    return spark.createDataFrame([("a", i, "article_text", t, i in heads) for i, t in enumerate(texts)], "article_id string, pos int, type string, text string, is_heading_like boolean")


def test_segmentation(spark):
    art = spark.createDataFrame([("a", "总题")], "article_id string, raw_title string")
    three = ["序", "一、新卡首发", "x", "y", "z", "二、返现优惠活动", "x", "y", "z", "三、公告", "x", "y"]
    t = sg.segment_topics(blocks(spark, three), art).orderBy("start_block").collect()
    assert [(r.topic_id, r.start_block, r.end_block, r.headline) for r in t] == [("a_t1", 1, 4, "一、新卡首发"), ("a_t2", 5, 8, "二、返现优惠活动"), ("a_t3", 9, 11, "三、公告")]
    single = sg.segment_topics(blocks(spark, ["只有一段", "没有标题"]), art).collect()
    assert len(single) == 1 and single[0].split_confidence == 1.0 and single[0].signals == ["single_topic_fallback:no_topic_starts"]
    s = sg.multi_topic_signals(blocks(spark, three)).first()
    assert s.is_candidate and "multiple_numbered_headings" in s.signals


def test_split_raw_text(spark):
    pad = "正文内容" * 30
    raw = "开头。招行新增返现活动。" + pad + "。农行调整积分规则。" + pad + "。工行下架。短"
    df = spark.createDataFrame([(1, raw), (2, "短文"), (3, "没有边界" * 80)], "doc_id int, text string")
    r = sg.split_raw_text(df).orderBy("topic_no").collect()
    # the third boundary opens a piece under 60 characters, which joins the second topic
    assert [(x.doc_id, x.topic_no, x.headline) for x in r] == [(1, 1, "招行新增返现活动"), (1, 2, "农行调整积分规则")]
    assert r[1].body.endswith("\n工行下架。短") and set(r[1].bank_hints) == {"农行", "工行"}


def test_topic_items_trace(spark):
    art = spark.createDataFrame([("a", "总题", "u", "招商银行信用卡", "2026.01.01")], "article_id string, raw_title string, url string, publisher_name string, publish_time string")
    t = sg.segment_topics(blocks(spark, ["一、新卡首发", "x", "y", "z", "二、返现活动优惠", "x", "y", "z"]), art)
    r = it.topic_items(t, art).orderBy("topic_id").collect()
    assert [(x.topic_id, x.category, x.bank) for x in r] == [("a_t1", "新卡", "招商银行"), ("a_t2", "活动", "招商银行")]


def test_bm25_against_formula(spark):
    import math
    docs = ["招行 积分", "积分 积分 活动", "无关", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    post = rt.bm25_postings(df)
    q = spark.createDataFrame([(0, "积分"), (1, "火星"), (2, "")], "qid long, text string")
    got = {(r.qid, r.doc_id): r.score for r in rt.bm25_search(post, rt.bm25_stats(df, post), q, 5).collect()}
    toks = [["招行", "行积", "积分", "招", "行", "积", "分"], ["积分", "分积", "积分", "分活", "活动", "积", "分", "积", "分", "活", "动"], ["无关", "无", "关"], []]
    avg = sum(map(len, toks)) / 4
    want = {}
    for d, ts in enumerate(toks):
        s = sum(math.log(1 + (4 - 2 + .5) / 2.5) * ts.count(t) * 2.5 / (ts.count(t) + 1.5 * (.25 + .75 * len(ts) / avg)) for t in ("积分", "积", "分") if ts.count(t))
        if s:
            want[(0, d)] = round(s, 9)
    assert got == pytest.approx(want)


def plain_topk(vectors, asked, k):
    import numpy as np
    out = []
    for qid, q in asked:
        if q is None or not np.linalg.norm(q) > 1e-8:
            continue
        near = [(-round(float(np.dot(q, v) / (np.linalg.norm(q) * np.linalg.norm(v))), 9), i) for i, v in vectors if v is not None and len(v) == len(q) and np.isfinite(v).all() and np.linalg.norm(v) > 1e-8]
        out += [(qid, i, n + 1, round(-s, 7)) for n, (s, i) in enumerate(sorted(near)[:k]) if s < 0]
    return sorted(out)


@pytest.mark.parametrize("pivots, cell", [(64, (8192, 1024)), (3, (7, 4)), (1, (1000, 1000))])
def test_vector_topk_against_every_pair(spark, monkeypatch, pivots, cell):
    import numpy as np
    monkeypatch.setattr(rt, "PIVOTS", pivots)
    monkeypatch.setattr(rt, "CELL_VECTORS", cell[0])
    monkeypatch.setattr(rt, "CELL_QUESTIONS", cell[1])
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(4, 6))
    vectors = [(k, (middles[k % 4] + rng.normal(scale=0.3, size=6)).round(2).tolist()) for k in range(120)]
    vectors += [(200, [0.0] * 6), (201, None), (202, [float("nan")] * 6), (203, [1.0, 2.0]), (204, vectors[5][1]), (205, vectors[5][1]), (206, [-x for x in vectors[5][1]])]
    asked = [(k, v) for k, v in vectors[::3]] + [(1000, [0.0] * 6), (1001, [2.0, 1.0]), (1002, [5.0] * 3), (1003, None)]
    kind = "{} long, embedding array<double>"
    got = rt.vector_topk(spark.createDataFrame(vectors, kind.format("vec_id")), spark.createDataFrame(asked, kind.format("qid")), 5).collect()
    assert sorted((r.qid, r.vec_id, r["rank"], round(r.score, 7)) for r in got) == plain_topk(vectors, asked, 5)
    assert rt.vector_topk(spark.createDataFrame([], kind.format("vec_id")), spark.createDataFrame(asked, kind.format("qid")), 5).collect() == []


def test_far_buckets_are_not_searched(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    rows = [(k, (np.eye(8)[k % 8] * 10 + rng.normal(scale=0.1, size=8)).tolist()) for k in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    pivots = {8: np.eye(8)}
    placed = rt._placed(rt._usable(df, "vec_id"), pivots)
    cones = {(r["size"], r["bucket"]): r["angle"] for r in placed.collect()}
    asks = placed.withColumnRenamed("vec_id", "qid").selectExpr("*", "0.9D AS floor")
    assert rt._reached(asks, pivots, cones).count() == 0 and rt._reached(asks.selectExpr("* EXCEPT (floor)", "0D AS floor"), pivots, cones).count() > 0


def test_bm25_prunes_without_loss(spark):
    import math
    import random
    rng = random.Random(5)
    words = [f"w{k}" for k in range(120)]
    text = lambda n: " ".join(words[min(119, int(rng.expovariate(0.05)))] for _ in range(n))
    docs = [(k, text(rng.randint(0, 60))) for k in range(300)]
    docs += [(300 + k, docs[k][1]) for k in range(20)]  # equal documents: ties by id
    asked = [(k, text(rng.choice([0, 1, 2, 8, 20]))) for k in range(40)] + [(100 + k, " ".join(docs[k][1].split()[:12])) for k in range(20)] + [(200, "w3 w5 w3"), (201, "w5 w3 w3")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    postings = rt.bm25_postings(df)
    got = rt.bm25_search(postings, rt.bm25_stats(df, postings), spark.createDataFrame(asked, "qid long, text string"), 4).collect()
    split = {k: t.split() for k, t in docs}
    avg, n = sum(map(len, split.values())) / len(split), len(split)
    df_of = {x: sum(x in ts for ts in split.values()) for x in words}
    want = []
    for qid, q in asked:
        score = {}
        for d, ts in split.items():
            s = sum(math.log(1 + (n - df_of[x] + .5) / (df_of[x] + .5)) * ts.count(x) * 2.5 / (ts.count(x) + 1.5 * (.25 + .75 * len(ts) / avg)) for x in q.split() if x in ts)
            if round(s, 9) > 0:
                score[d] = round(s, 9)
        want += [(qid, d, r + 1) for r, (d, _) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:4])]
    assert sorted((r.qid, r.doc_id, r["rank"]) for r in got) == sorted(want)


def test_fusion_keeps_lexical_ranks_without_vectors(spark):
    kind = "qid long, doc_id long, score double, rank int"
    lexical = spark.createDataFrame([(1, 10, 3.0, 1), (1, 11, 2.0, 2), (2, 10, 5.0, 1)], kind)
    vector = spark.createDataFrame([(1, 11, 0.9, 1)], kind)
    got = sorted(tuple(r) for r in rt.rrf_fuse(lexical, vector).collect())
    assert got == [(1, 10, round(0.5 / 61, 9), 2), (1, 11, round(0.5 / 62 + 0.5 / 61, 9), 1), (2, 10, 5.0, 1)]


def test_number_rows(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"))
    assert ru.number_rows(spark, df.repartition(9), "k").filter("rank != k + 1").count() == 0


def test_html_detail(spark):
    h = '<html><head><title>页面标题很长</title></head><body><nav>菜单</nav><h1>短</h1><span class="date">2026-01-02</span><div id="c"><p>首段内容。</p><div class="ad">广告</div><p>次段</p></div></body></html>'
    df = spark.createDataFrame([(1, "s", h)], "page_id int, source string, html string")
    rules = spark.createDataFrame([("s", "h1", ".date", "#c", [".ad"], [], [])], "source string, title_sel string, date_sel string, content_sel string, remove_sel array<string>, start_markers array<string>, end_markers array<string>")
    r = hx.html_detail_fields(df, rules).first()
    assert (r.title, r.date_text, r.content) == ("页面标题很长", "2026-01-02", "首段内容。\n次段")


def test_image_source(spark, tmp_path):
    import struct
    import zlib
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + bytes([0, 255] * 2) for _ in range(3))
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 3, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    r = rd.read_image_meta(spark, str(tmp_path)).first()
    assert (r.width, r.height, r.mode, r.stddev) == (4, 3, "L", 127.5)


def test_union_sources_small(spark):
    a = spark.createDataFrame([("u1", "招商银行新卡首发", "正文", "招商银行信用卡")], "url string, title string, text string, author string")
    n = spark.createDataFrame([("u2", "通知", "内容", "公告", "招行")], "url string, title string, content_text string, category string, bank string")
    w = spark.createDataFrame([("u3", "页", " "), ("u4", "优惠返现", "活动满减")], "url string, title string, content_text string")
    r = {x.url: (x.source, x.category, x.bank) for x in it.union_sources(a, n, w).collect()}
    assert r == {"u1": ("wechat", "新卡", "招商银行"), "u2": ("website", "公告", "招商银行"), "u4": ("website", "活动", "未知")}


def test_image_headers(spark):
    import struct
    seg = lambda mark, data: b"\xff" + bytes([mark]) + struct.pack(">H", len(data) + 2) + data
    frame = lambda mark, h, w, parts: seg(mark, b"\x08" + struct.pack(">HHB", h, w, parts) + b"\x01\x11\x00" * parts)
    jpeg = b"\xff\xd8" + seg(0xE0, b"JFIF\0" + b"\xff\xc0" * 20) + b"\xff" + seg(0xFE, b"\xff" * 41) + seg(0xC4, b"\0" * 30)
    webp = lambda kind, data: b"RIFF\0\0\0\0WEBP" + kind + struct.pack("<I", len(data)) + data
    rows = {
        "baseline": (jpeg + frame(0xC0, 480, 640, 3) + seg(0xDA, b"\1") + b"\xff\0" * 500, ("JPEG", "RGB", 640, 480)), "progressive": (jpeg + frame(0xC2, 65535, 1, 1), ("JPEG", "L", 1, 65535)),
        "cut": (jpeg, ("JPEG", None, None, None)), "pixels first": (b"\xff\xd8" + seg(0xDA, b"\1\2\3") + frame(0xC0, 9, 9, 3), ("JPEG", None, None, None)), "bare": (b"\xff\xd8\xff", ("JPEG", None, None, None)),
        "lossy": (webp(b"VP8 ", b"\x30\1\0\x9d\x01\x2a" + struct.pack("<HH", 800 | 0x4000, 600)), ("WEBP", "RGB", 800, 600)),
        "lossless": (webp(b"VP8L", b"\x2f" + struct.pack("<I", 799 | 599 << 14 | 1 << 28)), ("WEBP", "RGBA", 800, 600)),
        "extended": (webp(b"VP8X", b"\x10\0\0\0" + (69999).to_bytes(3, "little") + (1).to_bytes(3, "little")), ("WEBP", "RGBA", 70000, 2)),
        "png": (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">IIBB", 3, 4, 8, 6), ("PNG", "RGBA", 3, 4)), "gif": (b"GIF89a" + struct.pack("<HH", 5, 6), ("GIF", "P", 5, 6)),
        "bmp": (b"BM" + b"\0" * 16 + struct.pack("<iiHH", 7, 8, 1, 24), ("BMP", "RGB", 7, 8)), "text": (b"hello", ("", None, None, None)), "nothing": (b"", ("", None, None, None))}
    df = spark.createDataFrame([(k, bytearray(b)) for k, (b, _) in rows.items()], "name string, content binary")
    got = {r.name: (r.format, r.mode, r.width, r.height) for r in rd.image_meta(df).collect()}
    assert got == {k: want for k, (_, want) in rows.items()}
