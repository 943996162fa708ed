"""The encoder beside other work: a text reaches a task once, smaller caches give the same ids."""

import public_tokenizers
from pyspark.sql import functions as F

from broadsheet.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_text_is_sent_once_and_small_caches_change_nothing(spark):
    docs = spark.createDataFrame([(1, "Some words, some more words; déjà vu."), (2, None), (3, ""), (4, "words <unk> again " * 40)], "doc_id long, text string")
    plan = bpe.encode_documents(docs, PATH)._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce" not in plan.lower()
    usual = {r.doc_id: (r.text, r.ids, r.n_tokens, r.decoded) for r in bpe.encode_documents(docs, PATH).collect()}
    tight = {r.doc_id: (r.text, r.ids, r.n_tokens, r.decoded) for r in bpe.encode_documents(docs, PATH, room=0.0001).collect()}
    assert tight == usual and usual[2] == (None, [], 0, "") and usual[3] == ("", [], 0, "")
    other = bpe.encode_documents(docs.withColumn("decoded", F.col("text")), PATH, text="decoded").collect()
    assert {r.doc_id: r.ids for r in other} == {k: v[1] for k, v in usual.items()}


def test_room_bounds_the_caches():
    with open(PATH, encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read(), 0.4)
    assert (encoder.known.size, encoder.pieces.size, encoder.most_pairs) == (100_000, 48_000, 120_000)
