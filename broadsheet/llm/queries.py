"""One query per operator over its whole table, and SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from . import alignment, ann_forest, bpe, centroids, chat, licenses, minhash, mixing, pii, quality_rules, sharding, sql, syncmers, token_counts

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    found, name = pii.find(table(spark, sf_dir, "documents"), carry=["doc_id"])
    base, spans = F.col(name)["base"], F.col(name)["spans"]
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(spans).alias("spans"))


def op2_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path(BYTE_BPE)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged, (q, failed, kept) = quality_rules.judge(docs, carry=["doc_id"])
    numbers = [F.col(q)[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *numbers, F.col(failed).alias("base_failed"), F.col(kept).alias("kept"))


def op4_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, public_tokenizers.path(WORD_BPE))
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", "n_tokens", F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_sharding(spark, sf_dir):
    found, (slot, shard) = sharding.placed(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return found.select("doc_id", "source", F.col(slot).alias("slot"), F.col(shard).alias("shard"))


def op6_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_ann_forest(spark, sf_dir):
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op8_chat(spark, sf_dir):
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op9_mixing(spark, sf_dir):
    found, name = mixing.drawn(table(spark, sf_dir, "documents"), carry=["doc_id"])
    mix = F.col(name)
    taken = (mix["size"] * F.size(mix["draws"])).cast("long")
    return found.select("doc_id", mix["size"].alias("size"), mix["source_size"].alias("source_size"), mix["target"].alias("target"), taken.alias("taken"))


#: The documents have no paths: source and language stand for directories, and a document that begins or ends with a
#: licence statement for a licence file of its directory.
STATED = r"(licensed under|released under|this work is licensed)[^\n]*"


def path_of_document():
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    stated = F.col("text").rlike(rf"(?i)\A{STATED}|\n{STATED}\z")
    return F.concat_ws("/", "source", "lang", F.when(stated, F.concat(F.lit("LICENSE."), number)).otherwise(F.concat(number, F.lit(".txt"))))


def op10_licenses(spark, sf_dir):
    files = table(spark, sf_dir, "documents").withColumn("path", path_of_document())
    found, name = licenses.scan(files, carry=["doc_id", "path"])
    return found.select("doc_id", "path", *[F.col(name)[c].alias(c) for c in ("licence", "score", "how", "from_dir")])


def op11_syncmers(spark, sf_dir):
    return syncmers.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_centroids(spark, sf_dir):
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.compare(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES = {f.__name__: f for f in (op1_pii, op2_token_counts, op3_quality_rules, op4_bpe, op5_sharding, op6_minhash, op7_ann_forest, op8_chat, op9_mixing, op10_licenses, op11_syncmers, op12_centroids, op13_alignment)}

#: Counts of tokens, token ids and their alignment, learned patterns and a forest search cannot be put in SQL.
SQL = {"op3_quality_rules": sql.OP3, "op5_sharding": sql.OP5, "op6_minhash": sql.OP6, "op8_chat": sql.OP8, "op9_mixing": sql.OP9, "op10_licenses": sql.op10(STATED),
       "op11_syncmers": sql.OP11, "op12_centroids": sql.OP12}
