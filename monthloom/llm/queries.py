"""The registered query of each operator: thin, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.llm import bpe, divergence, exact_dedup, html_text, langid, lexical, near_dedup, packing, pii, quality, repeated_bytes, sharding, topk
from monthloom.llm.common import crc_remainder, read


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.dedup(read(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    voters = quality.train(docs, read(spark, folder, "labels"), crc_remainder("doc_id", 5) != 0)
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return quality.score(docs, voters).select("doc_id", held_out, "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(read(spark, folder, "documents"))


def op5_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = langid.train(docs, crc_remainder("doc_id", 4) != 2)
    held_out = F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_bytes.remove(read(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.decode(bpe.encode(read(spark, folder, "documents"), path), path)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.groups(read(spark, folder, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Under the law ``bytes``: slots are moved by their bytes, so sizes are near equal."""
    placed = sharding.shard_documents(read(spark, folder, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "virtual_slot")


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


QUERIES = {
    "op1_html": op1_html,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_langid": op5_langid,
    "op6_packing": op6_packing,
    "op7_repeats": op7_repeats,
    "op8_bpe": op8_bpe,
    "op9_topk": op9_topk,
    "op10_minhash": op10_minhash,
    "op11_sharding": op11_sharding,
    "op12_divergence": op12_divergence,
    "op13_lexical": op13_lexical,
}
