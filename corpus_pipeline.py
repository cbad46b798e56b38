"""The corpus pipeline: documents in, packed sequences out.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` over the rows its predecessor kept; all but the
last return the columns of ``docs``.

* Language identification drops texts it can't place: null, without letters, or, unless very short,
  with less than ``MIN_KNOWN`` of their n-grams in the language that fits best.
* Exact deduplication keeps of equal texts the row with the largest ``doc_id``.
* Near deduplication keeps of each group, over shingles of ``NEAR_WORDS`` words, the document with the
  smallest ``doc_id``.
* Personal data is replaced by its kind in angle brackets; no document is dropped.
* Packing cuts what is left into sequences of at most 4096 tokens.

Empty tables pass through every stage; nulls, repeated rows and further columns are treated as the
operators say.
"""

from __future__ import annotations

import public_tokenizers
from monthloom.llm import exact_dedup, langid, near_dedup, packing, pii
from monthloom.llm.common import crc_remainder
from monthloom.sources.scratch import materialise
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_KNOWN = 0.1
NEAR_WORDS = 5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, langid.train(docs, crc_remainder("doc_id", 4) != 2), MIN_KNOWN)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, NEAR_WORDS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# Trained models, sketches and tokens are beyond SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    *front, (_, last) = STAGES
    for _, stage in front:
        docs = materialise(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
