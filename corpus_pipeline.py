"""A pipeline over documents: language, quality, repeated lines, near duplicates, packing.

Every stage is one operator of ``crystalflow.llm`` on all that the stage before
it kept. ``run`` writes each stage's rows as Parquet to the shared folder and
gives the next stage what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from crystalflow.llm import jaccard, language, line_dedup, packing, rules
from crystalflow.operators.scratch import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _carried(docs: DataFrame) -> DataFrame:
    """The rows with all their columns as ``row``, to go through an operator as its id.

    A row is judged by its own text and needs no join: null ids and rows that
    repeat an id are rows as any other.
    """
    return docs.select(F.struct(*COLUMNS).alias("row"), "text")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the learned languages, one or a mixture, explain better than a uniform background does.

    Texts that are null or without letters go. The model learns from the
    documents' own non-null ``lang``.
    """
    found = language.identify(_carried(docs), language.fit(docs), "row")
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("evidence") > 0)).select("row.*")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the base counts and the likelihood ratio; the trusted ones come from ``labels``."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return rules.judge(_carried(docs), rules.fit(docs, labels), "row").where("kept").select("row.*")


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later occurrences of three-line windows out of the texts; ``n_chars`` follows.

    A document of which no word is left goes: other documents hold all its
    lines. Those that were empty before stay.
    """
    cleaned = line_dedup.dedup_lines(docs)
    cleaned = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, keep the document with the lowest id; texts without words all stay.

    Rows without an id go here, as nothing could name them; rows that repeat a kept id stay.
    """
    found = jaccard.near_duplicates(docs, count_links=False).where("doc_id = component_id")
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as power-of-two pieces with their sequences.

    ``ids`` holds a piece's tokens as little-endian unsigned 32-bit values.
    """
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("line_dedup", remove_repeated_lines),
    ("jaccard_join", keep_one_of_each),
    ("packing", pack_sequences),
]

# trigram likelihoods, hashed n-grams and token ids are not SQL; tests hold the stages against plain loops
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
