"""A training corpus from raw documents: five stages, each written and read again.

Languages are identified and documents without a known one go; of near duplicates one document
stays; secrets are blotted out; sources are mixed to target weights; the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, jaccard_join, language, mixing, secrets
from tidemark.llm.common import drop_tables, held_out, new_table, stored, table
from tidemark.llm.queries import MIX_SEED, MIX_SHARE, VOCABULARY, WEIGHTS, mix_levels

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose letters are mostly of scripts that no learned language uses is rejected.
LEAST_SUPPORTED = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with the language found."""
    model = language.learn(docs.where(~held_out()))
    found = language.identify(docs, model, keep=COLUMNS)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("supported") >= LEAST_SUPPORTED)
    return found.where(known).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents linked by shingles."""
    return jaccard_join.distinct_documents(docs.select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kinds."""
    clean = secrets.redact(docs.select(*COLUMNS))
    length = F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))
    return clean.withColumn("n_chars", length).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of each leaf's prefix of one epoch; the last one is kept whole. Budgets
    and weights are in tokens of the encoder, which are counted once."""
    counted = bpe.encode(docs.select(*COLUMNS, F.col("text").alias("_text")), public_tokenizers.path(VOCABULARY), "_text")
    docs = stored(counted.select(*COLUMNS, F.size("ids").cast("long").alias("n_tokens")))
    mix = mixing.Mix(docs, mix_levels(), WEIGHTS, MIX_SHARE, epochs=1, seed=MIX_SEED, tokens=F.col("n_tokens"))
    return mix.select(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, decoded="decoded").select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: The language model and the encoder are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_table(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


clean_up = drop_tables
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
