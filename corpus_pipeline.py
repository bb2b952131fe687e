"""Corpus pipeline: each stage works on all documents its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.llm.common import materialise, table
from indistar.llm.decontaminate import drop_contaminated
from indistar.llm.exact_dedup import drop_exact_copies
from indistar.llm.langid import UNDETERMINED, held_out, predict_languages, train_prototypes
from indistar.llm.minhash import drop_near_copies
from indistar.llm.packing import pack_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null texts and texts without a letter go.
    Where no row names a language, only those go."""
    prototypes = train_prototypes(docs.where(~held_out()))
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return predict_languages(rows, prototypes).where(F.col("lang_pred") != UNDETERMINED).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the largest id.  Null
    texts are empty texts; texts of any length are compared whole; all columns
    stay, whatever their names; an empty table stays empty."""
    return drop_exact_copies(docs, keep="max")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest id.  Null and
    blank texts are near nobody; rows without an id are records of their own;
    texts of any length are compared whole; all columns stay, whatever their
    names; an empty table stays empty."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window.  Null texts have no words and
    stay, and so does every document if ``benchmark`` is empty; all columns
    stay, whatever their names."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece.  A null or empty text is its
    end id; long texts are cut over sequences; other columns are not read; no
    documents give no pieces."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("decontaminate", decontaminate), ("pack", pack)]

#: SQL can't express the language profiles, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
