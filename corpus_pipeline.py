"""Corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

``STAGES`` names the stages in order; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``.  All but
the last return the columns of ``docs``; a document that mixing takes twice is there twice.

Defined results: each stage handles nulls, empty and very long texts, repeated rows, empty tables and
further columns as its operator's docstring states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, load
from gridmart.llm.exact_dedup import exact_dedup
from gridmart.llm.langid import UNKNOWN, identify, labelled_rows
from gridmart.llm.mixing import mix
from gridmart.llm.near_dedup import near_dedup
from gridmart.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language (no text, or no letter in it) go.  Where no label teaches a language, those
    without a letter go."""
    found = identify(docs, Scratch(spark, "pipeline-language"))
    known = F.col("lang_pred") != UNKNOWN if not labelled_rows(docs).isEmpty() else F.col("row.text").rlike("\\p{L}")
    return found.filter(known).select("row.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup(docs, Scratch(spark, "pipeline-exact"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows the one with the smallest doc_id stays."""
    return near_dedup(docs, Scratch(spark, "pipeline-near"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    mixed = mix(docs, Scratch(spark, "pipeline-mix"), carry=docs.columns)
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.filter("copies >= 1").select("row", each).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Training (language ID) and heuristics (packing) are not expressible in SQL.
ORACLE_SQL = None
