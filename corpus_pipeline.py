"""From raw documents to packed training sequences, in five stages.

Every stage takes all that the one before it kept, and is written to the shared
folder and read again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import materialise, table
from sluice.llm.line_dedup import line_dedup
from sluice.llm.packing import pack
from sluice.llm.quality_forest import quality_filter
from sluice.llm.simhash_dedup import simhash_dedup
from sluice.llm.suffix_dedup import suffix_array_dedup


def _counted(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    if "n_chars" in names:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*["`" + n.replace("`", "``") + "`" for n in names])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document without any other line stays, with an empty text."""
    return _counted(line_dedup(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return simhash_dedup(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes or more that stand elsewhere too are cut out."""
    return _counted(suffix_array_dedup(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of at most 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("best_fit_packing", packing),
]

#: SQL cannot express SimHash, the forest or the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table of documents."""
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = materialise(stage(spark, out, sf_dir), name)
    return out
