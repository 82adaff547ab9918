"""The corpus pipeline: documents through five stages, each stored as Parquet before the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents, whatever others there are.

Defined cases, as the operators have them: a row with a null id passes the substring dedup
unchanged and has a draw of its own in the mix; the Jaccard join compares it like any other.
Null and empty texts fail the base rules, so no stage after the first sees them; texts of any
length are read whole; of rows that tie as a class's first, and of fully equal rows, one
stays; an empty table gives an empty table at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.stages import cut
from patronage.llm import jaccard, mixing, packing, quality, substring
from patronage.llm.queries import table, tokenizer_file

WIDTH = 1024


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated classifier keep."""
    model = quality.train_rules(docs, table(spark, sf_dir, "labels"))
    return quality.apply_rules(docs, model).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the least id, of each class of similar texts; a null or repeated id is compared by its text."""
    return jaccard.one_of_each_class(docs)


def substring_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words or more that lie earlier too."""
    out = substring.remove_repeats(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by the target shares of their sources, in global random order."""
    return mixing.mix(docs).select(docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces that fill them."""
    return packing.pack(docs, tokenizer_file(), WIDTH)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_repeats),
    ("source mixing", source_mix),
    ("packing", sequence_packing),
]

# SQL can express neither the classifier nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
