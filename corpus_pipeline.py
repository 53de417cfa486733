"""Corpus preparation: five stages over ``documents``, each stage's rows written
as Parquet in the shared folder and read back for the next. What a stage has read and
written on the way is removed once its rows are written.

Quality rules drop rejected documents, exact dedup and SimHash near-dedup leave
one document per group, mixing takes documents to their source's target words
(a document taken twice is two rows, a partly taken one a shorter text), and
packing cuts the tokens of what is left into windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logpulse.llm.common import documents, made, removed, written
from logpulse.llm.exact_dedup import drop_exact_copies
from logpulse.llm.mixing import mixed_documents
from logpulse.llm.packing import packed_pieces
from logpulse.llm.quality import keep_good
from logpulse.llm.simhash import drop_near_copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_pieces(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Robust estimates, fingerprints, random draws and tokens cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    since = len(made)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
        removed(spark, since, keep=1)  # what the stage read and wrote on the way
    return STAGES[-1][1](spark, docs, sf_dir)
