"""A training corpus from raw documents: each stage works on all that the one before it kept.

A stage's result is to be written before the next stage is called (or be its `docs` as it is):
each stage begins by deleting the intermediate tables of the one before.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.decontaminate import tilings
from voltline.llm.line_dedup import PASSAGE_WORDS, dedup_lines
from voltline.llm.line_quality import apply_rules
from voltline.llm.mixing import mix_texts
from voltline.llm.ngram_join import join_by_shingles
from voltline.llm.store import noting, removed, stored

SHINGLE_WORDS, PERCENT = 5, 80


#: Intermediate tables of the stage called last.
_tables: list[str] = []


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame], first: bool = False) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _tables
        if not first:  # what an earlier run's last stage left may still be read
            removed(spark, _tables, docs)
        _tables = []
        with noting(_tables):
            return f(spark, docs, sf_dir)

    return run_stage


def _measured(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; so do lines that too many texts of a host share."""
    return _measured(apply_rules(docs), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of three lines or fifty words go out of the texts; documents of which no line is left go with them."""
    return _measured(dedup_lines(docs, least_words=PASSAGE_WORDS).filter("n_removed_lines = 0 OR n_removed_lines < n_lines"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    found = join_by_shingles(docs, size=SHINGLE_WORDS, percent=PERCENT)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = tilings(docs, items).select(F.col("key").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts and which pieces of them each shard of the mix holds, in which slots."""
    return mix_texts(docs).drop("n_chars")


STAGES = [
    ("quality rules", _stage(quality_rules, first=True)),
    ("line dedup", _stage(line_dedup)),
    ("n-gram Jaccard join", _stage(near_duplicates)),
    ("benchmark decontamination", _stage(decontamination)),
    ("mixing sources to target weights", _stage(source_mix)),
]

#: Permutations and tilings can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all of `documents`; between stages the corpus is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
