"""A training corpus from raw documents: STAGES in order, each writing its documents for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import curriculum, decontamination, jaccard_join, quality_rules, toxicity
from tillroll.llm.queries import table
from tillroll.llm.ship import ship
from tillroll.operators.staging import Staging

ORACLE_SQL = None  # the toxicity stage is learned


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents of the tables, and drops documents that score as toxic."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def remove_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are unlike their language, as the stage's own input has it."""
    return quality_rules.keep_good(docs, quality_rules.references(docs))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of linked documents, and every document without words."""
    return jaccard_join.keep_first(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out, and drops documents that are mostly benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), n_chars="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in training order; documents beyond their source's target go."""
    return curriculum.mixed(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("quality rules", remove_poor),
    ("n-gram Jaccard join", remove_copies),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs, staging = table(ship(spark), sf_dir, "documents"), Staging(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = staging.write(stage(spark, docs, sf_dir), f"{i}-{name.replace(' ', '-')}")
    return docs
