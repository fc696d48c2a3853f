"""A training-data pipeline over ``documents``: five stages, each one operator of farpoint.llm."""

from __future__ import annotations

from pyspark.sql import functions as F

from farpoint.llm import decontaminate, mixing, ngram_join, quality, secrets
from farpoint.llm.scratch import Scratch
from farpoint.sources.tables import load_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs).select(*COLUMNS)


def near_duplicate_stage(spark, docs, sf_dir):
    """One row of each group of near copies stays."""
    return ngram_join.keep_one_row(docs).select(*COLUMNS)


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, load_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secrets_stage(spark, docs, sf_dir):
    """Secrets are masked in the texts; every document stays."""
    return secrets.redact(docs).select(*COLUMNS)


def mixing_stage(spark, docs, sf_dir):
    """The words that the mix takes from each document."""
    return mixing.mix_sources(docs).select("doc_id", "source", "size", "source_size",
                                           F.round("target", 6).alias("target"), "taken")


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("mix_sources", mixing_stage),
]


def run(spark, sf_dir):
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs


# The banded alignment and the compression novelty have no SQL form.
ORACLE_SQL = None
