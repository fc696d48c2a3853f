"""Incremental class count and word count over a directory of text files.

New files in the directory are new input.  State is one row per class or
word (kept by the streaming aggregate in the checkpointed state store), so
the state grows with the number of distinct keys, not with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farpoint.operators import text
from farpoint.sources.files import parse_class_records


def _text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def stream_class_count(spark: SparkSession, path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(class, n)`` over class-record files; run in ``complete`` or ``update`` mode."""
    records = parse_class_records(_text_stream(spark, path, max_files_per_trigger))
    return records.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def stream_word_count(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(word, n)``: every line of every new file is a document."""
    lines = _text_stream(spark, path, max_files_per_trigger).select(
        F.lit(0).cast("bigint").alias("doc_id"), F.col("value").alias("text"))
    toks = lines.select(F.explode(text.java_space_split(F.col("text"))).alias("word"))
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
