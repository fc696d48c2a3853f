"""Text statistics: row count, term counts, word counts, distinct words.

Input: any DataFrame with ``doc_id`` and ``text``.  A document of the
reference is a line, so text values are first split into lines (a value with
embedded newlines is a small file); lines are tokenised with Java
``split(" ")`` rules.

Plans: the plain word count is scan -> explode -> partial HashAggregate ->
exchange on ``word`` -> final HashAggregate.  The partial aggregate already
combines per task (the reference's per-document and per-partition maps), so
the shuffle carries at most one row per (task, word).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.functions.text import document_lines_expr, java_space_split, utf16_length  # noqa: F401


def document_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, line): one row per line of each text value."""
    return docs.select("doc_id", F.posexplode(document_lines_expr(F.col(text_col)))
                       .alias("line_no", "line"))


def tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, word): one row per token (P1 + P2)."""
    lines = document_lines(docs, text_col)
    return lines.select("doc_id", "line_no", F.explode(java_space_split(F.col("line"))).alias("word"))


def row_count(df: DataFrame) -> DataFrame:
    """A1: number of rows, one-row DataFrame ``(n)``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def line_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A1 over reference documents (lines): ``(n)``."""
    lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(
        F.size(document_lines_expr(F.col(text_col))))
    return docs.agg(F.sum(lines).cast("bigint").alias("n"))


def doc_term_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A2: ``(doc_id, word, n)`` occurrences of each word in each document."""
    return tokens(docs, text_col).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A3 (= A5): ``(word, n)`` over all documents."""
    return tokens(docs, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(docs: DataFrame, k: int, text_col: str = "text") -> DataFrame:
    """A4: two-round word count with a salt in ``[0, k)`` per task.

    Round 1 groups by (salt, word), round 2 by word.  The salt is the task's
    number mod ``k``: a task ships one row per word, as without a salt, and a
    word that all tasks hold is spread over ``k`` reducers in round 1; round 2
    sees at most ``k`` rows per word.  Over a file scan a retried task has the
    same number, and the counts do not depend on it.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    t = tokens(docs, text_col).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(k)))
    r1 = t.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
    return r1.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def distinct_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(n_distinct)`` exact number of distinct words."""
    return word_count(docs, text_col).agg(F.count(F.lit(1)).alias("n_distinct"))


def avg_distinct_word_length(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(avg_len)`` = sum of UTF-16 lengths of the distinct words div their number.

    Not weighted by frequency; integer (truncating) division; NULL when there
    are no words.
    """
    wc = word_count(docs, text_col)
    agg = wc.agg(F.sum(utf16_length("word")).alias("s"), F.count(F.lit(1)).alias("c"))
    return agg.select(F.when(F.col("c") > 0, F.expr("CAST(s AS BIGINT) div c"))
                      .cast("bigint").alias("avg_len"))
