"""Shape the driver's parquet tables into the library's data model.

Only the needed columns are selected, so the parquet scan reads nothing else.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# table -> (id column, class column)
CLASS_SOURCES = {
    "events": ("event_id", "event_type"),
    "orders": ("o_orderkey", "o_orderpriority"),
    "documents": ("doc_id", "lang"),
}

# table -> (id column, vector expression)
POINT_SOURCES = {
    "embeddings": ("vec_id", lambda: F.col("embedding").cast("array<double>")),
    "part": ("p_partkey", lambda: F.array(F.col("p_size").cast("double"),
                                          F.col("p_retailprice").cast("double"))),
    "events": ("event_id", lambda: F.array(F.col("user_id").cast("double"),
                                           F.col("value").cast("double"))),
    "orders": ("o_orderkey", lambda: F.array(F.col("o_custkey").cast("double"),
                                             F.col("o_totalprice").cast("double"))),
}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def class_records_from(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """(idx bigint, class string) from a driver table."""
    id_col, cls_col = CLASS_SOURCES[table]
    return load_table(spark, sf_dir, table).select(
        F.col(id_col).cast("bigint").alias("idx"), F.col(cls_col).cast("string").alias("class"))


def documents_from(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """(doc_id bigint, text string) from the documents table."""
    return load_table(spark, sf_dir, table).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))


def points_from(spark: SparkSession, sf_dir: str, table: str = "embeddings") -> DataFrame:
    """(id bigint, v array<double>) from a driver table."""
    id_col, vec = POINT_SOURCES[table]
    return load_table(spark, sf_dir, table).select(
        F.col(id_col).cast("bigint").alias("id"), vec().alias("v"))
