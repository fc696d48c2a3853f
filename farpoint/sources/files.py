"""Text-file sources.

* S1 documents: one document per line (``doc_id``, ``text``);
* S2 class records ``"<index> <class>"`` -> (``idx`` bigint, ``class`` string);
* S3/S4 comma-separated numeric points -> (``id`` bigint, ``v`` array<double>).

Parsing is strict: a malformed line fails the job (``raise_error``) instead
of silently becoming NULL, whatever the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farpoint.functions.text import java_space_split
from farpoint.functions.vectors import parse_vector


def with_row_index(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a 0-based, contiguous row number in scan order (like ``zipWithIndex``).

    One row per input partition (its size) reaches the driver; the running
    offsets go back as a small broadcast table joined on the partition id,
    so the data itself is neither shuffled nor collected.  Scan order is
    file-split order, which is stable for a given input; ``df`` must be a scan
    (no shuffle in it), as its partitions are numbered in two jobs.
    """
    spark = df.sparkSession
    tagged = df.withColumn("_pid", F.spark_partition_id()) \
               .withColumn("_mid", F.monotonically_increasing_id())
    sizes = sorted((r["_pid"], r["n"]) for r in
                   tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, run = [], 0
    for pid, n in sizes:
        offsets.append((pid, run))
        run += n
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    table = spark.createDataFrame(offsets, "_pid int, _off long")
    # monotonically_increasing_id = (partition id << 33) + row position in partition
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(table), "_pid")
            .withColumn(name, (F.col("_off") + pos).cast("bigint"))
            .drop("_pid", "_mid", "_off"))


def with_file_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Add each row's 0-based position in the Parquet files that ``df`` reads, files by path.

    ``df`` is any plan of narrow steps (filters, projections) over one Parquet scan; a row that a
    filter drops keeps its number, so ids agree between a table and its filtered views, and
    however files are split.  The position inside a file comes with the scan (``row_index`` of its
    metadata).  Only the files' row counts are read besides, with no column of the data; they
    travel as a small table of one row per file, as the scan's own file listing does.
    """
    spark, meta = df.sparkSession, F.col("_metadata")
    files = df.inputFiles()
    if not files:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    counts = (spark.read.parquet(*files).groupBy(meta["file_path"].alias("path"))
              .agg(F.count(F.lit(1)).alias("n")))
    offsets, run = [], 0
    for r in sorted(counts.collect()):
        offsets.append((r["path"], run))
        run += r["n"]
    table = spark.createDataFrame(offsets, "_path string, _off long")
    return (df.select("*", meta["file_path"].alias("_path"), meta["row_index"].alias("_row"))
            .join(F.broadcast(table), "_path")
            .withColumn(name, F.col("_off") + F.col("_row")).drop("_path", "_row", "_off"))


def read_text_documents(spark: SparkSession, path: str, num_partitions: int | None = None) -> DataFrame:
    """Every line of the text file(s) at ``path`` is one document."""
    df = spark.read.text(path).withColumnRenamed("value", "text")
    if num_partitions:
        df = df.repartition(int(num_partitions))
    return df.select(F.monotonically_increasing_id().alias("doc_id"), "text")


def parse_class_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """S2 parse step: ``"<index> <class>"`` -> (idx, class); bad lines raise."""
    toks = lines.select(java_space_split(F.col(col)).alias("t"), F.col(col).alias("_line"))
    idx = F.get(F.col("t"), 0).try_cast("bigint")
    cls = F.get(F.col("t"), 1)
    bad = idx.isNull() | cls.isNull()
    # the check stands in every column, so it holds whichever of them a query reads
    error = F.raise_error(F.concat(F.lit("malformed class record: "),
                                   F.coalesce("_line", F.lit("NULL"))))
    return toks.select(F.when(bad, error).otherwise(idx).alias("idx"),
                       F.when(bad, error).otherwise(cls).alias("class"))


def read_class_records(spark: SparkSession, path: str) -> DataFrame:
    """Class records from text file(s)."""
    return parse_class_records(spark.read.text(path))


def parse_points(lines: DataFrame, col: str = "value") -> DataFrame:
    """S3 parse step: comma-separated doubles -> ``v``; bad lines raise."""
    return lines.select(parse_vector(F.col(col)).alias("v"))


def read_points_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless numeric CSV -> (id, v), ids are 0-based line numbers."""
    pts = parse_points(spark.read.text(path))
    return with_row_index(pts, "id").select("id", "v")
