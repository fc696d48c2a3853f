"""Row ids from the scan's own metadata."""

from pyspark.sql import functions as F

from farpoint.sources.files import with_file_row_id


def _table(spark, path, n=5000):
    rows = spark.range(n, numPartitions=3).select(F.col("id").alias("x"), F.sha2(F.col("id").cast("string"), 256)
                                                  .alias("pad"))
    rows.write.option("parquet.block.size", 20000).option("parquet.page.size", 2000).parquet(path)
    return spark.read.parquet(path)


def test_ids_are_contiguous_in_split_files(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = _table(spark, path)
        assert df.rdd.getNumPartitions() > 3              # files are split
        ids = {r["x"]: r["id"] for r in with_file_row_id(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(ids.values()) == list(range(5000))
    assert all(ids[x + 1] == ids[x] + 1 for x in range(1665))      # in the first file's order
    # other splits, filters and projections: the same ids
    again = with_file_row_id(spark.read.parquet(path).where("x % 7 = 3").select("x"))
    assert again.columns == ["x", "id"]
    assert {r["x"]: r["id"] for r in again.collect()} == {x: i for x, i in ids.items() if x % 7 == 3}


def test_empty_table(spark, tmp_path):
    df = _table(spark, str(tmp_path / "e"), 0)
    assert with_file_row_id(df).count() == 0


def test_counts_read_no_column(spark, tmp_path):
    df = _table(spark, str(tmp_path / "c"), 10)
    plan = with_file_row_id(df.select("x"))._jdf.queryExecution().executedPlan().toString()
    assert "pad" not in plan and plan.count("FileScan") == 1
