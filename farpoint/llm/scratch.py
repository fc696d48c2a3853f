"""Tables written to the shared checkpoint folder, to cut lineage and to prune columns.

Every table goes to a fresh folder below ``spark.checkpoint.dir`` (see
``farpoint.session.ensure_checkpoint_dir``), so it survives lost executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from farpoint.session import ensure_checkpoint_dir


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000         # texts per Arrow batch; Spark's default of 10,000 long texts is too much


class Scratch:
    """The intermediate tables of one operator run; lowers the session's Arrow batch size."""

    def __init__(self, spark: SparkSession, name: str):
        if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
            spark.conf.set(BATCH, str(BATCH_ROWS))
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.saved: list[DataFrame] = []

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return the table read back."""
        path = f"{self.base}/t{len(self.saved) + 1}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        self.saved.append(out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete saved tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            p.getFileSystem(conf).delete(p, True)

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all saved tables but these, which a result still reads."""
        kept = {t.scratch_path for t in tables}
        self.drop(*[t for t in self.saved if t.scratch_path not in kept])
