"""Streaming counts agree with the batch operators on the same files."""

import os

from farpoint.operators import classes, text
from farpoint.sources.files import read_class_records, read_text_documents
from farpoint.streaming import stream_class_count, stream_word_count


def _run(stream_df, name, ckpt):
    q = (stream_df.writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_stream_class_count(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("1 x\n2 y\n3 x\n")
    (src / "b.txt").write_text("4 z\n5 x\n")
    _run(stream_class_count(spark, str(src), max_files_per_trigger=1), "cls_counts",
         os.path.join(str(tmp_path), "ck1"))
    got = {r["class"]: r["n"] for r in spark.sql("SELECT * FROM cls_counts").collect()}
    batch = {r["class"]: r["n"] for r in classes.class_count(read_class_records(spark, str(src))).collect()}
    assert got == batch == {"x": 3, "y": 1, "z": 1}


def test_stream_word_count(spark, tmp_path):
    src = tmp_path / "docs"
    src.mkdir()
    (src / "a.txt").write_text("a b b\nc \n")
    (src / "b.txt").write_text("b  a\n")
    _run(stream_word_count(spark, str(src)), "word_counts", os.path.join(str(tmp_path), "ck2"))
    got = {r["word"]: r["n"] for r in spark.sql("SELECT * FROM word_counts").collect()}
    batch = {r["word"]: r["n"] for r in text.word_count(read_text_documents(spark, str(src))).collect()}
    assert got == batch == {"a": 2, "b": 3, "c": 1, "": 1}


def test_stream_state_carries_across_batches(spark, tmp_path):
    src = tmp_path / "live"
    src.mkdir()
    (src / "a.txt").write_text("1 x\n2 y\n")
    q = (stream_class_count(spark, str(src)).writeStream.outputMode("complete")
         .format("memory").queryName("live_counts")
         .option("checkpointLocation", os.path.join(str(tmp_path), "ck3")).start())
    try:
        q.processAllAvailable()
        first = {r["class"]: r["n"] for r in spark.sql("SELECT * FROM live_counts").collect()}
        (src / "b.txt").write_text("3 x\n4 x\n5 z\n")        # arrives after the first batch
        q.processAllAvailable()
        second = {r["class"]: r["n"] for r in spark.sql("SELECT * FROM live_counts").collect()}
    finally:
        q.stop()
    assert first == {"x": 1, "y": 1}
    assert second == {"x": 3, "y": 1, "z": 1}
