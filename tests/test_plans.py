"""Physical-plan properties of the registered queries."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL, have_testdata
from farpoint.plans import QUERIES

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver tables not present")


def plan_of(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_no_cartesian_or_nested_loop_joins(spark):
    for name, q in QUERIES.items():
        plan = plan_of(q(spark, SF_SMALL), "extended")
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "CrossJoin"):
            assert bad not in plan, f"{name}: {bad}"


def test_counts_prune_columns_and_combine_map_side(spark):
    for name, allowed, exchanges in [("word_count", {"struct<text:string>"}, 1),
                                     ("word_count_salted", {"struct<text:string>"}, 2),
                                     ("class_count", {"struct<event_type:string>"}, 2)]:
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == exchanges, name
        schemas = set(re.findall(r"ReadSchema: (\S+)", plan))
        assert schemas and schemas <= allowed, (name, schemas)
        assert "partial_count" in plan, name


def test_bounded_sides_are_broadcast(spark):
    from farpoint.operators import diversity, sampling
    from farpoint.sources.tables import points_from
    pts = points_from(spark, SF_SMALL, "embeddings")
    sample = sampling.random_sample(pts, 10, 1)
    plan = plan_of(sampling.sample_complement(pts, sample))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    core = diversity.partition_coreset(pts, 4, 4)
    plan = plan_of(diversity.coreset_points(pts, core))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_tiles_shuffle_once_per_tile_group(spark):
    from farpoint.operators import pairwise
    from farpoint.sources.tables import points_from
    pts = points_from(spark, SF_SMALL, "embeddings")
    plan = plan_of(pairwise.avg_pairwise_distance(pts, n_blocks_hint=3))
    # tile i on task i (6 tiles), reused by the grouping: one exchange before the UDF
    assert "shufflepartitionidpassthrough" in plan and ", 6)" in plan
    exchanges = re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)
    assert len(exchanges) == 2      # tile exchange + final single-row aggregate


def test_one_part_per_task(spark):
    from pyspark.sql import functions as F
    from farpoint.operators.pairwise import by_task
    parts = by_task(spark.range(400).withColumn("part", F.col("id") % 16), 16, F.col("part"))
    got = parts.select("part", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(got) == 16 and len({r["task"] for r in got}) == 16


def test_limits_only_where_they_are_the_feature(spark):
    """Whole tables: a row limit appears only in the sample and top-1 queries."""
    # the K-sample (X1) and the queries built on it, and the top-1 class
    allowed = {"random_sample_k", "sample_complement", "sample_max_distance",
               "most_frequent_class"}
    for name, q in QUERIES.items():
        plan = plan_of(q(spark, SF_SMALL), "extended")
        limited = any(op in plan for op in ("GlobalLimit", "LocalLimit", "CollectLimit",
                                            "TakeOrderedAndProject"))
        assert not limited or name in allowed, name
