"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each one reads whole driver tables (only the needed columns) and applies one
operator; doubles are rounded to 6 places so the SQL oracle can compare
values exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farpoint.operators import (ball_tiles, centers, classes, coreset_tree, diversity, lazy_centers, pairwise, sampling,
                                text)
from farpoint.plans import params as P
from farpoint.functions.vectors import parse_vector
from farpoint.sources.files import parse_class_records
from farpoint.sources.tables import class_records_from, documents_from, load_table, points_from

Query = Callable[[SparkSession, str], DataFrame]


# ---- classes ---------------------------------------------------------------

def q_class_count(spark, sf_dir):
    return classes.class_count(class_records_from(spark, sf_dir, "events"))


def q_class_count_two_round(spark, sf_dir):
    return classes.class_count_two_round(class_records_from(spark, sf_dir, "orders"), P.K_PARTS)


def q_class_histogram_by_part(spark, sf_dir):
    return classes.class_histogram_by_part(class_records_from(spark, sf_dir, "orders"), P.K_PARTS)


def q_class_record_parse(spark, sf_dir):
    # events rendered as the reference's "<index> <class>" text lines, parsed back
    rec = class_records_from(spark, sf_dir, "events")
    lines = rec.select(F.concat_ws(" ", F.col("idx").cast("string"), F.col("class")).alias("value"))
    return parse_class_records(lines)


def q_max_partition_deterministic(spark, sf_dir):
    return classes.max_partition_size_deterministic(
        class_records_from(spark, sf_dir, "orders"), P.K_PARTS)


def q_max_partition_spark(spark, sf_dir):
    # the size itself depends on the layout: rows, parts and its bounds do not
    got = classes.max_partition_size_spark(class_records_from(spark, sf_dir, "orders"), P.K_PARTS)
    size = F.col("max_partition_size")
    return got.select("n", F.lit(P.K_PARTS).cast("bigint").alias("n_parts"),
                      ((size >= F.ceil(F.col("n") / P.K_PARTS)) & (size <= F.col("n")))
                      .alias("within_bounds"))


def q_most_frequent_class(spark, sf_dir):
    return classes.most_frequent_class(class_records_from(spark, sf_dir, "documents"))


# ---- text ------------------------------------------------------------------

def q_row_count(spark, sf_dir):
    return text.row_count(documents_from(spark, sf_dir))


def q_line_count(spark, sf_dir):
    return text.line_count(documents_from(spark, sf_dir))


def q_doc_term_count(spark, sf_dir):
    return text.doc_term_count(documents_from(spark, sf_dir))


def q_word_count(spark, sf_dir):
    return text.word_count(documents_from(spark, sf_dir))


def q_word_count_salted(spark, sf_dir):
    return text.word_count_salted(documents_from(spark, sf_dir), P.SALT_K)


def q_distinct_words(spark, sf_dir):
    return text.distinct_words(documents_from(spark, sf_dir))


def q_avg_distinct_word_length(spark, sf_dir):
    return text.avg_distinct_word_length(documents_from(spark, sf_dir))


# ---- points ----------------------------------------------------------------

def _r6(df, *cols):
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _emb(spark, sf_dir):
    return points_from(spark, sf_dir, "embeddings")


def q_point_parse(spark, sf_dir):
    # part rendered as the reference's "x,y" CSV lines, parsed back
    part = load_table(spark, sf_dir, "part")
    lines = part.select(F.col("p_partkey").alias("id"),
                        F.concat_ws(",", F.col("p_size").cast("string"),
                                    F.col("p_retailprice").cast("string")).alias("value"))
    pts = lines.select("id", parse_vector(F.col("value")).alias("v"))
    return pts.select("id", F.col("v")[0].alias("x0"), F.col("v")[1].alias("x1"))


def q_max_pairwise_distance(spark, sf_dir):
    return _r6(pairwise.max_pairwise_distance(_emb(spark, sf_dir)), "max_dist")


def q_avg_pairwise_distance(spark, sf_dir):
    return _r6(pairwise.avg_pairwise_distance(_emb(spark, sf_dir)), "avg_dist")


def q_random_sample_k(spark, sf_dir):
    return sampling.random_sample(_emb(spark, sf_dir), P.SAMPLE_K, P.SAMPLE_SEED).select("id")


def q_sample_complement(spark, sf_dir):
    pts = _emb(spark, sf_dir)
    sample = sampling.random_sample(pts, P.SAMPLE_K, P.SAMPLE_SEED)
    return sampling.sample_complement(pts, sample).select("id")


def q_sample_max_distance(spark, sf_dir):
    return _r6(sampling.sample_max_distance(_emb(spark, sf_dir), P.SAMPLE_K, P.SAMPLE_SEED),
               "max_dist")


def q_farthest_first_centers(spark, sf_dir):
    return centers.farthest_first_centers(_emb(spark, sf_dir), P.CENTERS_K)


def q_nearest_center(spark, sf_dir):
    pts = _emb(spark, sf_dir)
    cen = centers.farthest_first_centers(pts, P.CENTERS_K)
    return _r6(centers.nearest_center(pts, cen), "dist")


def q_nearest_center_sizes(spark, sf_dir):
    pts = _emb(spark, sf_dir)
    cen = centers.farthest_first_centers(pts, P.CENTERS_K)
    return centers.center_sizes(centers.nearest_center(pts, cen))


def q_farthest_first_random_start(spark, sf_dir):
    return centers.farthest_first_centers(_emb(spark, sf_dir), P.CENTERS_K, seed=P.SAMPLE_SEED)


def q_kcenter_max_distance(spark, sf_dir):
    return _r6(centers.kcenter_max_distance(_emb(spark, sf_dir), P.CENTERS_K), "max_dist")


def q_kcenter_random_start(spark, sf_dir):
    return _r6(centers.kcenter_max_distance(_emb(spark, sf_dir), P.CENTERS_K, seed=P.SAMPLE_SEED),
               "max_dist")


# the plans for large inputs, each forced on a given table

def q_max_pairwise_distance_tiled(spark, sf_dir):
    return _r6(pairwise.max_pairwise_distance(_emb(spark, sf_dir), min_blocks=3, prune=False),
               "max_dist")


def q_avg_pairwise_distance_tiled(spark, sf_dir):
    return _r6(pairwise.avg_pairwise_distance(_emb(spark, sf_dir), min_blocks=3), "avg_dist")


def q_partition_coreset_lockstep(spark, sf_dir):
    return diversity.partition_coreset(_emb(spark, sf_dir), P.DIVERSITY_K, P.DIVERSITY_L,
                                       plan="lockstep")


def q_greedy_pairs_rounds(spark, sf_dir):
    return diversity.greedy_pairs(_emb(spark, sf_dir), P.GREEDY_K, plan="rounds")


def q_greedy_pairs_steps(spark, sf_dir):
    return diversity.greedy_pairs(_emb(spark, sf_dir), P.GREEDY_K, plan="steps")


def q_partition_coreset(spark, sf_dir):
    return diversity.partition_coreset(_emb(spark, sf_dir), P.DIVERSITY_K, P.DIVERSITY_L)


def q_greedy_pairs(spark, sf_dir):
    return diversity.greedy_pairs(_emb(spark, sf_dir), P.GREEDY_K)


def q_diversity_two_round(spark, sf_dir):
    return diversity.diversity_two_round(_emb(spark, sf_dir), P.DIVERSITY_K, P.DIVERSITY_L)


def _orders_pts(spark, sf_dir):
    return points_from(spark, sf_dir, "orders")


def q_max_pairwise_distance_orders(spark, sf_dir):
    return _r6(pairwise.max_pairwise_distance(_orders_pts(spark, sf_dir)), "max_dist")


def q_diversity_orders(spark, sf_dir):
    return diversity.diversity_two_round(_orders_pts(spark, sf_dir), P.ORDERS_DIV_K, P.ORDERS_DIV_L)


def q_diversity_baseline_config(spark, sf_dir):
    pts = _orders_pts(spark, sf_dir)
    sol = diversity.diversity_two_round(pts, P.BASELINE_K, P.BASELINE_L)
    score = diversity.diversity_score(pts, sol)
    return _with_score(sol, score)


def _with_score(sol, score):
    # one-row score attached to every pick as a literal (no join)
    value = score.first()["avg_dist"]
    return sol.withColumn("avg_dist", F.round(F.lit(value).cast("double"), 6))


# coresets in rounds, bounds instead of whole scans

def q_coreset_tree(spark, sf_dir):
    return coreset_tree.coreset_tree(_emb(spark, sf_dir), P.DIVERSITY_K, P.TREE_L, P.TREE_FAN_IN, P.TREE_ROWS).select(
        "part", "step", "id")


def q_diversity_tree(spark, sf_dir):
    return coreset_tree.diversity_tree(_emb(spark, sf_dir), P.DIVERSITY_K, P.TREE_L, fan_in=P.TREE_FAN_IN,
                                       max_rows=P.TREE_ROWS)


def q_farthest_first_lazy(spark, sf_dir):
    return lazy_centers.farthest_first_lazy(_orders_pts(spark, sf_dir), P.CENTERS_K).select("step", "id")


def q_max_pairwise_distance_balls(spark, sf_dir):
    return _r6(ball_tiles.max_pairwise_distance_balls(_emb(spark, sf_dir)), "max_dist")


def q_nearest_center_many(spark, sf_dir):
    pts = _orders_pts(spark, sf_dir)
    cen = sampling.random_sample(pts, P.MANY_CENTERS, P.SAMPLE_SEED).select(F.col("id").alias("step"), "id")
    return _r6(centers.nearest_center(pts, cen), "dist")


def q_diversity_score(spark, sf_dir):
    pts = _emb(spark, sf_dir)
    sol = diversity.diversity_two_round(pts, P.DIVERSITY_K, P.DIVERSITY_L)
    return _r6(diversity.diversity_score(pts, sol), "avg_dist")


QUERIES: dict[str, Query] = {
    "class_count": q_class_count,
    "class_count_two_round": q_class_count_two_round,
    "class_histogram_by_part": q_class_histogram_by_part,
    "class_record_parse": q_class_record_parse,
    "max_partition_deterministic": q_max_partition_deterministic,
    "max_partition_spark": q_max_partition_spark,
    "most_frequent_class": q_most_frequent_class,
    "row_count": q_row_count,
    "line_count": q_line_count,
    "doc_term_count": q_doc_term_count,
    "word_count": q_word_count,
    "word_count_salted": q_word_count_salted,
    "distinct_words": q_distinct_words,
    "avg_distinct_word_length": q_avg_distinct_word_length,
    "point_parse": q_point_parse,
    "max_pairwise_distance": q_max_pairwise_distance,
    "avg_pairwise_distance": q_avg_pairwise_distance,
    "random_sample_k": q_random_sample_k,
    "sample_complement": q_sample_complement,
    "sample_max_distance": q_sample_max_distance,
    "farthest_first_centers": q_farthest_first_centers,
    "nearest_center": q_nearest_center,
    "nearest_center_sizes": q_nearest_center_sizes,
    "farthest_first_random_start": q_farthest_first_random_start,
    "kcenter_max_distance": q_kcenter_max_distance,
    "kcenter_random_start": q_kcenter_random_start,
    "max_pairwise_distance_tiled": q_max_pairwise_distance_tiled,
    "avg_pairwise_distance_tiled": q_avg_pairwise_distance_tiled,
    "partition_coreset_lockstep": q_partition_coreset_lockstep,
    "greedy_pairs_rounds": q_greedy_pairs_rounds,
    "greedy_pairs_steps": q_greedy_pairs_steps,
    "partition_coreset": q_partition_coreset,
    "greedy_pairs": q_greedy_pairs,
    "diversity_two_round": q_diversity_two_round,
    "diversity_score": q_diversity_score,
    "max_pairwise_distance_orders": q_max_pairwise_distance_orders,
    "diversity_orders": q_diversity_orders,
    "coreset_tree": q_coreset_tree,
    "diversity_tree": q_diversity_tree,
    "farthest_first_lazy": q_farthest_first_lazy,
    "max_pairwise_distance_balls": q_max_pairwise_distance_balls,
    "nearest_center_many": q_nearest_center_many,
    "diversity_baseline_config": q_diversity_baseline_config,
}
