"""Coreset tree, center groups, lazy farthest-first and ball tiles against plain models."""

import numpy as np
import pytest

from farpoint.operators import centers, coreset_tree, diversity, lazy_centers, pairwise
from farpoint.operators import kernels as K
from farpoint.operators.ball_tiles import max_pairwise_distance_balls
from farpoint.operators.center_groups import CenterGroups, nearest_by_groups


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "id long, v array<double>")


def cloud(seed, n, dim, clusters=0, spread=0.05):
    rng = np.random.default_rng(seed)
    if not clusters:
        return rng.normal(size=(n, dim))
    return rng.normal(size=(clusters, dim))[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, dim))


def grid(n):
    """Points with very many ties."""
    return np.array([(i % n, i // n) for i in range(n * n)], float)


# ---- coreset tree ----------------------------------------------------------------

def tree_model(ids, x, k, l_parts, fan_in, max_rows):
    part, rows = ids % l_parts, np.arange(len(ids))
    while True:
        kept = []
        for p in np.unique(part):
            mine = rows[part == p]
            of = {int(ids[r]): r for r in mine}
            kept += [(p, s, of[i]) for s, i in K.farthest_first(ids[mine], x[mine], k)]
        if l_parts == 1 or len(kept) <= max_rows:
            return [(int(p), s, int(ids[r])) for p, s, r in kept]
        part, rows = np.array([p // fan_in for p, _, _ in kept]), np.array([r for _, _, r in kept])
        l_parts = -(-l_parts // fan_in)


@pytest.mark.parametrize("data, k, l_parts, fan_in, max_rows, max_bytes", [
    (cloud(1, 400, 3), 4, 40, 3, 20, None), (grid(15), 3, 30, 2, 10, None), (cloud(2, 300, 5), 5, 7, 2, 12, 1),
    (np.zeros((50, 2)), 4, 10, 3, 2, None), (cloud(3, 60, 2), 50, 8, 2, 20, None)])
def test_tree_equals_its_model(spark, data, k, l_parts, fan_in, max_rows, max_bytes):
    ids = np.random.default_rng(5).permutation(len(data)) * 3
    got = coreset_tree.coreset_tree(frame(spark, ids, data), k, l_parts, fan_in, max_rows, max_group_bytes=max_bytes)
    rows = got.collect()
    want = tree_model(ids, data, k, l_parts, fan_in, max_rows)
    assert sorted((r["part"], r["step"], r["id"]) for r in rows) == sorted(want)
    at = {int(i): v for i, v in zip(ids, data)}
    assert all(r["v"] == at[r["id"]].tolist() for r in rows)
    picks = [r["id"] for r in coreset_tree.diversity_tree(
        frame(spark, ids, data), k, l_parts, fan_in=fan_in, max_rows=max_rows).orderBy("pick").collect()]
    core = np.array(sorted(i for _, _, i in want))
    assert picks == K.greedy_pairs(core, np.array([at[i] for i in core]), k)


def test_tree_of_two_rounds_equals_two_rounds(spark):
    pts = frame(spark, range(300), cloud(4, 300, 4))
    a = coreset_tree.diversity_tree(pts, 8, 5).orderBy("pick").collect()
    assert a == diversity.diversity_two_round(pts, 8, 5).orderBy("pick").collect()


def test_tree_of_very_many_parts_ends_in_one_tile(spark):
    ids = np.arange(9000) * 11
    core = coreset_tree.coreset_tree(frame(spark, ids, cloud(6, 9000, 2)), 100, 100_000)
    # 9000 parts of one point are too many for one tile; merged, they are thinned to 100 a part
    assert 100 <= core.count() <= pairwise.MAX_BLOCK_ROWS


def test_tree_arguments(spark):
    pts = frame(spark, [1], [[0.0]])
    assert [tuple(r) for r in coreset_tree.coreset_tree(pts, 3, 4).collect()] == [(1, 0, 1, [0.0])]
    assert coreset_tree.coreset_tree(pts.limit(0), 3, 4).count() == 0
    for bad in (dict(k=0, l_parts=2), dict(k=1, l_parts=0), dict(k=1, l_parts=2, fan_in=1),
                dict(k=1, l_parts=2, part_key="spark")):
        with pytest.raises(ValueError):
            coreset_tree.coreset_tree(pts, **bad)


# ---- center groups ---------------------------------------------------------------

def odd(x):
    x = x.copy()
    x[3, 0], x[7, 1], x[11, 0] = np.nan, np.inf, -np.inf
    return x


@pytest.mark.parametrize("x, cx", [
    (cloud(1, 900, 2), cloud(2, 300, 2)), (cloud(3, 400, 24, 12), cloud(3, 200, 24, 12)), (grid(20), grid(12) + 0.5),
    (odd(cloud(4, 200, 3)), odd(cloud(5, 90, 3))), (cloud(6, 50, 2), np.zeros((40, 2))), (cloud(7, 20, 2), cloud(8, 1, 2))])
def test_groups_equal_all_distances(x, cx):
    rng = np.random.default_rng(9)
    cid, rank = rng.permutation(len(cx)) + 100, rng.permutation(len(cx))
    c, d, n = CenterGroups.build(cid, cx, rank).nearest(x)
    want_c, want_d = K.nearest(x, cx, cid, rank)
    assert (c == want_c).all() and (d == want_d).all()
    assert n.min() >= 1


def test_groups_skip_most_of_10000_centers(spark):
    x, cx = cloud(1, 3000, 2), cloud(2, 10_000, 2)
    at = np.arange(len(cx))
    got = nearest_by_groups(frame(spark, range(len(x)), x), CenterGroups.build(at, cx, at), counted=True).collect()
    want_c, want_d = K.nearest(x, cx, at, at)
    assert {r["id"]: (r["center_id"], r["dist"]) for r in got} == {
        i: (int(c), float(d)) for i, (c, d) in enumerate(zip(want_c, want_d))}
    assert sum(r["n_dist"] for r in got) < 0.2 * len(x) * len(cx)


def test_nearest_center_by_groups_equals_plain(spark, monkeypatch):
    pts = frame(spark, range(400), odd(cloud(8, 400, 2)))
    cen = spark.createDataFrame([(s, int(i)) for s, i in enumerate(range(20, 400, 7))], "step int, id long")
    plain = centers.nearest_center(pts, cen).orderBy("id").collect()
    monkeypatch.setattr(centers, "GROUPS_MIN_CENTERS", 1)
    grouped = centers.nearest_center(pts, cen)
    assert grouped.columns == ["id", "center_id", "dist"]
    assert grouped.orderBy("id").collect() == plain


# ---- lazy farthest-first -----------------------------------------------------------

@pytest.mark.parametrize("data, k", [
    (cloud(1, 1500, 2), 25), (grid(18), 12), (odd(cloud(2, 200, 3)), 8), (cloud(3, 300, 16), 10),
    (np.repeat(cloud(4, 5, 2), 20, axis=0), 9), (cloud(5, 3, 2), 3)])
def test_lazy_equals_plain(spark, data, k):
    ids = np.random.default_rng(3).permutation(len(data)) * 2 + 5
    pts = frame(spark, ids, data)
    got = lazy_centers.farthest_first_lazy(pts, k).collect()
    assert [(r["step"], r["id"]) for r in got] == [
        (r["step"], r["id"]) for r in centers.farthest_first_centers(pts, k).orderBy("step").collect()]


def test_lazy_reads_few_rows(spark):
    n, k = 4000, 30
    got = lazy_centers.farthest_first_lazy(frame(spark, range(n), cloud(6, n, 2)), k).collect()
    assert len(got) == k
    # the plain loop reads all rows in each of its steps; here the first reads them, the others a part
    later = [r["rows_read"] for r in got[2:]]
    assert got[1]["rows_read"] >= n and sum(later) < 0.3 * n * len(later)


def test_lazy_arguments(spark):
    pts = frame(spark, [4, 9], [[0.0], [2.0]])
    assert [tuple(r) for r in lazy_centers.farthest_first_lazy(pts, 2, start_id=9).collect()] == [(0, 9, 0), (1, 4, 2)]
    assert lazy_centers.farthest_first_lazy(pts.limit(0), 2).collect() == []
    for bad in (dict(k=0), dict(k=1, start_id=5)):
        with pytest.raises(ValueError):
            lazy_centers.farthest_first_lazy(pts, **bad)


# ---- ball tiles ----------------------------------------------------------------------

def diameter(x):
    x = x[~np.isnan(x).any(axis=1)]
    at = np.arange(len(x))
    return float(np.sqrt(K.max_sq(x, at, x, at, triangle=True) or 0.0))


@pytest.mark.parametrize("data, rows", [
    (cloud(1, 300, 8), 8192), (cloud(2, 200, 2), 16), (grid(12), 20), (odd(cloud(3, 120, 3)), 8192),
    (np.zeros((30, 2)), 8), (cloud(4, 1, 2), 8192), (cloud(5, 0, 2), 8192)])
def test_balls_give_the_diameter(spark, data, rows):
    got = max_pairwise_distance_balls(frame(spark, range(len(data)), data), n_pivots=3, rings=2, block_rows=rows)
    assert got.first()["max_dist"] == pytest.approx(diameter(data), abs=1e-12)


def test_balls_drop_most_tiles_of_clustered_points(spark):
    x = cloud(7, 3000, 32, clusters=40)
    got = max_pairwise_distance_balls(frame(spark, range(len(x)), x), n_pivots=40, rings=1, block_rows=64,
                                      counted=True).first()
    assert got["max_dist"] == pytest.approx(diameter(x), abs=1e-12)
    assert 0 < got["n_tiles"] < 0.1 * got["all_tiles"]
