"""Point-set operators against brute-force numpy / Python models.

Small block sizes force several tiles so the tiled plans are exercised.
"""

import itertools
import math

import numpy as np
import pytest

from farpoint.operators import bounded, centers, diversity, pairwise, sampling
from farpoint.sources.files import parse_points, read_points_csv, with_row_index


def make_points(spark, arr, ids=None):
    ids = list(range(len(arr))) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, arr)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def dist(a, b):
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


def brute_ff(arr, k):
    n = len(arr)
    picks = [0]
    d = [dist(arr[0], p) for p in arr]
    for _ in range(1, k):
        j = max(range(n), key=lambda i: (d[i], -i))
        if not d[j] > 0:
            break
        picks.append(j)
        d = [min(d[i], dist(arr[j], arr[i])) for i in range(n)]
    return picks


def brute_greedy(arr, ids, k):
    n = len(arr)
    if k >= n:
        return sorted(ids)
    used, out = set(), []
    order = sorted(range(n), key=lambda i: ids[i])
    for _ in range(k // 2):
        best = None
        for a, b in itertools.combinations(order, 2):
            if a in used or b in used:
                continue
            i, j = sorted((ids[a], ids[b]))
            key = (-dist(arr[a], arr[b]), i, j)
            if best is None or key < best[0]:
                best = (key, a, b)
        _, a, b = best
        used |= {a, b}
        out += sorted((ids[a], ids[b]))
    if k % 2:
        out.append(min(ids[i] for i in range(n) if i not in used))
    return out


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(7)
    arr = rng.normal(size=(300, 5))
    arr[10] = arr[20]            # duplicates
    arr[30] = arr[20]
    return arr


def test_parse_vector_rules(spark):
    df = spark.createDataFrame([("1,2,",), ("3.5,NaN",), (" 1 ,2",)], "value string")
    got = [list(r["v"]) for r in parse_points(df).collect()]
    assert got[0] == [1.0, 2.0] and math.isnan(got[1][1]) and got[2] == [1.0, 2.0]


@pytest.mark.parametrize("line", ["", "1,x"])
def test_malformed_points_fail(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception):
        parse_points(df).collect()


def test_csv_ids_follow_lines(spark, tmp_path):
    p = tmp_path / "pts.csv"
    p.write_text("".join(f"{i},{i * 2}\n" for i in range(1000)))
    df = spark.read.text(str(p)).repartition(1)
    pts = read_points_csv(spark, str(p))
    got = sorted((r["id"], r["v"][0]) for r in pts.collect())
    assert got == [(i, float(i)) for i in range(1000)]
    idx = with_row_index(df.coalesce(1), "rid")
    assert sorted(r["rid"] for r in idx.collect()) == list(range(1000))


@pytest.mark.parametrize("blocks", [1, 3])
def test_max_and_avg_pairwise(spark, cloud, blocks):
    pts = make_points(spark, cloud)
    d = np.sqrt(((cloud[:, None, :] - cloud[None, :, :]) ** 2).sum(-1))
    iu = np.triu_indices(len(cloud), 1)
    got = pairwise.max_pairwise_distance(pts, n_blocks_hint=blocks).first()[0]
    assert got == pytest.approx(d[iu].max(), abs=1e-9)
    pruned = pairwise.max_pairwise_distance(pts, prune=True).first()[0]
    assert pruned == pytest.approx(d[iu].max(), abs=1e-9)
    got = pairwise.avg_pairwise_distance(pts, n_blocks_hint=blocks).first()[0]
    assert got == pytest.approx(d[iu].mean(), abs=1e-9)


def test_pruning_low_dimension(spark):
    rng = np.random.default_rng(3)
    arr = rng.uniform(size=(2000, 2))
    pts = make_points(spark, arr)
    lb, cand = pairwise.prune_for_diameter(pts)
    kept = {r["id"] for r in cand.collect()}
    d = np.sqrt(((arr[:, None, :] - arr[None, :, :]) ** 2).sum(-1))
    i, j = np.unravel_index(np.argmax(d), d.shape)
    assert len(kept) < 200 and {int(i), int(j)} <= kept
    assert pairwise.max_pairwise_distance(pts, prune=True).first()[0] == pytest.approx(d.max(), abs=1e-12)


def test_pairwise_degenerate(spark):
    one = make_points(spark, np.array([[1.0, 2.0]]))
    assert pairwise.max_pairwise_distance(one).first()[0] == 0.0
    assert pairwise.avg_pairwise_distance(one).first()[0] is None
    nan = make_points(spark, np.array([[0.0, 0.0], [3.0, 4.0], [np.nan, 1.0]]))
    assert pairwise.max_pairwise_distance(nan).first()[0] == pytest.approx(5.0)
    assert pairwise.max_pairwise_distance(nan, prune=True).first()[0] == pytest.approx(5.0)


@pytest.mark.parametrize("blocks", [1, 4])
def test_farthest_partner(spark, cloud, blocks):
    pts = make_points(spark, cloud)
    got = {r["id"]: r["partner"] for r in pairwise.farthest_partner(pts, n_blocks_hint=blocks).collect()}
    d = np.sqrt(((cloud[:, None, :] - cloud[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, -1)
    for i in range(len(cloud)):
        assert got[i] == int(np.argmax(d[i]))


def test_sampling(spark, cloud):
    pts = make_points(spark, cloud)
    s1 = [r["id"] for r in sampling.random_sample(pts, 10, 1231829).collect()]
    s2 = [r["id"] for r in sampling.random_sample(pts.repartition(7), 10, 1231829).collect()]
    assert len(set(s1)) == 10 and sorted(s1) == sorted(s2)
    rest = sampling.sample_complement(pts, sampling.random_sample(pts, 10, 1231829))
    assert rest.count() == 290 and not set(s1) & {r["id"] for r in rest.collect()}
    exact = pairwise.max_pairwise_distance(pts).first()[0]
    approx = sampling.sample_max_distance(pts, 10, 1231829).first()[0]
    assert exact / 2 - 1e-12 <= approx <= exact + 1e-12
    with pytest.raises(ValueError):
        sampling.sample_max_distance(pts, 300, 1)


def test_farthest_first_and_kcenter(spark, cloud):
    pts = make_points(spark, cloud)
    got = [r["id"] for r in centers.farthest_first_centers(pts, 8, checkpoint_every=3)
           .orderBy("step").collect()]
    assert got == brute_ff(cloud, 8)
    exact = pairwise.max_pairwise_distance(pts).first()[0]
    kc = centers.kcenter_max_distance(pts, 8).first()[0]
    assert exact / 2 - 1e-12 <= kc <= exact + 1e-12


def test_farthest_first_duplicates_stop(spark):
    pts = make_points(spark, np.array([[1.0, 1.0]] * 5 + [[2.0, 2.0]] * 3))
    got = [r["id"] for r in centers.farthest_first_centers(pts, 6).orderBy("step").collect()]
    assert got == [0, 5]


def test_nearest_center(spark, cloud):
    pts = make_points(spark, cloud)
    cen = centers.farthest_first_centers(pts, 5)
    cids = [r["id"] for r in cen.orderBy("step").collect()]
    got = {r["id"]: (r["center_id"], r["dist"]) for r in centers.nearest_center(pts, cen).collect()}
    for i, p in enumerate(cloud):
        ds = [dist(p, cloud[c]) for c in cids]
        j = int(np.argmin(ds))
        assert got[i][0] == cids[j] and got[i][1] == pytest.approx(ds[j], abs=1e-12)
    sizes = centers.center_sizes(centers.nearest_center(pts, cen)).collect()
    assert sum(r["n"] for r in sizes) == len(cloud)


@pytest.mark.parametrize("k,l_parts", [(4, 3), (5, 4), (1, 2)])
def test_coreset_plans_agree(spark, cloud, k, l_parts):
    pts = make_points(spark, cloud)
    a = sorted(tuple(r) for r in diversity.partition_coreset(pts, k, l_parts, plan="group").collect())
    b = sorted(tuple(r) for r in diversity.partition_coreset(pts, k, l_parts, plan="lockstep",
                                                              checkpoint_every=2).collect())
    assert a == b and len(a) <= k * l_parts
    for part in range(l_parts):
        idx = [i for i in range(len(cloud)) if i % l_parts == part]
        expect = [idx[j] for j in brute_ff(cloud[idx], k)]
        assert [r[2] for r in a if r[0] == part] == expect


@pytest.mark.parametrize("k", [1, 2, 5, 6, 12])
@pytest.mark.parametrize("plan", ["steps", "group", "rounds"])
def test_greedy_pairs(spark, cloud, k, plan):
    sub = cloud[:40]
    pts = make_points(spark, sub)
    got = [r["id"] for r in diversity.greedy_pairs(pts, k, checkpoint_every=2, plan=plan)
           .orderBy("pick").collect()]
    assert got == brute_greedy(sub, list(range(40)), k)


def test_greedy_grid_ties_and_small_n(spark):
    grid = np.array([[x, y] for x in range(4) for y in range(4)], dtype=float)
    pts = make_points(spark, grid)
    for plan in ("steps", "group", "rounds"):
        got = [r["id"] for r in diversity.greedy_pairs(pts, 7, plan=plan).orderBy("pick").collect()]
        assert got == brute_greedy(grid, list(range(16)), 7)
        three = make_points(spark, grid[:3])
        assert [r["id"] for r in diversity.greedy_pairs(three, 5, plan=plan)
                .orderBy("pick").collect()] == [0, 1, 2]


def test_diversity_end_to_end(spark, cloud):
    pts = make_points(spark, cloud)
    sol = diversity.diversity_two_round(pts, 6, 4)
    ids = [r["id"] for r in sol.orderBy("pick").collect()]
    assert len(set(ids)) == 6
    score = diversity.diversity_score(pts, sol).first()[0]
    sub = cloud[ids]
    expect = np.mean([dist(a, b) for a, b in itertools.combinations(sub, 2)])
    assert score == pytest.approx(expect, abs=1e-12)


def test_diversity_large_k_against_model(spark):
    """The baseline configuration's shape (k much larger than a part) against
    the composition of the brute-force models."""
    rng = np.random.default_rng(11)
    arr = rng.uniform(size=(240, 3))
    pts = make_points(spark, arr)
    k, l_parts = 30, 4
    core = []
    for part in range(l_parts):
        idx = [i for i in range(len(arr)) if i % l_parts == part]
        core += [idx[j] for j in brute_ff(arr[idx], k)]
    core = sorted(core)
    expect = brute_greedy(arr[core], core, k)
    got = [r["id"] for r in diversity.diversity_two_round(pts, k, l_parts).orderBy("pick").collect()]
    assert got == expect


def test_nearest_center_with_nan_point(spark):
    arr = np.array([[0.0, 0.0], [10.0, 0.0], [1.0, 1.0], [np.nan, 2.0]])
    pts = make_points(spark, arr)
    cen = centers.farthest_first_centers(pts, 2)
    assert [r["id"] for r in cen.orderBy("step").collect()] == [0, 1]
    got = {r["id"]: (r["center_id"], r["dist"]) for r in centers.nearest_center(pts, cen).collect()}
    assert got[2][0] == 0 and got[3] == (None, None)


def test_pairwise_with_a_third_copies(spark):
    """One point copied into a third of all rows: every copy ties."""
    rng = np.random.default_rng(5)
    arr = rng.normal(size=(180, 4))
    arr[:60] = arr[0]
    arr[60:90] = arr[60]
    pts = make_points(spark, arr)
    d = np.sqrt(((arr[:, None, :] - arr[None, :, :]) ** 2).sum(-1))
    iu = np.triu_indices(len(arr), 1)
    assert pairwise.max_pairwise_distance(pts, n_blocks_hint=3).first()[0] == pytest.approx(d[iu].max())
    assert pairwise.avg_pairwise_distance(pts, n_blocks_hint=3).first()[0] == pytest.approx(d[iu].mean())
    np.fill_diagonal(d, -1)
    got = {r["id"]: r["partner"] for r in pairwise.farthest_partner(pts, n_blocks_hint=3).collect()}
    assert all(got[i] == int(np.argmax(d[i])) for i in range(len(arr)))
    expect = brute_greedy(arr, list(range(len(arr))), 9)
    for plan in ("steps", "rounds"):
        picks = [r["id"] for r in diversity.greedy_pairs(pts, 9, plan=plan).orderBy("pick").collect()]
        assert picks == expect, plan


def test_coreset_hash_parts(spark, cloud):
    pts = make_points(spark, cloud)
    a = sorted(tuple(r) for r in diversity.partition_coreset(pts, 4, 5, part_key="hash", plan="group").collect())
    b = sorted(tuple(r) for r in diversity.partition_coreset(pts, 4, 5, part_key="hash", plan="lockstep").collect())
    assert a == b and {r[0] for r in a} <= set(range(5)) and len(a) <= 20


def test_empty_point_set(spark):
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert pairwise.max_pairwise_distance(empty).first()[0] == 0.0
    assert pairwise.avg_pairwise_distance(empty).first()[0] is None
    assert centers.farthest_first_centers(empty, 3).count() == 0
    assert diversity.partition_coreset(empty, 3, 2).count() == 0
    assert diversity.greedy_pairs(empty, 3).count() == 0
    assert diversity.diversity_two_round(empty, 3, 2).count() == 0
    with pytest.raises(ValueError):
        sampling.sample_max_distance(empty, 1, 1)


def test_block_size_setting(spark, cloud):
    pts = make_points(spark, cloud)
    d = np.sqrt(((cloud[:, None, :] - cloud[None, :, :]) ** 2).sum(-1))
    spark.conf.set("spark.farpoint.blockBytes", "1024")     # 256-row blocks -> 2 blocks
    try:
        assert pairwise._blocks_for(pts, None, None) == 2
        got = pairwise.max_pairwise_distance(pts, prune=False).first()[0]
    finally:
        spark.conf.unset("spark.farpoint.blockBytes")
    assert got == pytest.approx(d.max(), abs=1e-9)


def test_farthest_first_lineage_cut(spark, cloud, monkeypatch):
    """Recomputing from the points, or checkpointing beyond the broadcast limit: same picks."""
    pts = make_points(spark, cloud).repartition(6)

    def ids():
        got = centers.farthest_first_centers(pts, 9, checkpoint_every=2)
        return [r["id"] for r in got.orderBy("step").collect()]
    again = ids()
    monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)
    assert again == ids() == brute_ff(cloud, 9)


def test_coreset_spark_parts(spark, cloud):
    pts = make_points(spark, cloud)
    core = diversity.partition_coreset(pts, 4, 3, part_key="spark", plan="group").collect()
    assert {r["part"] for r in core} <= {0, 1, 2} and len(core) <= 12
    # every part's picks are a farthest-first traversal of that part's points
    parted = diversity.with_part(pts, 3, part_key="spark").collect()
    for part in {r["part"] for r in core}:
        idx = sorted(r["id"] for r in parted if r["part"] == part)
        expect = [idx[j] for j in brute_ff(cloud[idx], 4)]
        assert [r["id"] for r in sorted(core, key=lambda r: r["step"]) if r["part"] == part] == expect


def test_greedy_plan_choice():
    assert diversity.choose_greedy_plan(1600, 300) == "group"
    assert diversity.choose_greedy_plan(20000, 300) == "rounds"
    assert diversity.choose_greedy_plan(20000, 2) == "steps"
    assert diversity.choose_greedy_plan(5000, 64, max_group_bytes=1024) == "rounds"


NAN, INF = float("nan"), float("inf")


def test_average_with_nan_is_nan_in_any_number_of_blocks(spark):
    rng = np.random.default_rng(3)
    arr = rng.normal(size=(30, 3))
    arr[4, 1] = NAN
    for b in (1, 2, 3, 5):
        got = pairwise.avg_pairwise_distance(make_points(spark, arr), n_blocks_hint=b).first()[0]
        assert math.isnan(got), b


def test_infinite_distances_count(spark):
    pts = make_points(spark, [[0, 0], [3, 4], [INF, 0], [1, 1]])
    for prune in (False, True):
        assert pairwise.max_pairwise_distance(pts, prune=prune).first()[0] == INF
    assert pairwise.avg_pairwise_distance(pts).first()[0] == INF


def test_unequal_lengths_fail(spark):
    pts = make_points(spark, [[0, 0], [3, 4], [1, 2, 3]])
    for prune in (False, True, "auto"):
        with pytest.raises(ValueError):
            pairwise.max_pairwise_distance(pts, prune=prune)
    with pytest.raises(Exception, match="dimension"):
        centers.farthest_first_centers(pts, 2).collect()


def test_coreset_plans_sum_in_one_order(spark):
    # all points but the origin equally far: the last bit decides the picks
    rng = np.random.default_rng(11)
    arr = rng.normal(size=(201, 24))
    arr /= np.sqrt((arr ** 2).sum(axis=1, keepdims=True))
    arr[0] = 0
    pts = make_points(spark, arr)
    group, lockstep = (sorted(tuple(r) for r in diversity.partition_coreset(
        pts, 5, 2, plan=p).collect()) for p in ("group", "lockstep"))
    assert group == lockstep


@pytest.mark.parametrize("plan", ["group", "steps", "rounds"])
def test_greedy_returns_min_k_n_with_nan_points(spark, plan):
    pts = make_points(spark, [[0.0], [NAN], [NAN], [NAN]])
    got = [r["id"] for r in diversity.greedy_pairs(pts, 2, plan=plan).orderBy("pick").collect()]
    assert got == [0, 1]
    pts = make_points(spark, [[0.0], [5.0], [NAN], [1.0], [NAN], [NAN]])
    got = [r["id"] for r in diversity.greedy_pairs(pts, 5, plan=plan).orderBy("pick").collect()]
    assert got == [0, 1, 2, 3, 4]


def test_nothing_stays_cached(spark, cloud):
    spark.catalog.clearCache()
    pts = make_points(spark, cloud)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    sampling.sample_max_distance(pts, 20, 3).collect()
    diversity.diversity_two_round(pts, 4, 3).collect()
    for plan in ("steps", "rounds"):
        diversity.greedy_pairs(pts, 4, plan=plan).collect()
    centers.farthest_first_centers(pts, 4).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_k_must_be_below_n(spark, cloud):
    pts = make_points(spark, cloud[:5])
    for k in (0, 5, 6):
        with pytest.raises(ValueError):
            centers.kcenter_max_distance(pts, k)
    seeded = centers.farthest_first_centers(pts, 3, seed=4)
    want = pairwise.max_pairwise_distance(centers.center_points(pts, seeded)).first()[0]
    assert centers.kcenter_max_distance(pts, 3, seed=4).first()[0] == want


def test_sample_max_distance_tile_fallback(spark, cloud, monkeypatch):
    pts = make_points(spark, cloud)
    direct = sampling.sample_max_distance(pts, 25, 7).first()[0]
    monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)    # force the tiled path
    tiled = sampling.sample_max_distance(pts, 25, 7).first()[0]
    sample = {r["id"] for r in sampling.random_sample(pts, 25, 7).collect()}
    rest = [i for i in range(len(cloud)) if i not in sample]
    expect = max(dist(cloud[a], cloud[b]) for a in sample for b in rest)
    assert direct == pytest.approx(expect, abs=1e-12) and tiled == pytest.approx(expect, abs=1e-12)


def test_nearest_center_tile_fallback(spark, cloud, monkeypatch):
    pts = make_points(spark, cloud)
    cen = centers.farthest_first_centers(pts, 5)
    direct = sorted(tuple(r) for r in centers.nearest_center(pts, cen).collect())
    monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)      # force the tiled path
    tiled = sorted(tuple(r) for r in centers.nearest_center(pts, cen).collect())
    assert [r[:2] for r in direct] == [r[:2] for r in tiled]
    assert all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(direct, tiled))


def test_all_pairs_guard(spark, cloud):
    pts = make_points(spark, cloud)
    spark.conf.set("spark.farpoint.maxPairs", "1000")
    try:
        with pytest.raises(ValueError):
            pairwise.avg_pairwise_distance(pts)
        with pytest.raises(ValueError):
            pairwise.max_pairwise_distance(pts, prune=False)
        # pruning leaves few candidates in low dimension: the guard applies to those
        rng = np.random.default_rng(2)
        flat = make_points(spark, rng.uniform(size=(3000, 2)))
        assert pairwise.max_pairwise_distance(flat, prune=True).first()[0] > 0
    finally:
        spark.conf.unset("spark.farpoint.maxPairs")


def test_coreset_lockstep_shuffled(spark, cloud, monkeypatch):
    """More parts than may be collected: centers stay DataFrames, same result."""
    pts = make_points(spark, cloud)
    group = sorted(tuple(r) for r in diversity.partition_coreset(pts, 4, 3, plan="group").collect())
    monkeypatch.setattr(diversity, "MAX_BROADCAST_PARTS", 0)
    shuffled = sorted(tuple(r) for r in diversity.partition_coreset(pts, 4, 3, plan="lockstep").collect())
    assert shuffled == group


def test_row_ids_over_several_files(spark, tmp_path):
    src = tmp_path / "pts"
    src.mkdir()
    for f in range(3):
        (src / f"part{f}.csv").write_text("".join(f"{f},{i}\n" for i in range(100 + f * 50)))
    pts = read_points_csv(spark, str(src))
    rows = pts.collect()
    assert sorted(r["id"] for r in rows) == list(range(450))
    # within one file, ids follow the line order
    for f in range(3):
        ids = [r["id"] for r in sorted((r for r in rows if r["v"][0] == f), key=lambda r: r["v"][1])]
        assert ids == list(range(ids[0], ids[0] + len(ids)))
