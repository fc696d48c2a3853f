"""What tasks hold and tiles ship when the tables grow."""

import tracemalloc

import numpy as np
import pandas as pd

from farpoint.operators import ball_tiles, diversity, pairwise
from farpoint.operators import kernels as K


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "id long, v array<double>")


def test_part_of_a_coreset_is_held_compactly():
    rng = np.random.default_rng(8)
    n, rows = 300_000, 10_000
    ids, x = rng.permutation(n), rng.integers(0, 1000, size=(n, 2)).astype(float)
    frames = (pd.DataFrame({"id": ids[s:s + rows], "v": list(x[s:s + rows])}) for s in range(0, n, rows))
    tracemalloc.start()
    got = K.farthest_first_chunks(K.batch_points(frames), 12)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * 60                    # 32 bytes a point; a frame of the whole part takes over 150
    order = np.argsort(ids)
    want, d = [int(order[0])], np.full(n, np.inf)
    for _ in range(11):
        d = np.minimum(d, ((x - x[want[-1]]) ** 2).sum(axis=1))
        far = np.flatnonzero(d == d.max())
        want.append(int(far[np.argmin(ids[far])]))
    assert [i for _, i, _ in got] == [int(ids[j]) for j in want]


def test_coreset_does_not_depend_on_batches(spark):
    x = np.array([(i % 9, i // 9) for i in range(162)], float) % 9          # ties and copies
    pts, conf = frame(spark, range(162), x), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "7")
    try:
        got = sorted(tuple(r) for r in diversity.partition_coreset(pts, 9, 3, plan="group").collect())
    finally:
        spark.conf.set(conf, before)
    assert got == sorted(tuple(r) for r in diversity.partition_coreset(pts, 9, 3, plan="lockstep").collect())


def rows_sent(monkeypatch):
    """Records the sizes of the tile grids."""
    grids, cross = [], pairwise._cross_tiles

    def spy(left, right, bl, br):
        grids.append((bl, br))
        return cross(left, right, bl, br)

    monkeypatch.setattr(pairwise, "_cross_tiles", spy)
    return grids


def test_greedy_step_sends_the_live_rows_once(spark, monkeypatch):
    """Few rows lose their partner in a step: the others must not be sent once per block of all rows."""
    grids = rows_sent(monkeypatch)
    monkeypatch.setattr(diversity, "MAX_BLOCK_ROWS", 300)
    monkeypatch.setattr(pairwise, "MAX_BLOCK_ROWS", 300)
    monkeypatch.setattr(pairwise, "MAX_LARGE_BLOCK_ROWS", 300)
    x = np.random.default_rng(4).normal(size=(1300, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(1300) * 7 + 2
    want = K.greedy_pairs(ids, x, 7)
    for plan in ("steps", "rounds"):
        got = diversity.greedy_pairs(frame(spark, ids, x), 7, plan=plan).orderBy("pick").collect()
        assert [r["id"] for r in got] == want
    assert grids and all(bl == 1 and br == 5 for bl, br in grids)


def test_blocks_grow_before_their_number():
    assert pairwise.n_blocks(8192, 64) == 1 and pairwise.n_blocks(100_000, 64) == 13
    assert pairwise.n_blocks(600_000, 64) == pairwise.MANY_BLOCKS
    assert -(-3_000_000 // pairwise.n_blocks(3_000_000, 64)) * 64 * 8 <= pairwise.DEFAULT_BLOCK_BYTES


def brute_partners(xa, ia, xb, ib):
    out = {}
    for i, v in zip(ia, xa):
        d = K.exact_sq(np.broadcast_to(v, xb.shape), xb)
        d = np.where(np.isnan(d) | (ib == i), -1.0, d)
        if d.max() >= 0:
            out[int(i)] = (int(ib[d == d.max()].min()), float(d.max()))
    return out


def test_partners_of_both_sides_are_exact(monkeypatch):
    monkeypatch.setattr(K, "FAST_ROWS", 16)
    monkeypatch.setattr(K, "FAST_COLS", 32)
    rng = np.random.default_rng(2)
    odd = rng.normal(size=(90, 3))
    odd[rng.random(odd.shape) < 0.05] = np.nan
    odd[5, 1], odd[50, 2], odd[60, 0] = np.inf, -np.inf, 1e200
    for x in (rng.normal(size=(90, 40)), rng.integers(0, 3, size=(90, 2)).astype(float), np.zeros((90, 3)), odd,
              1 + rng.integers(0, 4, size=(90, 2)) * 2.0 ** -50, rng.normal(size=(90, 5)) * 1e-3 + 1e7,
              rng.normal(size=(90, 5)) * 1e-170):
        ids = rng.permutation(400)[:90]
        xa, ia, xb, ib = x[:50], ids[:50], x[40:], ids[40:]         # ten points are on both sides
        got = [list(map(list, zip(*(c.tolist() for c in K.partners(xa, ia, xb, ib, both=both)))))
               for both in (False, True)]
        a, b = brute_partners(xa, ia, xb, ib), brute_partners(xb, ib, xa, ia)
        assert {i: (p, d) for i, p, d in got[0]} == a
        assert sorted(map(tuple, got[1])) == sorted((i, *v) for m in (a, b) for i, v in m.items())
        best = [d for _, d in a.values()]
        with np.errstate(all="ignore"):
            assert K.max_sq(xa, ia, xb, ib, triangle=False) == (max(best) if best else None)
            at = np.arange(90)
            assert K.max_sq(x, at, x, at, triangle=True) == max(d for _, d in brute_partners(x, at, x, at).values())


def test_ball_tiles_send_a_row_once_per_group(spark, monkeypatch):
    """Points on a sphere: no pair of blocks can be dropped, and still no row is sent once per block."""
    x = np.random.default_rng(6).normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    sent, send = [], ball_tiles.by_task

    def spy(rows, n, number):
        sent.append((rows.count(), n))
        return send(rows, n, number)

    monkeypatch.setattr(ball_tiles, "by_task", spy)
    got = ball_tiles.max_pairwise_distance_balls(frame(spark, range(4000), x), n_pivots=60, rings=3, block_rows=100,
                                                 counted=True).first()
    at = np.arange(4000)
    assert got["max_dist"] == np.sqrt(K.max_sq(x, at, x, at, triangle=True))
    assert got["all_tiles"] > 60 * 60 / 2 and got["n_tiles"] > got["all_tiles"] / 2
    groups = pairwise.MANY_BLOCKS + 6                   # groups are of whole blocks, not all full
    assert sum(n for n, _ in sent) < 4000 * 2 * groups and max(t for _, t in sent) <= groups * (groups + 1) / 2
