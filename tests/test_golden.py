"""Golden values computed for the survey on the sf0.01 embeddings (FIXTURES F6)."""

import os

import pytest

from conftest import SF_MID

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_MID), reason="driver tables not present")


@pytest.fixture(scope="module")
def emb(spark):
    from farpoint.sources.tables import points_from
    return points_from(spark, SF_MID, "embeddings").persist()


def test_diameter(emb):
    from farpoint.operators import pairwise
    assert pairwise.max_pairwise_distance(emb).first()[0] == pytest.approx(1.759898122772, abs=1e-9)


def test_centers_kcenter_and_sizes(emb):
    from farpoint.operators import centers
    c5 = [r["id"] for r in centers.farthest_first_centers(emb, 5).orderBy("step").collect()]
    assert c5 == [0, 188, 291, 152, 366]
    c6 = centers.farthest_first_centers(emb, 6)
    assert [r["id"] for r in c6.orderBy("step").collect()] == [0, 188, 291, 152, 366, 49]
    assert centers.kcenter_max_distance(emb, 6).first()[0] == pytest.approx(1.635295420980, abs=1e-9)
    sizes = {r["center_id"]: r["n"] for r in
             centers.center_sizes(centers.nearest_center(emb, c6)).collect()}
    assert sizes == {0: 88, 49: 82, 152: 81, 188: 71, 291: 90, 366: 88}


def test_diversity(emb):
    from farpoint.operators import diversity
    sol = diversity.diversity_two_round(emb, 6, 4)
    assert [r["id"] for r in sol.orderBy("pick").collect()] == [2, 138, 3, 311, 1, 389]
    assert diversity.diversity_score(emb, sol).first()[0] == pytest.approx(1.430316808162, abs=1e-9)
