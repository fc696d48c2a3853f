"""Excerpts of benchmark items are found wherever they start."""

import random

import pyarrow as pa
import pytest

from cases import frame, prose
from farpoint.llm import decontaminate
from farpoint.llm import words as W


@pytest.mark.parametrize("n", [150, 199, 200, 394, 1003])
def test_every_excerpt_of_150_bytes_is_found(n):
    rng = random.Random(n)
    some = lambda k: "".join(rng.choice("abcdefghij klmnop") for _ in range(k))
    item = "x" + some(n - 2) + "y"
    item = " ".join(item.split()).ljust(n, "z")
    index = decontaminate.build_index(decontaminate.cut_pieces(item))
    docs = [some(40) + item[a:a + 150] + some(40) for a in range(0, n - 149)]
    found = {c.lo + x[0] for c in W.chunks(pa.array(docs))
             for x in decontaminate.chunk_matches(c, index)}
    assert found == set(range(len(docs)))


def test_pieces_of_larger_budgets_stay():
    # 11 edits in a piece of 199 bytes, 7 in the first of 131: within the budget of the disjoint pieces
    rng = random.Random(2)
    some = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    for n, m, edits in ((199, 199, 11), (394, 131, 7)):
        item = some(n)
        pieces = decontaminate.cut_pieces(item)
        assert item[:m].encode() in pieces
        doc = list(item[:m])
        for k in rng.sample(range(m), edits):
            doc[k] = "Z"
        index = decontaminate.build_index(pieces)
        (c,) = W.chunks(pa.array([some(30) + "".join(doc) + some(30)]))
        assert decontaminate.chunk_matches(c, index)


def test_excerpts_that_straddle_cuts_go(spark):
    rng = random.Random(5)
    items = [prose(rng, n, 10_000) for n in (33, 66)]
    assert 180 <= len(items[0]) and len(items[1]) >= 300
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = [(1, prose(rng, 9) + " " + items[0][:150], "en", "a"),
            (2, items[1][30:232] + " " + prose(rng, 9), "en", "a"), (3, prose(rng, 60), "en", "a")]
    got = decontaminate.contaminated(frame(spark, rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 0), (2, 1)}
    assert [r["doc_id"] for r in decontaminate.keep_clean(frame(spark, rows), bench).collect()] == [3]


def test_equal_items_are_compared_once(spark):
    rng = random.Random(9)
    item, other = prose(rng, 70, 10_000), prose(rng, 70, 10_000)
    bench = spark.createDataFrame([(i, item) for i in range(1000)] + [(2000, other), (None, item)],
                                  "item_id bigint, text string")
    pieces = decontaminate.benchmark_pieces(bench)
    (index, _), = decontaminate._slices(pieces)
    assert len(index["pieces"]) == len(set(decontaminate.cut_pieces(item) + decontaminate.cut_pieces(other)))
    rows = [(k, prose(rng, 300) + " " + item + " " + prose(rng, 300), "en", "a") for k in range(20)]
    rows += [(100, prose(rng, 60), "en", "a"), (None, other, "en", "a")]
    got = decontaminate.contaminated(frame(spark, rows), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {
        (k, i) for k in range(20) for i in [*range(1000), None]} | {(None, 2000)}
    assert [r["doc_id"] for r in decontaminate.keep_clean(frame(spark, rows), bench).collect()] == [100]


def test_hits_are_counted_in_parts(monkeypatch):
    rng = random.Random(3)
    item = prose(rng, 70, 10_000)[:400]
    near = [item[:200] + "%04d" % k + item[204:] for k in range(12)]
    index = decontaminate.build_index(sorted({p for x in near for p in decontaminate.cut_pieces(x)}))
    (c,) = W.chunks(pa.array([near[k] + prose(rng, 5) for k in range(2)]))
    got = decontaminate.chunk_matches(c, index)
    assert {x[0] for x in got} == {0, 1}
    monkeypatch.setattr(decontaminate, "HITS", 50)         # many parts, the same counts
    assert decontaminate.chunk_matches(c, index) == got


def test_long_document(spark):
    rng = random.Random(4)
    item = prose(rng, 60, 10_000)
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    long = prose(rng, 150_000) + " " + item + " " + prose(rng, 150_000)
    got = decontaminate.contaminated(frame(spark, [(1, long, "en", "a"), (2, long[:400_000], "en", "a")]), bench)
    assert [(r["doc_id"], r["edits"]) for r in got.collect()] == [(1, 0)]
