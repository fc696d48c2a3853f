"""N-gram join, byte and word dedup against brute force, with the odd cases."""

import random

import pytest

from cases import documents, frame, jaccard_components, prose, repeated, words
from farpoint.llm import debruijn, ngram_join, suffix_dedup
from farpoint.llm.components import connected_components
from farpoint.llm.scratch import Scratch


def unique_rows(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def test_jaccard_classes_match_brute_force(spark):
    rows = unique_rows(documents())
    got = ngram_join.jaccard_classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == jaccard_components(rows)


def test_jaccard_classes_of_borderline_pairs(spark):
    # sets that differ by so much that the similarity lies just above or below 0.75
    rng = random.Random(5)
    rows = []
    for k in range(14):
        base = prose(rng, 40 + k, 10_000).split(" ")
        for cut in range(0, 14):
            rows.append((len(rows), " ".join(base[:len(base) - cut]), "en", "a"))
    got = ngram_join.jaccard_classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == jaccard_components(rows)


def test_jaccard_frequent_ngrams_and_hot_group(spark, monkeypatch):
    # many n-grams count as frequent, a third of the rows are near copies of one text
    monkeypatch.setattr(ngram_join, "MIN_HOT", 2)
    rng = random.Random(8)
    line = prose(rng, 12)
    hot = prose(rng, 60).split(" ")
    rows = []
    for k in range(90):
        w = list(hot)
        w[rng.randrange(60)] = "edit%d" % k
        rows.append((k, " ".join(w) if k < 30 else line + " " + prose(rng, 10 + k % 40), "en", "a"))
    got = ngram_join.jaccard_classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == jaccard_components(rows)


def test_jaccard_repeated_rows_null_ids_and_empty_table(spark):
    rows = documents()
    got = ngram_join.jaccard_classes(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    # the row without id is a copy of the first prose text
    first = next(r[0] for r in rows if r[1] == rows[-1][1])
    assert [r for r in got if r["doc_id"] is None][0]["component_id"] == first
    assert ngram_join.jaccard_classes(frame(spark, [])).count() == 0


def test_jaccard_bridge_through_a_null_id(spark):
    rng = random.Random(4)
    w = prose(rng, 100, 10_000).split(" ")
    far = w[:88] + ["x%d" % i for i in range(24)]
    mid = w[:88] + ["x%d" % i for i in range(12)]
    rows = [(1, " ".join(w), "en", "a"), (None, " ".join(mid), "en", "a"), (2, " ".join(far), "en", "a")]
    assert [n for _, _, n in jaccard_components([(1, rows[0][1]), (2, rows[2][1])])] == [1, 2]
    got = ngram_join.jaccard_classes(frame(spark, rows + [(None, "alone", "en", "a")])).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == [
        (1, 1), (2, 1), (None, 1), (None, None)]


def test_jaccard_group_of_many_near_copies(spark):
    # copies with many edits each: about half of the pairs link, so pivots alone don't connect them
    rng = random.Random(12)
    base = prose(rng, 150, 10_000).split(" ")
    rows = []
    for k in range(120):
        w = list(base)
        for i in rng.sample(range(150), 3 + k % 5):
            w[i] = "edit%d" % rng.randrange(10_000)
        rows.append((k, " ".join(w), "en", "a"))
    rows += [(1000 + k, prose(rng, 60, 10_000), "en", "a") for k in range(60)]
    got = ngram_join.jaccard_classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == jaccard_components(rows)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000)],
                                  "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in
           connected_components(links, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


@pytest.mark.parametrize("periodic,start", [(False, 50), (True, 50), (True, 10), (False, 190)])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, periodic, start):
    monkeypatch.setattr(suffix_dedup, "START", start)       # more or fewer rounds, same result
    rows = documents()
    if periodic:
        rng = random.Random(2)
        rows = [(i, ("abc" * rng.randrange(40, 120)) + "z" * i, "en", "a") for i in range(12)]
        rows += [(50, "q" * 199, "en", "a"), (51, "q" * 199, "en", "a"), (52, "r" * 201, "en", "a")]
    got = sorted(map(tuple, suffix_dedup.remove_repeats(frame(spark, rows)).collect()), key=repr)
    raw = [(t or "").encode() for _, t, *_ in rows]
    exp = []
    for r, b, mark in zip(rows, raw, repeated(raw, suffix_dedup.WIDTH)):
        kept = bytes(x for x, m in zip(b, mark) if not m)
        runs = sum(m and not (k and mark[k - 1]) for k, m in enumerate(mark))
        exp.append((r[0], len(b), sum(mark), runs, kept))
    assert [(*x[:4], bytes(x[4])) for x in got] == sorted(exp, key=repr)
    assert any(x[2] for x in exp) and any(not x[2] for x in exp)


def test_suffix_dedup_of_a_hot_passage_and_of_repeated_rows(spark):
    # one passage in a third of the rows, cut at every length about the limit; one row many times
    rng = random.Random(6)
    passage = prose(rng, 60, 10_000)
    rows = [(k, prose(rng, 20 + k % 7, 10_000) + " " + (passage[k % 9:190 + k] if k % 3 == 0 else "")
             + prose(rng, 30, 10_000), "en", "a") for k in range(90)]
    rows += [rows[3]] * 20 + [(None, rows[4][1], "en", "a")] * 10 + [(None, passage[:230], "en", "a")]
    got = sorted(map(tuple, suffix_dedup.remove_repeats(frame(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed").collect()), key=repr)
    raw = [(t or "").encode() for _, t, *_ in rows]
    assert got == sorted(((r[0], len(b), sum(m)) for r, b, m in zip(
        rows, raw, repeated(raw, suffix_dedup.WIDTH))), key=repr)


def test_prefix_doubling_ranks_by_growing_contexts(spark):
    # two places agree on 150 bytes from their first position, a third on 60 of them
    step = suffix_dedup.STEP
    texts = ["".join(chr(97 + i % 23) for i in range(200))]
    texts += [texts[0][:150] + "Z" * 50, texts[0][:60] + "Y" * 140]
    cells = spark.createDataFrame(
        [(p, x, hash(t[x * step:x * step + 50])) for p, t in enumerate(texts) for x in range(16)],
        "place bigint, x smallint, rank bigint")

    def alike(goal):
        got = suffix_dedup.double_ranks(cells, Scratch(spark, "test"), 50, goal).collect()
        first = {r["place"]: r["rank"] for r in got if r["x"] == 0}
        return sorted(p for p, k in first.items() if list(first.values()).count(k) > 1)
    assert [alike(n) for n in (60, 100, 150)] == [[0, 1, 2], [0, 1], [0, 1]]
    assert alike(160) == []


@pytest.mark.parametrize("periodic", [False, True])
def test_debruijn_dedup_matches_brute_force(spark, periodic):
    rows = documents()
    if periodic:
        rng = random.Random(2)
        rows = [(i, "a b c " * rng.randrange(10, 40) + "z" * i, "en", "a") for i in range(12)]
        rows += [(50, "q " * 34, "en", "a"), (51, "q " * 34, "en", "a"), (52, "r " * 36, "en", "a")]
    got = sorted(map(tuple, debruijn.remove_repeats(frame(spark, rows)).collect()), key=repr)
    seqs = [words(t) for _, t, *_ in rows]
    exp = []
    for r, w, mark in zip(rows, seqs, repeated(seqs, debruijn.WIDTH)):
        exp.append((r[0], len(w), sum(mark), " ".join(x for x, m in zip(w, mark) if not m)))
    assert got == sorted(exp, key=repr)
    assert any(x[2] for x in exp) and any(not x[2] for x in exp)


def test_debruijn_paths_compact(spark):
    # one long passage in three documents: its inner nodes form few paths
    rng = random.Random(4)
    passage = prose(rng, 600, 10_000)
    rows = [(i, prose(rng, 50, 10_000) + " " + passage + " " + prose(rng, 50, 10_000), "en", "a")
            for i in range(3)]
    scratch = Scratch(spark, "test")
    from pyspark.sql import functions as F
    texts = frame(spark, rows).select("doc_id", F.xxhash64("text").alias("fp"), "text")
    nodes, occ = debruijn.nodes_and_occurrences(texts, scratch)
    paths = debruijn.compact_paths(nodes, scratch).collect()
    assert len(paths) > 20 and len({p["path"] for p in paths}) == 1
    assert max(p["dist"] for p in paths) > 400


def test_dedup_of_empty_tables(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    assert debruijn.remove_repeats(frame(spark, [])).count() == 0
