"""op13 against brute-force scores of all documents."""

import math
import random
import re

import numpy as np
import pytest

from farpoint.llm import lexical as X
from cases import LOWER, documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string, query int, key string, score double"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def rows():
    rng = random.Random(8)
    out = documents()
    vocabulary = [f"t{i}" for i in range(300)] + ["Ünï", "日本"]
    for i in range(200):
        n = rng.choice([3, 10, 40, 200])
        out.append((5000 + i, " ".join(vocabulary[min(int(rng.expovariate(0.02)), 301)] for _ in range(n)) + "!", "en", "a"))
    out += [(9000 + i, "copy of t1 t2 t3 t2", "en", "a") for i in range(150)]
    out += [(9000, "copy of t1 t2 t3 t2", "en", "a")] * 3 + [(None, "copy of t1 t2 t3 t2", "en", "a")] * 2
    out += [(9900, "--- ...", "en", "a"), (9901, "A-Z a_z", "en", "a"), (9902, " ".join(f"u{i}" for i in range(40_000)), "en", "a")]
    return out


def items():
    base = ["t1 t2 t3 common copy", "w1 w2 w3 w4 w5", "T250 t299 Ünï 日本", "nowhere found", "", None, "... !",
            "a z", " ".join(f"t{i}" for i in range(300)), "u7 u8 t5 t5 t5", "line with words"]
    return [(i, t) for i, t in enumerate(base)] + [(1, "w9 w8"), (1, "w9 w8"), (None, "t4 t9")]


def brute(docs, asked, k):
    bags = []
    for i, t, *_ in docs:
        bag = {}
        for x in terms(t):
            bag[x] = bag.get(x, 0) + 1
        if bag:
            bags.append((i, bag, sum(bag.values())))
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    out = []
    for item, text in asked:
        ts = set(terms(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in b for _, b, _ in bags) + 1))) for t in ts}
        found = []
        for i, bag, n in bags:
            m = 100 - 50 + 50 * n * n_docs // n_terms
            score = sum(w[t] * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in ts if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, query_bytes, block_docs", [(50, X.QUERY_BYTES, X.BLOCK_DOCS), (5, 300, 16)])
def test_equals_brute_force(spark, monkeypatch, k, query_bytes, block_docs):
    monkeypatch.setattr(X, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(X, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(X, "MAX_WIDTH", 1 << 12)
    docs, asked = rows(), items()
    d = frame(spark, docs).repartition(4)
    q = spark.createDataFrame([(i, t, 1, "k", 0.0) for i, t in asked], ITEMS)
    got = X.search(d, q, k)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, asked, k)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "t1", 1, "k", 0.0)], ITEMS)
    assert X.search(frame(spark, rows()), none).collect() == []
    assert X.search(frame(spark, []), some).collect() == []
    assert X.search(frame(spark, [(1, None, "en", "a"), (2, "", "en", "a")]), some).collect() == []


def test_bounds_never_fall_below_scores(spark):
    docs, asked = rows(), [x for x in items() if terms(x[1])]
    q = X.Queries.of([(i, t) for i, (_, t) in enumerate(asked)])
    built = X.build_index(frame(spark, docs), q.vocabulary).collect()
    blocks = [r for r in built if r["slices"] is not None]
    bags = [terms(t) for _, t, *_ in docs if terms(t)]
    assert sum(len(r["key"]) for r in blocks) == len(bags)
    q.n_docs, q.n_terms = sum(r["n_docs"] or 0 for r in built), sum(r["n_terms"] or 0 for r in built)
    assert (q.n_docs, q.n_terms) == (len(bags), sum(map(len, bags)))
    q.weights = X.term_weights(q.n_docs, sum(np.array(r["df"]) for r in built if r["df"] is not None))
    keys = {r["key"]: r["text"] for r in X.keyed(frame(spark, docs)).collect()}
    exact, bound = 0, 0
    for r in blocks:
        n, top = np.array(r["n"]), np.array(r["top"])
        for lo, ub in X.block_bounds(q, r["width"], r["slices"], n, top):
            for j in range(ub.shape[1]):
                ts = terms(keys[r["key"][lo + j]])
                m = int(q.lengths(n[lo + j:lo + j + 1])[0])
                h = {t: ts.count(t) for t in set(ts)}
                for i, (_, text) in enumerate(asked):
                    score = 0
                    for t in set(terms(text)) & set(h):
                        code = X.Queries.of([(0, t)]).vocabulary[0]
                        w = int(q.weights[np.searchsorted(q.vocabulary, code)])
                        score += w * (10**9 * h[t] // (1000 * h[t] + 20 * m))
                    assert ub[i, j] >= score
                    exact, bound = exact + score, bound + ub[i, j]
    assert bound < 2 * exact                  # the signatures do exclude
