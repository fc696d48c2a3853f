"""The pipeline's near-duplicate stage keeps one physical row of each group."""

import random
from collections import Counter

import corpus_pipeline
from cases import documents, frame, jaccard_components, prose


def expected(rows):
    """(doc_id, text) counts that stay: one row per component, smallest id, null ids last."""
    comp = jaccard_components([(k, r[1]) for k, r in enumerate(rows)])
    best, out = {}, Counter()
    for k, n, c in comp:
        i, text = rows[k][:2]
        if not n:
            out[i, text] += 1
        else:
            best[c] = min(best.get(c, (True, 1 << 62, "~")), (i is None, i or 0, text))
    out.update((None if null else i, text) for null, i, text in best.values())
    return out


def check(spark, rows):
    df = frame(spark, rows)
    out = corpus_pipeline.near_duplicate_stage(spark, df, None)
    assert out.columns == corpus_pipeline.COLUMNS
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    exp = expected(rows)
    # of rows alike in id and n-gram set any text may stay
    alike = lambda c: Counter({(i, (t or "").lower()): 0 for i, t in c}) + Counter(
        {(i, (t or "").lower()): n for (i, t), n in c.items()})
    assert sum(got.values()) == sum(exp.values())
    assert alike(got) == alike(exp)


def test_repeated_rows_ids_and_nulls(spark):
    rng = random.Random(2)

    def near(text, k):
        w = text.split(" ")
        w[rng.randrange(len(w))] = "edit%d" % k
        return " ".join(w)
    hot, lone, zero = prose(rng, 80), prose(rng, 80), prose(rng, 40)
    rows = [(5, hot, "en", "a")] * 60 + [(100 + k, near(hot, k), "en", "a") for k in range(9)]
    rows += [(101, prose(rng, 60), "en", "a"), (5, prose(rng, 60), "en", "a")]   # other texts
    rows += [(None, hot, "en", "a")] * 3 + [(None, near(hot, 90), "en", "a")]
    rows += [(None, lone, "en", "a")] * 4 + [(None, near(lone, 91), "en", "a")]
    rows += [(None, zero, "en", "a"), (0, zero, "en", "a")]
    rows += [(7, "", "en", "a"), (7, None, "en", "a"), (7, " \n", "en", "a"), (None, "", "en", "a")] * 2
    rows += [(200 + k, prose(rng, 50), "en", "a") for k in range(9)]
    check(spark, rows)


def test_odd_documents(spark):
    check(spark, documents())


def test_empty_table(spark):
    assert corpus_pipeline.near_duplicate_stage(spark, frame(spark, []), None).count() == 0
