"""N-gram Jaccard self join with multiple-global-order filtering.

A document is the set of its distinct word 5-grams (fingerprints); two
documents link when 100 * |intersection| >= 75 * |union|.  For any total order
of all n-grams, two linked sets share an n-gram among the first
n - ceil(0.75 n) + 1 of each.  The join uses three orders, all with the
corpus-wide frequent n-grams last (lines and passages that many documents
share then rarely stand in a prefix), the others by three different hashes:

1. order 1 makes the candidates: an index of the prefix n-grams, of which only
   those in two different sets are kept;
2. each order filters: with c shared prefix n-grams, no more than c plus the
   longer rest beyond a prefix can be shared in all, which must reach the
   overlap that the threshold asks for; the filters of the three orders are
   intersected;
3. the survivors are verified on their whole sets.

Equal sets are one class from the start.  Where many classes share an n-gram,
they are first tried against one or two pivots (the classes whose n-grams are
the most shared, such as the original of near copies).  Then the components found
are compared: each class that may still link to a component is tried against a few
of its members that share the most prefix n-grams with it.  The index makes
all pairs only between classes that are not connected by then, so a large group
of near copies costs few pairs more than it has members.  Links inside a known
component are not needed for the classes that the join returns.

The texts are made into n-grams in three whole passes (signatures with the counts of
the frequent n-grams, the index twice).  Whole sets are read again only for the rows whose
hash of (doc_id, text) passes a Bloom filter of the classes under test.

Which n-grams count as frequent changes the speed only, never the result.

Defined cases: null or empty text or no words: empty set, linked with nothing;
1 to 4 words: the whole sequence is the one n-gram; equal rows are copies of
one another; rows with a null doc_id link like others, and a component has
the smallest doc_id of its rows (null if none has one); an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farpoint.llm import bloom
from farpoint.llm import words as W
from farpoint.llm.components import connected_components
from farpoint.llm.scratch import Scratch

N = 5                     # words of an n-gram
NUM, DEN = 3, 4           # similarity threshold 3/4
STAR_GROUP = 16           # classes that share an n-gram in a large group
STAR_PIVOTS = 2           # pivots that a class is tried against in a round
BRIDGES = 4               # members of a component that a class outside is tried against
ORDER_SEEDS = (21, 22, 23)
FLUSH = 1 << 21           # n-grams counted together inside a task
MIN_FLUSH = 4             # n-grams found less often in FLUSH n-grams are not counted
MIN_HOT = 32              # an n-gram counted this often is frequent
MAX_HOT = 1 << 20         # frequent n-grams that are broadcast (8 MB); the most frequent ones

U = W.U


def shingle_sets(c: W.Chunk, n: int = N) -> list[np.ndarray]:
    """Sorted distinct n-gram fingerprints of every document of a chunk."""
    w = W.words(c, lower=True)
    at, h = W.windows(w, n)
    cut = np.searchsorted(at, w.first)
    count = np.diff(w.first)
    out = []
    for i in range(c.n):
        if count[i] >= n:
            s = h[cut[i]:cut[i + 1]]
            s.sort()
            if len(s) > 1:
                s = s[np.append(True, s[1:] != s[:-1])]
        elif count[i]:
            x = U(0)
            with np.errstate(over="ignore"):
                for v in w.hash[w.first[i]:w.first[i + 1]]:
                    x = x * W._R + v
                s = W.mix(np.array([x + U(1000 + count[i])], U))
        else:
            s = np.zeros(0, U)
        out.append(s)
    return out


def set_fingerprint(s: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        return W.mix(np.array([W.mix(s ^ U(77)).sum(dtype=U) + U(len(s))], U))[0]


def prefix_len(n: int) -> int:
    return n - (NUM * n + DEN - 1) // DEN + 1


def order_ranks(hot: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hot, rank under order 0, 1, ...): the frequent n-grams, sorted, the rarer ranked first."""
    ranks = []
    for seed in ORDER_SEEDS:
        r = np.empty(len(hot), np.uint32)
        r[np.lexsort((W.mix(hot ^ U(seed)), count))] = np.arange(len(hot), dtype=np.uint32)
        ranks.append(r)
    return (hot, *ranks)


def prefix(s: np.ndarray, order: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    """The prefix n-grams of the set ``s`` under order ``k``: by a hash, frequent ones last."""
    p = prefix_len(len(s))
    if p >= len(s):
        return s
    key = W.mix(s ^ U(ORDER_SEEDS[k])) >> U(1)
    hot = order[0]
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        is_hot = hot[at] == s
        key[is_hot] = (U(1) << U(63)) | order[k + 1][at[is_hot]].astype(U)
    return s[np.argpartition(key, p - 1)[:p]]


def _i64(x) -> pa.Array:
    return pa.array(np.asarray(x, dtype=U).view(np.int64))


def _lists(parts: list[np.ndarray], dtype) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.astype(dtype, copy=False)))


def _row_key() -> Column:
    """Fingerprint of (doc_id, text): names a row, and the representative row of a class."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _pass(docs: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn(iterator of (doc_id array, key array, list of sets))`` over (doc_id, text, k)."""
    def run(batches):
        def sets():
            for b in batches:
                for c in W.chunks(b.column(1)):
                    yield b.column(0).slice(c.lo, c.n), b.column(2).slice(c.lo, c.n), shingle_sets(c)
        yield from fn(sets())
    return docs.select("doc_id", "text", "k").mapInArrow(run, schema)


def _signatures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, k, n_shingles, fp) of the documents, and rows (h, n) of repeated n-grams."""
    names = ["doc_id", "k", "n_shingles", "fp", "h", "n"]

    def none(n):
        return pa.nulls(n, pa.int64())

    def fn(it):
        held, size, seen = [], 0, set()

        def flush():
            v, n = np.unique(np.concatenate(held), return_counts=True)
            v, n = v[n >= MIN_FLUSH], n[n >= MIN_FLUSH]
            return pa.RecordBatch.from_arrays(
                [*[none(len(v))] * 4, _i64(v), pa.array(n.astype(np.int64))], names=names)
        for ids, keys, sets in it:
            fp = np.array([set_fingerprint(s) for s in sets], U)
            yield pa.RecordBatch.from_arrays(
                [ids, keys, pa.array([len(s) for s in sets], pa.int64()), _i64(fp),
                 none(len(sets)), none(len(sets))], names=names)
            for x, s in zip(fp.tolist(), sets):
                if len(s) and x not in seen:
                    seen.add(x)
                    held.append(s)
                    size += len(s)
            if size >= FLUSH:
                yield flush()
                held, size, seen = [], 0, set()
        if held:
            yield flush()
    return _pass(docs, fn, ", ".join(f"{x} bigint" for x in names))


def _frequent(found: DataFrame, scratch: Scratch) -> tuple[np.ndarray, ...]:
    """The order that puts the most frequent n-grams of all documents last."""
    counts = scratch.save(found.filter("h is not null").groupBy("h").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= MIN_HOT))
    # the least power of two at or above MIN_HOT that leaves MAX_HOT n-grams at most
    level = {int(r["k"]): r["c"] for r in counts.groupBy(F.floor(F.log2("n")).alias("k")).agg(
        F.count(F.lit(1)).alias("c")).collect()}
    least, total = 62, 0
    for k in sorted(level, reverse=True):
        if total + level[k] > MAX_HOT:
            break
        least, total = k, total + level[k]
    t = counts.filter(F.col("n") >= (1 << least)).toArrow()
    h = np.asarray(t["h"], dtype=np.int64).view(U)
    at = np.argsort(h)
    scratch.drop(counts)
    return order_ranks(h[at], np.asarray(t["n"], dtype=np.int64)[at])


def _prefix_index(docs: DataFrame, order, live=None) -> DataFrame:
    """(h, fp): the order-1 prefix n-grams of every distinct set; ``live``: only possible hits.

    ``order`` and ``live`` are broadcast variables of bounded size.
    """
    def fn(it):
        seen: set[int] = set()
        for _, _, sets in it:
            hs, fps = [], []
            for s in sets:
                fp = set_fingerprint(s)
                if not len(s) or int(fp) in seen:
                    continue
                seen.add(int(fp))
                p = prefix(s, order.value, 0)
                if live is not None:
                    p = p[bloom.hits(live.value, p)]
                hs.append(p)
                fps.append(np.full(len(p), fp, U))
            if hs:
                yield pa.RecordBatch.from_arrays(
                    [_i64(np.concatenate(hs)), _i64(np.concatenate(fps))], names=["h", "fp"])
    return _pass(docs, fn, "h bigint, fp bigint")


def _sets_of(docs: DataFrame, wanted: DataFrame, order, scratch: Scratch) -> DataFrame:
    """(fp, n, p2, p3, s) of the classes ``wanted`` (k): filters of orders 2 and 3, whole set.

    Only rows that pass the Bloom filter of the keys reach Python; false hits do no harm.
    """
    maybe, _ = bloom.split(docs, F.col("k"), bloom.build(wanted, "k", wanted.count()))

    def fn(it):
        seen: set[int] = set()
        for _, _, sets in it:
            fp = np.array([set_fingerprint(s) for s in sets], U)
            ok = []
            for i, s in enumerate(sets):
                if int(fp[i]) not in seen and len(s):
                    seen.add(int(fp[i]))
                    ok.append(i)
            for j in range(0, len(ok), 256):
                part = ok[j:j + 256]
                keep = [sets[i] for i in part]
                yield pa.RecordBatch.from_arrays([
                    _i64(fp[part]), pa.array([len(s) for s in keep], pa.int64()),
                    *[_lists([prefix(s, order.value, k).view(np.int64) for s in keep], np.int64)
                      for k in (1, 2)],
                    _lists([s.view(np.int64) for s in keep], np.int64)],
                    names=["fp", "n", "p2", "p3", "s"])
    return scratch.save(_pass(maybe, fn, "fp bigint, n bigint, p2 array<bigint>, p3 array<bigint>, "
                                         "s array<bigint>"))


def _side(t: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return t.select(F.col("fp").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in cols])


def _rest(n) -> Column:
    """n-grams of a set of n beyond its prefix, as a column."""
    return F.ceil(n * NUM / DEN).cast("bigint") - 1


def _reaches(shared, n_a, n_b) -> Column:
    """Whether ``shared`` prefix n-grams leave the threshold within reach.

    Of the two prefixes, take the one that ends first in the order: whatever
    else its set shares lies beyond that prefix.  The overlap must be at least
    NUM / (NUM + DEN) of the sizes' sum.
    """
    most = shared + F.greatest(_rest(n_a), _rest(n_b))
    return ((NUM + DEN) * most >= NUM * (n_a + n_b)) & (
        DEN * F.least(n_a, n_b) >= NUM * F.greatest(n_a, n_b))


def _verify(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that link: filters of orders 2 and 3 first, then the whole sets."""
    few = (pairs.join(_side(sets, "a", ["n", "p2", "p3"]), "a")
           .join(_side(sets, "b", ["n", "p2", "p3"]), "b"))
    for p in ("p2", "p3"):
        both = F.size(F.array_intersect(f"{p}_a", f"{p}_b"))
        few = few.filter(_reaches(both, F.col("n_a"), F.col("n_b")))
    few = scratch.save(few.select("a", "b").distinct())
    both = F.size(F.array_intersect("s_a", "s_b"))
    out = (few.join(_side(sets, "a", ["n", "s"]), "a").join(_side(sets, "b", ["n", "s"]), "b")
           .withColumn("i", both)
           .filter(DEN * F.col("i") >= NUM * (F.col("n_a") + F.col("n_b") - F.col("i")))
           .select("a", "b"))
    links = scratch.save(out)
    scratch.drop(few)
    return links


def _try_pairs(docs, pairs, classes, order, scratch) -> DataFrame:
    """Verify candidate pairs (a, b) of classes; returns the links among them."""
    ends = pairs.select(F.col("a").alias("fp")).unionByName(
        pairs.select(F.col("b").alias("fp"))).distinct()
    wanted = scratch.save(ends.join(classes.select("fp", "k"), "fp").select("k"))
    sets = _sets_of(docs, wanted, order, scratch)
    links = _verify(pairs, sets, scratch)
    scratch.drop(wanted, sets)
    return links


def _star_pairs(entries: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of pivots and the other classes of large groups: STAR_PIVOTS each, at most.

    The pivot of an n-gram is the class with the largest sum of group sizes.
    """
    large = entries.filter(F.col("d") >= STAR_GROUP)
    score = large.groupBy("fp").agg(F.sum("d").alias("score"))
    large = scratch.save(large.join(score, "fp"))
    pivot = scratch.save(large.groupBy("h").agg(F.max_by(
        F.struct(F.col("fp").alias("a"), F.col("n").alias("n_a")),
        F.struct("score", "fp")).alias("p")).select("h", "p.*"))
    tried = (large.join(pivot, "h").filter(
        (F.col("fp") != F.col("a"))
        & (DEN * F.least("n", "n_a") >= NUM * F.greatest("n", "n_a")))
        .groupBy("a", F.col("fp").alias("b")).agg(F.count(F.lit(1)).alias("shared")))
    best = Win.partitionBy("b").orderBy(F.desc("shared"), "a")
    return scratch.save(tried.withColumn("r", F.row_number().over(best))
                        .filter(F.col("r") <= STAR_PIVOTS).select("a", "b"))


def _component_pairs(entries: DataFrame, comp: DataFrame, scratch: Scratch):
    """(entries with their component c, pairs of two lone classes, pairs (c_a, c_b) of the others).

    The n-grams that two components share bound what any two of their members
    share.  For components of one class each that is the pair's own count.  Of the others
    c_b is the one with linked classes, or the larger label if both have.
    """
    known = scratch.save(entries.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "h", "fp", "n", F.coalesce("label", "fp").alias("c"), F.col("label").isNotNull().alias("linked")))
    groups = scratch.save(known.groupBy("h", "c").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("linked").alias("linked")))
    mixed = scratch.save(groups.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
                         .filter("k > 1").select("h"))
    groups = scratch.save(groups.join(mixed, "h"))
    a, b = (groups.select("h", *[F.col(x).alias(f"{x}_{y}") for x in ("c", "lo", "hi", "linked")])
            for y in "ab")
    # some sizes within the ranges must be within the threshold
    sized = (DEN * F.col("hi_a") >= NUM * F.col("lo_b")) & (DEN * F.col("hi_b") >= NUM * F.col("lo_a"))
    # each pair once: the lone class first, else the smaller label
    once = (F.struct("linked_a", "c_a") < F.struct("linked_b", "c_b"))
    shared = F.col("shared")
    both = scratch.save(a.join(b, "h").filter(once & sized).groupBy("c_a", "c_b").agg(
        F.count(F.lit(1)).alias("shared"), F.min("lo_a").alias("lo_a"), F.max("hi_a").alias("hi_a"),
        F.min("lo_b").alias("lo_b"), F.max("hi_b").alias("hi_b"), F.max("linked_b").alias("linked"))
        # (NUM + DEN) * (shared + rest) >= NUM * (n_a + n_b) for the best sizes, rest <= 3/4 n
        .filter((28 * shared >= 12 * F.col("lo_a") - 9 * F.col("hi_b"))
                | (28 * shared >= 12 * F.col("lo_b") - 9 * F.col("hi_a"))))
    scratch.drop(groups, mixed)
    direct = (both.filter(~F.col("linked")).filter(_reaches(shared, F.col("lo_a"), F.col("lo_b")))
              .select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))
    return known, direct, both.filter("linked").select("c_a", "c_b")


def _bridges(known: DataFrame, wide: DataFrame) -> DataFrame:
    """(a, b): the classes of c_a with the members of c_b that are most likely to link to them.

    For every n-gram of c_b a few members stand, chosen by hashes of the member, so a member
    stands for many of its n-grams; per class a those that share the most n-grams with it remain.
    """
    stand = known.filter("linked").groupBy("h", F.col("c").alias("c_b")).agg(F.array_distinct(F.array(*[
        F.min_by("fp", F.xxhash64("fp", F.lit(k))) for k in range(BRIDGES)])).alias("bs"))
    outside = known.select("h", F.col("fp").alias("a"), F.col("c").alias("c_a"))
    tried = (outside.join(wide, "c_a").join(stand, ["h", "c_b"])
             .select("a", F.explode("bs").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")))
    best = Win.partitionBy("a").orderBy(F.desc("shared"), "b")
    return tried.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= BRIDGES).select("a", "b")


def _member_pairs(known: DataFrame, wide: DataFrame, comp: DataFrame) -> DataFrame:
    """(a, b): the pairs of classes of ``wide`` components not connected by now, by the filter of order 1."""
    def now(c):
        return comp.select(F.col("node").alias(c), F.col("label").alias(f"{c}_now"))
    left_over = (wide.join(now("c_a"), "c_a", "left").join(now("c_b"), "c_b", "left")
                 .filter(F.coalesce("c_a_now", "c_a") != F.coalesce("c_b_now", "c_b")).select("c_a", "c_b"))
    left = known.select("h", F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("c").alias("c_a"))
    right = known.select("h", F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("c").alias("c_b"))
    return (left.join(left_over, "c_a").join(right, ["h", "c_b"])
            .filter(DEN * F.least("n_a", "n_b") >= NUM * F.greatest("n_a", "n_b"))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"),
                                   F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))
            .filter(_reaches(F.col("shared"), F.col("n_a"), F.col("n_b"))).select("a", "b"))


def _classes(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows with their signatures, (class, label, component_id) of the classes).

    Components of different texts may have the same component_id where ids repeat; their
    labels differ.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.col("text").cast("string").alias("text")).withColumn("k", _row_key())
    found = scratch.save(_signatures(texts))
    rows = found.filter("fp is not null").select("doc_id", "k", "n_shingles", "fp")
    classes = scratch.save(rows.filter("n_shingles > 0").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.coalesce(F.min_by("k", "doc_id"), F.min("k")).alias("k"),
        F.max("n_shingles").alias("n")))
    order = spark.sparkContext.broadcast(_frequent(found, scratch))

    # index of order 1: n-grams that stand in the prefixes of two sets or more
    live = scratch.save(_prefix_index(texts, order).groupBy("h").agg(
        F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count(F.lit(1)).alias("d"))
        .filter("lo < hi").select("h", "d"))
    possible = spark.sparkContext.broadcast(bloom.build(live, "h", live.count()))
    entries = scratch.save(_prefix_index(texts, order, possible).distinct()
                           .join(live, "h").join(classes.select("fp", "n"), "fp"))
    links = _try_pairs(texts, _star_pairs(entries, scratch), classes, order, scratch)
    known, direct, wide = _component_pairs(entries, connected_components(links, scratch), scratch)
    near = scratch.save(direct.unionByName(_bridges(known, wide)).distinct())
    links = scratch.save(links.unionByName(_try_pairs(texts, near, classes, order, scratch)))
    comp = connected_components(links, scratch)
    rest = scratch.save(_member_pairs(known, wide, comp).join(near, ["a", "b"], "left_anti"))
    if rest.limit(1).count():
        links = links.unionByName(_try_pairs(texts, rest, classes, order, scratch))
        comp = connected_components(links, scratch)

    named = (classes.select("fp", "rep").join(comp.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("label", F.coalesce("label", "fp")))
    first = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    classes_out = scratch.save(named.join(first, "label").select(
        F.col("fp").alias("class"), "label", "component_id"))
    scratch.keep_only(found, classes_out)
    return rows, classes_out


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    rows, classes_out = _classes(docs, Scratch(docs.sparkSession, "ngram_join"))
    some, empty = rows.filter("n_shingles > 0"), rows.filter("n_shingles = 0")
    return (some.join(classes_out, F.col("fp") == F.col("class"))
            .select("doc_id", "n_shingles", "component_id")
            .unionByName(empty.select("doc_id", "n_shingles",
                                      F.col("doc_id").alias("component_id"))))


def keep_one_row(docs: DataFrame) -> DataFrame:
    """One row of each group of linked rows stays: the one with the smallest doc_id, null ids last.

    Rows are told apart by doc_id and text, so ids may repeat; of rows alike
    in both one stays.  Rows without words all stay.  Whole rows are read again and
    shuffled only where a Bloom filter of the ids says that they may have to go.
    """
    scratch = Scratch(docs.sparkSession, "ngram_join")
    rows, classes = _classes(docs, scratch)
    keys = scratch.save(rows.filter("n_shingles > 0").groupBy("k", "fp").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
        .join(classes, F.col("fp") == F.col("class")).select("k", "label", "id", "n"))
    first = keys.groupBy("label").agg(F.min_by("k", F.struct(
        F.col("id").isNull(), "id", "k")).alias("k")).select("k")
    gone = scratch.save(keys.join(first, "k", "left_anti").select("k", "id"))
    ids = scratch.save(gone.select("id").unionByName(keys.filter("n > 1").select("id")).distinct()
                       .select(F.xxhash64("id").alias("h")))
    blocks = bloom.build(ids, "h", ids.count())
    maybe, stays = bloom.split(docs, F.xxhash64(F.col("doc_id").cast("bigint")), blocks)
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    plain = [f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType)]
    # rows of one key are copies: one is left of them before anything is shuffled
    whole = maybe.filter(has_word).select(
        F.struct(*[maybe[c] for c in maybe.columns]).alias("row"), _row_key().alias("_k"))
    alike = whole.groupBy("_k").agg(F.min_by("row", F.struct(
        F.col("row.doc_id").isNull(), "row.doc_id",
        F.xxhash64(*[F.col("row")[c] for c in plain]))).alias("row"))
    left = alike.join(gone.select(F.col("k").alias("_k")), "_k", "left_anti").select("row.*")
    return stays.unionByName(maybe.filter(~has_word)).unionByName(left)
