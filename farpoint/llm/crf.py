"""Language ID by a linear-chain conditional random field over the words of a text.

Every word has affix features (first and last 1 to 3 bytes), character 2- and
3-grams, and a lexicon feature (the word itself), hashed into a weight table
with one weight per language.  Transition weights between the languages of
neighbouring words are learned with them, from code-switched sequences put
together of segments of labelled documents.  Forward-backward gives each word
its language probabilities; a document's language is the one with the largest
sum.  Long texts are cut into blocks whose transfer matrices are combined, so
all blocks of a batch advance together; the result is that of the whole text.

The model is fitted on a bounded sample (TRAIN_DOCS documents per language, in
expectation, chosen by a hash of the id, SEGMENTS segments of SEGMENT words of
each); all documents are labelled.

Defined cases: null text or text without a letter: ``und``, score 0; no labelled
row: all ``und``; rows that repeat are judged each; ties go to the first language
by code point; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

TRAIN_DOCS = 400          # per language
SEGMENTS, SEGMENT = 4, 24
SEQUENCES, LENGTH = 2000, 64
EPOCHS, RATE, DECAY = 30, 0.3, 1e-4
BITS = 18                 # log2 of the hashed weight table
BLOCK = 64                # words advanced together

U = W.U


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray       # (2^BITS, languages)
    trans: np.ndarray         # log transition weights (from, to)


def word_features(buf: np.ndarray, start: np.ndarray, end: np.ndarray,
                  whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, first feature of each word) of the words ``start:end`` of ``buf``.

    A word's features stand together: 6 affixes, the word, its 2- and 3-grams
    with a mark before and after.
    """
    n = end - start
    flat_n = n + 2                                     # with both marks
    first = np.concatenate([[0], np.cumsum(flat_n)])
    which = np.repeat(np.arange(len(n)), flat_n)
    pos = np.arange(first[-1]) - first[which]
    sym = buf[np.clip(start[which] + pos - 1, 0, max(0, len(buf) - 1))].astype(U)
    sym[pos == 0] = 256
    sym[pos == flat_n[which] - 1] = 257
    two = np.append(sym[1:], U(0)) * U(0x1F123BB5) + sym * U(0x9E3779B1)
    three = np.append(two[1:], U(0)) * U(0x85EBCA6B) + sym + U(1 << 40)
    two_ok = pos < flat_n[which] - 1
    three_ok = pos < flat_n[which] - 2
    ids, owner = [W.mix(two[two_ok] + U(2 << 50)), W.mix(three[three_ok] + U(3 << 50))], [
        which[two_ok], which[three_ok]]
    pre = np.zeros(len(n), U)
    suf = np.zeros(len(n), U)
    for k in range(3):
        ok = n > k
        pre[ok] = pre[ok] * U(0x100000001B3) + buf[start[ok] + k].astype(U) + U(1)
        suf[ok] = suf[ok] * U(0x100000001B3) + buf[end[ok] - 1 - k].astype(U) + U(1)
        ids += [W.mix(pre[ok] + U((4 + k) << 50)), W.mix(suf[ok] + U((7 + k) << 50))]
        owner += [np.flatnonzero(ok)] * 2
    ids.append(W.mix(whole + U(10 << 50)))
    owner.append(np.arange(len(n)))
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ((ids[order] >> U(64 - BITS)).astype(np.int64),
            np.searchsorted(owner[order], np.arange(len(n))))


def emissions(buf: np.ndarray, w: W.Words, weights: np.ndarray) -> np.ndarray:
    """Emission scores (word, language) of all words of a chunk; equal words are scored once."""
    _, at, inv = np.unique(w.hash, return_index=True, return_inverse=True)
    out = np.empty((len(at), weights.shape[1]), np.float32)
    for a in range(0, len(at), 1 << 14):
        sel = at[a:a + (1 << 14)]
        ids, first = word_features(buf, w.start[sel], w.end[sel], w.hash[sel])
        out[a:a + len(sel)] = np.add.reduceat(weights[ids], first, axis=0)
    return out[inv]


def _norm(x: np.ndarray, axes) -> np.ndarray:
    return x / x.max(axis=axes, keepdims=True)


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Forward-backward probabilities of all words; documents are ``first[i]:first[i + 1]``."""
    n, lang = e.shape
    if not n:
        return np.zeros((0, lang))
    count = np.diff(first)
    docs = np.flatnonzero(count)
    blocks = -(-count[docs] // BLOCK)
    b0 = np.concatenate([[0], np.cumsum(blocks)])
    nb = int(b0[-1])
    nth = np.arange(nb) - np.repeat(b0[:-1], blocks)
    start = np.repeat(first[docs], blocks) + nth * BLOCK
    size = np.minimum(BLOCK, np.repeat(first[docs + 1], blocks) - start)
    a = np.exp(trans - trans.max())
    p = np.exp(e - e.max(axis=1, keepdims=True)).astype(np.float64)
    at = start[:, None] + np.arange(BLOCK)
    live = np.arange(BLOCK) < size[:, None]
    em = p[np.minimum(at, n - 1)]                       # (block, BLOCK, language)
    # transfer matrix of each block: row vector before it -> row vector after it
    m = np.broadcast_to(np.eye(lang), (nb, lang, lang)).copy()
    for t in range(BLOCK):
        on = live[:, t]
        if not on.any():
            break
        step = _norm((m[on] @ a) * em[on, t][:, None, :], (1, 2))
        m[on] = step
    alpha_in = np.full((nb, lang), 1.0 / lang)
    beta_out = np.ones((nb, lang))
    for k in range(1, int(blocks.max())):               # all documents' k-th blocks together
        b = b0[:-1][blocks > k] + k
        alpha_in[b] = _norm(np.einsum("bi,bij->bj", alpha_in[b - 1], m[b - 1]), 1)
        z = b0[1:][blocks > k] - 1 - k
        beta_out[z] = _norm(np.einsum("bij,bj->bi", m[z + 1], beta_out[z + 1]), 1)
    alpha = np.empty((nb, BLOCK, lang))
    v = alpha_in
    for t in range(BLOCK):
        v = np.where(live[:, t, None], _norm((v @ a) * em[:, t], 1), v)
        alpha[:, t] = v
    out = np.empty((n, lang))
    v = beta_out
    for t in range(BLOCK - 1, -1, -1):
        on = live[:, t]
        g = alpha[on, t] * v[on]
        out[at[on, t]] = g / g.sum(axis=1, keepdims=True)
        v = np.where(on[:, None], _norm((em[:, t] * v) @ a.T, 1), v)
    return out


def training_segments(docs: DataFrame, counts: dict[str, int]) -> list[tuple[str, list[bytes]]]:
    """Word segments of the sampled documents (doc_id, text, lang), in a fixed order.

    Per language the TRAIN_DOCS rows with the least hashes of (doc_id, text) are taken; rows
    are thinned to twice as many in expectation before they are ranked.
    """
    share = F.create_map(*[x for k, v in counts.items()
                           for x in (F.lit(k), F.lit(min(1.0, 2 * TRAIN_DOCS / v)))])
    point = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30))
    first = Win.partitionBy("lang").orderBy("point", F.col("doc_id").asc_nulls_last(), "text")
    picked = (docs.withColumn("point", point).filter(F.col("point") / (1 << 30) < share[F.col("lang")])
              .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= TRAIN_DOCS))

    def run(batches):
        for b in batches:
            lang, key, seg = [], [], []
            for c in W.chunks(b.column(1)):
                w = W.words(c)
                for i in range(c.n):
                    a, z = int(w.first[i]), int(w.first[i + 1])
                    for k in range(SEGMENTS):
                        s = a + (z - a) * k // SEGMENTS
                        ws = [c.buf[w.start[j]:w.end[j]].tobytes()
                              for j in range(s, min(s + SEGMENT, z))]
                        if ws:
                            lang.append(b.column(2)[c.lo + i])
                            key.append(b.column(0)[c.lo + i])
                            seg.append(b" ".join(ws))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.as_py() for x in lang], pa.string()),
                 pa.array([x.as_py() for x in key], pa.int64()), pa.array(seg, pa.binary())],
                names=["lang", "key", "words"])
    rows = (picked.select("doc_id", "text", "lang").mapInArrow(
        run, "lang string, key bigint, words binary").collect())
    return [(r["lang"], bytes(r["words"]).split(b" ")) for r in
            sorted(rows, key=lambda r: (r["lang"], r["key"] is None, r["key"] or 0, bytes(r["words"])))]


def fit(segments: list[tuple[str, list[bytes]]]) -> Model | None:
    """Maximum likelihood by adaptive gradient steps on code-switched sequences."""
    langs = sorted({x for x, _ in segments})
    if not langs:
        return None
    rng = np.random.default_rng(7)
    by = [[s for x, s in segments if x == y] for y in langs]
    index: dict[bytes, int] = {}
    x = np.zeros((SEQUENCES, LENGTH), np.int64)
    y = np.zeros((SEQUENCES, LENGTH), np.int64)
    for i in range(SEQUENCES):
        t, lang = 0, int(rng.integers(len(langs)))
        while t < LENGTH:
            s = by[lang][int(rng.integers(len(by[lang])))]
            s = s[:int(rng.integers(4, SEGMENT + 1))] if i % 2 else s
            for word in s[:LENGTH - t]:
                x[i, t], y[i, t] = index.setdefault(word, len(index)), lang
                t += 1
            if i % 2:                                    # every other sequence switches
                lang = int(rng.integers(len(langs)))
    vocabulary = list(index)
    size = np.array([len(v) for v in vocabulary])
    buf = np.frombuffer(b"".join(vocabulary), np.uint8)
    end = np.cumsum(size)
    ids, first = word_features(buf, end - size, end, W.segment_hash(buf, end - size, end))
    n_feat = np.diff(np.append(first, len(ids)))
    used, ids = np.unique(ids, return_inverse=True)
    k = len(langs)
    w, a = np.zeros((len(used), k)), np.zeros((k, k))
    gw, ga = np.full_like(w, 1e-8), np.full_like(a, 1e-8)
    gold = np.eye(k)[y]
    gold_pairs = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    for _ in range(EPOCHS):
        e = np.add.reduceat(w[ids], first, axis=0)[x]
        p = np.exp(e - e.max(axis=2, keepdims=True))
        m = np.exp(a - a.max())
        alpha, beta = np.empty_like(p), np.ones_like(p)
        v = np.full((SEQUENCES, k), 1.0 / k)
        for t in range(LENGTH):
            v = _norm((v @ m) * p[:, t], 1)
            alpha[:, t] = v
        v = np.ones((SEQUENCES, k))
        for t in range(LENGTH - 1, 0, -1):
            v = _norm((p[:, t] * v) @ m.T, 1)
            beta[:, t - 1] = v
        g = alpha * beta
        g /= g.sum(axis=2, keepdims=True)
        pair = np.einsum("nti,ntj->ntij", alpha[:, :-1], p[:, 1:] * beta[:, 1:]) * m
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        da = (gold_pairs - pair.sum(axis=(0, 1))) / SEQUENCES - DECAY * a
        diff = (gold - g).reshape(-1, k)
        dw = np.empty_like(w)
        for j in range(k):
            per_word = np.bincount(x.ravel(), diff[:, j], len(vocabulary))
            dw[:, j] = np.bincount(ids, np.repeat(per_word, n_feat), len(used))
        dw = dw / SEQUENCES - DECAY * w
        gw += dw ** 2
        ga += da ** 2
        w += RATE * dw / np.sqrt(gw)
        a += RATE * da / np.sqrt(ga)
    weights = np.zeros((1 << BITS, k), np.float32)
    weights[used] = w
    return Model(langs, weights, a)


def train(docs: DataFrame) -> Model | None:
    """Fit on the labelled rows of ``docs`` (doc_id, text, lang)."""
    ok = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in
              ok.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    return fit(training_segments(ok, counts)) if counts else None


def _labelled(docs: DataFrame, model: Model, fn, schema: str) -> DataFrame:
    """``fn(doc_id column, per-document (words, probabilities))`` over (doc_id, text)."""
    Scratch(docs.sparkSession, "crf")            # small batches of texts
    b = docs.sparkSession.sparkContext.broadcast((model.weights, model.trans))

    def run(batches):
        weights, trans = b.value
        for batch in batches:
            for c in W.chunks(batch.column(1)):
                w = W.words(c)
                g = marginals(emissions(c.buf, w, weights), w.first, trans)
                yield fn(batch.column(0).slice(c.lo, c.n), w, g)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def label_words(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, runs): maximal runs of words of one language, [{lang, first_word, n_words}]."""
    langs = np.array(model.langs)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()),
                               ("n_words", pa.int64())]))

    def fn(ids, w, g):
        best = g.argmax(axis=1)
        rows = []
        for a, z in zip(w.first[:-1], w.first[1:]):
            y = best[a:z]
            cut = np.append(np.flatnonzero(np.append(True, y[1:] != y[:-1])), len(y)) if z > a else [0]
            rows.append([{"lang": str(langs[y[i]]), "first_word": int(i), "n_words": int(j - i)}
                         for i, j in zip(cut[:-1], cut[1:])])
        return pa.RecordBatch.from_arrays([ids, pa.array(rows, kind)], names=["doc_id", "runs"])
    return _labelled(docs, model, fn, "doc_id bigint, "
                     "runs array<struct<lang:string,first_word:bigint,n_words:bigint>>")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, n_switches) for every row of ``docs`` (doc_id, text)."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.when(letter, F.col("text")).alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("bigint").alias("n_switches"))
    langs = model.langs

    def fn(ids, w, g):
        n = np.diff(w.first)
        total = np.concatenate([np.zeros((1, g.shape[1])), np.cumsum(g, axis=0)])
        sums = total[w.first[1:]] - total[w.first[:-1]]
        best = sums.argmax(axis=1)
        score = np.where(n > 0, sums.max(axis=1) / np.maximum(n, 1), 0.0)
        y = g.argmax(axis=1)
        change = np.append(0, np.cumsum((y[1:] != y[:-1]) & (w.doc[1:] == w.doc[:-1]))) if len(
            y) else np.zeros(1, np.int64)
        switches = np.where(n > 0, change[np.maximum(w.first[1:] - 1, 0)]
                            - change[np.minimum(w.first[:-1], len(change) - 1)], 0)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([langs[k] if m else "und" for k, m in zip(best, n)], pa.string()),
             pa.array(np.clip(score, 0.0, 1.0)), pa.array(switches.astype(np.int64))],
            names=["doc_id", "lang_pred", "score", "n_switches"])
    return _labelled(rows, model, fn,
                     "doc_id bigint, lang_pred string, score double, n_switches bigint")
