"""Benchmark decontamination by the q-gram lemma.

Benchmark items are normalised (A-Z lower-cased, runs of white space as one
space) and cut into disjoint pieces of PIECE to 2 * PIECE - 1 bytes (shorter items
are one piece), and into pieces of PIECE bytes that start every STEP bytes, the
last one at the item's end: every excerpt of PIECE + STEP - 1 bytes holds one of
these.  The first kind has larger budgets of edits, the second finds excerpts.
A piece of m bytes may differ from a document's region by
e = floor(EDIT_RATE * m) edits.  By the q-gram lemma such a region shares
m + 1 - q * (e + 1) q-grams or more with the piece, all on diagonals that
differ by e at most.  Every document's shared q-grams are counted in
overlapping diagonal bands (2 (e + 1) wide, a new one every e + 1), so one band
holds them all; bands that reach the bound are verified by a banded alignment.

The distinct pieces are worked off in slices of about SLICE_BYTES; one slice is
broadcast at a time, each is compared with all documents.  Pieces that many items
have in common are compared once; Spark joins the items to the matches.  The
shared q-grams of a chunk of documents are counted HITS at a time, so pieces
that are alike (near copies of one item) cost no more memory.

Defined cases: null or empty texts match nothing; items of fewer than Q bytes
after normalising match nothing (no q-gram); repeated rows are judged each;
equal items are reported each; several regions of one piece give its best one
(fewest edits, then the leftmost); empty tables give an empty result; columns
other than those named are not read or are carried untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

Q = 12
EDIT_RATE = 0.06
PIECE = 100
STEP = 50
SLICE_BYTES = 4 << 20
TABLE_BITS = 21
HITS = 1 << 21              # shared q-grams that are counted together


def normalise(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(normalised bytes, their positions in ``buf``)."""
    space = W.IS_SPACE[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    at = np.flatnonzero(keep)
    out = W.LOWER[buf[at]]
    out[space[at]] = 32
    return out, at


def cut_pieces(text: str) -> list[bytes]:
    norm, _ = normalise(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
    raw = norm.tobytes().strip()
    n = max(1, len(raw) // PIECE)
    cut = [len(raw) * i // n for i in range(n + 1)]
    ranges = set(zip(cut, cut[1:]))
    if len(raw) > PIECE:
        starts = [*range(0, len(raw) - PIECE, STEP), len(raw) - PIECE]
        ranges.update((a, a + PIECE) for a in starts)
    return [raw[a:b] for a, b in sorted(ranges) if b - a >= Q]


def edit_budget(m: int) -> int:
    """Edits allowed in a piece of m bytes; the lemma's bound stays 1 or more."""
    return max(0, min(int(EDIT_RATE * m), m // Q - 1))


def qgram_codes(norm: np.ndarray) -> np.ndarray:
    """A fingerprint of the Q bytes from every position."""
    n = len(norm) - Q + 1
    if n <= 0:
        return np.zeros(0, W.U)
    pad = np.concatenate([norm, np.zeros(16, np.uint8)])
    eight = np.empty(n + 4, W.U)
    for k in range(8):
        part = eight[k::8]
        part[:] = pad[k:k + 8 * len(part)].view(W.U)
    return W.mix(eight[:n] * W.U(0x9E3779B97F4A7C15) ^ (eight[4:n + 4] * W.U(0xC2B2AE3D27D4EB4F)))


def build_index(pieces: list[bytes]) -> dict:
    """The q-gram postings of the distinct pieces of one slice."""
    code, owner, pos = [], [], []
    for i, raw in enumerate(pieces):
        c = qgram_codes(np.frombuffer(raw, np.uint8))
        code.append(c)
        owner.append(np.full(len(c), i, np.int64))
        pos.append(np.arange(len(c), dtype=np.int64))
    code = np.concatenate(code) if code else np.zeros(0, W.U)
    order = np.argsort(code, kind="stable")
    code = code[order]
    grams, first = np.unique(code, return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[(grams >> W.U(64 - TABLE_BITS)).astype(np.int64)] = True
    m = np.array([len(p) for p in pieces], np.int64)
    e = np.array([edit_budget(x) for x in m], np.int64)
    return {"grams": grams, "first": np.append(first, len(code)), "table": table,
            "owner": np.concatenate(owner)[order] if len(code) else np.zeros(0, np.int64),
            "pos": np.concatenate(pos)[order] if len(code) else np.zeros(0, np.int64),
            "m": m, "e": e, "need": m + 1 - Q * (e + 1), "pieces": pieces}


def banded(piece: np.ndarray, text: np.ndarray, lo: int, width: int,
           start: np.ndarray) -> np.ndarray:
    """Last row of the edit distances of ``piece`` on diagonals lo .. lo + width - 1 of ``text``."""
    ar = np.arange(width)
    inf = 1 << 20
    d = start.astype(np.int64)
    for i, ch in enumerate(piece):
        j = i + lo + ar
        inside = (j >= 0) & (j < len(text))
        sub = np.where(inside, d + (text[np.clip(j, 0, max(0, len(text) - 1))] != ch), inf)
        skip = np.append(d[1:], inf) + 1
        t = np.minimum(sub, skip)
        t[(j < -1) | (j >= len(text))] = inf        # column j stands after text[j]
        d = np.minimum(np.minimum.accumulate(t - ar) + ar, inf)
    return d


def align(piece: bytes, text: np.ndarray, diag: int, e: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best region of ``text`` with diagonals diag .. diag + 2e + 1."""
    m = len(piece)
    lo, hi = max(0, diag - e), min(len(text), diag + m + 3 * e + 2)
    exact = text[lo:hi].tobytes().find(piece)
    if exact >= 0:
        return 0, lo + exact, lo + exact + m
    if e == 0:
        return None
    p = np.frombuffer(piece, np.uint8)
    width = 4 * e + 2
    first = diag - e + np.arange(width)
    d = banded(p, text, diag - e, width, np.where((first >= 0) & (first <= len(text)), 0, 1 << 20))
    k = int(np.argmin(d))
    edits = int(d[k])
    if edits > e:
        return None
    end = diag - e + k + m
    # the same alignment backwards from its end finds the start
    back = text[:end][::-1]
    k0 = np.arange(2 * e + 1) - e
    r = banded(p[::-1], back, -e, 2 * e + 1, np.where(k0 >= 0, k0, 1 << 20))
    return edits, end - (m + int(np.argmin(r)) - e), end


def band_counts(ix: dict, p: np.ndarray, g: np.ndarray, doc: np.ndarray, lowest: int,
                bands: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, piece and band as one key, shared q-grams) of the hits: q-gram g at position p.

    At most HITS pairs of a hit and a piece (or those of one hit) are held at once.
    """
    n = ix["first"][g + 1] - ix["first"][g]
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.append(0, np.cumsum(n))
    lo = 0
    while lo < len(p):
        hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + HITS, "right")) - 1)
        k = n[lo:hi]
        which = lo + np.repeat(np.arange(hi - lo), k)
        post = np.arange(len(which)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(ix["first"][g[lo:hi]], k)
        owner = ix["owner"][post]
        band = (p[which] - ix["pos"][post] + lowest) // (ix["e"][owner] + 1)
        key = (doc[which] * len(ix["m"]) + owner) * bands + band
        key, count = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        if len(keys):
            both = np.concatenate([keys, key])
            key, back = np.unique(both, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, back, np.concatenate([counts, count]))
            count = total
        keys, counts, lo = key, count, hi
    return keys, counts


def chunk_matches(c: W.Chunk, ix: dict) -> list[tuple[int, int, int, int, int]]:
    """(row of the chunk, piece, start, end, edits): best region of each matching piece."""
    norm, at = normalise(c.buf) if len(c.buf) else (c.buf, np.zeros(0, np.int64))
    code = qgram_codes(norm)
    p = np.flatnonzero(ix["table"][(code >> W.U(64 - TABLE_BITS)).astype(np.int64)])
    if not len(p) or not len(ix["grams"]):
        return []
    g = np.minimum(np.searchsorted(ix["grams"], code[p]), len(ix["grams"]) - 1)
    ok = ix["grams"][g] == code[p]
    p, g = p[ok], g[ok]
    doc = np.searchsorted(c.off, at[p], "right") - 1
    ok = at[np.minimum(p + Q - 1, len(at) - 1)] < c.off[doc + 1]
    p, g, doc = p[ok], g[ok], doc[ok]
    lowest = int(ix["m"].max())
    bands = len(norm) + lowest + 2
    key, count = band_counts(ix, p, g, doc, lowest, bands)
    owner = key // bands % len(ix["m"])
    full = count >= ix["need"][owner]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k, o in zip(key[full], owner[full]):
        d, b = int(k // bands // len(ix["m"])), int(k % bands)
        a, z = np.searchsorted(at, c.off[d]), np.searchsorted(at, c.off[d + 1])
        e = int(ix["e"][o])
        got = align(ix["pieces"][o], norm[a:z], b * (e + 1) - lowest - a, e)
        if got and got < best.get((d, int(o)), (1 << 30, 0, 0)):
            best[d, int(o)] = got
    return [(d, o, int(at[np.searchsorted(at, c.off[d]) + s] - c.off[d]),
             int(at[np.searchsorted(at, c.off[d]) + t - 1] + 1 - c.off[d]), ed)
            for (d, o), (ed, s, t) in sorted(best.items())]


def benchmark_pieces(benchmark: DataFrame) -> DataFrame:
    """(item_id, piece, raw, piece_id) of every piece of every item, as a written table."""
    def run(batches):
        for b in batches:
            out = [(i.as_py(), k, p) for i, t in zip(b.column(0), b.column(1)) if t.is_valid
                   for k, p in enumerate(cut_pieces(t.as_py()))]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                pa.array([x[2] for x in out], pa.binary())], names=["item_id", "piece", "raw"])
    return Scratch(benchmark.sparkSession, "benchmark").save(benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), "text")
        .mapInArrow(run, "item_id bigint, piece int, raw binary")
        .withColumn("piece_id", F.xxhash64("raw")))


def _slices(pieces: DataFrame) -> Iterator[tuple[dict, np.ndarray]]:
    """(index, piece_id) of the distinct pieces, each of SLICE_BYTES of text or about."""
    distinct = pieces.select("raw", "piece_id").distinct()
    size = distinct.agg(F.sum(F.length("raw"))).first()[0] or 0
    n = max(1, -(-size // SLICE_BYTES))
    for i in range(n):
        part = distinct if n == 1 else distinct.filter(F.pmod("piece_id", F.lit(n)) == i)
        rows = part.orderBy("raw").collect()
        if rows:
            yield build_index([bytes(r["raw"]) for r in rows]), np.array([r["piece_id"] for r in rows])


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and matching piece; start and end are bytes of the document's text."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, piece_id bigint, start bigint, end bigint, edits int"
    names = [x.split()[0] for x in schema.split(", ")]

    def against(index):
        ix = spark.sparkContext.broadcast(index)

        def run(batches):
            for b in batches:
                out = [(c.lo + d, *rest) for c in W.chunks(b.column(1))
                       for d, *rest in chunk_matches(c, ix.value[0])]
                row, piece, start, end, edits = (
                    np.array([x[k] for x in out], np.int64) for k in range(5))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(ix.value[1][piece]), pa.array(start),
                     pa.array(end), pa.array(edits.astype(np.int32))], names=names)
        return texts.mapInArrow(run, schema)

    pieces = benchmark_pieces(benchmark)
    parts = [against(index) for index in _slices(pieces)]
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.join(pieces.drop("raw"), "piece_id").select(
        "doc_id", "item_id", "piece", "start", "end", "edits")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_pieces, start, end, edits) of every leaked item."""
    return find_matches(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.count_distinct("piece").alias("n_pieces"), F.min("start").alias("start"),
        F.max("end").alias("end"), F.min("edits").alias("edits"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a match, columns unchanged; row by row, without a shuffle."""
    at = docs.columns.index("text")
    spark = docs.sparkSession

    def without(frame, index):
        ix = spark.sparkContext.broadcast(index)

        def run(batches):
            for b in batches:
                bad = {c.lo + x[0] for c in W.chunks(b.column(at))
                       for x in chunk_matches(c, ix.value[0])}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))
        return frame.mapInArrow(run, frame.schema)

    for index in _slices(benchmark_pieces(benchmark)):
        docs = without(docs, index)
    return docs
