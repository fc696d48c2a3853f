"""Quality rules with adaptive thresholds.

Base rules are fixed; on top, each (language, source) gets its own thresholds
from mergeable quantile sketches of the documents that pass the base rules.
Sketches of small groups are merged up to the language, then to all.

Defined cases: null text = empty (all measures 0, ``base_failed``); null lang
or source forms its own group; an empty table gives an empty result; repeated
rows are judged each on their own; only the four input columns are read, so
extra columns of any name do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

MIN_WORDS = 50          # base rule: fewer words fail
MAX_REPEAT_PCT = 50     # base rule: more words in repeated 3-word windows fail
MIN_GROUP = 200         # documents a group needs for thresholds of its own
FENCE = 4               # a measure fails beyond q75 + FENCE * (q75 - q25) ...
MARGIN = {"symbol_ratio": 50, "dup_line_ratio": 300}   # ... and beyond q75 + margin (1/1000)
BROADCAST_GROUPS = 50_000   # threshold rows up to which they are broadcast

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]

SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1


def _per_doc(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def chunk_metrics(c: W.Chunk) -> list[np.ndarray]:
    """The measures of every document of a chunk, as one array each."""
    w = W.words(c)
    n_words = np.diff(w.first)
    solid = ~W.IS_SPACE[c.buf]
    word_chars = _per_doc(solid & ((c.buf & 0xC0) != 0x80), c.off)
    n_symbols = _per_doc(SYMBOL[c.buf], c.off)
    n_lines = np.zeros(c.n, np.int64)
    n_dup = np.zeros(c.n, np.int64)
    if len(c.buf):
        # a line starts at a document's start and after each \n; its hash leaves the \n out
        brk = c.buf == 10
        begin = np.zeros(len(c.buf) + 1, bool)
        begin[c.off] = True
        begin[1:] |= brk
        ls = np.flatnonzero(begin[:-1])
        le = np.append(ls[1:], len(c.buf))
        le = le - brk[le - 1]
        solid_sum = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
        has = solid_sum[le] > solid_sum[ls]
        # only lines with a word are hashed; the bytes of the others don't count for the line before
        of_word_line = np.repeat(has, np.diff(np.append(ls, len(c.buf))))
        doc = np.searchsorted(c.off, ls[has], "right") - 1
        h = W.segment_hash(c.buf, ls[has], le[has], of_word_line & ~brk)
        n_lines = np.bincount(doc, minlength=c.n)
        _, at = np.unique(h ^ W.mix(doc.astype(W.U) + W.U(1)), return_index=True)
        n_dup = n_lines - np.bincount(doc[at], minlength=c.n)
    n_rep = np.zeros(c.n, np.int64)
    at, h = W.windows(w, 3)
    if len(at):
        key = h ^ W.mix(w.doc[at].astype(W.U) + W.U(1))
        _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
        at = at[cnt[inv] >= 2]
        cover = np.zeros(len(w.hash), bool)
        for j in range(3):
            cover[at + j] = True
        n_rep = np.bincount(w.doc[cover], minlength=c.n)
    return [n_words, word_chars, n_symbols, n_dup, n_lines, n_rep]


def text_metrics(docs: DataFrame, carry: list[str], prefix: str = "") -> DataFrame:
    """The ``carry`` columns and the measures of every row (whole texts, one pass, row by row)."""
    names = [prefix + m for m in MEASURES]
    schema = T.StructType([*[docs.select(c).schema[0] for c in carry],
                           *[T.StructField(m, T.LongType()) for m in names]])

    def run(batches):
        for b in batches:
            parts = [chunk_metrics(c) for c in W.chunks(b.column(b.num_columns - 1))]
            cols = [np.concatenate(x) for x in zip(*parts)] or [np.zeros(0, np.int64)] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *[pa.array(x.astype(np.int64)) for x in cols]],
                names=[*carry, *names])
    return docs.select(*carry, F.col("text").alias("_text")).mapInArrow(run, schema)


def _ratio_buckets(m: DataFrame) -> DataFrame:
    """Adds the two ratios in whole thousandths (the buckets of the sketches)."""
    def per_mille(part, whole):
        return F.when(F.col(whole) > 0, F.floor(1000 * F.col(part) / F.col(whole))).otherwise(
            F.lit(0)).cast("bigint")
    return (m.withColumn("symbol_ratio", per_mille("n_symbols", "word_chars"))
            .withColumn("dup_line_ratio", per_mille("n_dup_lines", "n_lines")))


def base_failed() -> F.Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def quantile_sketches(metrics: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): one histogram sketch per group and measure.

    Both ratios lie in [0, 1], so a sketch has 1001 buckets at most, its
    quantiles are right to 1/1000, and sketches merge by adding counts, in any
    order and always to the same result.
    """
    good = _ratio_buckets(metrics).filter(~base_failed())
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("bucket"))
                               for c in MARGIN]))
    return (good.select("lang", "source", each.alias("x"))
            .groupBy("lang", "source", "x.measure", "x.bucket")
            .agg(F.count(F.lit(1)).alias("n")))


def _fences(sketches: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, measure, <name>_n, <name>_fence) of the sketches merged to ``keys``."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Win.partitionBy(*keys, "measure")
    cum = (merged.withColumn("upto", F.sum("n").over(
        group.orderBy("bucket").rowsBetween(Win.unboundedPreceding, 0)))
        .withColumn("all", F.sum("n").over(group)))
    q = cum.groupBy(*keys, "measure").agg(
        F.max("all").alias(f"{name}_n"),
        *[F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bucket"))).alias(f"q{k}")
          for k in (1, 3)])
    margin = F.create_map(*[F.lit(x) for kv in MARGIN.items() for x in kv])[F.col("measure")]
    return q.select(*keys, "measure", f"{name}_n", (F.col("q3") + F.greatest(
        FENCE * (F.col("q3") - F.col("q1")), margin)).alias(f"{name}_fence"))


def adaptive_thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, max_<measure> ...), small groups by the sketch of the language or of all."""
    g = _fences(sketches, ["lang", "source"], "own")
    by_lang = _fences(sketches, ["lang"], "lang").withColumnRenamed("lang", "l")
    every = _fences(sketches, [], "all")
    t = (g.join(by_lang.withColumnRenamed("measure", "m"),
                F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m")))
         .drop("m", "l").join(every, "measure"))
    fence = (F.when(F.col("own_n") >= MIN_GROUP, F.col("own_fence"))
             .when(F.col("lang_n") >= MIN_GROUP, F.col("lang_fence"))
             .otherwise(F.col("all_fence")))
    return t.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == c, fence)).alias(f"max_{c}") for c in MARGIN])


def _verdict(m: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows with lang, source and the measures."""
    small = limits.count() <= BROADCAST_GROUPS
    t = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    m = _ratio_buckets(m).withColumn("base_failed", base_failed())
    j = m.join(F.broadcast(t) if small else t,
               F.col("lang").eqNullSafe(F.col("t_lang"))
               & F.col("source").eqNullSafe(F.col("t_source")), "left")
    within = F.lit(True)
    for c in MARGIN:
        within = within & (F.col(c) <= F.coalesce(F.col(f"max_{c}"), F.col(c)))
    return j.withColumn("kept", ~F.col("base_failed") & within)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), "text")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, measures, base_failed, kept), one row per document."""
    scratch = Scratch(docs.sparkSession, "quality")
    metrics = scratch.save(text_metrics(_keyed(docs), ["doc_id", "lang", "source"]))
    limits = scratch.save(adaptive_thresholds(scratch.save(quantile_sketches(metrics))))
    return _verdict(metrics, limits).select("doc_id", "lang", "source", *MEASURES,
                                            "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged; no join on ids, no text shuffle.

    The measures are taken again beside the whole rows, so every row is judged
    by its own text, also where ids repeat.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    sketches = scratch.save(quantile_sketches(text_metrics(_keyed(docs), ["lang", "source"])))
    limits = scratch.save(adaptive_thresholds(sketches))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        F.col("lang").cast("string").alias("lang"),
                        F.col("source").cast("string").alias("source"), "text")
    judged = _verdict(text_metrics(whole, ["row", "lang", "source"]), limits)
    return judged.filter("kept").select("row.*")
