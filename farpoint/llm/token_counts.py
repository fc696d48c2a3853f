"""Token counts of whole texts by a map-side two-tier lookup.

A sentencepiece BPE model merges neighbouring characters only into pieces of
its vocabulary.  Where no piece spans two neighbouring characters, the text can
be cut there and the parts (pre-tokens) encoded alone: before a space that
follows another character, and around the ASCII characters that stand in no
longer piece.  Both cuts are read off the vocabulary (``cut_rules``); a model
they don't hold for is given whole texts instead.

1. One scan of all texts keeps a bounded summary of frequent pre-tokens per task
   (at most TASK_ROWS rows a task leave it); the TABLE_ROWS most frequent are
   encoded once and broadcast as a compact open-addressing table of
   (fingerprint, number of tokens).
2. A second scan sums the lengths per document inside the task: first tier the
   broadcast table, second tier a cache in the Python worker that keeps what the
   library gave for the misses.  No pre-token of a text is shuffled.

Which pre-tokens are in the table or the cache changes the speed only.  Pre-tokens
are known by 64-bit fingerprints.

Defined cases: null text counts as empty: 0 bytes, 0 tokens; rows with null or
equal doc_id are counted one by one; the model's special strings inside a text
are ordinary text; an empty table gives an empty result; further columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.llm import words as W
from farpoint.llm.scratch import Scratch

TABLE_ROWS = 1 << 16       # pre-tokens in the broadcast table (10 bytes a slot, 4 slots each)
TASK_ROWS = 1 << 12        # summary rows that a task hands on
SUMMARY_ROWS = 1 << 15     # summary rows that a task holds
CACHE_ROWS = 1 << 18       # pre-tokens in a worker's cache
LONGEST = 64               # bytes of a pre-token that may enter the table
SPACE_MARK = "▁"      # fixed value: how sentencepiece writes a space
GUARD = "\n"               # stands before a pre-token, so that no space is put before it


@dataclass
class CutRules:
    """Where texts may be cut: ASCII bytes that stand alone; None: nowhere."""

    solo: np.ndarray | None


def cut_rules(model: bytes) -> CutRules:
    """Read the cuts off the vocabulary of a sentencepiece model."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(model)
    plain, user_defined, unused, bpe = 1, 4, 5, 2
    norm = proto.normalizer_spec
    pieces = [p.piece for p in proto.pieces if p.type == plain and len(p.piece) > 1]
    joined = any(b == SPACE_MARK and a != SPACE_MARK for p in pieces for a, b in zip(p, p[1:]))
    known = (proto.trainer_spec.model_type == bpe and proto.trainer_spec.byte_fallback
             and not norm.precompiled_charsmap and norm.add_dummy_prefix
             and norm.escape_whitespaces and not norm.remove_extra_whitespaces
             and not proto.trainer_spec.treat_whitespace_as_suffix
             and not any(p.type in (user_defined, unused) for p in proto.pieces))
    inside = set().union(*pieces) if pieces else set()
    if not known or joined or GUARD in inside:
        return CutRules(None)
    solo = np.zeros(256, bool)
    solo[[i for i in range(128) if chr(i) not in inside and i != 0x20]] = True
    return CutRules(solo)


def spaced(text: pa.Array) -> pa.Array:
    """Texts as the model sees them: the space mark is a space, one space before a text."""
    text = text.fill_null("")
    if pc.any(pc.match_substring(text, SPACE_MARK)).as_py():
        text = pc.replace_substring(text, SPACE_MARK, " ")
    # an empty text gets no space
    return pc.if_else(pc.equal(pc.binary_length(text), 0), text,
                      pc.binary_join_element_wise(pa.scalar("", text.type), text, " "))


def pre_tokens(c: W.Chunk, rules: CutRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte ranges that cover the chunk, and the first of each document."""
    buf, n = c.buf, len(c.buf)
    begin = np.zeros(n + 1, bool)
    begin[c.off] = True
    begin = begin[:n]
    if rules.solo is not None:
        space, solo = buf == 0x20, rules.solo[buf]
        begin |= solo
        begin[1:] |= solo[:-1] | (space[1:] & ~space[:-1])
    start = np.flatnonzero(begin)
    return start, np.append(start[1:], n)[:len(start)], np.searchsorted(start, c.off)


@dataclass
class LengthTable:
    """Open addressing: fingerprints and numbers of tokens; slot by the top bits."""

    keys: np.ndarray
    tokens: np.ndarray
    used: np.ndarray
    probes: int

    @classmethod
    def build(cls, h: np.ndarray, n: np.ndarray) -> LengthTable:
        bits = max(4, int(max(1, len(h)) * 4 - 1).bit_length())
        size = 1 << bits
        t = cls(np.zeros(size, np.uint64), np.zeros(size, np.uint16), np.zeros(size, bool), 0)
        left = np.arange(len(h))
        slot = (h >> np.uint64(64 - bits)).astype(np.int64)
        while len(left):
            at = (slot[left] + t.probes) % size
            t.probes += 1
            free = ~t.used[at]
            _, one = np.unique(at[free], return_index=True)      # one key a slot
            put = np.flatnonzero(free)[one]
            t.keys[at[put]], t.tokens[at[put]], t.used[at[put]] = h[left[put]], n[left[put]], True
            left = np.delete(left, put)
        return t

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of tokens, -1 where the table has no entry."""
        size = len(self.keys)
        slot = (h >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for p in range(self.probes):
            at = (slot[left] + p) % size
            hit = self.used[at] & (self.keys[at] == h[left])
            out[left[hit]] = self.tokens[at[hit]]
            left = left[~hit & self.used[at]]                    # a free slot ends the search
        return out


class Counter:
    """The two tiers; broadcast once, so the cache lives as long as the Python worker."""

    def __init__(self, model: bytes, rules: CutRules, table: LengthTable):
        self.model, self.rules, self.table = model, rules, table
        self.cache: dict[int, int] = {}
        self.library = None

    def __getstate__(self):
        return {"model": self.model, "rules": self.rules, "table": self.table,
                "cache": {}, "library": None}

    def encode(self, parts: list[str]) -> list[int]:
        """Number of tokens of each pre-token (or of each whole text) as the library gives it."""
        if self.library is None:
            import sentencepiece
            self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        if self.rules.solo is None:          # whole texts; the library puts the space itself
            return [len(x) for x in self.library.encode([p[1:] for p in parts], num_threads=1)]
        base = len(self.library.encode(GUARD))
        return [len(x) - base for x in
                self.library.encode([GUARD + p for p in parts], num_threads=1)]

    def chunk_tokens(self, c: W.Chunk) -> np.ndarray:
        """Tokens of every document of the chunk."""
        start, end, first = pre_tokens(c, self.rules)
        h = W.segment_hash(c.buf, start, end)
        n = self.table.find(h)
        miss = np.flatnonzero(n < 0)
        if len(miss):
            u, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            known = [self.cache.get(x, -1) for x in u.tolist()]
            new = [i for i, x in enumerate(known) if x < 0]
            at = miss[one[new]]
            got = self.encode([c.buf[a:z].tobytes().decode("utf-8", "replace")
                               for a, z in zip(start[at], end[at])]) if new else []
            if len(self.cache) + len(new) > CACHE_ROWS:          # the older half goes
                self.cache = dict(list(self.cache.items())[len(self.cache) // 2:])
            for i, x in zip(new, got):
                known[i] = x
                if len(self.cache) < CACHE_ROWS:
                    self.cache[int(u[i])] = x
            n[miss] = np.asarray(known, np.int64)[back]
        total = np.append(0, np.cumsum(n))
        return total[first[1:]] - total[first[:-1]]


class Summary:
    """Frequent pre-tokens of one task in bounded memory: the rarest half goes when it is full."""

    def __init__(self):
        self.count: dict[bytes, int] = {}

    def add(self, c: W.Chunk, rules: CutRules) -> None:
        start, end, _ = pre_tokens(c, rules)
        h = W.segment_hash(c.buf, start, end)
        _, one, n = np.unique(h, return_index=True, return_counts=True)
        # those found once in a chunk are left to the workers' caches
        for i in np.flatnonzero((n > 1) & (end[one] - start[one] <= LONGEST)):
            piece = c.buf[start[one[i]]:end[one[i]]].tobytes()
            self.count[piece] = self.count.get(piece, 0) + int(n[i])
        if len(self.count) > SUMMARY_ROWS:
            self.count = dict(self.top(SUMMARY_ROWS // 2))

    def top(self, k: int) -> list[tuple[bytes, int]]:
        return sorted(self.count.items(), key=lambda x: (-x[1], x[0]))[:k]


def frequent_pre_tokens(docs: DataFrame, rules: CutRules, rows: int) -> list[bytes]:
    """The about ``rows`` most frequent pre-tokens of all texts."""
    def run(batches):
        s = Summary()
        for b in batches:
            for c in W.chunks(spaced(b.column(0))):
                s.add(c, rules)
        got = s.top(TASK_ROWS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in got], pa.binary()), pa.array([n for _, n in got], pa.int64())],
            names=["piece", "n"])
    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, "piece binary, n bigint")
    top = (parts.groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(rows).collect())
    return [bytes(r["piece"]) for r in top]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096,
                 table_rows: int = TABLE_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    Scratch(spark, "token_counts")               # small batches of texts
    with open(model_path, "rb") as f:
        model = f.read()
    counter = Counter(model, cut_rules(model), LengthTable.build(
        np.zeros(0, np.uint64), np.zeros(0, np.uint16)))
    if counter.rules.solo is not None and table_rows:
        pieces = frequent_pre_tokens(docs, counter.rules, table_rows)
        size = np.array([len(p) for p in pieces], np.int64)
        end = np.cumsum(size)
        h = W.segment_hash(np.frombuffer(b"".join(pieces), np.uint8), end - size, end)
        n = counter.encode([p.decode("utf-8", "replace") for p in pieces]) if pieces else []
        counter.table = LengthTable.build(h, np.asarray(n, np.uint16))
    shared = spark.sparkContext.broadcast(counter)

    def run(batches):
        tiers = shared.value
        for b in batches:
            n_bytes = pc.binary_length(b.column(1)).fill_null(0).cast(pa.int64())
            n = [tiers.chunk_tokens(c) for c in W.chunks(spaced(b.column(1)))]
            n = pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), n_bytes, n, pc.greater(n, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"))
