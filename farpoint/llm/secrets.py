"""Secret scans: three base patterns, and dictionary-primed zstandard novelty.

Base kinds are found left to right without overlap, each kind on its own; a
match that fails its length test is dropped.  The method adds spans of kind
``novel``: whole strings that follow a sensitive word and hold a piece that adds
nearly all that its alphabet can carry to the compressed size of the surrounding
text, with a dictionary of the corpus's identifiers primed; what the context or
the identifiers predict compresses, random secrets don't.  Marginal bytes are
size(context + piece) - size(context).  Pieces overlap and have one length, so the
score of a random string does not fall with its length.

Defined cases: null or empty text: no spans; repeated rows are scanned each;
equal starts: kinds in the order of ``KINDS``; offsets are code points, end
exclusive; an empty table gives an empty result; columns other than the text
are carried untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farpoint.llm.scratch import Scratch

# The base patterns and their least lengths.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.A)
HEX = re.compile(r"[0-9a-f]{32,}", re.A)     # a run of 32+ is the maximal run
MIN_ASSIGN, MIN_ACCESS = 8, 16

SENSITIVE = re.compile(r"(?:key|secret|token|passw|pwd|auth|credential|bearer|private|signature)"
                       r"[A-Za-z_]{0,12}[\"']?[\x20]{0,3}(?:[:=]|\bis\b|\x20)[\x20]{0,3}[\"'(]?",
                       re.I | re.A)
SENSITIVE_HINTS = ("key", "secret", "token", "passw", "pwd", "auth", "credential", "bearer",
                   "private", "signature")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.A)
IDENTIFIER = re.compile(r"[A-Za-z_]{4,32}", re.A)
CONTEXT = 256             # code points before and after a candidate
PIECE = 32                # code points of a candidate that are scored together ...
STEP = 16                 # ... a new piece every so many, the last one at the end
NOVELTY = 0.75            # least marginal compressed bytes per byte (6 bits: 64 symbols) ...
SLACK = 0.9               # ... smaller alphabets: this share of their bits (short pieces vary)
CLASSES = (("0-9", 10), ("a-f", 6), ("g-z", 20), ("A-F", 6), ("G-Z", 20), ("+/_=-", 5))
DICTIONARY = 2000         # most frequent identifiers near candidates (the dictionary's bound)
ALPHABET = [(re.compile(f"[{x}]", re.A), n) for x, n in CLASSES]
SPANS_TYPE = "array<struct<kind:string,start:int,end:int>>"


def base_spans(text: str, low: str) -> list[tuple[int, int, str]]:
    """(start, kind index, end) of the base kinds."""
    out = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def candidates(text: str, low: str) -> list[tuple[int, int]]:
    """Whole strings that directly follow a sensitive word."""
    if not any(h in low for h in SENSITIVE_HINTS):
        return []
    out, last = [], 0
    for m in SENSITIVE.finditer(text):
        c = CANDIDATE.match(text, m.end()) if m.end() >= last else None
        if c:
            out.append((c.start(), c.end()))
            last = c.end()
    return out


def pieces(string: str) -> list[str]:
    """Overlapping pieces of PIECE code points that cover the string."""
    ends = [*range(PIECE, len(string), STEP), len(string)]
    return [string[max(0, e - PIECE):e] for e in ends]


def bar(piece: str) -> float:
    """Least marginal bytes per byte of a novel piece, by the bits of its alphabet."""
    symbols = sum(n for x, n in ALPHABET if x.search(piece))
    return NOVELTY if symbols >= 62 else NOVELTY * SLACK * math.log2(symbols) / 6


def context_of(text: str, start: int, end: int) -> str:
    """The text around a candidate, without the candidate itself, wherever it stands."""
    near = text[max(0, start - CONTEXT):start] + "\n" + text[end:end + CONTEXT]
    return near.replace(text[start:end], " ")


class Novelty:
    """Marginal compressed bytes per byte of a string, given context and dictionary."""

    def __init__(self, dictionary: bytes):
        if dictionary:
            d = zstandard.ZstdCompressionDict(dictionary,
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.c = zstandard.ZstdCompressor(level=9, dict_data=d, write_content_size=False)
        else:
            self.c = zstandard.ZstdCompressor(level=9, write_content_size=False)

    def of(self, string: str, context: str) -> float:
        ctx = context.encode("utf-8", "surrogatepass")
        return (len(self.c.compress(ctx + string.encode())) - len(self.c.compress(ctx))) / len(string)

    def found(self, string: str, context: str) -> bool:
        """Whether a piece of the string is novel."""
        return any(self.of(p, context) >= bar(p) for p in pieces(string))


def scan(text: str | None, novelty: Novelty) -> list[tuple[int, int, str]]:
    """All spans of one text, by start, then kind."""
    if not text:
        return []
    low = text.lower()
    found = base_spans(text, low)
    covered = sorted((s, e) for s, _, e in found)
    for s, e in candidates(text, low):
        # a base span inside a longer string covers only a part of it
        if not any(a <= s and e <= b for a, b in covered):
            if novelty.found(text[s:e], context_of(text, s, e)):
                found.append((s, 3, e))
    return sorted(found)


def identifier_dictionary(docs: DataFrame) -> bytes:
    """The most frequent identifiers near candidates, over all documents (most frequent last)."""
    def run(batches):
        for b in batches:
            count: Counter[str] = Counter()
            for t in b.column(0):
                text = t.as_py()
                if text:
                    for s, e in candidates(text, text.lower()):
                        count.update(set(IDENTIFIER.findall(context_of(text, s, e))))
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()),
                                              pa.array(list(count.values()), pa.int64())],
                                             names=["word", "n"])
    top = (docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(DICTIONARY))
    return " ".join(r["word"] for r in reversed(top.collect())).encode()


def scan_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one more column ``_spans``: all spans of the text."""
    Scratch(docs.sparkSession, "secrets")        # small batches of texts
    dictionary = identifier_dictionary(docs)
    schema = T.StructType([*docs.schema.fields,
                           T.StructField("_spans", T._parse_datatype_string(SPANS_TYPE))])
    at = docs.columns.index("text")
    names = [*docs.columns, "_spans"]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        novelty = Novelty(dictionary)
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in
                      scan(t.as_py(), novelty)] for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, kind)], names=names)
    return docs.mapInArrow(run, schema)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _count(kind: str):
    return F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("bigint")


def secret_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per document."""
    found = scan_secrets(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    base = F.filter("_spans", lambda x: x["kind"] != "novel")
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))


def redact_text(text: str | None, spans, mask: str = "[SECRET]") -> str | None:
    """The text with each maximal run of overlapping spans replaced by ``mask``."""
    if not text or not spans:
        return text
    out, end = [], 0
    for s in spans:
        if s["start"] >= end:
            out += [text[end:s["start"]], mask]
        end = max(end, s["end"])
    return "".join(out) + text[end:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the found secrets masked in the text; n_chars, if there, follows."""
    Scratch(docs.sparkSession, "secrets")        # small batches of texts
    dictionary = identifier_dictionary(docs)
    cols = docs.columns
    at = cols.index("text")

    def run(batches):
        novelty = Novelty(dictionary)
        for b in batches:
            texts = [t.as_py() for t in b.column(at)]
            out = pa.array([redact_text(t, [{"start": s, "end": e} for s, _, e in scan(t, novelty)])
                            for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([out if i == at else b.column(i)
                                              for i in range(len(cols))], names=cols)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(kind)))
    return out
