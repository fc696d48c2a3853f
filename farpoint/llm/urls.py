"""URL filters: a blocked Bloom filter of the listed URLs, then an exact hash join.

A rule lists a canonical URL prefix (host + path prefix) with a verdict.  It
fits its host and all subdomains when the URL's path starts with the rule's;
the longest fitting rule wins (ties: the first by code point).  Every distinct
URL gives its candidate keys (host suffixes x path prefixes of the listed path
lengths); the Bloom filter drops nearly all keys that are not listed, the join
on the exact key removes the false positives.  URLs without a rule get
``default``: they are not listed.

Defined cases: null URL or one without ``://``: host and path empty, no rule;
an empty rule list or table works; repeated pages keep their rows; further
columns of ``pages`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farpoint.llm import bloom
from farpoint.llm.scratch import Scratch

# The rules of the registered query (verdict, host, path prefix).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
RULE_SCHEMA = "verdict string, host string, path string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit("")))


def _candidate_keys(lengths: list[int], labels: int) -> Column:
    """``host-suffix + path-prefix`` keys of the columns host and path.

    Suffixes have ``labels`` labels at most, as many as the longest listed host.
    """
    label = F.split(F.col("host"), r"\.")
    n = F.size(label)
    suffix = F.transform(F.sequence(F.greatest(F.lit(1), n - labels + 1), n),
                         lambda i: F.array_join(F.slice(label, i, n - i + 1), "."))
    prefixes = F.array(*[F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in lengths])
    return F.flatten(F.transform(suffix, lambda s: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.struct(
            F.concat(s, p).alias("key"), F.xxhash64(s, p).alias("h")))))


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "urls")
    listed = scratch.save(rules.select("verdict", "host", "path").withColumn(
        "key", F.concat("host", "path")).withColumn("h", F.xxhash64("host", "path"))
        .groupBy("key", "h").agg(F.min("verdict").alias("rule_verdict")))
    lengths = [r[0] for r in rules.select(F.length("path").alias("n")).distinct().orderBy("n").collect()]
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0]
    blocks = bloom.build(listed, "h", listed.count())
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    distinct = rows.select("host", "path").distinct()
    keyed = distinct.withColumn("k", _candidate_keys(lengths, labels) if lengths else F.array().cast(
        "array<struct<key:string,h:bigint>>"))

    def possible(batches):
        for b in batches:
            ks = b.column(2)
            flat = ks.flatten()
            at = np.repeat(np.arange(len(ks)), np.asarray(ks.value_lengths().fill_null(0)))
            ok = np.flatnonzero(bloom.hits(blocks, np.asarray(flat.field(1), dtype=np.int64)))
            take = pa.array(at[ok])
            keys = flat.field(0).take(pa.array(ok))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), keys], names=["host", "path", "key"])

    maybe = keyed.mapInArrow(possible, "host string, path string, key string")
    exact = maybe.join(listed.select("key", "rule_verdict"), "key")
    best = exact.groupBy("host", "path").agg(F.max_by(
        F.struct(F.col("key").alias("rule"), F.col("rule_verdict")),
        F.struct(F.length("key"), F.col("key"))).alias("best"))
    return (rows.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict")))
