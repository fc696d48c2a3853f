"""Tokeniser, line splitting and word counts against a plain-Python model."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from farpoint.functions.text import java_space_split
from farpoint.operators import text


def java_split(s):
    """Model of Java String.split(" ") (limit 0)."""
    if s == "":
        return [""]
    toks = s.split(" ")
    while toks and toks[-1] == "":
        toks.pop()
    return toks


def lines_of(t):
    if t.endswith("\n"):
        t = t[:-1]
    return t.split("\n")


CASES = ["", " ", "  ", "a ", "a  b", " a", "a\tb", "a b  ", "x", "  lead and trail  "]


def test_tokeniser_edge_cases(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(CASES)], "i int, s string")
    got = {r["i"]: list(r["t"]) for r in df.select("i", java_space_split("s").alias("t")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == java_split(s), repr(s)


def test_tokeniser_table():
    # the documented expectations themselves
    assert java_split("") == [""]
    assert java_split(" ") == [] and java_split("  ") == []
    assert java_split("a  b") == ["a", "", "b"]
    assert java_split(" a") == ["", "a"]
    assert java_split("a b  ") == ["a", "b"]


DOCS = [
    (1, "the cat sat\non the mat\n"),
    (2, "the  cat\n\nran "),
    (3, ""),
    (4, "   "),
    (5, "mat mat mat mat mat mat mat mat"),
    (6, "naïve café déjà vu\nthe end"),
]


def model_counts(docs):
    c = Counter()
    for _, t in docs:
        for line in lines_of(t):
            c.update(java_split(line))
    return c


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def test_word_count_matches_model(docs):
    got = {r["word"]: r["n"] for r in text.word_count(docs).collect()}
    assert got == dict(model_counts(DOCS))


def test_salted_equals_plain(docs):
    plain = {r["word"]: r["n"] for r in text.word_count(docs).collect()}
    for k in (1, 2, 5):
        salted = {r["word"]: r["n"] for r in text.word_count_salted(docs, k).collect()}
        assert salted == plain


def test_term_count_and_totals(docs):
    per_doc = text.doc_term_count(docs)
    total = per_doc.agg(F.sum("n")).first()[0]
    assert total == sum(model_counts(DOCS).values())
    d5 = {r["word"]: r["n"] for r in per_doc.filter("doc_id = 5").collect()}
    assert d5 == {"mat": 8}


def test_distinct_and_avg_length(docs):
    c = model_counts(DOCS)
    assert text.distinct_words(docs).first()["n_distinct"] == len(c)
    expect = sum(len(w.encode("utf-16-le")) // 2 for w in c) // len(c)
    assert text.avg_distinct_word_length(docs).first()["avg_len"] == expect


def test_avg_length_counts_utf16_units(spark):
    df = spark.createDataFrame([(1, "\U0001F600 ab")], "doc_id long, text string")
    # words: the emoji (2 UTF-16 units) and "ab" (2) -> 4 // 2
    assert text.avg_distinct_word_length(df).first()["avg_len"] == 2


def test_empty_input(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert text.word_count(df).count() == 0
    assert text.avg_distinct_word_length(df).first()["avg_len"] is None
    assert text.row_count(df).first()["n"] == 0


def test_line_count(docs):
    assert text.line_count(docs).first()["n"] == sum(len(lines_of(t)) for _, t in DOCS)


def test_text_file_source(spark, tmp_path):
    from farpoint.sources.files import read_text_documents
    p = tmp_path / "docs.txt"
    p.write_text("a b\nb c c\n\n")
    docs = read_text_documents(spark, str(p), num_partitions=2)
    assert docs.count() == 3
    got = {r["word"]: r["n"] for r in text.word_count(docs).collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "": 1}


def test_line_ends_and_null_text(spark):
    rows = [(1, "a b\r\nc\rd\n"), (2, None), (3, "e\r"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert text.line_count(docs).first()["n"] == 3 + 0 + 1 + 1
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
    got = {r["word"]: r["n"] for r in text.word_count(docs).collect()}
    assert got == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 1, "": 1}
