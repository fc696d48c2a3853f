"""Registered queries against their SQL, and the pipeline against its stages' own brute force."""

import os

import pytest

from cases import jaccard_components, words
from conftest import SF_SMALL
from test_rows import base_metrics

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([r[i] for i in order]) for r in rows)


def test_queries_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from farpoint.llm.oracle import ORACLE_SQL
    from farpoint.llm.queries import QUERIES
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        got, rel = QUERIES[name](spark, SF_SMALL), con.sql(sql)
        assert _rows(got.columns, got.collect()) == _rows(rel.columns, rel.fetchall()), name


def test_entry_has_all_queries():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {
        f"op{k}" for k in range(1, 14)}


def test_pipeline_matches_brute_force(spark, monkeypatch):
    """Stage by stage: the rows that each keeps are those that plain code keeps."""
    import corpus_pipeline as P
    from farpoint.llm import quality
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "ngram_jaccard_join",
                                        "benchmark_decontamination", "secret_scans", "mix_sources"]
    at = {r["doc_id"]: r for r in docs.collect()}

    def run(name, df):
        out = stages[name](spark, df, SF_SMALL)
        path = spark.createDataFrame(out.collect(), out.schema)
        return path

    good = run("quality_rules", docs)
    left = {r["doc_id"]: r for r in good.collect()}
    for i, r in at.items():
        m = base_metrics(r["text"])
        if m[0] < 50 or 100 * m[4] > 50 * m[0]:
            assert i not in left
        elif m[2] * 1000 // max(1, m[1]) <= quality.MARGIN["symbol_ratio"] and not m[3]:
            assert left[i] == r                 # clean documents stay as they are

    one = run("ngram_jaccard_join", good)
    comp = jaccard_components([(i, r["text"]) for i, r in left.items()])
    assert {r["doc_id"] for r in one.collect()} == {i for i, _, c in comp if i == c}

    clean = run("benchmark_decontamination", one)
    kept = {r["doc_id"] for r in clean.collect()}
    leaked = {r["doc_id"] for r in one.collect() if any(b in r["text"] for b in bench)}
    assert not kept & leaked
    assert len(kept | leaked) >= one.count() - 1          # a near copy of an item may go as well

    masked = run("secret_scans", clean).collect()
    assert {r["doc_id"] for r in masked} == kept
    for r in masked:
        assert r["n_chars"] == len(r["text"])
        if "[SECRET]" not in r["text"]:
            assert r["text"] == at[r["doc_id"]]["text"]

    mixed = P.run(spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["size"]) for r in mixed} == {
        (r["doc_id"], len(words(r["text"]))) for r in masked}
    total = sum(r["size"] for r in mixed)
    assert abs(sum(r["taken"] for r in mixed) - total) < 0.02 * total
