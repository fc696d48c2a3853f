"""Driver contract and SQL oracle agreement on the smallest driver tables."""

import math
import os

import pytest

from conftest import SF_SMALL, have_testdata
from farpoint.plans import ORACLE_SQL, QUERIES

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver tables not present")

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 1
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(E.oracle_sql()) == {"diversity_baseline_config"}


def test_oracle_agreement(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sqls = ORACLE_SQL
    to_duck = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    for name, q in QUERIES.items():
        frame = q(spark, SF_SMALL)
        sdf = frame.toPandas()
        if name not in sqls:
            assert len(sdf) >= 1
            continue
        assert _rows(sdf) == _rows(con.execute(sqls[name]).df()), name
        rel = con.sql(sqls[name])
        spark_types = {f.name: to_duck.get(f.dataType.simpleString()) for f in frame.schema.fields}
        assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}, name
