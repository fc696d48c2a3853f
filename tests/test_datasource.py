"""The registered text sources: splits, directories, globs, ids and errors."""

import numpy as np
import pytest

from farpoint.operators import classes
from farpoint.sources import datasource as D
from farpoint.sources import read_class_records, read_points_csv

RECORDS = [f"{i * 7 - 50} class{i % 5}" for i in range(200)] + ["5  x", "+6 y z", f"{2**63 - 1} big", "7 ünï日本"]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_class_records_of_any_split(spark, tmp_path, size):
    f = tmp_path / "records.txt"
    f.write_text("\n".join(RECORDS))                      # no final line end
    got = D.load_class_records(spark, str(f), partitionBytes=size) if size > 1 else D.load_class_records(
        spark, f.as_uri(), partitionBytes=31)
    want = sorted((r["idx"], r["class"]) for r in read_class_records(spark, str(f)).collect())
    assert sorted((r["idx"], r["class"]) for r in got.collect()) == want and len(want) == len(RECORDS)
    assert got.schema.simpleString() == "struct<idx:bigint,class:string>"


def test_operators_take_the_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 x\n2 y\n")
    (tmp_path / "b.txt").write_text("3 x\r\n")
    (tmp_path / "_hidden").write_text("no record")
    (tmp_path / "empty.txt").write_text("")
    got = classes.class_count(D.load_class_records(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in got] == [("x", 2), ("y", 1)]
    some = D.load_class_records(spark, str(tmp_path / "[ab].txt"), source=True).orderBy("idx").collect()
    assert [(r["idx"], r["line_start"], r["file"][-5:]) for r in some] == [
        (1, 0, "a.txt"), (2, 4, "a.txt"), (3, 0, "b.txt")]


@pytest.mark.parametrize("bad", ["", " 1 x", "x 1", "1", "1 ", "1   ", "1.5 x", f"{2**63} x"])
def test_a_bad_record_names_file_and_line(spark, tmp_path, bad):
    f = tmp_path / "bad.txt"
    f.write_text("\n".join([*RECORDS[:40], bad, "1 x"]) + "\n")
    for column in ("idx", "class"):
        with pytest.raises(Exception, match=r"bad\.txt, line 41"):
            D.load_class_records(spark, str(f), partitionBytes=50).select(column).collect()


def test_points_of_any_split(spark, tmp_path):
    x = np.random.default_rng(1).normal(size=(300, 3))
    lines = [",".join(repr(float(a)) for a in v) for v in x]
    (tmp_path / "p0.csv").write_text("\n".join(lines[:200]) + "\n")
    (tmp_path / "p1.csv").write_text("\n".join(lines[200:]))
    for size in (11, 1000, 1 << 20):
        got = D.load_points(spark, str(tmp_path), partitionBytes=size).orderBy("id").collect()
        assert np.array_equal(np.array([r["v"] for r in got]), x)
        assert [r["id"] >> D.FILE_BITS for r in got] == [0] * 200 + [1] * 100
    # ids stay whatever is filtered or split
    kept = D.load_points(spark, str(tmp_path), partitionBytes=99).filter("v[0] > 0")
    assert {r["id"] for r in kept.collect()} == {r["id"] for r in got if r["v"][0] > 0}
    wide = D.load_points(spark, str(tmp_path), columns=True, dim=3).orderBy("id")
    assert wide.columns == ["id", "x0", "x1", "x2"]
    assert np.array_equal(np.array([tuple(r)[1:] for r in wide.collect()]), x)


def test_points_parse_as_the_other_source(spark, tmp_path):
    f = tmp_path / "odd.csv"
    f.write_text("1, 2 ,NaN\nInfinity,-Infinity,1e3\n1.0f,2d,3\n4,5,6,,\n")
    a = [r["v"] for r in D.load_points(spark, str(f)).orderBy("id").collect()]
    b = [r["v"] for r in read_points_csv(spark, str(f)).orderBy("id").collect()]
    assert repr(a) == repr(b)


@pytest.mark.parametrize("bad, options", [("1,x,3", {}), ("", {}), ("1,,3", {}), ("1,2", {"dim": 3})])
def test_a_bad_point_names_file_and_line(spark, tmp_path, bad, options):
    f = tmp_path / "pts.csv"
    f.write_text("1,2,3\n" * 30 + bad + "\n4,5,6\n")
    with pytest.raises(Exception, match=r"pts\.csv, line 31"):
        D.load_points(spark, str(f), partitionBytes=40, **options).collect()


def test_arguments(spark, tmp_path):
    with pytest.raises(Exception, match="missing"):
        D.load_class_records(spark, str(tmp_path / "missing")).collect()
    with pytest.raises(Exception, match="no files"):
        D.load_class_records(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="needs dim"):
        (tmp_path / "x").write_text("1,2")
        D.load_points(spark, str(tmp_path), columns=True).collect()


def test_lines_longer_than_a_read(tmp_path, monkeypatch):
    monkeypatch.setattr(D, "READ_BYTES", 3)
    data = b"a\n\nlong line here\r\nb"
    f = tmp_path / "x"
    f.write_bytes(data)
    for size in (1, 2, 5, 100):
        got = []
        for start in range(0, len(data), size):
            with open(f, "rb") as h:
                for offsets, lines in D.lines_of(h, start, min(start + size, len(data))):
                    got += list(zip(offsets, lines))
        assert got == [(0, b"a"), (2, b""), (3, b"long line here"), (19, b"b")]
