"""Strict text sources as Spark data sources (S2, S3/S4, S5): ``spark.read.format("class_records")``.

The files at ``path`` (one file, a directory or a glob; local or any store that
pyarrow knows by its URI) are cut into byte ranges of ``partitionBytes``, one
partition each, so one large file is read by many tasks.  A range holds the lines that
start in it.  Lines are parsed in Arrow batches; a malformed line fails the job with an
error that names the file and the line.

* ``class_records``: lines ``<index> <class>`` -> (``idx`` bigint, ``class`` string);
* ``csv_points``: comma-separated numbers -> (``id`` bigint, ``v`` array<double>), or with
  ``columns=true`` and ``dim=N`` -> (``id``, ``x0`` .. double).  ``dim`` makes another length an error.

A point's id is its file's number (files in name order) and the byte at which its line
starts, ``number << 40 | byte``: unique, ascending in scan order and known without another
job or scan, whatever filters or splits follow.  Ids are not contiguous.

Options: ``path``, ``partitionBytes`` (default 64 MB), ``dim``, ``columns``, ``source=true`` (adds
``file`` string and ``line_start`` bigint).  Lines end at a line feed, a carriage return before
it is dropped; a last line needs no end; empty files give no row.  Names that begin
with ``.`` or ``_`` are not read.
"""

from __future__ import annotations

import fnmatch
import posixpath

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PARTITION_BYTES = 64 << 20
READ_BYTES = 4 << 20        # bytes read at a time
FILE_BITS = 40              # bits of an id for the byte of a line; the rest number the file
RECORD = r"^(?P<idx>[+-]?[0-9]+) (?P<cls>[^ ]*)(?P<rest>(?s:.*))$"


class MalformedLine(ValueError):
    """A line that is no record; names the file and the line."""


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a URI or a local path."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def input_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files, in name order."""
    files, at = _filesystem(path)
    shown = lambda name: not posixpath.basename(name).startswith((".", "_"))     # noqa: E731
    if any(c in at for c in "*?["):
        base = posixpath.dirname(at[:min(at.index(c) for c in "*?[" if c in at)])
        found = files.get_file_info(pafs.FileSelector(base, recursive=True))
        found = [f for f in found if len(f.path.split("/")) == len(at.split("/")) and all(
            fnmatch.fnmatchcase(a, b) for a, b in zip(f.path.split("/"), at.split("/")))]
        dirs = [f for f in found if f.type == pafs.FileType.Directory]
        found += [g for d in dirs for g in files.get_file_info(pafs.FileSelector(d.path))]
    else:
        info = files.get_file_info(at)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = files.get_file_info(pafs.FileSelector(at)) if info.type == pafs.FileType.Directory else [info]
    found = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and shown(f.path))
    if not found:
        raise FileNotFoundError(f"no files at {path}")
    return found


class ByteRange(InputPartition):
    """Lines that start in bytes ``start`` to ``end`` of a file."""

    def __init__(self, number: int, file: str, start: int, end: int):
        super().__init__(number)
        self.number, self.file, self.start, self.end = number, file, start, end


def lines_of(f, start: int, end: int):
    """(offsets, lines) in lists of about READ_BYTES: the lines that start in ``start`` to ``end``."""
    at = start
    if start:                   # the byte before tells whether a line starts here
        f.seek(start - 1)
        while True:
            piece = f.read(READ_BYTES)
            cut = piece.find(b"\n")
            if cut >= 0 or not piece:
                at = f.tell() - len(piece) + cut + 1 if piece else end
                break
    f.seek(at)
    held = b""
    while at < end:
        piece = f.read(READ_BYTES)
        held += piece
        whole = held if not piece else held[:held.rfind(b"\n") + 1]
        if piece and not whole:
            continue            # one line longer than what was read so far
        offsets, lines = [], []
        pos = 0
        while pos < len(whole) and at + pos < end:
            cut = whole.find(b"\n", pos)
            stop = len(whole) if cut < 0 else cut
            offsets.append(at + pos)
            lines.append(whole[pos:stop - 1] if stop > pos and whole[stop - 1:stop] == b"\r" else whole[pos:stop])
            pos = stop + 1
        if lines:
            yield offsets, lines
        if not piece:
            return
        at, held = at + len(whole), held[len(whole):]


class _LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("option path is missing")
        self.bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        if self.bytes < 1:
            raise ValueError("partitionBytes must be >= 1")
        self.source = str(options.get("source", "false")).lower() == "true"

    def partitions(self):
        return [ByteRange(i, name, a, min(a + self.bytes, size))
                for i, (name, size) in enumerate(input_files(self.path)) for a in range(0, size, self.bytes)]

    def read(self, partition: ByteRange):
        files, _ = _filesystem(self.path)
        with files.open_input_file(partition.file) as f:
            for offsets, lines in lines_of(f, partition.start, partition.end):
                columns, names, bad = self.parse(partition, offsets, lines)
                if bad is not None:
                    raise MalformedLine(
                        f"{partition.file}, line {self.line_number(f, offsets[bad])}: {self.what} expected, found "
                        f"{lines[bad][:200].decode('utf-8', 'replace')!r}")
                if self.source:
                    columns += [pa.array([partition.file] * len(lines)), pa.array(offsets, pa.int64())]
                    names = [*names, "file", "line_start"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    @staticmethod
    def line_number(f, offset: int) -> int:
        """The 1-based number of the line that starts at ``offset``; read only for an error."""
        f.seek(0)
        n, left = 1, offset
        while left > 0:
            piece = f.read(min(READ_BYTES, left))
            if not piece:
                break
            n, left = n + piece.count(b"\n"), left - len(piece)
        return n


def _first(mask: pa.Array) -> int | None:
    at = pc.index(mask, True).as_py()
    return None if at < 0 else at


class _ClassReader(_LineReader):
    what = "'<index> <class>'"

    def parse(self, partition, offsets, lines):
        text = pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())
        got = pc.extract_regex(text, RECORD)
        idx, cls, rest = (pc.struct_field(got, i) for i in range(3))
        # a second token that is empty counts only if another follows (trailing empty tokens are dropped)
        none = pc.and_(pc.equal(cls, ""), pc.equal(pc.utf8_trim(rest, " "), ""))
        bad = _first(pc.or_kleene(pc.is_null(got), none).fill_null(True))
        if bad is None:
            try:
                return [pc.cast(pc.utf8_ltrim(idx, "+"), pa.int64()), cls], ["idx", "class"], None
            except pa.ArrowInvalid:                             # beyond 64 bits
                bad = next(i for i, x in enumerate(idx.to_pylist()) if not -(1 << 63) <= int(x) < 1 << 63)
        return [], [], bad


def _number(token: str) -> float | None:
    """A double as Spark casts it: blanks around, Infinity, NaN and the suffixes d and f are allowed."""
    t = token.strip()
    try:
        return float(t)
    except ValueError:
        try:
            return float(t[:-1]) if t[-1:] in "dDfF" and t[-2:-1].isdigit() else None
        except ValueError:
            return None


class _PointReader(_LineReader):
    what = "comma-separated numbers"

    def __init__(self, options: dict):
        super().__init__(options)
        self.dim = int(options["dim"]) if "dim" in options else None
        self.columns = str(options.get("columns", "false")).lower() == "true"
        if self.columns and self.dim is None:
            raise ValueError("columns=true needs dim")
        if self.dim is not None:
            self.what = f"{self.dim} comma-separated numbers"

    def parse(self, partition, offsets, lines):
        text = pa.array([x.decode("utf-8", "replace").rstrip(",") for x in lines], pa.string())
        parts = pc.split_pattern(text, ",")
        size = pc.list_value_length(parts)
        if self.dim is not None and (bad := _first(pc.not_equal(size, self.dim))) is not None:
            return [], [], bad
        tokens = parts.flatten()
        try:
            numbers = pc.cast(tokens, pa.float64())
        except pa.ArrowInvalid:
            values = [_number(t) for t in tokens.to_pylist()]
            if None in values:
                at = values.index(None)
                return [], [], int(pc.list_parent_indices(parts)[at].as_py())
            numbers = pa.array(values, pa.float64())
        ids = pa.array([partition.number << FILE_BITS | o for o in offsets], pa.int64())
        v = pa.ListArray.from_arrays(parts.offsets, numbers)
        if not self.columns:
            return [ids, v], ["id", "v"], None
        return ([ids, *[pc.list_element(v, i) for i in range(self.dim)]],
                ["id", *[f"x{i}" for i in range(self.dim)]], None)


class ClassRecordSource(DataSource):
    reader_class = _ClassReader

    @classmethod
    def name(cls):
        return "class_records"

    def fields(self):
        return ["idx bigint", "class string"]

    def schema(self):
        more = ["file string", "line_start bigint"] if str(self.options.get("source", "")).lower() == "true" else []
        return ", ".join(self.fields() + more)

    def reader(self, schema):
        return self.reader_class({k.lower(): v for k, v in self.options.items()})


class PointSource(ClassRecordSource):
    reader_class = _PointReader

    @classmethod
    def name(cls):
        return "csv_points"

    def fields(self):
        if str(self.options.get("columns", "")).lower() == "true":
            return ["id bigint", *[f"x{i} double" for i in range(int(self.options.get("dim", 0)))]]
        return ["id bigint", "v array<double>"]


def register_sources(spark: SparkSession) -> None:
    """Make ``class_records`` and ``csv_points`` known to ``spark.read.format``."""
    spark.dataSource.register(ClassRecordSource)
    spark.dataSource.register(PointSource)


def _load(spark: SparkSession, name: str, path: str, options: dict) -> DataFrame:
    register_sources(spark)
    # options of a data source are strings
    plain = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    return spark.read.format(name).options(path=path, **plain).load()


def load_class_records(spark: SparkSession, path: str, **options) -> DataFrame:
    """(idx, class) of the text file(s) at ``path``."""
    return _load(spark, "class_records", path, options)


def load_points(spark: SparkSession, path: str, **options) -> DataFrame:
    """(id, v) of the comma-separated text file(s) at ``path``."""
    return _load(spark, "csv_points", path, options)
