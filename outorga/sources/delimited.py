"""Delimited text in byte ranges, line breaks in quoted fields included, and members of zip archives.

A byte range cannot tell whether it begins inside quotes, so it is scanned under both assumptions and yields two
bits: the state it ends in if it began outside, and if it began inside. A window over the ranges of a file composes
these bits in order, which gives each range its true state; then records are cut. A record belongs to the range in
which it starts. Nothing but the ranges (one row each) is shuffled. A task holds one range at a time and gets some
``STEP`` bytes of them, so a file of any size is read by many tasks, and small ranges don't cost a task each.

A quote opens a field only at its start; elsewhere it is a character. Two quotes inside a quoted field are one.
Records end with a line feed, with or without a carriage return. Empty lines are skipped, missing fields are null,
surplus ones are left out. The encoding must keep ASCII bytes as they are (UTF-8, Latin-1, Windows-1252).

Files are listed by Spark and opened by Arrow's file systems (local or mounted folders, S3, GCS, HDFS).
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outorga.functions.text import null_tokens
from outorga.session import importable

STEP = 64 << 20
#: Ranges for each core that get a task of their own, however small they are.
TASKS = 16
#: Bytes of a zip member that are parsed at a time, and rows handed out at a time where Arrow cannot parse them.
BLOCK, ROWS = 8 << 20, 20_000
QUOTE = b'"'
REST_OF_QUOTED = re.compile(rb'[^"]*+(?:""[^"]*+)*+("?)')


@cache
def _quoted(sep: bytes) -> re.Pattern[bytes]:
    """A quoted field, seen from outside quotes; the group is empty where it is not closed."""
    return re.compile(rb'(?:\A|(?<=[' + re.escape(sep) + rb'\r\n]))"[^"]*+(?:""[^"]*+)*+("?)')


def ends_inside(text: bytes, sep: bytes, inside: bool) -> bool:
    """Whether the end of ``text``, which is the start of a line, lies in quotes."""
    if QUOTE not in text:
        return inside
    at = 0
    if inside:
        rest = REST_OF_QUOTED.match(text)
        if not rest[1]:
            return True
        at = rest.end()
    last = None
    for last in _quoted(sep).finditer(text, at):
        pass
    return last is not None and not last[1]


def first_record_end(text: bytes, sep: bytes, inside: bool) -> int:
    """Where the first record that ends in ``text`` ends; -1 if none does for certain."""
    at = 0
    if inside:
        rest = REST_OF_QUOTED.match(text)
        if not rest[1] or rest.end() == len(text):
            return -1
        at = rest.end()
    for field in _quoted(sep).finditer(text, at):
        line = text.find(b"\n", at, field.start())
        if line >= 0:
            return line + 1
        at = field.end()
        if not field[1] or at == len(text):
            return -1
    return text.find(b"\n", at) + 1 or -1


def last_record_end(text: bytes, sep: bytes) -> int:
    """Where the last record that ends in ``text`` ends, if it begins with a record; 0 if none ends."""
    spans = [f.span() for f in _quoted(sep).finditer(text)] if QUOTE in text else []
    limit = len(text)
    if spans and spans[-1][1] == limit:  # open, or closed by what may be the first of two quotes
        limit = spans.pop()[0]
    starts = [a for a, _ in spans]
    while (line := text.rfind(b"\n", 0, limit)) >= 0:
        k = bisect_right(starts, line) - 1
        if k < 0 or spans[k][1] <= line:
            return line + 1
        limit = starts[k]
    return 0


def open_file(uri: str) -> pa.NativeFile:
    """A seekable file by the name that Spark lists it under."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/"))
    system, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    return system.open_input_file(path)


def _next_line(file: pa.NativeFile, at: int, size: int) -> int:
    """The first start of a line at or after ``at``."""
    if at == 0 or at >= size:
        return min(at, size)
    file.seek(at - 1)
    while text := file.read(1 << 16):
        line = text.find(b"\n")
        if line >= 0:
            return file.tell() - len(text) + line + 1
    return size


def _record_end(file: pa.NativeFile, at: int, size: int, sep: bytes, inside: bool) -> int:
    """The end of the record that ``at`` lies in: from there inside quotes, or at the start of a record."""
    file.seek(at)
    text = b""
    while more := file.read(max(1 << 16, len(text))):
        text += more
        end = first_record_end(text, sep, inside)
        if end >= 0:
            return at + end
    return size


def parsed(text: bytes, header: list[str], columns: list[str], sep: str, encoding: str) -> Iterator[pa.RecordBatch]:
    """Columns of whole records. Arrow parses them; records of other widths or bad bytes go through Python."""
    from pyarrow import csv as arrow_csv

    schema = pa.schema([(c, pa.string()) for c in columns])
    if not text.strip():
        return
    try:
        table = arrow_csv.read_csv(
            pa.BufferReader(text),
            arrow_csv.ReadOptions(use_threads=False, column_names=header, encoding=encoding),
            arrow_csv.ParseOptions(delimiter=sep, newlines_in_values=True),
            arrow_csv.ConvertOptions(column_types={c: pa.string() for c in header}, include_columns=columns, strings_can_be_null=False))
        yield from table.cast(schema).to_batches(max_chunksize=ROWS)
        return
    except (pa.ArrowInvalid, pa.ArrowKeyError, UnicodeDecodeError):
        pass
    csv.field_size_limit(2**31 - 1)
    places, out = [header.index(c) for c in columns], []
    for row in csv.reader(io.StringIO(text.decode(encoding, "replace"), newline=""), delimiter=sep):
        if row:
            out.append([row[p] if p < len(row) else None for p in places])
        if len(out) == ROWS:
            yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*out)], schema=schema)
            out = []
    if out:
        yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*out)], schema=schema)


def header_names(record: bytes, columns: list[str], sep: str, encoding: str, name: str) -> list[str]:
    text = record.decode(encoding, "replace").lstrip("﻿")
    header = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep), [])
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{name} has no column {', '.join(missing)}")
    return header


def _listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length) of the files that hold something; their content is not looked at."""
    return importable(spark).read.format("binaryFile").load(path).select("path", "length").where("length > 0")


def _texts(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def byte_ranges(spark: SparkSession, path: str | list[str], sep: str = ";", step: int = STEP) -> DataFrame:
    """(path, length, first, last, inside, still): the ranges of each file, from one start of a line to another, and
    whether these lie in quotes. Ranges smaller than ``STEP`` share tasks where there are more than ``TASKS`` for each core."""
    mark = sep.encode()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                with open_file(r["path"]) as file:
                    first, last = (_next_line(file, r[c], r["length"]) for c in ("start", "end"))
                    file.seek(first)
                    text = file.read(max(last - first, 0))
                out.append({**r, "first": first, "last": last, "from_out": ends_inside(text, mark, False), "from_in": ends_inside(text, mark, True)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("path", pa.string()), *[(c, pa.int64()) for c in ("length", "start", "end", "first", "last")],
                ("from_out", pa.bool_()), ("from_in", pa.bool_())]))

    files = _listed(spark, path)
    cuts = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))).alias("start"))
    cuts = cuts.withColumn("end", F.least(F.col("start") + step, F.col("length")))
    ranges, work = files.agg(F.sum(F.ceil(F.col("length") / step)), F.sum(F.ceil(F.col("length") / max(step, STEP)))).first()
    n = min(ranges or 1, max(work or 1, TASKS * spark.sparkContext.defaultParallelism))
    scanned = cuts.repartition(n).mapInArrow(scan, "path string, length long, start long, end long, first long, last long, from_out boolean, from_in boolean")
    # A range sets the state, swaps it or leaves it: the state is that of the last one that set it, and the swaps since.
    order = W.partitionBy("path").orderBy("start")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    swaps = F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)).over(upto)
    set_here = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("state"), F.col("swaps")))
    known = scanned.withColumn("swaps", swaps).withColumn("set", F.last(set_here, ignorenulls=True).over(upto))
    after = (F.coalesce(F.col("set.state"), F.lit(False)).cast("int") + F.col("swaps") - F.coalesce(F.col("set.swaps"), F.lit(0))) % 2 == 1
    known = known.withColumn("still", after).withColumn("inside", F.coalesce(F.lag("still").over(order), F.lit(False)))
    return known.select("path", "length", "first", "last", "inside", "still").repartition(n)


def read_ranges(
    spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";", encoding: str = "utf-8", step: int = STEP,
) -> DataFrame:
    """Named columns of plain delimited files with a header, null tokens made null; ``step`` bytes are held at a time."""
    mark = sep.encode()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header_of, head, header = None, 0, []
        for batch in batches:
            for r in batch.to_pylist():
                with open_file(r["path"]) as file:
                    size = r["length"]
                    if header_of != r["path"]:
                        header_of, header, head = r["path"], None, _record_end(file, 0, size, mark, False)
                    first = _record_end(file, r["first"], size, mark, True) if r["inside"] else r["first"]
                    end = _record_end(file, r["last"], size, mark, True) if r["still"] and r["last"] < size else r["last"]
                    first = max(first, head)
                    if first >= end:
                        continue
                    if header is None:
                        file.seek(0)
                        header = header_names(file.read(head), columns, sep, encoding, r["path"])
                    file.seek(first)
                    text = file.read(end - first)
                yield from parsed(text, header, columns, sep, encoding)

    return null_tokens(byte_ranges(spark, path, sep, step).mapInArrow(records, _texts(columns)))


def zip_members(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, member, length) of the files in zip archives, by their central directories."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                with open_file(uri) as file, zipfile.ZipFile(file) as archive:
                    found = [m for m in archive.infolist() if not m.is_dir()]
                yield pa.record_batch(
                    [pa.array([uri] * len(found), pa.string()), pa.array([m.filename for m in found], pa.string()),
                     pa.array([m.file_size for m in found], pa.int64())], names=["path", "member", "length"])

    archives = _listed(spark, path).select("path")
    return archives.repartition(max(archives.count(), 1)).mapInArrow(members, "path string, member string, length long")


def read_zipped(
    spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";", encoding: str = "utf-8", block: int = BLOCK,
) -> DataFrame:
    """Named columns of the delimited members of zip archives, null tokens made null. One member is one task's work:
    it is unpacked as a stream and parsed in blocks of whole records, so neither it nor its archive is held whole."""
    mark = sep.encode()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with open_file(r["path"]) as file, zipfile.ZipFile(file) as archive, archive.open(r["member"]) as stream:
                    header, text = None, b""
                    while True:
                        more = stream.read(max(block, len(text)))
                        text += more
                        end = last_record_end(text, mark) if more else len(text)
                        whole, text = text[:end], text[end:]
                        if whole and header is None:
                            cut = first_record_end(whole, mark, False)
                            cut = len(whole) if cut < 0 else cut
                            header = header_names(whole[:cut], columns, sep, encoding, f"{r['member']} of {r['path']}")
                            whole = whole[cut:]
                        yield from parsed(whole, header, columns, sep, encoding)
                        if not more:
                            break

    members = zip_members(spark, path).where("length > 0")
    return null_tokens(members.repartition(max(members.count(), 1)).mapInArrow(records, _texts(columns)))
