"""Delimited text with quoted line breaks, read by byte ranges.

Spark divides a CSV file among tasks only if no cell holds a line break, since a task that starts at some byte cannot know whether
it starts inside a cell.  Here it need not know:

1. Every range of lines is scanned once for both cases, started outside and inside a quoted cell: how it ends, and how many records
   begin in it.  That is one row of numbers a range.
2. The ranges of a file are chained in order (each end is the next start), which tells every range its true start and the number of
   records before it, over all files by name.
3. Every range is read again with that knowledge: records that lie within it are parsed there; what is cut by its borders comes out as
   pieces under the record's number, and the pieces alone are grouped, joined and parsed.

So a table of any size is read by as many tasks as it has ranges, rows are numbered in table order (part files by name, then place) and equal
those of Python's ``csv``: a quote opens a cell only at the cell's start, ``""`` within is a quote, blank lines are no records.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "file string, row_index long, cells array<string>, piece long, text string"
csv.field_size_limit(2 ** 31 - 1)


class Lines:
    """What a line does to the two states between lines: outside a cell, or inside a quoted one."""

    def __init__(self, sep: str):
        other = f"[^{re.escape(sep)}]*+"
        quoted = '(?:[^"]++|"")*+'  # possessive: a pair of quotes is never taken for the end of a cell
        self.opens = re.compile(f'(?:(?:"{quoted}"{other}|(?!"){other}){re.escape(sep)})*+"{quoted}')
        self.closes = re.compile(f'{quoted}"{other}')

    def ends_inside(self, line: str, inside: bool) -> bool:
        if not inside:
            return self.opens.fullmatch(line) is not None
        closed = self.closes.match(line)
        if not closed:
            return True
        return closed.end() < len(line) and self.ends_inside(line[closed.end() + 1:], False)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, value``: lines in order within the byte range they begin in."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(b: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """Consecutive lines of one file and range."""
    file, block = b.column("file").to_pylist(), b.column("block").to_pylist()
    at = 0
    for i in range(1, b.num_rows + 1):
        if i == b.num_rows or block[i] != block[at] or file[i] != file[at]:
            yield file[at], block[at], b.column("value").slice(at, i - at)
            at = i


def ranges(lines: DataFrame, sep: str) -> DataFrame:
    """``file, block, end0, n0, end1, n1``: for a start outside (0) and inside (1) a cell, whether the range ends inside one and how many
    records begin in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, held = Lines(sep), {}
        for b in batches:
            for file, block, values in _runs(b):
                now = held.setdefault((file, block), [False, 0, True, 0])
                plain = pc.invert(pc.match_substring(values, '"'))
                blank = pc.or_(pc.equal(values, ""), pc.equal(values, "\r"))
                for line, simple, empty in zip(values.to_pylist(), plain.to_pylist(), blank.to_pylist()):
                    for k in (0, 2):
                        if not now[k] and not empty:
                            now[k + 1] += 1
                        if not simple:
                            now[k] = rule.ends_inside(line, now[k])
        rows = [(*key, *v) for key, v in held.items()]
        cols = list(zip(*rows)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()))],
                                         ["file", "block", "end0", "n0", "end1", "n1"])

    return lines.mapInArrow(run, "file string, block long, end0 boolean, n0 long, end1 boolean, n1 long")


def chained(rows: list[tuple]) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """By (file, block): whether the range starts inside a cell, the file's records before it, and all files' data rows before its file."""
    out, file, inside, before, rows_before = {}, None, False, 0, 0
    for f, block, end0, n0, end1, n1 in sorted(rows):
        if f != file:
            rows_before += max(before - 1, 0)  # the first record is the header
            file, inside, before = f, False, 0
        out[f, block] = (inside, before, rows_before)
        inside, before = (end1, before + n1) if inside else (end0, before + n0)
    return out


def parsed(text: str, sep: str) -> list[str]:
    """The cells of one record; a carriage return that ends the line is no part of it."""
    text = text[:-1] if text.endswith("\r") else text
    return next(csv.reader([text], delimiter=sep)) if "\r" not in text else _cells(text, sep)


def _cells(text: str, sep: str) -> list[str]:
    """As ``csv`` does, but a carriage return within the line is a character like any other."""
    out, quoted = [], re.compile('"((?:[^"]++|"")*+)("?)')
    while True:
        if m := quoted.match(text):
            tail, _, rest = text[m.end():].partition(sep)
            more = m.end() + len(tail) < len(text)
            out.append(m.group(1).replace('""', '"') + tail)
        else:
            tail, _, rest = text.partition(sep)
            more = len(tail) < len(text)
            out.append(tail)
        if not more:
            return out
        text = rest


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``row_index, cells``: every record of the files under ``path``, numbered from 0 over all files; each file's first record is its
    header, with ``row_index`` -1."""
    lines = _lines(spark, path)
    starts = chained([tuple(r) for r in ranges(lines, sep).collect()])  # a row of numbers for each byte range
    known = spark.sparkContext.broadcast(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, done = Lines(sep), []
        now, inside, record, offset, own, open_lines = None, False, 0, 0, False, []

        def close(last: bool) -> None:
            """The open record ends here, or (not ``last``) goes on in the next range."""
            if open_lines:
                text, row = "\n".join(open_lines), offset + record if record else -1
                done.append((now[0], row, parsed(text, sep), None, None) if last and own else (now[0], row, None, now[1], text))
                open_lines.clear()

        for b in batches:
            for file, block, values in _runs(b):
                if now != (file, block):
                    close(False)
                    now, own = (file, block), False
                    inside, before, rows_before = known.value[now]
                    record, offset = before - 1, rows_before - 1
                for line, simple in zip(values.to_pylist(), pc.invert(pc.match_substring(values, '"')).to_pylist()):
                    if not inside and not open_lines:
                        if line in ("", "\r"):
                            continue
                        record, own = record + 1, True
                    open_lines.append(line)
                    inside = inside if simple else rule.ends_inside(line, inside)
                    if not inside:
                        close(True)
            yield _batch(done)
            done.clear()
        close(False)
        yield _batch(done)

    found = lines.mapInArrow(run, ROW)
    pieces = found.where("cells is null").groupBy("file", "row_index").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda p: p["text"]), "\n").alias("text"))

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(f, r, parsed(t, sep), None, None) for f, r, t in zip(*[b.column(c).to_pylist() for c in ("file", "row_index", "text")])])

    whole = found.where("cells is not null").unionByName(pieces.mapInArrow(stitch, ROW))
    return whole.select("row_index", "cells")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 5
    types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["file", "row_index", "cells", "piece", "text"])


def header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """The column names: the first line of a file (a name holds no line break); all part files have the same."""
    first = spark.read.option("lineSep", "\n").text(path).first()
    return parsed(first[0], sep) if first else []


def rows(spark: SparkSession, path: str, sep: str, names: list[str] | None = None, wanted: list[str] | None = None) -> DataFrame:
    """``row_index`` and the data rows' cells under ``names`` (those of the header if none are given), as text, ``''`` where a row is short.
    ``wanted`` names the columns needed, in any order; a missing one is an error."""
    names = header(spark, path, sep) if names is None else names
    if missing := [c for c in wanted or () if c not in names]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    at = {c: i for i, c in reversed(list(enumerate(names)))}
    return records(spark, path, sep).where("row_index >= 0").select(
        "row_index", *[F.coalesce(F.get("cells", F.lit(at[c])), F.lit("")).alias(c) for c in (wanted or names)])
