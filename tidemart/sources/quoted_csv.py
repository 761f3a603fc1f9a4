"""CSV records with line breaks inside quotes, read by many tasks.

A CSV file is read as lines, which Spark splits by byte ranges. Where a record
ends depends on whether a line break is inside quotes, so on everything before
it in the file; but all that a line (or a whole range) does is turn "outside
quotes" and "inside quotes" into one of the two. Each range tells where it leads
from either; one row per range is enough to know how every range begins. Then
the ranges cut their own records, in parallel. Only a record that crosses a
border between ranges is put together afterwards, from one piece per range.

Quotes follow the usual rules: a quote opens a field only at the field's start,
two quotes inside quotes are one, any other quote is an ordinary character. A
record ends at a line feed, a carriage return before it goes with it. Blank
lines are skipped; a file that ends inside quotes is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_OPENS = re.compile('(?:^|,)"')  # at the start of a line that is outside quotes
_OPENS_LATER = re.compile(',"')
#: What a row of ``_pieces`` is: a whole record, the end of one that began in an
#: earlier range, all of a range within one record, the start of one that goes on.
WHOLE, END, MIDDLE, START = 0, 1, 2, 3
_BATCH_ROWS = 4096


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of ``line`` is inside quotes, given that of its start."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside, at = False, at + 1
        # outside: after the closing quote only a comma lets the next field begin
        found = (_OPENS_LATER if at else _OPENS).search(line, at)
        if not found:
            return False
        inside, at = True, found.end()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the byte range), line; in file order within a range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"))


def _ranges(batches) -> Iterator[tuple[tuple[str, int], list[str], bool]]:
    """((file, start), lines, first): runs of lines of one range in order."""
    last = None
    for b in batches:
        files, starts, lines = (c.to_pylist() for c in b.columns)
        at = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or starts[i] != starts[at] or files[i] != files[at]:
                key = (files[at], starts[at])
                yield key, lines[at:i], key != last
                last, at = key, i


def _effects(lines: DataFrame) -> DataFrame:
    """file, start, from_outside, from_inside: where each range leads."""
    def run(batches):
        out, state = [], None
        for key, some, first in _ranges(batches):
            if first:
                if state:
                    out.append(state)
                state = [*key, False, True]
            for line in some:
                if '"' in line:
                    state[2:] = inside_after(line, state[2]), inside_after(line, state[3])
        if state:
            out.append(state)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out) if out else ([],) * 4, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
            names=["file", "start", "from_outside", "from_inside"])

    return lines.mapInArrow(run, "file string, start long, from_outside boolean, from_inside boolean")


def _beginnings(effects: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether each range begins inside quotes. One row per range comes to the
    driver, as many as the scan has splits, which the driver planned itself."""
    out, file, inside = {}, None, False
    for r in effects.orderBy("file", "start").toLocalIterator():
        if r["file"] != file:
            file, inside = r["file"], False
        out[r["file"], r["start"]] = inside
        inside = r["from_inside"] if inside else r["from_outside"]
    return out


def _pieces(lines: DataFrame, begins) -> DataFrame:
    """file, start, kind, first, text: records and the pieces of those that
    cross a border; ``first`` marks the first record of a file."""
    def run(batches):
        rows: list[tuple] = []
        key, kind, held, inside = None, WHOLE, [], False
        top = False  # the next record is the file's first

        def flush():
            done, rows[:] = list(rows), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*done) if done else ([],) * 5, (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
                names=["file", "start", "kind", "first", "text"])

        def leave():
            if held:
                rows.append((*key, MIDDLE if kind == END else START, top, "\n".join(held)))

        for now, some, new in _ranges(batches):
            if new:
                leave()
                key, inside, held = now, begins.value[now], []
                kind, top = (END if inside else WHOLE), now[1] == 0
            for line in some:
                held.append(line)
                if '"' in line:
                    inside = inside_after(line, inside)
                if not inside:
                    text = "\n".join(held).removesuffix("\r")
                    if text or kind == END:
                        rows.append((*key, kind, top, text))
                        top = False
                    kind, held = WHOLE, []
                    if len(rows) >= _BATCH_ROWS:
                        yield flush()
        leave()
        yield flush()

    return lines.mapInArrow(run, "file string, start long, kind int, first boolean, text string")


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, first, text: every record of the CSV files under ``path``, without
    the line break that ends it."""
    lines = _lines(spark, path)
    begins = spark.sparkContext.broadcast(_beginnings(_effects(lines)))
    pieces = _pieces(lines, begins)
    # at most two pieces per range; a record is a START, any MIDDLEs and an END
    order = Window.partitionBy("file").orderBy("start", "kind")
    crossing = pieces.filter(F.col("kind") != WHOLE).withColumn(
        "record", F.sum((F.col("kind") == START).cast("long")).over(order))
    joined = crossing.groupBy("file", "record").agg(
        F.max("first").alias("first"), (F.max((F.col("kind") == END).cast("int")) == 1).alias("ended"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))),
                                 lambda x: x["text"]), "\n").alias("text"))
    whole = F.when(F.col("ended"), F.col("text")).otherwise(F.raise_error(
        F.concat(F.lit("the file ends inside quotes: "), F.col("file"))))
    return (pieces.filter(F.col("kind") == WHOLE).select("file", "first", "text")
            .unionByName(joined.select("file", "first", whole.alias("text"))))


def _names(header: str) -> list[str]:
    import csv

    return next(csv.reader([header.removeprefix("﻿")]), [])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header; the header of every file must
    be that of the first one. A record with another number of fields is an
    error."""
    found = records(spark, path)
    headers = [r["text"] for r in found.filter("first").select("text").distinct().limit(2).collect()]
    if not headers:
        return spark.createDataFrame([], StructType([]))
    names = _names(headers[0])
    if any(_names(h) != names for h in headers):
        raise ValueError(f"{path}: the header differs between files: {headers}")
    ddl = ", ".join("`{}` string".format(c.replace("`", "``")) for c in names)
    parsed = F.from_csv("text", ddl, {"escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    return found.filter("not first").select(parsed.alias("r")).select("r.*")
