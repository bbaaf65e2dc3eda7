"""Delimited records whose quoted fields may hold line breaks, from splittable
files.

A line is a whole record unless a quoted field is open at one of its ends.
Whether a field is open where a file split begins depends on all bytes before
it, so each split first says in which state it would end for both states it
could begin in (one row per split); composed in file order, these say how each
split begins.  A second pass over the lines then cuts records; only the pieces
of records that cross a border of splits (two per split at most) are grouped.
Files of any size are read in parallel, and no line is shuffled.
"""

from __future__ import annotations

import csv

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: lines looked at for a file's first record
HEADER_LINES = 256


def open_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted field is open at the end of ``line``, if one is
    (``inside``) or is not at its start.  A quote opens a field only as its
    first character; two quotes inside a quoted field are one of its text."""
    if not inside and '"' not in line:
        return False
    at = 0
    if not inside and line.startswith('"'):
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line[at + 1:at + 2] == '"':
                at = line.find('"', at + 2)
            if at < 0:
                return True
            at += 1
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1
        inside = line[at:at + 1] == '"'
        at += inside


def first_record(spark: SparkSession, path: str, sep: str = ",") -> str | None:
    """The header record of a file; None for an empty file."""
    lines, inside = [], False
    for row in spark.read.text(path, lineSep="\n").limit(HEADER_LINES).collect():
        lines.append(row[0])
        inside = open_after(row[0], inside, sep)
        if not inside and "\n".join(lines).strip("﻿\r \t"):
            return "\n".join(lines).lstrip("﻿").rstrip("\r")
        if not inside:
            lines.clear()
    if inside:
        raise ValueError(f"{path}: no header record within {HEADER_LINES} lines")
    return None


def field_names(header: str, sep: str = ",") -> list[str]:
    """Names of a header record, trimmed; a repeated name gets .1, .2, ..."""
    names, used = [], {}
    for name in next(csv.reader([header], delimiter=sep)):
        name = name.strip()
        used[name] = used.get(name, -1) + 1
        names.append(f"{name}.{used[name]}" if used[name] else name)
    return names


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batches):
    """((file, start), lines) of consecutive rows of one split."""
    for b in batches:
        files, starts, values = (b.column(c).to_pylist() for c in ("file", "start", "value"))
        lo = 0
        while lo < len(values):
            hi = lo + 1
            while hi < len(values) and starts[hi] == starts[lo] and files[hi] == files[lo]:
                hi += 1
            yield (files[lo], starts[lo]), values[lo:hi]
            lo = hi


def split_states(lines: DataFrame, sep: str = ",") -> DataFrame:
    """file, start, from_out, from_in: the state at each split's end."""
    def run(batches):
        split, states = None, (False, True)

        def row():
            return pa.RecordBatch.from_pydict({"file": [split[0]], "start": pa.array([split[1]], pa.int64()),
                                               "from_out": [states[0]], "from_in": [states[1]]})

        for key, values in _runs(batches):
            if key != split:
                if split:
                    yield row()
                split, states = key, (False, True)
            for v in values:
                if states[0] == states[1]:
                    states = (open_after(v, states[0], sep),) * 2
                else:
                    states = (open_after(v, states[0], sep), open_after(v, states[1], sep))
        if split:
            yield row()

    return lines.mapInArrow(run, "file string, start long, from_out boolean, from_in boolean")


def begins_inside(states: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin inside a quoted field.  A file's splits (one per
    file block) are composed in one row; only splits cut inside a field come
    to the driver."""
    per = states.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("start", "from_out", "from_in"))).alias("s"))
    step = lambda acc, s: F.struct(
        F.when(acc.inside, s.from_in).otherwise(s.from_out).alias("inside"),
        F.when(acc.inside, F.concat(acc.cut, F.array(s.start))).otherwise(acc.cut).alias("cut"))
    begin = F.struct(F.lit(False).alias("inside"), F.array().cast("array<bigint>").alias("cut"))
    cut = per.select("file", F.explode(F.aggregate("s", begin, step, lambda acc: acc.cut)).alias("start"))
    return {(r["file"], r["start"]) for r in cut.collect()}


def records(spark: SparkSession, paths: list[str], sep: str = ",") -> DataFrame:
    """file, record of every record of the files, their headers left out.  A
    record keeps the line breaks inside its quoted fields; blank lines between
    records are none.  A field that never closes runs to the end of its file.
    """
    lines = _lines(spark, paths)
    inside_at = begins_inside(split_states(lines, sep))

    def run(batches):
        split, open_, parts, head, first = None, False, [], False, True
        out = ([], [], [], [])

        def put(kind):
            nonlocal first
            text = "\n".join(parts)
            parts.clear()
            if kind == "whole":
                text = text.rstrip("\r")
                if not text.strip("﻿ \t"):
                    return
                if first and split[1] == 0:
                    first = False
                    return
            first = False
            for column, v in zip(out, (*split, kind, text)):
                column.append(v)

        def close():
            if split and parts:
                # what is still open ends in another split (or with the file)
                put("middle" if head else "tail")

        def batch():
            b = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                                            pa.array(out[3], pa.string())], ["file", "start", "kind", "record"])
            for column in out:
                column.clear()
            return b

        for key, values in _runs(batches):
            if key != split:
                close()
                split, first = key, True
                head = open_ = key in inside_at
            for v in values:
                parts.append(v)
                open_ = open_after(v, open_, sep)
                if not open_:
                    put("head" if head else "whole")
                    head = False
            yield batch()
        close()
        if out[0]:
            yield batch()

    cut = lines.mapInArrow(run, "file string, start long, kind string, record string")
    if not inside_at:
        # an unclosed last field is a record of its own
        return cut.select("file", F.rtrim("record", F.lit("\r")).alias("record"))
    pieces = cut.where(F.col("kind") != "whole")
    turn = F.sum((F.col("kind") == "tail").cast("int")).over(Window.partitionBy("file").orderBy("start", (F.col("kind") == "tail")))
    joined = (pieces.withColumn("turn", turn).groupBy("file", "turn")
              .agg(F.array_sort(F.collect_list(F.struct("start", (F.col("kind") == "tail").alias("last"), "record"))).alias("p"))
              .select("file", F.array_join(F.transform("p", lambda x: x.record), "\n").alias("record")))
    return cut.where(F.col("kind") == "whole").select("file", "record").unionByName(
        joined.select("file", F.rtrim("record", F.lit("\r")).alias("record")))
