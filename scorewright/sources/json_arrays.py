"""JSON array files read entry by entry (A1-A3, A5, H1).

A JSON array has no line structure that Spark could split at.  The files are therefore read by the
text source with ``}`` as line separator: short rows whatever the layout, through any file system that
Spark reads, and large files in many splits.  The rows of a file come together in order (one shuffle,
a sort that can spill) and stream through a small cutter, which follows strings and brackets and
gives out each array element with its exact 0-based position.  No file is ever held whole: a task
holds one Arrow batch and one element.

A file with any fault (no array, cut off, text after the end, an element that is no JSON) gives no
entries at all and one row of the rejects with the reason, as a file that cannot be parsed is skipped,
never fatal.  Files without a single byte are not seen by Spark's sources; they hold no entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scorewright.session import materialize

_MARK = re.compile(r'["\[\]{},]')
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_CUT = "src_file string, ordinal long, entry string, fault string"


class Cutter:
    """Cuts one file's text, fed in pieces, into the elements of its array."""

    def __init__(self) -> None:
        self.depth, self.count, self.fault = 0, 0, None
        self.in_string = self.closed = self.nonblank = False
        self.parts: list[str] = []

    def feed(self, text: str) -> Iterator[tuple[int, str]]:
        at = start = 0
        while self.fault is None and at < len(text):
            if self.in_string:
                m = _STRING_END.match(text, at)
                if m is None:
                    break
                self.in_string, at = False, m.end()
                continue
            m = _MARK.search(text, at)
            end = m.start() if m else len(text)
            if self.depth == 0 and text[at:end].strip(" \t\r\n﻿"):
                self.fault = "text after the array" if self.closed else "not an array"
                break
            if m is None:
                break
            mark, at = m[0], m.end()
            if self.depth == 0:
                if mark != "[" or self.closed:
                    self.fault = "text after the array" if self.closed else "not an array"
                    break
                self.depth, start = 1, at
            elif mark == '"':
                self.in_string = True
            elif mark in "[{":
                self.depth += 1
            elif self.depth > 1:
                self.depth -= mark in "]}"
            elif mark == "}":
                self.fault = "unbalanced brackets"
            else:                                   # the end of an element: a comma, or the array's own bracket
                self.parts.append(text[start:m.start()])
                element = "".join(self.parts).strip()
                self.parts, start = [], at
                if element:
                    yield self.count, element
                    self.count += 1
                elif mark == "," or self.count:
                    self.fault = "an empty element"
                if mark == "]":
                    self.depth, self.closed = 0, True
        if self.depth and self.fault is None:
            self.parts.append(text[start:])

    def close(self) -> str | None:
        """The file's fault once all of it was fed; None when it was a whole array."""
        return self.fault or (None if self.closed else "cut off")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in file order -> one row per element and, per file, a last row (ordinal -1) with its fault."""
    name, cutter, held = None, Cutter(), None
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)],
                                          ["src_file", "ordinal", "entry", "fault"])

    def finish() -> None:
        if name is not None:
            out.extend((name, i, e, None) for i, e in cutter.feed(held))
            out.append((name, -1, None, cutter.close()))

    for batch in batches:
        for file, piece in zip(batch.column("src_file").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if file == name:                        # a separator stood between two pieces
                out.extend((name, i, e, None) for i, e in cutter.feed(held + "}"))
            else:
                finish()
                name, cutter = file, Cutter()
            held = piece
        yield flush()
    finish()
    yield flush()


def read_array_entries(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True,
                       tally: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, rejects): every element as (src_file, src_name, ordinal, e VARIANT) and the files left out as
    (src_file, reason).  ``tally`` counts files read, kept and rejected.  The cut elements are written once."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    pieces = reader.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_seq"), "value")
    ordered = pieces.repartition("src_file").sortWithinPartitions("src_file", "_at", "_seq")
    cut = materialize(ordered.select("src_file", "value").mapInArrow(_cut, _CUT), "entries")
    cut = cut.withColumn("e", F.try_parse_json("entry"))
    bad = F.when(F.col("entry").isNotNull() & F.col("e").isNull(), F.lit("not JSON"))
    verdicts = cut.groupBy("src_file").agg(F.coalesce(F.max("fault"), F.max(bad)).alias("reason"))
    files = verdicts if tally is None else observed(verdicts, tally)
    rejects = files.filter(F.col("reason").isNotNull())
    entries = cut.filter("ordinal >= 0").join(verdicts.filter(F.col("reason").isNotNull()), "src_file", "left_anti")
    name = F.regexp_extract(decoded("src_file"), r"([^/]*)$", 1)
    return entries.select("src_file", name.alias("src_name"), "ordinal", "e"), rejects


def observed(rows: DataFrame, tally: Observation, reason: str = "reason") -> DataFrame:
    """``rows`` with counters of what was read, kept (no reason) and rejected; filled when an action runs."""
    return rows.observe(tally, F.count(F.lit(1)).alias("read"), F.count_if(F.col(reason).isNull()).alias("kept"),
                        F.count_if(F.col(reason).isNotNull()).alias("rejected"))


def decoded(column: str) -> F.Column:
    """A ``_metadata`` path with its percent escapes (blanks and the like) taken back."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def below(column: str, root: str) -> F.Column:
    """The part of a file's path below ``root``; the bare file name where the root is a pattern or unknown."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"
    p = decoded(column)
    at = F.instr(p, bare)
    return F.when(at > 0, F.substring(p, at + len(bare), 1 << 20)).otherwise(F.regexp_extract(p, r"([^/]*)$", 1))
