"""Parallel scan of quoted multi-line delimited text, with quarantine of malformed records.

A quoted field may hold line breaks, so a byte range of a file cannot know by
itself whether it begins inside a record. The scan therefore goes twice over the
splits that Spark's line reader makes (any file system it can read; several
tasks per file unless the codec forbids it):

1. Per split, what it does to the state "inside a quoted field": the end state
   for each of the two start states, and the text of the records that cross its
   ends (``split_states``). One row per split.
2. A prefix scan composes these maps in file order and gives every split's start
   state (``start_states``); the crossing pieces are joined to whole records.
3. The splits are read again with their start states and give the records that
   lie inside them (``records``).

``land`` parses records by the full column list and writes good rows and rejects
(text, file, reason) in one pass. Reasons: ``header`` (a file's first record is
not the column list), ``unclosed_quote`` (the file ends inside a quoted field),
``short`` and ``long`` (fields missing or left over).

A quote opens a field only where the field begins, and two quotes inside are
one, as in the plain reader. Empty lines are no records. Text is UTF-8.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortcraft.session import checkpoint_dir

MAX_OPEN_SPLITS = 1_000_000
"""Splits that begin inside a quoted field and are named to the tasks (about 100 bytes each); more raise."""
REASONS = ("header", "unclosed_quote", "short", "long")
BOM = "﻿"

# A quoted field up to its closing quote, then anything up to the separator; or an unquoted one.
_CLOSE = re.compile(r'(?:[^"]|"")*+"(?!")')
_REST = re.compile(r"[^,]*+(?:,|\Z)")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, given whether one was open before it."""
    at, end = 0, len(line)
    while True:
        if inside or (at < end and line[at] == '"'):
            closed = _CLOSE.match(line, at if inside else at + 1)
            if closed is None:
                return True
            inside, at = False, closed.end()
        at = _REST.match(line, at).end()
        if at >= end:
            return False


def _changes(values: pa.Array, inside: bool) -> tuple[list[int], bool]:
    """Rows after which the state changes, and the state at the end."""
    quoted = pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist()
    out = []
    for i in quoted:
        after = ends_inside(values[i].as_py(), inside)
        if after != inside:
            out.append(i)
            inside = after
    return out, inside


class _Piece:
    """The state of one split under one start state, read batch by batch."""

    def __init__(self, inside: bool) -> None:
        self.inside = inside
        self.head: list[str] | None = [] if inside else None  # lines that end a record of an earlier split
        self.ended = not inside  # whether a record has ended or begun here
        self.tail: list[str] = []

    def read(self, values: pa.Array) -> Iterator[tuple[int, int, str | None]]:
        """Whole records as (first, end, None) row ranges or (0, 0, text) when they have several lines."""
        at = 0
        changes, last = _changes(values, self.inside)
        for i in changes:
            if not self.inside:  # a record of several lines opens in row i
                if at < i:
                    yield at, i, None
                self.tail, at = [values[i].as_py()], i + 1
            else:
                lines = [v.as_py() for v in values.slice(at, i + 1 - at)]
                if self.ended:
                    yield 0, 0, "\n".join([*self.tail, *lines])
                else:
                    self.head, self.ended = [*self.head, *lines], True
                self.tail, at = [], i + 1
            self.inside = not self.inside
        if at < len(values):
            if not self.inside:
                yield at, len(values), None
            else:
                rest = [v.as_py() for v in values.slice(at)]
                if self.ended:
                    self.tail += rest
                else:
                    self.head += rest
        self.inside = last


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """(split, lines) in reading order; a split may come in several parts."""
    for batch in batches:
        path, start, value = batch.columns
        cuts = [0]
        if batch.num_rows > 1:
            same = pc.and_(pc.equal(path.slice(1), path.slice(0, len(path) - 1)), pc.equal(start.slice(1), start.slice(0, len(start) - 1)))
            cuts += [i + 1 for i in pc.indices_nonzero(pc.invert(same)).to_pylist()]
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            if b > a:
                yield (path[a].as_py(), start[a].as_py()), value.slice(a, b - a)


_STATES = "path string, start bigint, after_outside boolean, after_inside boolean, head string, tail_outside string, tail_inside string"


def split_states(lines: DataFrame) -> DataFrame:
    """One row per split: end state per start state, the lines that end an open record, and those that open one.

    ``head`` is null where no record ends; then the whole split is ``tail_inside``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("start", pa.int64()), ("after_outside", pa.bool_()), ("after_inside", pa.bool_()),
             ("head", pa.string()), ("tail_outside", pa.string()), ("tail_inside", pa.string())]
        )

        def row(split, outside: _Piece, inside: _Piece) -> pa.RecordBatch:
            text = lambda lines, there: "\n".join(lines) if there else None
            return pa.RecordBatch.from_pylist([{
                "path": split[0], "start": split[1], "after_outside": outside.inside, "after_inside": inside.inside,
                "head": text(inside.head, inside.ended), "tail_outside": text(outside.tail, outside.inside),
                "tail_inside": text(inside.tail if inside.ended else inside.head, inside.inside),
            }], schema)

        held, outside, inside = None, None, None
        for split, values in _by_split(batches):
            if split != held:
                if held is not None:
                    yield row(held, outside, inside)
                held, outside, inside = split, _Piece(False), _Piece(True)
            for piece in (outside, inside):
                for _ in piece.read(values):
                    pass
        if held is not None:
            yield row(held, outside, inside)

    return lines.mapInArrow(run, _STATES)


def start_states(states: DataFrame) -> DataFrame:
    """``states`` with ``inside``: whether the split begins inside a quoted field.

    The prefix scan: a split whose end state does not depend on its start fixes
    the state behind it; from the last such split on, only flips count.
    """
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("after_outside") == F.col("after_inside")
    flips = (F.col("after_outside") & ~F.col("after_inside")).cast("int")
    marked = states.withColumn("_flips", F.sum(flips).over(order))
    last = F.last(F.when(fixed, F.struct("after_outside", "_flips")), ignorenulls=True).over(before)
    since = F.coalesce(F.lag("_flips").over(order), F.lit(0)) - F.coalesce(F.col("_last._flips"), F.lit(0))
    return marked.withColumn("_last", last).select(
        *states.columns, (F.coalesce(F.col("_last.after_outside"), F.lit(False)) != (since % 2 == 1)).alias("inside")
    )


def _crossing(starts: DataFrame) -> DataFrame:
    """(path, start, record, closed): records that lie in several splits, from their pieces."""
    head = F.when(F.col("inside") & F.col("head").isNotNull(), F.struct(F.lit(0).alias("k"), F.col("head").alias("text")))
    whole = F.col("inside") & F.col("head").isNull()
    tail = F.when(F.col("inside"), F.col("tail_inside")).otherwise(F.col("tail_outside"))
    opens = F.when(tail.isNotNull(), F.struct(F.when(whole, 0).otherwise(1).alias("k"), tail.alias("text")))
    pieces = starts.select("path", "start", F.explode(F.array_compact(F.array(head, opens))).alias("p")).select(
        "path", "start", "p.*", F.lit(1).alias("one")
    )
    # a piece of kind 1 opens a record; what follows up to the next one belongs to it
    order = Window.partitionBy("path").orderBy("start", "k")
    numbered = pieces.withColumn("record_no", F.sum(F.when(F.col("k") == 1, 1).otherwise(0)).over(order))
    joined = numbered.groupBy("path", "record_no").agg(
        F.min("start").alias("start"), F.sort_array(F.collect_list(F.struct("start", "k", "text"))).alias("parts")
    )
    record = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return joined.select("path", "start", record.alias("record"))


_RECORDS = "path string, start bigint, record string, first boolean"


def _inside_records(lines: DataFrame, open_splits: set[tuple[str, int]]) -> DataFrame:
    """Records that lie inside one split; ``first`` marks the first record of a file."""
    spark = lines.sparkSession
    sent = spark.sparkContext.broadcast(open_splits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, piece, first = None, None, False
        for split, values in _by_split(batches):
            if split != held:
                held, piece = split, _Piece(split in sent.value)
                first = split[1] == 0
            parts = []
            for a, b, text in piece.read(values):
                parts.append(values.slice(a, b - a) if text is None else pa.array([text], values.type))
            if parts:
                found = pa.concat_arrays(parts)
                marks = pa.array([first and i == 0 for i in range(len(found))])
                first = False
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()), found.cast(pa.string()), marks],
                    names=["path", "start", "record", "first"],
                )

    return lines.mapInArrow(run, _RECORDS)


@contextmanager
def _same_splits(spark: SparkSession):
    """Within it, files are cut alike however many executors there are."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    if before is None:
        spark.conf.set(key, str(max(spark.sparkContext.defaultParallelism, 1)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/text-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, start, record, first, closed): every record of the files, without its line end.

    ``start`` is the split in which the record begins, ``first`` marks a file's
    first record, ``closed`` is false where the file ends inside a quoted field.
    The splits' states are computed at once; use the result while the session's
    file settings stay as they are (``land`` sees to that itself).
    """
    lines = _lines(spark, path)
    starts = _written(start_states(split_states(lines)), "splits")
    open_ = starts.where("inside").select("path", "start").limit(MAX_OPEN_SPLITS + 1).collect()
    if len(open_) > MAX_OPEN_SPLITS:
        raise ValueError(f"over {MAX_OPEN_SPLITS} splits begin inside a quoted field; read with larger spark.sql.files.maxPartitionBytes")
    whole = _inside_records(lines, {(r["path"], r["start"]) for r in open_})
    crossing = _crossing(starts)
    # a file's last record may be open; a record that crosses may be the file's first
    ends = starts.groupBy("path").agg(
        F.max_by(F.when(F.col("inside"), F.col("after_inside")).otherwise(F.col("after_outside")), "start").alias("open_end")
    )
    last = Window.partitionBy("path").orderBy(F.desc("start"))
    crossing = crossing.withColumn("_last", F.row_number().over(last) == 1).join(ends, "path").select(
        "path", "start", "record", F.lit(False).alias("first"), (~(F.col("_last") & F.col("open_end"))).alias("closed")
    )
    text = F.regexp_replace("record", r"\r$", "")
    both = whole.withColumn("closed", F.lit(True)).unionByName(crossing).withColumn("record", text)
    return both.where(F.col("record") != "")


def _fields(record: Column) -> Column:
    """Number of fields of a record, quoted ones taken out first."""
    bare = F.regexp_replace(record, r'(^|,)"(?:[^"]|"")*"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _parsed(found: DataFrame, columns: list[str], header: bool) -> DataFrame:
    names = ",".join(columns)
    corrupt = "_corrupt"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, corrupt]])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    row = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options)
    count = _fields(F.col("record"))
    is_head = F.col("first") if header else F.lit(False)
    plain = F.regexp_replace(F.regexp_replace("record", f"^{BOM}", ""), '"', "")
    reason = (
        F.when(is_head & (plain != names), "header")
        .when(~F.col("closed"), "unclosed_quote")
        .when(count < len(columns), "short")
        .when(count > len(columns), "long")
        .when(F.col("_row")[corrupt].isNotNull(), "malformed")
    )
    out = found.withColumn("_row", row).withColumn("_reason", reason)
    return out.where(~(is_head & F.col("_reason").isNull())).select(
        *(F.col("_row")[c].alias(c) for c in columns), F.col("path").alias("_path"), F.col("record").alias("_record"), "_reason"
    )


def land(
    spark: SparkSession, path: str | list[str], columns: Iterable[str], out: str, header: bool = True, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Write the files' records as a table at ``out``; returns (rows, rejects) read back from it.

    Good rows hold ``columns`` as text; rejects hold ``text``, ``file`` and
    ``reason``. ``strict`` raises when there is a reject.
    """
    columns = list(columns)
    with _same_splits(spark):
        parsed = _parsed(records(spark, path), columns, header)
        good = F.col("_reason").isNull()
        parsed.withColumn("_rejected", ~good).select(
            *(F.when(good, F.col(c)).alias(c) for c in columns),
            *(F.when(~good, F.col(c)).alias(c) for c in ("_path", "_record")), "_reason", "_rejected",
        ).write.mode("overwrite").option("compression", "zstd").partitionBy("_rejected").parquet(out)
    fields = [T.StructField(c, T.StringType()) for c in [*columns, "_path", "_record", "_reason"]]
    table = spark.read.schema(T.StructType([*fields, T.StructField("_rejected", T.BooleanType())])).parquet(out)
    rejects = table.where("_rejected").select(
        F.col("_record").alias("text"), F.element_at(F.split("_path", "/"), -1).alias("file"), F.col("_reason").alias("reason")
    )
    if strict:
        first = rejects.limit(3).collect()  # shown in the error only
        if first:
            raise ValueError("malformed records: " + "; ".join(f"{r['file']}: {r['reason']}: {r['text'][:80]}" for r in first))
    return table.where(~F.col("_rejected")).select(*columns), rejects
