"""Quoted delimited files with line breaks inside fields, read by many tasks.

Spark's ``multiLine`` gives a file to one task, because only the quotes before
a line break tell whether it ends a record. Here a file is split at byte ranges
like any text file, and the quotes are counted first:

1. every split counts its quotes; a running sum over the splits of a file (one
   row per split) tells which splits start inside a quoted field;
2. each task joins the physical lines of its splits to records: a record ends
   with the first line after which the number of quotes is even;
3. a record cut by a split's end leaves a tail there and heads in the splits
   that follow; only these pieces are shuffled and put together;
4. every record is parsed by Spark's own CSV parser (``from_csv``).

The text itself is not shuffled. Splits that start inside a field reach the
tasks as a broadcast of one row per split, behind a check of their number;
above ``max_broadcast_splits`` the lines are grouped by split with a shuffle,
and the rest is the same.

Defined results: fields with quotes are quoted and double them (a lone quote in
an unquoted field would open a field); a record ends with LF or CRLF; in a file
whose first line ends with CRLF, a CRLF inside quotes is read as LF (as Spark's
reader does), otherwise it stays; blank records are skipped; the first record
of each file is its header; a field never closed takes the rest of its file
(without its last line break).
Files are UTF-8. A compressed file is one split. A change of the splits between the passes
(another width of the cluster) fails the job instead of giving wrong records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Splits (one small row each) up to which their states are broadcast.
MAX_BROADCAST_SPLITS = 200_000
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, row, line``: physical lines with their split and order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))


def split_states(lines: DataFrame) -> DataFrame:
    """``file, block, start, after, crlf``: 1 where a split starts / ends inside quotes; whether the file's first
    line ends with CRLF."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    odd = lines.groupBy(*_SPLIT).agg((F.sum(quotes) % 2).alias("odd"),
                                       F.min_by(F.col("line").endswith("\r"), "row").alias("crlf"))
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    return odd.select(*_SPLIT, "odd", start.alias("start"), F.first("crlf").over(in_file).alias("crlf")).select(
        *_SPLIT, F.col("start").cast("int"), ((F.col("start") + F.col("odd")) % 2).cast("int").alias("after"), "crlf")


def _assembler():
    """Lines of whole splits, in order -> records and pieces of records.

    A nested function without references to this package, so executors need
    nothing but the installed libraries.
    """
    whole, head, tail = _WHOLE, _HEAD, _TAIL

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        now, inside, crlf, kind, first, held = None, 0, False, whole, False, []

        def rows(line, row, bounds, last):
            """Records between ``bounds``; the first one of a split may be a head, ``last`` marks an open one."""
            nonlocal kind, first
            offsets = pa.array(bounds, pa.int32())
            text = pc.binary_join(pa.ListArray.from_arrays(offsets, line), "\n")
            n = len(text)
            kinds, firsts = np.full(n, whole, np.int32), np.zeros(n, bool)
            kinds[0], kind = (head if kind == head else last), whole
            if first and kinds[0] != head:
                filled = np.flatnonzero(pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(text)), 0).to_numpy(zero_copy_only=False))
                if len(filled):
                    firsts[filled[0]], first = True, False
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(now[0]), n), pa.repeat(pa.scalar(now[1], pa.int64()), n),
                 row.take(pa.array(bounds[:-1], pa.int64())), pa.array(kinds), pa.array(firsts),
                 pa.repeat(pa.scalar(crlf), n), text],
                ["file", "block", "row", "kind", "first", "crlf", "record"])

        def ended():
            """What the split before left open."""
            if held:
                line, row = (pa.concat_arrays([h[i] for h in held]) for i in range(2))
                held.clear()
                yield rows(line, row, [0, len(line)], tail)

        for batch in batches:
            file, block, row, line, start, ends_crlf = (batch.column(i) for i in range(6))
            if not len(line):
                continue
            place = block.to_numpy()
            moved = place[1:] != place[:-1]
            if len(place) > 1:
                moved |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), len(place)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = file[a].as_py(), int(place[a])
                if key != now:
                    yield from ended()
                    now, inside, crlf = key, start[a].as_py(), ends_crlf[a].as_py()
                    kind, first = (head if inside else whole), key[1] == 0
                part, at = line.slice(a, b - a), row.slice(a, b - a)
                after = (inside + np.cumsum(pc.count_substring(part, '"').to_numpy() & 1)) & 1
                inside = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if not len(ends):
                    held.append((part, at))
                    continue
                done, had = int(ends[-1]), sum(len(h[0]) for h in held)
                got = [*held, (part.slice(0, done), at.slice(0, done))]
                held.clear()
                yield rows(pa.concat_arrays([g[0] for g in got]), pa.concat_arrays([g[1] for g in got]),
                           [0, *(ends + had).tolist()], whole)
                if done < b - a:
                    held.append((part.slice(done), at.slice(done)))
        yield from ended()

    return run


def _pieces(lines: DataFrame, states: DataFrame, spread: bool, only_cut: bool) -> DataFrame:
    """Records and pieces of the splits (``only_cut``: of those that a record crosses)."""
    cut = states.where("start = 1 OR after = 1") if only_cut else states
    known = cut.select(*_SPLIT, "start", "crlf")
    how = "inner" if only_cut else "left"
    if spread:
        tagged = lines.join(known, _SPLIT, how).repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "row")
    else:
        tagged = lines.join(F.broadcast(known), _SPLIT, how)
    start = F.coalesce("start", F.raise_error(F.lit("the splits of the file changed between two passes")).cast("int"))
    return tagged.select("file", "block", "row", "line", start.alias("start"), "crlf").mapInArrow(
        _assembler(), "file string, block long, row long, kind int, first boolean, crlf boolean, record string")


def _stitched(pieces: DataFrame) -> DataFrame:
    """Each tail with the heads that follow it in its file, as one record."""
    upto = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    tail = F.when(F.col("kind") == _TAIL, F.col("block"))
    owner = pieces.select(*_SPLIT, "kind", F.last(tail, ignorenulls=True).over(upto).alias("owner"))
    joined = pieces.join(owner, [*_SPLIT, "kind"]).groupBy("file", "owner").agg(
        F.max(F.when(F.col("kind") == _TAIL, F.col("row"))).alias("row"), F.max("first").alias("first"), F.max("crlf").alias("crlf"),
        F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
    return joined.select("file", F.col("owner").alias("block"), "row", "first", "crlf",
                         F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))


def records(spark: SparkSession, path: str, header: bool = True,
            max_broadcast_splits: int = MAX_BROADCAST_SPLITS) -> DataFrame:
    """``file, block, row, record``: raw records without their line ends; (file, block, row) is their order.

    Counts the quotes and puts the cut records together when called; the whole
    records are read when the frame is.
    """
    lines = _lines(spark, path)
    stored = scratch_path(spark, "csv-splits")
    split_states(lines).write.parquet(stored)
    states = spark.read.parquet(stored)
    spread = states.count() > max_broadcast_splits
    columns = ["file", "block", "row", "first", "crlf", "record"]
    out = _pieces(lines, states, spread, False).where(F.col("kind") == _WHOLE).select(*columns)
    if not states.where("start = 1 OR after = 1").isEmpty():
        cut = scratch_path(spark, "csv-cut-records")
        _pieces(lines, states, spread, True).where(F.col("kind") != _WHOLE).write.parquet(cut)
        out = out.unionByName(_stitched(spark.read.parquet(cut)).select(*columns))
    if header:
        out = out.where(~F.col("first"))
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    text = F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    return out.select("file", "block", "row", text.alias("record")).where(F.trim("record") != "")


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",",
                    mode: str = "FAILFAST", corrupt: str = "_corrupt_record",
                    max_broadcast_splits: int = MAX_BROADCAST_SPLITS) -> DataFrame:
    """The typed fields of ``schema`` plus ``file, block, row``; with mode
    ``PERMISSIVE`` a ``corrupt`` field of the schema has the text of bad records."""
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": mode,
               "columnNameOfCorruptRecord": corrupt}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = records(spark, path, header, max_broadcast_splits).select(
        F.from_csv("record", ddl, options).alias("_mw_r"), "file", "block", "row")
    return parsed.select("_mw_r.*", "file", "block", "row")
