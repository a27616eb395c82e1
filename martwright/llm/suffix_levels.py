"""Suffix-array dedup: a logarithmic family of sparse suffix arrays.

Every byte covered by a ``length``-byte string that starts anywhere else too is removed. Only suffixes at
content-chosen anchors are kept: a window of ``length`` bytes belongs to the position of its smallest
``length - 127``-byte hash (leftmost on ties), so equal windows have equal anchors at equal offsets, and
one suffix in about 64 bytes is enough to compare all windows.

* A batch of documents becomes a sorted run of its sparse suffixes: ``core`` (the anchor's hash, which all
  its windows hold), ``whole`` (hash of all bytes its windows cover), document and place. The order of
  the suffixes is that of these hashes instead of their bytes, so a row has 32 bytes, not 200.
* Runs form levels; two runs of equal level merge into one of the next (a merge of co-partitioned sorted tables,
  no shuffle), so a suffix is rewritten a logarithmic number of times.
* The merge scan reads neighbours in the sorted levels: equal ``whole`` elsewhere: all windows of the anchor
  repeat; a ``core`` found nowhere else: none does. Anchors at the edges of a match are left open.
* Open anchors are cut into narrower ranges of windows (16, then 1) and scanned alike; a range of one window
  is exact. Ranges that repeat as a whole send one representative along as a partner.

Hashes are 64 bits. Rows of one anchor hash meet in one task but are never gathered: the scan only looks at
neighbours and spills.

Defined results: null and empty texts have no bytes; rows that repeat both doc_id and text are one document, rows of one
doc_id with different texts are documents of their own (a row is known by a hash of both); a null doc_id
takes no part and keeps its text; a document's windows never reach into another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.session import scratch_path, shuffle_width

from .flat import column, mix, pieces, prefix_sums, span_hash

#: Windows of one anchor; then the widths of the ranges that open anchors are cut into.
REACH, STEPS = 128, (16, 1)
ROW = "core long, whole long, doc_id long, place long"
_TOP = np.uint64(0xFFFFFFFF00000000)


def _place(at: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Anchor and the windows that start ``far`` to ``near`` bytes before it."""
    return at << 16 | far << 8 | near


def _unplaced(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, place >> 8 & 0xFF, place & 0xFF


def _keys(sums: np.ndarray, at: np.ndarray, far: np.ndarray, near: np.ndarray, width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(core, whole) of ranges of windows; ``width`` is the grid of offsets they were cut by."""
    low = near // width * width
    core = span_hash(sums, at - low, at - (low + width - 1) + length)
    core = mix(core + (low * 256 + width).astype(np.uint64))
    whole = span_hash(sums, at - far, at - near + length)
    return core, mix(whole + (far * 256 + near + 65536 * width).astype(np.uint64))


def anchors(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, anchor, far, near, prefix sums) of all anchors of a piece; positions in the piece."""
    n, gram = len(data), length - REACH + 1
    sums = prefix_sums(data)
    if n < length:
        return *(np.zeros(0, np.int64),) * 4, sums
    pos = np.arange(n - gram + 1)
    best = (span_hash(sums, pos, pos + gram) & _TOP) | pos.astype(np.uint64)
    span = 1
    while span < REACH:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    ok = np.zeros(len(best), bool)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        ok[a:max(a, b - length + 1)] = True
    at = (best & ~_TOP).astype(np.int64)
    start = np.flatnonzero(ok)
    at = at[start]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.append(first[1:], len(at))[:len(first)] - 1
    at, lo, hi = at[first], start[first], start[last]
    return np.searchsorted(off, lo, "right") - 1, at, at - lo, at - hi, sums


def _batch(core: np.ndarray, whole: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(doc), pa.array(place)],
                                      ["core", "whole", "doc_id", "place"])


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """Sparse suffixes of whole documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, _, data, off in pieces(column(batch, "text")):
                doc, at, far, near, sums = anchors(data, off, length)
                core, whole = _keys(sums, at, far, near, REACH, length)
                yield _batch(core, whole, ids[a + doc], _place(at - off[doc], far, near))

    return docs.select("doc_id", "text").mapInArrow(run, ROW)


def _narrower(docs: DataFrame, length: int, width: int) -> DataFrame:
    """The ranges of ``places`` cut on a grid of ``width`` offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            size = pa.compute.list_value_length(places).to_numpy(zero_copy_only=False)
            bound = np.concatenate(([0], np.cumsum(size)))
            flat = places.flatten().to_numpy(zero_copy_only=False)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, data, off in pieces(column(batch, "text")):
                doc = np.repeat(np.arange(a, b), size[a:b])
                at, far, near = _unplaced(flat[bound[a]:bound[b]])
                low = near // width
                n = far // width - low + 1
                k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc, at, far, near, cell = (np.repeat(x, n) for x in (doc, at, far, near, low))
                cell = cell + k
                far, near = np.minimum(far, cell * width + width - 1), np.maximum(near, cell * width)
                core, whole = _keys(prefix_sums(data), at + off[doc - a], far, near, width, length)
                yield _batch(core, whole, ids[doc].astype(np.int64), _place(at, far, near))

    return docs.select("doc_id", "text", "places").mapInArrow(run, ROW)


def scan(rows: DataFrame) -> DataFrame:
    """Merge scan of sorted suffixes: ``doc_id, place, repeats, open``; what has no partner is left out.

    ``repeats``: all windows of the row repeat. ``open``: to be looked at more closely, or a partner for such rows.
    """
    key = Window.partitionBy("core")
    order = key.orderBy("whole", "doc_id", "place")
    same = F.coalesce(F.lag("whole").over(order) == F.col("whole"), F.lit(False))
    then = F.coalesce(F.lead("whole").over(order) == F.col("whole"), F.lit(False))
    mixed = F.min("whole").over(key) != F.max("whole").over(key)
    return (rows.select("doc_id", "place", same.alias("s"), then.alias("t"), mixed.alias("m"))
            .where("s OR t OR m").select("doc_id", "place", F.expr("s OR t").alias("repeats"), F.expr("m AND NOT s").alias("open")))


class SuffixLevels:
    """Levels of sorted runs; ``levels[i]`` is the run of level i or None."""

    def __init__(self, spark: SparkSession, length: int) -> None:
        self.spark, self.length, self.width = spark, length, shuffle_width(spark)
        self.levels: list[str | None] = []

    def _write(self, rows: DataFrame) -> str:
        path = scratch_path(self.spark, "suffix-run")
        name = "suffix_run_" + path[-32:]
        (rows.write.bucketBy(self.width, "core").sortBy("core", "whole", "doc_id", "place")
         .option("path", path).option("compression", "zstd").saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        path = self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()[1]
        self.spark.sql(f"DROP TABLE {name}")
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def add(self, docs: DataFrame) -> None:
        """``doc_id, text`` of documents that were not added before."""
        rows = suffixes(docs, self.length).repartition(self.width, "core")
        run, level = self._write(rows.dropDuplicates()), 0
        while level < len(self.levels) and self.levels[level]:
            other, self.levels[level] = self.levels[level], None
            merged = self._write(self.spark.table(other).unionByName(self.spark.table(run)))
            self._drop(other)
            self._drop(run)
            run, level = merged, level + 1
        self.levels += [None] * (level + 1 - len(self.levels))
        self.levels[level] = run

    def rows(self) -> DataFrame:
        runs = [self.spark.table(x) for x in self.levels if x]
        every = runs[0]
        for r in runs[1:]:
            every = every.unionByName(r)
        return every

    def drop(self) -> None:
        for x in self.levels:
            if x:
                self._drop(x)
        self.levels = []


def repeated(spark: SparkSession, docs: DataFrame, length: int = 200, batches: int = 2) -> DataFrame:
    """``doc_id, place`` of all ranges of windows that repeat, each window of them in some row."""
    if not REACH < length <= 1 << 15:
        raise ValueError(f"length must be over {REACH}")
    known = docs.where("doc_id IS NOT NULL")
    index = SuffixLevels(spark, length)
    for b in range(batches):
        index.add(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b))
    path = scratch_path(spark, "suffix-scan")
    scan(index.rows()).write.parquet(path)
    index.drop()
    found = spark.read.parquet(path)
    done = found.where("repeats")
    for width in STEPS:
        places = found.where("open").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
        rows = _narrower(known.join(places, "doc_id"), length, width)
        path = scratch_path(spark, "suffix-scan")
        scan(rows.repartition(shuffle_width(spark), "core").dropDuplicates()).write.parquet(path)
        found = spark.read.parquet(path)
        done = done.unionByName(found.where("repeats"))
    return done.select("doc_id", "place")


def remove(spark: SparkSession, docs: DataFrame, length: int = 200, batches: int = 2,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans`` (removed byte runs) and ``kept`` (the remaining bytes) per document."""
    docs = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").withColumn(
        "row", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    gone = (repeated(spark, docs.select(F.col("row").alias("doc_id"), "text"), length, batches)
            .groupBy(F.col("doc_id").alias("row")).agg(F.collect_list("place").alias("places")))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            size = [x or 0 for x in pa.compute.list_value_length(places).to_pylist()]
            bound = np.concatenate(([0], np.cumsum(size)))
            flat = places.flatten().to_numpy(zero_copy_only=False)
            n_bytes, n_removed, spans, kept = [], [], [], []
            for a, b, data, off in pieces(column(batch, "text")):
                for k in range(a, b):
                    text = data[off[k - a]:off[k - a + 1]]
                    n_bytes.append(len(text))
                    if not size[k]:
                        n_removed.append(0)
                        spans.append([])
                        kept.append(text.tobytes())
                        continue
                    at, far, near = _unplaced(flat[bound[k]:bound[k + 1]])
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, at - far, 1)
                    np.add.at(edge, at - near + length, -1)
                    cover = np.cumsum(edge)[:-1] > 0
                    turn = np.flatnonzero(np.diff(np.concatenate(([0], cover.astype(np.int8), [0]))))
                    n_removed.append(int(cover.sum()))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)])
                    kept.append(text[~cover].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(spans, span), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return docs.join(gone, "row", "left").select("doc_id", "text", "places").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
