"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z lower-cased;
only keys of at least ``least_chars`` code points are indexed (128-bit hashes). ``LineRuns`` keeps the
index as levels of runs, each a table sorted by key with the number of documents that hold the key and
the largest doc_id among them:

* ``fresh(batch)`` merge-anti-joins a new batch with the runs: the lines nobody has had before;
* ``add(batch)`` writes the batch's fresh keys as its own run to level 0, so a key is in one run only; what the
  batch has of older keys goes to a second, smaller family of runs with the counts to be added;
* compaction: ``fanout`` runs of a level are merged into one run of the next level, so a key is
  rewritten a logarithmic number of times;
* ``merged()`` reads all levels as one table of keys.

A run is a table bucketed and sorted by key, all with one number of buckets: anti-joins, compaction and ``merged``
are merge joins of bucket with bucket and shuffle nothing. The only shuffles are the batches' own aggregations.

Batches part documents, not lines (by a hash of doc_id), so counts of batches add up. Runs are written
to the shared folder and never change; a lost executor only repeats tasks that read them.

Defined results: null or empty text is one empty line; a null doc_id is passed through with all its lines;
repeated rows of one doc_id count as one document, and each row is cleaned alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import scratch_path, shuffle_width

from .flat import _IS_SPACE, column, lowered, pieces, tidy

KEY = ["h1", "h2"]


def _line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines of a piece (without the line break), line offsets per document."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((off[:-1], breaks + 1)), kind="stable")
    ends = np.sort(np.concatenate((off[1:], breaks)), kind="stable")
    # a break that ends a document opens an empty line there, before the next document's first line
    per_doc = np.searchsorted(breaks, off[1:]) - np.searchsorted(breaks, off[:-1]) + 1
    return starts, ends, np.concatenate(([0], np.cumsum(per_doc)))


def line_keys(data: np.ndarray, off: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(line starts, line ends, line offsets per document, lines with a key, their 128-bit keys)."""
    starts, ends, lines = _line_spans(data, off)
    n = len(data)
    solid = ~_IS_SPACE[data]
    place = np.arange(n)
    nxt = np.append(np.minimum.accumulate(np.where(solid, place, n)[::-1])[::-1], n)
    last = np.append(0, np.maximum.accumulate(np.where(solid, place + 1, 0)))
    a = np.minimum(nxt[starts], ends)
    b = np.maximum(np.minimum(last[ends], ends), a)
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    long_ = np.flatnonzero(chars[b] - chars[a] >= least_chars)
    text = lowered(data).tobytes()
    keys = [xxhash.xxh3_128_digest(text[i:j]) for i, j in zip(a[long_].tolist(), b[long_].tolist(), strict=True)]
    return starts, ends, lines, long_, keys


def keyed_lines(docs: DataFrame, least_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``h1, h2, doc_id``: the distinct keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, _, data, off in pieces(column(batch, "text")):
                _, _, lines, long_, keys = line_keys(data, off, least_chars)
                doc = ids[a + np.searchsorted(lines, long_, "right") - 1]
                h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                row = np.unique(np.column_stack((h, doc)), axis=0) if len(h) else np.zeros((0, 3), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(row[:, i])) for i in range(3)],
                                                 ["h1", "h2", "doc_id"])

    return (docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").where("doc_id IS NOT NULL")
            .mapInArrow(run, "h1 long, h2 long, doc_id long"))


class LineRuns:
    """The index: ``levels[i]`` holds the tables of the runs of level i, ``more[i]`` those of further counts.

    ``buckets`` is the number of buckets of every run (the shuffle width unless given). ``close`` takes the tables
    out of the catalog; their files lie in the scratch folder.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None) -> None:
        self.spark, self.fanout, self.buckets = spark, fanout, buckets or shuffle_width(spark)
        self.levels, self.more = [[]], [[]]
        self._tables: list[str] = []

    def _write(self, run: DataFrame) -> str:
        path = scratch_path(self.spark, "line-run")
        name = "mw_" + path.rsplit("/", 1)[1].replace("-", "_")
        (run.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", path).option("compression", "zstd").saveAsTable(name))
        self._tables.append(name)
        return name

    def _put(self, levels: list[list[str]], run: str) -> None:
        levels[0].append(run)
        level = 0
        while len(levels[level]) >= self.fanout:
            tables, levels[level] = levels[level], []
            if len(levels) == level + 1:
                levels.append([])
            levels[level + 1].append(self._write(_combined([self.spark.table(t) for t in tables])))
            level += 1

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    def fresh(self, batch: DataFrame) -> DataFrame:
        """Rows of ``h1, h2, ...`` whose key no run holds."""
        for run in self.runs():
            batch = batch.join(run.select(*KEY), KEY, "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """``h1, h2, doc_id`` of documents that were not added before."""
        own = self._write(batch.dropDuplicates([*KEY, "doc_id"]).groupBy(*KEY)
                          .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")))
        if self.runs():
            every = self.spark.table(own)
            own = self._write(self.fresh(every))
            self._put(self.more, self._write(every.join(self.spark.table(own).select(*KEY), KEY, "left_anti")))
        self._put(self.levels, own)

    def merged(self) -> DataFrame:
        """``h1, h2, n_docs, last_doc`` over all levels."""
        more = [self.spark.table(t) for level in self.more for t in level]
        out = [_combined([run, *more], "left") for run in self.runs()]      # a key is in one run only
        every = out[0]
        for run in out[1:]:
            every = every.unionByName(run)
        return every

    def close(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")      # external: the files stay
        self._tables = []


def _combined(runs: list[DataFrame], how: str = "full_outer") -> DataFrame:
    """Runs merged by key, bucket by bucket: counts added, the largest document kept."""
    every = runs[0]
    for r in runs[1:]:
        other = r.select(*KEY, F.col("n_docs").alias("_n"), F.col("last_doc").alias("_last"))
        every = every.join(other, KEY, how).select(
            *KEY, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n_docs"),
            F.greatest("last_doc", "_last").alias("last_doc"))
    return every


def clean(spark: SparkSession, docs: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int = 4,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept`` (the remaining lines, joined by line breaks).

    A key found in at least ``least_docs`` documents keeps its lines only in the largest doc_id that holds it.
    """
    staged = scratch_path(spark, "lines-staged")
    (keyed_lines(docs, least_chars, id_col, text_col)
     .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
     .write.partitionBy("batch").parquet(staged))
    lines = spark.read.schema("h1 long, h2 long, doc_id long, batch int").parquet(staged)
    index = LineRuns(spark)
    for b in range(batches):
        index.add(lines.where(F.col("batch") == b))
    found = scratch_path(spark, "lines-common")
    index.merged().where(F.col("n_docs") >= least_docs).select(*KEY, "last_doc").write.parquet(found)
    index.close()
    common = spark.read.schema("h1 long, h2 long, last_doc long").parquet(found)
    drop = (lines.join(common, KEY).where("doc_id <> last_doc").groupBy("doc_id")
            .agg(F.collect_set(F.struct(*KEY)).alias("_drop")))

    out = docs.drop("_drop", "n_lines", "n_dropped", "kept")
    if id_col != "doc_id":
        drop = drop.withColumnRenamed("doc_id", id_col)
    joined = out.join(drop, id_col, "left")
    schema = out.schema
    place, spot = schema.fieldNames().index(text_col), len(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            text = batch.column(place)
            text = text.fill_null("") if text.null_count else text
            h1, h2 = (batch.column(spot).flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
            keys = np.ascontiguousarray(np.column_stack((h1, h2))).astype(np.int64).tobytes()
            size = [0 if x is None else x for x in pa.compute.list_value_length(batch.column(spot)).to_pylist()]
            bounds = np.concatenate(([0], np.cumsum(size))).tolist()
            n_lines, n_dropped, kept = [], [], []
            for a, b, data, off in pieces(text):
                starts, ends, lines, long_, key = line_keys(data, off, least_chars)
                for k in range(b - a):
                    i, j = int(lines[k]), int(lines[k + 1])
                    x, y = bounds[a + k], bounds[a + k + 1]
                    whole = data[off[k]:off[k + 1]].tobytes()
                    n_lines.append(j - i)
                    if x == y:
                        n_dropped.append(0)
                        kept.append(whole.decode())
                        continue
                    gone = {keys[16 * q:16 * q + 16] for q in range(x, y)}
                    p, q = np.searchsorted(long_, [i, j])
                    out_ = {int(long_[r]) for r in range(p, q) if key[r] in gone}
                    base = int(off[k])
                    n_dropped.append(len(out_))
                    kept.append(b"\n".join(whole[starts[r] - base:ends[r] - base] for r in range(i, j) if r not in out_).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:spot], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                [*schema.fieldNames(), "n_lines", "n_dropped", "kept"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return joined.select(*[F.col(f"`{c}`") for c in schema.fieldNames()], "_drop").mapInArrow(
        run, f"{fields}, n_lines long, n_dropped long, kept string")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return clean(spark, docs).select("doc_id", "n_lines", "n_dropped",
                                     F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The rule in DuckDB SQL (keys by text instead of hash).
OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
common AS (
  SELECT k, max(doc_id) AS last_doc FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.i, l.line, c.k IS NOT NULL AS gone
  FROM lines l LEFT JOIN common c ON l.k = c.k AND l.doc_id <> c.last_doc)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
