"""Keyed tables: upsert by rewriting only the files hit, delete by writing only keys.

A keyed table is a publication (``operators.publish``) that names its data files. Rows lie in key ranges (slots) whose
bounds are fixed at the first write; a file holds rows of one slot, so slot bounds are its least and greatest key.

* *Locating.* ``slot_of`` finds a key's slot by two short searches over the bounds. Per file a Bloom filter is kept as rows
  (file, word, bits): a key's bits are looked up by an equi-join on (file, word). Files that pass are verified
  by a semi-join on their key columns, so a file is rewritten only if it holds a key of the batch.
* *Upsert* writes the rows of the files hit that stay and the batch's rows, and commits a manifest in which
  these replace the files hit. All other files keep their names.
* *Delete* writes the keys to a side table. A row counts as deleted if its key is there with a later sequence number than
  its own, so a key that comes back later is not masked. ``read`` applies the side tables by one anti-join;
  ``compact`` rewrites the files that hold deleted keys and drops the side tables.

The number of files and slots is bounded by the table's size over ``SLOT_BYTES``; their names, and nothing else of the
table, pass through the driver. Rows with a null in the key are refused. A writer that raced another fails
with ``PublicationConflict`` and leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import publish
from .dml import latest_per_key

SLOT_BYTES = 128 * 1024 * 1024
#: Bits of a Bloom filter per key of its file, and bits set per key.
BLOOM_BITS, BLOOM_HASHES = 10, 4
SEQ, SLOT = "_mw_seq", "_mw_slot"


def _key_order(keys: Sequence[str], alias: str = "_mw_key") -> Column:
    return F.struct(*[F.col(k) for k in keys]).alias(alias)


def slot_of(keys: Sequence[str], bounds: list[tuple]) -> Column:
    """Number of the slot of a row: how many of the ascending ``bounds`` are at most its key.

    Searched in two levels (every m-th bound, then the m after it), so a row compares with about 2 * sqrt(slots) bounds.
    """
    if not bounds:
        return F.lit(0)
    m = max(1, round(len(bounds) ** .5))
    key = F.struct(*[F.col(k) for k in keys])

    def listed(some: list[tuple]) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, b, strict=True)]) for b in some])

    top = F.size(F.filter(listed(bounds[::m]), lambda b: b <= key))
    rest = F.slice(listed(bounds), F.greatest((top - 1) * m + 1, F.lit(1)), F.lit(m))
    return F.when(top == 0, F.lit(0)).otherwise((top - 1) * m + F.size(F.filter(rest, lambda b: b <= key))).cast("int")


def _bloom_places(keys: Sequence[str], bits: Column) -> Column:
    """Array of the bit numbers of a key in a filter of ``bits`` bits."""
    return F.array(*[F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), bits) for salt in range(BLOOM_HASHES)])


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        """The last publication (or publication ``number``) of the table under ``root``."""
        self.spark, self.root = spark, root.rstrip("/")
        self.number = publish.current(spark, root) if number is None else number
        if self.number is None:
            raise FileNotFoundError(f"no keyed table under {root}")
        self.state = publish.load(spark, root, self.number)
        self.keys: list[str] = self.state["keys"]
        self.schema = self.spark.createDataFrame([], self.state["schema"]).schema

    # -- writing

    @classmethod
    def create(cls, df: DataFrame, root: str, keys: Sequence[str], slots: int | None = None) -> KeyedTable:
        """Write ``df`` as a new keyed table with ``slots`` key ranges (default: from the planner's size)."""
        spark, keys = df.sparkSession, list(keys)
        if slots is None:
            size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            slots = min(max(1, -(-size // SLOT_BYTES)), 1 << 16)
        if not df.where(" OR ".join(f"`{k}` IS NULL" for k in keys)).isEmpty():
            raise ValueError(f"null in the key {keys}")
        bounds = []
        if slots > 1:
            # range partitioning finds even bounds on a sample; the least key of each range is a bound
            placed = df.select(*keys).repartitionByRange(slots, *keys)
            least = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.min(_key_order(keys)).alias("k")).select("k.*").collect()
            bounds = sorted(tuple(r) for r in least)[1:]     # fewer than ``slots`` rows
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        state = {"keys": keys, "schema": columns, "bounds": [list(b) for b in bounds], "files": [], "blooms": [], "deletes": []}
        state = cls._with_rows(spark, root, state, df, 0)
        publish.commit(spark, root, state, None)
        return cls(spark, root)

    @staticmethod
    def _bounds(spark: SparkSession, state: dict) -> list[tuple]:
        types = {f.name: f.dataType for f in spark.createDataFrame([], state["schema"]).schema.fields}
        if any(types[k].typeName() not in ("string", "long", "integer", "short", "byte") for k in state["keys"]):
            raise TypeError("key columns must be strings or whole numbers")
        return [tuple(b) for b in state["bounds"]]

    @classmethod
    def _with_rows(cls, spark: SparkSession, root: str, state: dict, rows: DataFrame, seq: int) -> dict:
        """``state`` with the files of ``rows`` (written here) added."""
        keys, folder = state["keys"], publish.new_folder("rows")
        path = f"{root.rstrip('/')}/{folder}"
        slotted = rows.withColumn(SLOT, slot_of(keys, cls._bounds(spark, state)))
        if SEQ not in rows.columns:
            slotted = slotted.withColumn(SEQ, F.lit(seq).cast("long"))
        (slotted.repartition(SLOT).sortWithinPartitions(SLOT, *keys).write.partitionBy(SLOT).parquet(path))
        placed = cls._placed(spark, path, [path]) if cls._has_files(spark, path) else None
        if placed is None:
            return dict(state)
        counted = placed.groupBy("_mw_file").agg(F.first(SLOT).alias("_mw_in"), F.count(F.lit(1)).alias("_mw_n"))
        bloom = publish.new_folder("bloom")
        bits = F.col("_mw_n") * BLOOM_BITS
        (placed.select("_mw_file", *keys).join(counted.select("_mw_file", "_mw_n"), "_mw_file")
         .select(F.element_at(F.split("_mw_file", "/_data/"), -1).alias("file"), F.explode(_bloom_places(keys, bits)).alias("b"))
         .groupBy("file", F.floor(F.col("b") / 64).alias("word"))
         .agg(F.bit_or(F.expr("shiftleft(1L, CAST(b % 64 AS INT))")).alias("bits")).write.parquet(f"{root.rstrip('/')}/{bloom}"))
        files = [{"file": "_data/" + r[0].split("/_data/")[-1], "slot": r["_mw_in"], "n": r["_mw_n"]} for r in counted.collect()]  # one row per file
        return {**state, "files": state["files"] + files, "blooms": [*state["blooms"], bloom]}

    @staticmethod
    def _has_files(spark: SparkSession, path: str) -> bool:
        _, conf, p = publish._hadoop(spark, path)
        return any(s.isDirectory() for s in p.getFileSystem(conf).listStatus(p))

    @staticmethod
    def _placed(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
        """Rows with the file each is in."""
        return spark.read.option("basePath", base).parquet(*paths).withColumn("_mw_file", F.col("_metadata.file_path"))

    # -- locating

    def _paths(self, files: Sequence[str]) -> list[str]:
        return [f"{self.root}/{f}" for f in files]

    def _rows(self, files: Sequence[str]) -> DataFrame:
        """Rows of the files with their sequence numbers."""
        wanted = ", ".join((f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields))
        reader = self.spark.read.schema(f"{wanted}, {SEQ} long")
        return reader.parquet(*self._paths(files)) if files else self.spark.createDataFrame([], f"{wanted}, {SEQ} long")

    def files_hit(self, batch: DataFrame) -> list[str]:
        """Names of the files that hold a key of ``batch`` (its key columns; written or cheap to evaluate)."""
        spark, bounds = self.spark, self._bounds(self.spark, self.state)
        if not self.state["files"]:
            return []
        known = batch.select(*self.keys).distinct().withColumn(SLOT, slot_of(self.keys, bounds))
        files = spark.createDataFrame([(f["file"].removeprefix("_data/"), f["slot"], f["n"]) for f in self.state["files"]],
                                      f"_mw_file string, {SLOT} int, _mw_n long")
        ask = known.join(files, SLOT).select("_mw_file", *self.keys, F.explode(_bloom_places(self.keys, F.col("_mw_n") * BLOOM_BITS)).alias("_mw_b"))
        ask = ask.withColumn("_mw_word", F.floor(F.col("_mw_b") / 64))
        bloom = spark.read.schema("file string, word long, bits long").parquet(*self._paths(self.state["blooms"])).toDF("_mw_file", "_mw_word", "_mw_bits")
        passed = (ask.join(bloom, ["_mw_file", "_mw_word"]).where(F.expr("getbit(_mw_bits, CAST(_mw_b % 64 AS INT)) = 1"))
                  .groupBy("_mw_file", *self.keys).agg(F.count(F.lit(1)).alias("_mw_c")).where(F.col("_mw_c") >= BLOOM_HASHES))
        maybe = ["_data/" + r[0] for r in passed.select("_mw_file").distinct().collect()]      # at most the table's files
        if not maybe:
            return []
        found = (self._rows(maybe).select(*self.keys, F.col("_metadata.file_path").alias("_mw_file"))
                 .join(batch.select(*self.keys), self.keys, "left_semi").select("_mw_file").distinct().collect())
        return sorted("_data/" + r[0].split("/_data/")[-1] for r in found)

    # -- changing

    def upsert(self, batch: DataFrame, seq_col: str | None = None) -> KeyedTable:
        """Insert; on key clash replace every column (the last incoming row wins). Only files hit are rewritten."""
        latest = latest_per_key(batch, self.keys, seq_col).select(*self.schema.names)
        path = scratch_path(self.spark, "upsert-batch")
        latest.write.parquet(path)
        latest = self.spark.read.schema(latest.schema).parquet(path)
        if not latest.where(" OR ".join(f"`{k}` IS NULL" for k in self.keys)).isEmpty():
            raise ValueError(f"null in the key {self.keys}")
        hit, seq = self.files_hit(latest), self.number + 1
        stay = self._rows(hit).join(latest.select(*self.keys), self.keys, "left_anti")
        rows = stay.unionByName(latest.withColumn(SEQ, F.lit(seq).cast("long")))
        return self._replaced(hit, rows, seq)

    def _replaced(self, hit: Sequence[str], rows: DataFrame, seq: int, **changes) -> KeyedTable:
        gone = set(hit)
        state = {**self.state, **changes, "files": [f for f in self.state["files"] if f["file"] not in gone]}
        state = self._with_rows(self.spark, self.root, state, rows.select(*self.schema.names, SEQ), seq)
        publish.commit(self.spark, self.root, state, self.number)
        return KeyedTable(self.spark, self.root)

    def delete(self, keys: DataFrame) -> KeyedTable:
        """``DELETE`` of the rows with these keys: only the keys are written. Null keys delete nothing."""
        k = keys.toDF(*self.keys).where(" AND ".join(f"`{c}` IS NOT NULL" for c in self.keys)).distinct()
        k = k.select(*[F.col(c).cast(self.schema[c].dataType) for c in self.keys])
        folder, seq = publish.new_folder("deleted"), self.number + 1
        k.withColumn(SEQ, F.lit(seq).cast("long")).write.parquet(f"{self.root}/{folder}")
        state = {**self.state, "deletes": [*self.state["deletes"], folder]}
        publish.commit(self.spark, self.root, state, self.number)
        return KeyedTable(self.spark, self.root)

    def _deleted(self) -> DataFrame | None:
        """Key and the last sequence number it was deleted at."""
        if not self.state["deletes"]:
            return None
        key = ", ".join(f"`{c}` {self.schema[c].dataType.simpleString()}" for c in self.keys)
        every = self.spark.read.schema(f"{key}, {SEQ} long").parquet(*self._paths(self.state["deletes"]))
        return every.groupBy(*self.keys).agg(F.max(SEQ).alias("_mw_deleted"))

    def _left(self, rows: DataFrame) -> DataFrame:
        gone = self._deleted()
        if gone is None:
            return rows
        g, r = gone.alias("g"), rows.alias("r")
        same = [F.col(f"r.`{k}`") == F.col(f"g.`{k}`") for k in self.keys]
        return r.join(g, [*same, F.col(f"r.{SEQ}") < F.col("g._mw_deleted")], "left_anti")

    def read(self) -> DataFrame:
        """The table's rows."""
        return self._left(self._rows([f["file"] for f in self.state["files"]])).select(*self.schema.names)

    def compact(self) -> KeyedTable:
        """Fold the deletes in: files that hold a deleted key are rewritten without it."""
        gone = self._deleted()
        if gone is None:
            return self
        hit = self.files_hit(gone)
        return self._replaced(hit, self._left(self._rows(hit)), self.number + 1, deletes=[])

    def files(self) -> list[str]:
        return sorted(f["file"] for f in self.state["files"])
