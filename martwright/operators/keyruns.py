"""Checks of a new load against everything loaded before, without reading the tables.

``KeyRuns`` keeps the distinct keys of a table's loads as sorted runs beside it, as a publication (``operators.publish``):

* a run has the keys of one load (or of merged loads) in ``buckets`` hash buckets, a folder each, sorted by key;
* beside each run lies a Bloom filter per bucket, as rows (bucket, word, bits);
* ``FAN`` runs of one level are merged into one of the next, so n loads leave about ``FAN * log(n)`` runs and a key is rewritten
  once per level.

``lookup`` aggregates a load per key and asks the filters by an equi-join on (run, bucket, word). A key that passes no
filter is new, and no run is opened for it. Keys that pass are verified by a join with the key columns of just the (run,
bucket) folders in which some key passed: the answer is exact. So a load costs its own keys, the filters and those
folders; the table itself is never scanned. A load whose keys pass in every bucket (references, which mostly exist) reads all
runs, keys only.

On it rest ``key_check`` (duplicates inside the load and with earlier loads: D4) and ``reference_check`` (child rows whose key no
load of the parent holds: D3). NULL keys are counted and not stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import publish

#: Filter bits per key and bits set per key, all of a key in one 64-bit word (about one key in 60 passes wrongly).
BLOOM_BITS, BLOOM_HASHES = 12, 5
FAN = 4
BUCKET, RUN, COUNT = "_mw_bucket", "_mw_run", "_mw_n"


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


class KeyRuns:
    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        """The last state (or state ``number``) of the runs under ``root``."""
        self.spark, self.root = spark, root.rstrip("/")
        self.number = publish.current(spark, root) if number is None else number
        if self.number is None:
            raise FileNotFoundError(f"no key runs under {root}")
        self.state = publish.load(spark, root, self.number)
        self.keys: list[str] = self.state["keys"]

    @classmethod
    def create(cls, spark: SparkSession, root: str, key_schema: str, buckets: int) -> KeyRuns:
        """Empty runs for keys of ``key_schema`` (``"order_id string"``); ``buckets`` for the size the table will have:
        a bucket of a run is sorted by one task."""
        keys = spark.createDataFrame([], key_schema).columns
        publish.commit(spark, root, {"keys": keys, "schema": key_schema, "buckets": buckets, "runs": []}, None)
        return cls(spark, root)

    # -- placing keys

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.state["buckets"])).cast("int").alias(BUCKET)

    def _place(self, bits: Column) -> tuple[Column, Column]:
        """Word of a key in a filter of ``bits`` bits, and its bits there: all in one word, so a key asks a filter with one row."""
        word = F.pmod(F.xxhash64(F.lit(0), *[F.col(k) for k in self.keys]), F.greatest(F.floor(bits / 64), F.lit(1)).cast("long"))
        mask = "xxhash64(1, " + ", ".join(f"`{k}`" for k in self.keys) + ")"
        each = " | ".join(f"shiftleft(1L, CAST(shiftright({mask}, {6 * i}) & 63 AS INT))" for i in range(BLOOM_HASHES))
        return word.alias("word"), F.expr(each).alias("_mw_mask")

    def _filter_bits(self, n: int) -> int:
        return max(64, BLOOM_BITS * -(-n // self.state["buckets"]))

    # -- asking

    def lookup(self, load: DataFrame) -> DataFrame:
        """Per distinct key of ``load`` without a NULL: its rows there (``_mw_n``) and whether a run holds it (``known``)."""
        spark, keys, runs = self.spark, self.keys, self.state["runs"]
        path = scratch_path(spark, "load-keys")
        per_key = load.select(*keys).where(_all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT)).withColumn(BUCKET, self._bucket())
        per_key.write.parquet(path)
        asked = spark.read.schema(per_key.schema).parquet(path)
        if not runs:
            return asked.select(*keys, COUNT, F.lit(False).alias("known"))
        listed = F.array(*[F.struct(F.lit(r["run"]).alias(RUN), F.lit(r["bits"]).cast("long").alias("_mw_bits")) for r in runs])
        ask = asked.select(*keys, BUCKET, F.explode(listed).alias("_mw_r")).select(*keys, BUCKET, "_mw_r.*")
        ask = ask.select(*keys, BUCKET, RUN, *self._place(F.col("_mw_bits")))
        filters = (spark.read.option("basePath", f"{self.root}/_data").schema(f"word long, bits long, {BUCKET} int, bloom string")
                   .parquet(*[f"{self.root}/{r['bloom']}" for r in runs]).withColumnRenamed("bloom", RUN))
        passed = ask.join(filters, [RUN, BUCKET, "word"]).where("bits & _mw_mask = _mw_mask").select(RUN, BUCKET, *keys)
        path = scratch_path(spark, "passed-keys")
        passed.write.parquet(path)
        passed = spark.read.schema(passed.schema).parquet(path)
        folders = passed.select(RUN, BUCKET).distinct().collect()          # at most runs x buckets
        if not folders:
            return asked.select(*keys, COUNT, F.lit(False).alias("known"))
        held = self._run_keys([f"{self.root}/_data/run={r[RUN]}/{BUCKET}={r[BUCKET]}" for r in folders])
        found = passed.join(held, [RUN, BUCKET, *keys], "left_semi").select(*keys).distinct().withColumn("_mw_held", F.lit(True))
        return asked.join(found, keys, "left").select(*keys, COUNT, F.coalesce("_mw_held", F.lit(False)).alias("known"))

    def _run_keys(self, paths: Sequence[str]) -> DataFrame:
        """Keys under the given run or bucket folders."""
        return (self.spark.read.option("basePath", f"{self.root}/_data").schema(f"{self.state['schema']}, {BUCKET} int, run string")
                .parquet(*paths).withColumnRenamed("run", RUN))

    def key_check(self, load: DataFrame) -> DataFrame:
        """One row: rows, rows with a NULL in the key, keys that occur twice in the load, keys that an earlier load holds."""
        nulls = load.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(~_all_set(self.keys), F.lit(1))).alias("n_null_keys"))
        counts = self.lookup(load).agg(F.count(F.when(F.col(COUNT) > 1, F.lit(1))).alias("n_duplicate_keys"),
                                       F.count(F.when(F.col("known"), F.lit(1))).alias("n_known_keys"))
        both = nulls.unionByName(counts, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])

    def reference_check(self, load: DataFrame, columns: Sequence[str]) -> DataFrame:
        """One row: rows of ``load`` with a key in ``columns``, and those whose key no run holds (dangling)."""
        child = load.select(*[F.col(c).alias(k) for c, k in zip(columns, self.keys, strict=True)])
        total = F.coalesce(F.sum(COUNT), F.lit(0)).cast("long").alias("child_rows")
        dangling = F.coalesce(F.sum(F.when(~F.col("known"), F.col(COUNT))), F.lit(0)).cast("long").alias("dangling_rows")
        return self.lookup(child).agg(total, dangling)

    # -- adding

    def _write(self, keys: DataFrame, level: int) -> dict | None:
        """A run of the distinct ``keys`` and its filter; nothing for no keys."""
        spark, name = self.spark, uuid.uuid4().hex
        run, bloom = f"_data/run={name}", f"_data/bloom={name}"
        dealt = keys.withColumn(BUCKET, self._bucket()).repartition(self.state["buckets"], BUCKET)
        dealt.sortWithinPartitions(BUCKET, *self.keys).write.partitionBy(BUCKET).parquet(f"{self.root}/{run}")
        _, conf, p = publish._hadoop(spark, f"{self.root}/{run}")
        if not any(s.isDirectory() for s in p.getFileSystem(conf).listStatus(p)):
            return None
        written = self._run_keys([f"{self.root}/{run}"])
        n = written.count()
        bits = self._filter_bits(n)
        (written.select(BUCKET, *self._place(F.lit(bits).cast("long"))).groupBy(BUCKET, "word").agg(F.bit_or("_mw_mask").alias("bits"))
         .repartition(BUCKET).sortWithinPartitions(BUCKET, "word").write.partitionBy(BUCKET).parquet(f"{self.root}/{bloom}"))
        return {"run": name, "folder": run, "bloom": bloom, "n": n, "bits": bits, "level": level}

    def add(self, load: DataFrame) -> KeyRuns:
        """The keys of ``load`` as a new run; full levels are merged. Commits one state."""
        fresh = self._write(load.select(*self.keys).where(_all_set(self.keys)).distinct(), 0)
        runs = [*self.state["runs"], *([fresh] if fresh else [])]
        level = 0
        while len(full := [r for r in runs if r["level"] == level]) >= FAN:
            merged = self._write(self._run_keys([f"{self.root}/{r['folder']}" for r in full]).select(*self.keys).distinct(), level + 1)
            runs = [*[r for r in runs if r["level"] != level], merged]
            level += 1
        publish.commit(self.spark, self.root, {**self.state, "runs": runs}, self.number)
        return KeyRuns(self.spark, self.root)
