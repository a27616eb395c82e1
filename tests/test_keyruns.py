"""Key runs: a load checked against all before it, through filters and sorted runs alone."""

import random

import pytest
from pyspark.sql import functions as F

from martwright.operators import keyruns, publish
from martwright.operators.keyruns import KeyRuns
from martwright.session import scratch_path


@pytest.fixture
def runs(spark):
    return KeyRuns.create(spark, scratch_path(spark, "t-runs"), "a string, b long", buckets=4)


def _load(spark, rows):
    return spark.createDataFrame(rows, "a string, b long")


def _one(df):
    return df.first().asDict()


def test_loads_against_brute_force(spark, runs):
    rng, seen = random.Random(7), set()
    for _ in range(6):                                      # more loads than FAN: one level is merged
        rows = [(f"k{rng.randrange(60)}" if rng.random() > .1 else None, rng.randrange(9) if rng.random() > .05 else None) for _ in range(120)]
        load = _load(spark, rows)
        whole = [r for r in rows if None not in r]
        want = {"n_rows": 120, "n_null_keys": 120 - len(whole), "n_duplicate_keys": sum(whole.count(k) > 1 for k in set(whole)),
                "n_known_keys": len(set(whole) & seen)}
        assert _one(runs.key_check(load)) == want
        refs = load.select(F.col("b").alias("y"), F.col("a").alias("x"))
        assert _one(runs.reference_check(refs, ["x", "y"])) == {"child_rows": len(whole), "dangling_rows": sum(r not in seen for r in whole)}
        seen |= set(whole)
        runs = runs.add(load)
    assert [r["level"] for r in runs.state["runs"]] == [1, 0, 0]
    held = runs._run_keys([f"{runs.root}/{r['folder']}" for r in runs.state["runs"]])
    assert {(r.a, r.b) for r in held.collect()} == seen


def test_new_keys_open_no_run_and_no_table(spark):
    root = scratch_path(spark, "t-runs")
    runs = KeyRuns.create(spark, root, "a string, b long", buckets=8)
    table = scratch_path(spark, "t-table")
    first = spark.range(2000).select(F.format_string("k%d", "id").alias("a"), F.col("id").alias("b"), F.lit("payload").alias("v"))
    first.write.parquet(table)
    runs = runs.add(spark.read.parquet(table))
    # keys that no filter passes: answered without a run
    few = [(f"new{i}", i) for i in range(5)]
    free = runs.lookup(_load(spark, few))
    assert not any("/run=" in f or table in f for f in free.inputFiles()) and not free.where("known").count()
    # one key that is there: just its bucket is read, and never the table
    hit = runs.lookup(_load(spark, [("k77", 77), ("k77", 78)]))
    opened = {f.split(f"/{keyruns.BUCKET}=")[1].split("/")[0] for f in hit.inputFiles() if "/run=" in f}
    assert len(opened) <= 2 and not any(table in f for f in hit.inputFiles())
    assert {(r.a, r.b): r.known for r in hit.collect()} == {("k77", 77): True, ("k77", 78): False}
    # a wrong pass is rare
    many = runs.lookup(spark.range(20000).select(F.format_string("x%d", "id").alias("a"), F.col("id").alias("b")))
    assert many.where("known").count() == 0


def test_empty_and_races(spark, runs):
    none = _load(spark, [])
    assert _one(runs.key_check(none)) == {"n_rows": 0, "n_null_keys": 0, "n_duplicate_keys": 0, "n_known_keys": 0}
    assert _one(runs.reference_check(none, ["a", "b"])) == {"child_rows": 0, "dangling_rows": 0}
    after = runs.add(none)
    assert after.state["runs"] == []
    one = after.add(_load(spark, [("", 0)]))                # an empty string is a key like any other
    assert _one(one.key_check(_load(spark, [("", 0), (None, 0)]))) == {"n_rows": 2, "n_null_keys": 1, "n_duplicate_keys": 0, "n_known_keys": 1}
    with pytest.raises(publish.PublicationConflict):
        after.add(_load(spark, [("z", 1)]))                 # another load was added meanwhile


def test_a_key_asks_a_filter_with_one_word(spark):
    runs = KeyRuns.create(spark, scratch_path(spark, "t-runs"), "a string, b long", buckets=1)
    runs = runs.add(spark.range(500).select(F.format_string("k%d", "id").alias("a"), F.col("id").alias("b")))
    runs = runs.add(_load(spark, [("alone", 1)]))
    many, one = (spark.read.parquet(f"{runs.root}/{r['bloom']}") for r in runs.state["runs"])
    assert many.count() > 50
    assert [bin(r.bits & (1 << 64) - 1).count("1") <= keyruns.BLOOM_HASHES for r in one.collect()] == [True]
    got = runs.lookup(_load(spark, [("alone", 1), ("k7", 7), ("k7", 8)]))
    assert {(r.a, r.b): r.known for r in got.collect()} == {("alone", 1): True, ("k7", 7): True, ("k7", 8): False}
