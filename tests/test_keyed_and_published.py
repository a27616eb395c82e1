"""Keyed tables (files hit, delete side tables) and publications."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from martwright.operators import publish
from martwright.operators.keyed import KeyedTable, slot_of
from martwright.plans import pipeline
from martwright.session import scratch_path
from martwright.sources.schemas import MANIFEST


def _rows(spark, lo, hi, tag):
    return spark.range(lo, hi).select(F.format_string("k%05d", "id").alias("k"), F.lit(tag).alias("v"), F.col("id").alias("n"))


def _as_dict(table):
    return {r.k: (r.v, r.n) for r in table.read().collect()}


def test_slots_follow_the_bounds(spark):
    for n in (0, 1, 2, 7, 30):
        bounds = [(f"k{5 * i:03d}",) for i in range(n)]
        got = spark.range(200).select(F.format_string("k%03d", "id").alias("k")).select("k", slot_of(["k"], bounds).alias("s")).collect()
        assert all(r.s == sum(b[0] <= r.k for b in bounds) for r in got)


def test_upsert_rewrites_only_the_files_hit(spark):
    root = scratch_path(spark, "t-keyed")
    table = KeyedTable.create(_rows(spark, 0, 4000, "old"), root, ["k"], slots=16)
    before = table.files()
    assert len(before) == 16 and table.read().count() == 4000
    some = _rows(spark, 100, 110, "new").unionByName(_rows(spark, 2500, 2510, "new"))
    hit = table.files_hit(some)
    assert len(hit) == 2                                    # k files hold a key of the batch
    after = table.upsert(some)
    assert set(before) - set(after.files()) == set(hit) and len(after.files()) == 16
    want = {f"k{i:05d}": ("old", i) for i in range(4000)} | {f"k{i:05d}": ("new", i) for i in [*range(100, 110), *range(2500, 2510)]}
    assert _as_dict(after) == want and _as_dict(table) == {k: ("old", n) for k, (_, n) in want.items()}
    # keys that no file holds rewrite none, though they fall between the keys of one
    added = after.upsert(spark.createDataFrame([("k00100x", "ins", 1), ("zzz", "ins", 2)], "k string, v string, n long"))
    assert set(after.files()) <= set(added.files()) and added.read().count() == 4002
    # the last version of a key in a batch wins; twice is the same as once
    two = spark.createDataFrame([("zzz", "a", 1, 2), ("zzz", "b", 1, 1)], "k string, v string, n long, s int")
    once = added.upsert(two, "s")
    assert _as_dict(once)["zzz"] == ("a", 1) and _as_dict(once.upsert(two, "s")) == _as_dict(once)
    with pytest.raises(ValueError):
        once.upsert(spark.createDataFrame([(None, "a", 1)], "k string, v string, n long"))
    with pytest.raises(publish.PublicationConflict):
        added.upsert(some)                                  # started from an older publication


def test_delete_writes_only_keys(spark):
    root = scratch_path(spark, "t-keyed")
    table = KeyedTable.create(_rows(spark, 0, 1000, "old"), root, ["k"], slots=8)
    keys = spark.createDataFrame([("k00007",), ("k00500",), ("absent",), (None,)], "x string")
    gone = table.delete(keys)
    assert gone.files() == table.files()                    # no data file is written
    want = {f"k{i:05d}": ("old", i) for i in range(1000) if i not in (7, 500)}
    assert _as_dict(gone) == want
    back = gone.upsert(_rows(spark, 7, 8, "back"))          # a key that comes back is not masked by the older delete
    want["k00007"] = ("back", 7)
    assert _as_dict(back) == want
    flat = back.compact()
    assert _as_dict(flat) == want and flat.state["deletes"] == [] and flat.compact() is flat
    assert len(set(back.files()) - set(flat.files())) == 2  # the files of k00007 and k00500
    assert publish.vacuum(spark, root, keep=1) and _as_dict(KeyedTable(spark, root)) == want


def test_keyed_table_equals_a_model(spark):
    rnd, model = random.Random(5), {}
    root = scratch_path(spark, "t-keyed")
    schema = "a long, b string, v long"
    table = KeyedTable.create(spark.createDataFrame([], schema), root, ["a", "b"])
    for step in range(8):
        keys = [(rnd.randint(0, 30), rnd.choice("xyz")) for _ in range(rnd.randint(1, 25))]
        if rnd.random() < .6:
            rows = [(*k, rnd.randint(0, 99), i) for i, k in enumerate(keys)]
            table = table.upsert(spark.createDataFrame(rows, schema + ", s int"), "s")
            model |= {r[:2]: r[2] for r in rows}
        else:
            table = table.delete(spark.createDataFrame(keys, "a long, b string"))
            model = {k: v for k, v in model.items() if k not in keys}
        table = table.compact() if step % 3 == 2 else table
        assert {(r.a, r.b): r.v for r in table.read().collect()} == model


def test_two_writers_one_wins(spark):
    root = scratch_path(spark, "t-publish")
    assert publish.current(spark, root) is None and len(publish.Snapshot(spark, root)) == 0
    assert publish.commit(spark, root, {"tables": {"a": "x"}}, None) == 0
    assert publish.publish_tables(spark, root, {"b": "y"}, 0) == 1
    with pytest.raises(publish.PublicationConflict):
        publish.publish_tables(spark, root, {"b": "z"}, 0)
    assert publish.Snapshot(spark, root).tables == {"a": "x", "b": "y"}
    assert publish.Snapshot(spark, root, 0).tables == {"a": "x"}


def test_readers_see_whole_publications(spark):
    """A reader that loops through 20 publications of three tables never misses one and never mixes two."""
    root = scratch_path(spark, "t-publish")
    names, errors, seen, done = ("fact", "mart_a", "mart_b"), [], set(), threading.Event()

    def publish_version(n):
        folders = {t: publish.new_folder(t) for t in names}
        for t, folder in folders.items():
            spark.range(3).select(F.lit(n).alias("version"), F.lit(t).alias("t")).coalesce(1).write.parquet(f"{root}/{folder}")
        publish.publish_tables(spark, root, folders, publish.current(spark, root))

    def reader():
        while not done.is_set():
            try:
                snap = publish.Snapshot(spark, root)
                got = {(r.t, r.version) for t in names for r in snap[t].collect()}
                assert {t for t, _ in got} == set(names) and len({v for _, v in got}) == 1, got
                seen.add(next(iter(got))[1])
            except Exception as e:  # noqa: BLE001 - reported by the test
                errors.append(e)
                return

    publish_version(0)
    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(1, 20):
        publish_version(n)
    done.set()
    thread.join()
    assert not errors and len(seen) > 2


def test_refresh_publishes_all_tables_at_once(spark, src_small):
    root = scratch_path(spark, "t-refresh")
    pipeline.run(spark, src_small, root, run_date="2024-10-26")
    first = publish.Snapshot(spark, root)
    assert set(first) == {*MANIFEST["warehouse"], *MANIFEST["mart"], "order_rollup", "order_numbers", "orders_of_day", "orders_of_product", "orders_of_city"}
    days = first["mart_sales_daily"].count()
    pipeline.run(spark, {**src_small.as_dict(), "order_items": src_small["order_items"].where("order_item_id = 1")}, root, run_date="2024-10-26")
    second = publish.Snapshot(spark, root)
    assert second.number == first.number + 1
    assert first["mart_sales_daily"].count() == days        # a reader of the older publication still reads it whole
    assert pipeline.read_table(spark, root, "fact_orders").count() == second["fact_orders"].count() < first["fact_orders"].count()


def test_a_failed_gate_publishes_nothing(spark, src_small, monkeypatch):
    root = scratch_path(spark, "t-refresh")
    pipeline.run(spark, src_small, root, run_date="2024-10-26")
    number = publish.current(spark, root)

    def fails(*_):
        raise pipeline.DataQualityError("mart: bad keys")

    monkeypatch.setattr(pipeline, "gate_marts", fails)
    with pytest.raises(pipeline.DataQualityError):
        pipeline.run(spark, src_small, root, run_date="2024-10-26")
    assert publish.current(spark, root) == number
