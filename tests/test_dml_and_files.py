"""Row maintenance, folder-swap writes and delimited-file round trips."""

import os

from pyspark.sql import functions as F

from martwright.operators import dml
from martwright.session import scratch_path
from martwright.sources import files
from martwright.sources.schemas import SOURCES


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_upsert_replaces_all_columns_last_wins_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    batch = spark.createDataFrame([("b", 20, None, 1), ("b", 21, "late", 2), ("c", 3, "z", 1)],
                                  "k string, v int, w string, seq int")
    once = dml.upsert(target, batch, ["k"], "seq")
    assert _rows(once, "k", "v", "w") == [("a", 1, "x"), ("b", 21, "late"), ("c", 3, "z")]
    twice = dml.upsert(once, batch, ["k"], "seq")
    assert _rows(twice, "k", "v", "w") == _rows(once, "k", "v", "w")


def test_delete_by_keys(spark):
    target = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert _rows(dml.delete_by_keys(target, "k", []), "k") == _rows(target, "k")
    assert _rows(dml.delete_by_keys(target, "k", ["zz"]), "k") == _rows(target, "k")
    kept = dml.delete_by_keys(target, "k", ["a"]).collect()
    assert sorted((r.k for r in kept), key=str) == [None, "b"]


def test_replace_table_swaps_while_reading_itself(spark):
    path = scratch_path(spark, "t-swap") + "/t"
    dml.replace_table(spark.range(5), path)
    current = spark.read.parquet(path)
    dml.replace_table(current.where("id % 2 = 0").withColumn("id", F.col("id") * 10), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 20, 40]
    parent = os.path.dirname(_local(path))
    assert sorted(os.listdir(parent)) == ["t"]  # no staging or old folders left


def test_append_by_name_and_truncate(spark):
    path = scratch_path(spark, "t-append") + "/t"
    like = spark.createDataFrame([], "a int, b string")
    dml.create_table_like(spark, like, path)
    dml.append_rows(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    dml.append_rows(spark.createDataFrame([("y", 2)], "b string, a int"), path)
    assert _rows(spark.read.parquet(path), "a", "b") == [(1, "x"), (2, "y")]
    dml.truncate_table(spark, path)
    t = spark.read.parquet(path)
    assert t.count() == 0 and t.columns == ["a", "b"]


def test_csv_crlf_lf_quotes_newlines_empty(spark):
    schema = SOURCES["product_category_name_translation"].schema
    body = ['product_category_name,product_category_name_english',
            'a,"x, y"', 'b,"he said ""hi"""', 'c,"two\nlines"', 'd,']
    folder = _local(scratch_path(spark, "t-csv"))
    os.makedirs(folder)
    for name, sep in [("lf.csv", "\n"), ("crlf.csv", "\r\n")]:
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(sep.join(body) + sep)
    lf = files.read_csv(spark, os.path.join(folder, "lf.csv"), schema, multi_line=True).collect()
    crlf = files.read_csv(spark, os.path.join(folder, "crlf.csv"), schema, multi_line=True).collect()
    want = [("a", "x, y"), ("b", 'he said "hi"'), ("c", "two\nlines"), ("d", None)]
    assert sorted(tuple(r) for r in lf) == want
    got_crlf = sorted(tuple(r) for r in crlf)
    assert [g[0] for g in got_crlf] == ["a", "b", "c", "d"]
    assert got_crlf[2][1].replace("\r\n", "\n") == "two\nlines"
    assert got_crlf[3][1] is None


def test_dump_round_trip_keeps_tabs_quotes_newlines_empty_and_null(spark):
    df = spark.createDataFrame([("1", "tab\there"), ("2", 'quote " and\nnewline'), ("3", ""), ("4", None), ("5", "a\\nb\\\\N\r\n\\s"), ("6", "\\N")],
                               "k string, v string")
    folder = scratch_path(spark, "t-dump")
    path = dml.dump_table(df, folder, "staging.t")
    assert path.endswith("staging__t.txt")
    back = files.reload_dump(spark, path, df.schema)
    assert _rows(back, "k", "v") == _rows(df, "k", "v")


def test_csv_quarantine_keeps_bad_rows_apart(spark):
    schema = SOURCES["order_items"].schema
    folder = _local(scratch_path(spark, "t-quarantine"))
    os.makedirs(folder)
    rows = ["order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
            "o1,1,p1,s1,2017-01-02,10.5,1.25",
            "o2,two,p2,s2,2017-01-03,3.0,0.5",
            "o3,1,p3,s3,not-a-date,3.0,0.5",
            'o4,2,"p,4",s4,2017-01-04,,0.5']
    with open(os.path.join(folder, "items.csv"), "w") as f:
        f.write("\n".join(rows) + "\n")
    good, bad = files.read_csv_with_quarantine(spark, os.path.join(folder, "items.csv"), schema)
    assert sorted(r.order_id for r in good.collect()) == ["o1", "o4"]
    assert [r.price for r in good.where("order_id = 'o4'").collect()] == [None]
    assert sorted(r["_corrupt_record"].split(",")[0] for r in bad.collect()) == ["o2", "o3"]


def test_write_table_modes(spark):
    import pytest
    path = scratch_path(spark, "t-modes") + "/t"
    dml.write_table(spark.range(3), path, "fail")
    with pytest.raises(Exception):
        dml.write_table(spark.range(3), path, "fail")
    dml.write_table(spark.range(2), path, "append")
    assert spark.read.parquet(path).count() == 5
    dml.write_table(spark.range(1), path, "replace")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        dml.write_table(spark.range(1), path, "upsert")


def test_upsert_partitions_rewrites_only_touched_partitions(spark):
    path = scratch_path(spark, "t-upsert-parts") + "/t"
    base = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("c", 2, "z"), ("d", 3, "w")], "k string, p int, v string")
    base.write.partitionBy("p").parquet(path)
    local = _local(path)
    untouched = sorted(os.listdir(os.path.join(local, "p=3")))
    # 'c' moves from partition 2 (which becomes empty) to 1; 'e' is new in 4
    batch = spark.createDataFrame([("c", 1, "z2"), ("e", 4, "q")], "k string, p int, v string")
    touched = dml.upsert_partitions(spark, path, batch, ["k"], "p")
    assert sorted(touched) == [1, 2, 4]
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "p", "v").collect())
    assert got == [("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z2"), ("d", 3, "w"), ("e", 4, "q")]
    assert not os.path.exists(os.path.join(local, "p=2"))
    assert sorted(os.listdir(os.path.join(local, "p=3"))) == untouched  # never rewritten


def test_delete_partitions_touches_only_partitions_with_keys(spark):
    path = scratch_path(spark, "t-delete-parts") + "/t"
    spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 3)], "k string, p int") \
        .write.partitionBy("p").parquet(path)
    local = _local(path)
    untouched = sorted(os.listdir(os.path.join(local, "p=3")))
    keys = spark.createDataFrame([("a",), ("c",), ("zz",)], "k string")
    assert sorted(dml.delete_partitions(spark, path, "k", keys, "p")) == [1, 2]
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "p").collect()) == [("b", 1), ("d", 3)]
    assert not os.path.exists(os.path.join(local, "p=2"))
    assert sorted(os.listdir(os.path.join(local, "p=3"))) == untouched
    assert dml.delete_partitions(spark, path, "k", spark.createDataFrame([], "k string"), "p") == []


def test_null_partition_survives_upsert_and_delete(spark):
    rows = [("a", None), ("b", None), ("c", "x/y")]
    path = scratch_path(spark, "t-null-parts") + "/t"
    spark.createDataFrame(rows, "k string, p string").write.partitionBy("p").parquet(path)
    read = lambda: sorted((tuple(r) for r in spark.read.parquet(path).select("k", "p").collect()), key=repr)
    batch = spark.createDataFrame([("z", None), ("c", "q")], "k string, p string")
    dml.upsert_partitions(spark, path, batch, ["k"], "p")
    assert read() == sorted([("a", None), ("b", None), ("z", None), ("c", "q")], key=repr)
    assert sorted(os.listdir(_local(path)))[:1] != ["p=x%2Fy"] and "p=x%2Fy" not in os.listdir(_local(path))
    dml.delete_partitions(spark, path, "k", spark.createDataFrame([("a",)], "k string"), "p")
    assert read() == sorted([("b", None), ("z", None), ("c", "q")], key=repr)
    dml.delete_partitions(spark, path, "k", spark.createDataFrame([("b",), ("z",)], "k string"), "p")
    assert read() == [("c", "q")]


def test_one_partition_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "t-wide-part") + "/t"
    df = spark.range(40_000).selectExpr("id AS k", "uuid() AS v", "1 AS p")
    df.limit(1).write.partitionBy("p").parquet(path)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        dml.overwrite_partitions(df, path, "p")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files_ = [f for f in os.listdir(os.path.join(_local(path), "p=1")) if f.endswith(".parquet")]
    assert len(files_) > 1 and spark.read.parquet(path).count() == 40_000


def test_ingest_position_follows_file_order(spark):
    """The smaller first file comes first, though readers pack larger files first."""
    schema = SOURCES["product_category_name_translation"].schema
    folder = _local(scratch_path(spark, "t-order"))
    os.makedirs(folder)
    for name, n in [("part-0.csv", 1), ("part-1.csv", 200)]:
        with open(os.path.join(folder, name), "w") as f:
            f.write("a,b\n" + "".join(f"{name},{i:03d}\n" for i in range(n)))
    df = files.read_csv(spark, folder, schema, with_position=True)
    got = [tuple(r)[:2] for r in df.orderBy("src_pos").collect()]
    assert got == [("part-0.csv", "000")] + [("part-1.csv", f"{i:03d}") for i in range(200)]
    path = scratch_path(spark, "t-order") + "/t"
    df.drop("src_pos").orderBy("product_category_name", "product_category_name_english").coalesce(1).write.parquet(path)
    back = files.read_table(spark, path, with_position=True).orderBy("src_pos")
    assert [tuple(r)[:2] for r in back.collect()] == got


def test_csv_sources_quarantine(spark):
    folder = _local(scratch_path(spark, "t-bad-rows"))
    os.makedirs(folder)
    with open(os.path.join(folder, "geolocation.csv"), "w") as f:
        f.write("z,lat,lng,city,state\n1,1.0,2.0,a,s\nx,1.0,2.0,b,s\n3,1.0,2.0,c,s\n")
    src = files.CsvSources(spark, folder, quarantine=True)
    assert [r.geolocation_city for r in src["geolocation"].orderBy("src_pos").collect()] == ["a", "c"]
    assert [r["_corrupt_record"] for r in src.rejected("geolocation").collect()] == ["x,1.0,2.0,b,s"]
