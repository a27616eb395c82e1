"""Cleaning rules and key operators on hand-made edge rows (FIXTURES.md §4)."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.functions import cleaning as C
from martwright.operators.keys import category_code, dense_key, keep_first
from martwright.plans import dims


def _col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_title_case(spark):
    cases = {
        "santa barbara d'oeste": "Santa Barbara D'Oeste",
        "mogi-guacu": "Mogi-Guacu",
        "arraial do cabo (rj)": "Arraial Do Cabo (Rj)",
        "4o. centenario": "4O. Centenario",
        "são josé": "São José",
        "nation_0 d'oeste-sul": "Nation_0 D'Oeste-Sul",
        "": "",
        None: None,
    }
    rows = _col(spark, list(cases), "string").select("x", C.title_case("x").alias("y")).collect()
    assert {r.x: r.y for r in rows} == cases
    # agrees with Python's own rule on these inputs
    assert all(k is None or k.title() == v for k, v in cases.items())


def test_zfill(spark):
    cases = {1001: "01001", 123456: "123456", 99999: "99999", 7: "00007", -12: "-0012", None: None}
    rows = _col(spark, list(cases), "int").select("x", C.zfill("x").alias("y")).collect()
    assert {r.x: r.y for r in rows} == cases
    assert all(k is None or str(k).zfill(5) == v for k, v in cases.items())


def test_fill_int_truncates_and_fills(spark):
    rows = _col(spark, [None, float("nan"), 2.9, -2.9, 3.0], "double") \
        .select(C.fill_int("x", 1).alias("y")).collect()
    assert [r.y for r in rows] == [1, 1, 2, -2, 3]


def test_total_amount_propagates_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "price double, freight double")
    assert [r.t for r in df.select((F.col("price") + F.col("freight")).alias("t")).collect()] == [3.0, None]


def test_day_diff_keeps_fraction(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 2, 12)), (dt.datetime(2016, 1, 1), None),
         (dt.datetime(2016, 1, 3), dt.datetime(2016, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz")
    got = [r.d for r in df.select(C.day_diff("a", "b").alias("d")).collect()]
    assert got == [1.5, None, -2.0]


def test_day_diff_on_dates(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1), dt.date(2016, 1, 25))], "a date, b date")
    assert df.select(C.day_diff("a", "b").alias("d")).first().d == 24.0


def test_category_code_sorted_null_zero(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["voucher", "boleto", None, "credit_card", "boleto"])],
                               "i int, t string")
    got = category_code(df, "t", "code").orderBy("i").collect()
    assert [r.code for r in got] == [3, 1, 0, 2, 1]


def test_keep_first_with_gapped_key(spark):
    df = spark.createDataFrame([(p, z) for p, z in enumerate([5, 5, 7, 9, 7])], "src_pos int, zip int")
    keyed = dense_key(df, [F.col("src_pos").asc()], "k")
    kept = keep_first(keyed, ["zip"], ["k"]).orderBy("zip").collect()
    assert [(r.zip, r.k) for r in kept] == [(5, 1), (7, 3), (9, 4)]


def test_keep_first_null_key_is_one_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 4)], "pos int, z int")
    kept = keep_first(df, ["z"], ["pos"]).orderBy("pos").collect()
    assert [(r.pos, r.z) for r in kept] == [(1, None), (3, 4)]


def test_dense_key_many_partitions(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("v")).repartition(13)
    got = dense_key(df, [F.col("v").desc()], "k", num_partitions=11).collect()
    assert sorted(r.k for r in got) == list(range(1, n + 1))
    assert all(r.k == n - r.v for r in got)


def test_calendar(spark):
    cal = dims.dim_dates(spark)
    assert cal.count() == 3653
    assert cal.where("is_weekend").count() == 1044
    r = cal.where(F.col("date_key") == F.lit("2016-01-02").cast("date")).first()
    assert (r.day_of_week, r.day_name, r.month_name, r.is_weekend, r.quarter) == (5, "Saturday", "January", True, 1)
    assert cal.where(F.col("date_key") == F.lit("2016-01-04").cast("date")).first().day_of_week == 0


def test_avg_money_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("4.69"), 2), (Decimal("-4.69"), 2), (Decimal("10.00"), 3),
                                (Decimal("1.00"), 0), (None, 2)], "t decimal(18,2), n long")
    got = [r.a for r in df.select(C.avg_money("t", "n").alias("a")).collect()]
    assert got == [Decimal("2.35"), Decimal("-2.35"), Decimal("3.33"), None, None]


def test_money_rounds_half_up(spark):
    df = _col(spark, [Decimal("2.345"), Decimal("-2.345")], "decimal(10,3)")
    assert [r.y for r in df.select(F.round("x", 2).alias("y")).collect()] == [Decimal("2.35"), Decimal("-2.35")]


def test_to_varchar_truncates(spark):
    r = _col(spark, ["a" * 70], "string").select(C.to_varchar("x", 64).alias("y")).first()
    assert r.y == "a" * 64


def test_nan_to_null(spark):
    rows = _col(spark, [float("nan"), 1.5], "double").select(C.nan_to_null("x").alias("y")).collect()
    assert rows[0].y is None and math.isclose(rows[1].y, 1.5)


def test_keep_first_with_position_composite_order_nulls_last(spark):
    from martwright.operators.keys import keep_first_with_position
    rows = [("10", 2, "a"), ("9", 1, "b"), (None, 1, "a"), ("10", 1, "c"), ("x", 1, "b")]
    df = spark.createDataFrame(rows, "oid string, seq int, t string")
    order = [F.expr("try_cast(oid AS BIGINT)"), F.col("oid"), F.col("seq")]
    got = {r.t: r.k for r in keep_first_with_position(df, ["t"], order, "k").collect()}
    # row order: 9/1, 10/1, 10/2, x/1, NULL/1
    assert got == {"b": 1, "c": 2, "a": 3}


def test_dense_key_default_width_coalesced_by_aqe(spark):
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")  # many tiny range partitions to merge
        n = 3000
        df = spark.range(n).select((F.col("id") * 7919 % n).alias("v")).repartition(7)
        got = dense_key(df, [F.col("v").asc()], "k").collect()
        assert all(r.k == r.v + 1 for r in got) and len(got) == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


def test_keep_first_with_position_tied_order_has_unique_keys(spark):
    from martwright.operators.keys import keep_first_with_position
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("c", 2, "z"), ("a", 1, "w"), (None, 1, "v"), (None, 3, "u")],
                               "g string, o int, v string")
    got = {r.g: (r.v, r.k) for r in keep_first_with_position(df, ["g"], [F.col("o")], "k").collect()}
    # order 1: a, a, b, NULL; then c, NULL
    assert got == {"a": ("w", 1), "b": ("y", 3), None: ("v", 4), "c": ("z", 5)}


def test_rank_values_many(spark):
    from martwright.operators.keys import rank_values
    vals = spark.range(3000).selectExpr("concat('v', id) AS v")
    got = {r.v: r.k for r in rank_values(vals, "v", "k").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(got))} and len(got) == 3000


def test_shuffle_width_follows_the_input(spark, monkeypatch):
    from martwright import session

    table, before = spark.range(10_000), session.shuffle_width(spark)
    with session.width_for(spark, [table]) as small:
        assert small == before == session.shuffle_width(spark)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
    with pytest.raises(KeyError), session.width_for(spark, [table, table]) as wide:
        assert wide == session.shuffle_width(spark) == 160
        raise KeyError
    assert session.shuffle_width(spark) == before
