"""Property tests: key operators against brute force on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.functions.cleaning import title_case, zfill
from martwright.operators import dml, keys
from martwright.operators.keys import dense_key, keep_first, keep_first_with_position, rank_values, stable_key
from martwright.session import scratch_path

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=40)


@SETTINGS
@given(rows)
def test_dense_key_is_position_in_order(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "i int, g int, v int")
    order = [F.col("v").asc_nulls_last(), F.col("g").asc_nulls_last(), F.col("i").asc_nulls_last()]
    got = {r.i: r.k for r in dense_key(df, order, "k", num_partitions=3).collect()}
    ranked = sorted(range(len(data)), key=lambda i: (data[i][1] is None, data[i][1] or 0, data[i][0], i))
    assert got == {i: pos + 1 for pos, i in enumerate(ranked)}


@SETTINGS
@given(rows)
def test_stable_key_is_a_stable_sort(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "i int, g int, v int")
    got = {r.i: r.k for r in stable_key(df, [F.col("v").desc_nulls_first()], "k", num_partitions=3).collect()}
    ranked = sorted(range(len(data)), key=lambda i: (data[i][1] is not None, -(data[i][1] or 0), i))
    assert got == {i: pos + 1 for pos, i in enumerate(ranked)}


def test_stable_key_spreads_one_value(spark, monkeypatch):
    """Nine of ten rows are identical: no range holds over three times the median."""
    df = spark.range(0, 200_000, numPartitions=8).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).alias("v"))
    made = {}
    monkeypatch.setattr(keys, "scratch_path", lambda s, label: made.setdefault(label, scratch_path(s, label)))
    keyed = stable_key(df, [F.col("v").asc()], "k", num_partitions=20)
    ranges = spark.read.parquet(made["ordered"]).groupBy("_metadata.file_path").count()      # a file per range
    sizes = sorted(r["count"] for r in ranges.collect())
    assert len(sizes) == 20 and sizes[-1] < 3 * sizes[10]
    assert keyed.agg(F.count_distinct("k"), F.min("k"), F.max("k")).first()[:] == (200_000, 1, 200_000)
    assert keyed.where("v = 7").agg(F.max("k") - F.min("k") + 1, F.count("*")).first()[:] == (180_000, 180_000)


@SETTINGS
@given(rows)
def test_keep_first_with_position_matches_brute_force(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "pos int, g int, v int")
    got = {r.g: (r.pos, r.k) for r in keep_first_with_position(df, ["g"], [F.col("pos")], "k").collect()}
    want = {}
    for pos, (g, _) in enumerate(data):
        want.setdefault(g, (pos, pos + 1))
    assert got == want
    plain = {r.g: r.pos for r in keep_first(df, ["g"], ["pos"]).collect()}
    assert plain == {g: p for g, (p, _) in want.items()}


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZ_", min_size=0, max_size=4), min_size=1, max_size=30, unique=True))
def test_rank_values_matches_sorted(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: r.k for r in rank_values(df, "v", "k").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 9), st.integers(1, 3)), max_size=12))
def test_upsert_matches_dict_semantics_and_is_idempotent(spark, batch):
    target = spark.createDataFrame([("a", 0), ("b", 0), ("z", 0)], "k string, v int")
    src = spark.createDataFrame(batch, "k string, v int, seq int") if batch else \
        spark.createDataFrame([], "k string, v int, seq int")
    want = {"a": 0, "b": 0, "z": 0}
    best = {}
    for k, v, seq in batch:
        if k not in best or (seq, v) > best[k]:
            best[k] = (seq, v)
    want.update({k: v for k, (_, v) in best.items()})
    once = dml.upsert(target, src, ["k"], "seq")
    assert {r.k: r.v for r in once.collect()} == want
    assert sorted(map(tuple, dml.upsert(once, src, ["k"], "seq").collect())) == sorted(map(tuple, once.collect()))


@SETTINGS
@given(st.lists(st.text(alphabet="abé D'-(x)9._ç", max_size=12), min_size=1, max_size=20))
def test_title_case_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.y for r in df.select(title_case("t").alias("y")).collect()]
    assert got == [t.title() for t in texts]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-99999, 9999999)), min_size=1, max_size=20))
def test_zfill_matches_python(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    got = [r.y for r in df.select(zfill("n").alias("y")).collect()]
    assert got == [None if n is None else str(n).zfill(5) for n in numbers]
