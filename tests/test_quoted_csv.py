"""Files with line breaks inside quotes, read by many tasks."""
import csv
import os
import random

import pytest
from pyspark.sql import types as T

from martwright.session import scratch_path
from martwright.sources import files, quoted

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def _folder(spark, name):
    path = scratch_path(spark, name).replace("file:", "", 1)
    os.makedirs(path)
    return path


def _write(path, rows, sep, header=True, last=True):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=sep)
        if header:
            w.writerow(["k", "a", "b"])
        w.writerows(rows)
    if not last:                                     # no line end after the last record
        with open(path, "rb+") as f:
            f.truncate(os.path.getsize(path) - len(sep))


def _rows(seed, n, breaks):
    rnd = random.Random(seed)

    def text():
        words = [rnd.choice(["x", "é", 'q"q', "a,b", "word", "", *breaks]) for _ in range(rnd.randrange(1, 12))]
        return " ".join(words) + "."
    return [(i, text(), text() if rnd.random() < .9 else "") for i in range(n)]


@pytest.fixture()
def small_splits(spark):
    """1 KB splits, so that files of some KB are read by many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("sep,breaks,limit", [("\n", ["\n", "\n\n"], 10**6), ("\r\n", ["\r\n", "\n"], 10**6), ("\n", ["\n"], 0)])
def test_splits_equal_the_file(spark, small_splits, sep, breaks, limit):
    folder = _folder(spark, "t-quoted")
    rows = _rows(1, 400, breaks)
    rows[50] = (50, "long " + "line of text\n" * 700, "z")         # covers several whole splits
    _write(f"{folder}/a.csv", rows, sep, last=False)
    more = [(1000 + i, a, b) for i, a, b in _rows(2, 300, breaks)]
    _write(f"{folder}/b.csv", more, sep)
    lines = quoted._lines(spark, f"{folder}/a.csv")
    assert lines.select("block").distinct().count() > 8
    states = quoted.split_states(lines).collect()
    assert {s.start for s in states} == {0, 1} and {(s.start, s.after) for s in states} >= {(1, 1)}
    got = quoted.read_quoted_csv(spark, folder, SCHEMA, max_broadcast_splits=limit).orderBy("file", "block", "row")
    # in CRLF files a CRLF inside quotes is read as LF, as Spark's own reader does
    clean = (lambda v: v.replace("\r\n", "\n")) if sep == "\r\n" else (lambda v: v)
    want = [(k, clean(a), clean(b) or None) for k, a, b in rows + more]
    assert [tuple(r)[:3] for r in got.collect()] == want           # ingest order as well
    assert sorted(map(tuple, files.read_csv(spark, folder, SCHEMA, multi_line=True).collect())) == sorted(want, key=lambda r: r[0])


def test_one_file_is_read_by_many_tasks(spark, small_splits):
    folder = _folder(spark, "t-quoted-tasks")
    _write(f"{folder}/a.csv", _rows(3, 1500, ["\n"]), "\n")
    df = files.read_csv(spark, folder, SCHEMA, split_records=True)
    plain = quoted._lines(spark, folder)
    assert plain.rdd.getNumPartitions() > 8
    assert df.rdd.getNumPartitions() > 8 and df.count() == 1500
    assert files.read_csv(spark, folder, SCHEMA, multi_line=True).rdd.getNumPartitions() == 1


def test_quarantine_positions_and_blank_lines(spark, small_splits):
    folder = _folder(spark, "t-quoted-bad")
    body = "k,a,b\n\n" + "".join(f'{i},"t\n{i}",x\n' if i % 7 else f'bad{i},"t\n\n{i}",x\n\n' for i in range(300))
    with open(f"{folder}/a.csv", "w") as f:
        f.write(body + '5,"never closed\n6,7,8\n')
    good, bad = files.read_csv_with_quarantine(spark, folder, SCHEMA, with_position=True, split_records=True)
    found = good.orderBy("src_pos").collect()
    assert [r.a for r in found] == [f"t\n{i}" for i in range(300) if i % 7]
    assert sorted(r["_corrupt_record"] for r in bad.collect() if r["_corrupt_record"].startswith("bad")) == sorted(
        f'bad{i},"t\n\n{i}",x' for i in range(0, 300, 7))
    # the open field takes the rest of its file, which then lacks a field
    assert [r["_corrupt_record"] for r in bad.collect() if "never" in r["_corrupt_record"]] == ['5,"never closed\n6,7,8']
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_csv(spark, folder, SCHEMA, split_records=True).collect()


def test_empty_files_and_no_header(spark):
    folder = _folder(spark, "t-quoted-empty")
    open(f"{folder}/a.csv", "w").close()
    _write(f"{folder}/b.csv", [], "\n")
    assert quoted.read_quoted_csv(spark, folder, SCHEMA).count() == 0
    _write(f"{folder}/c.csv", [(1, "a\nb", "")], "\n", header=False)
    got = quoted.read_quoted_csv(spark, f"{folder}/c.csv", SCHEMA, header=False)
    assert [tuple(r)[:3] for r in got.collect()] == [(1, "a\nb", None)]
