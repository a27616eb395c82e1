"""Table maintenance on plain parquet: replace, append, upsert, delete,
truncate, dump.

A parquet directory cannot be overwritten while it is being read, and a
half-written overwrite must never be visible. ``replace_table`` therefore
writes the new contents to a sibling folder and then swaps folders with two
renames. A reader never sees a half-written table, but one that opens the
folder between the two renames finds none and has to try again; on an object
store a rename is a copy, so that gap lasts as long as the copy.
Upsert and delete are pure ``DataFrame -> DataFrame`` plans (anti-join +
union) that are then written with ``replace_table``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import COMPRESSION
from ..sources.files import DUMP_NULL, escaped_text


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace-write (``if_exists='replace'``) with a folder swap (see above
    for the gap between its two renames). With ``partition_by`` the rows are
    rebalanced by these columns first: few files per folder, and a large
    folder written by several tasks."""
    staging = f"{path.rstrip('/')}.__new__{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("errorifexists").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staging)
    return _swap_in(df.sparkSession, staging, path)


def replace_bucketed_table(df: DataFrame, path: str, table: str, key: str, buckets: int) -> str:
    """Replace-write as a table bucketed and sorted by ``key`` into
    ``buckets`` files, registered as ``table`` over ``path``.

    Joins and groupings on ``key`` between tables bucketed the same way read
    co-partitioned files instead of shuffling them. The data is written to a
    sibling folder and swapped in like ``replace_table``; the catalog entry
    (which carries the bucket spec) is then re-pointed at the folder.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    staging, staging_table = f"{path.rstrip('/')}.__new__{tag}", f"{table}__new_{tag}"
    (df.repartition(buckets, key).write.format("parquet").option("compression", COMPRESSION)
     .bucketBy(buckets, key).sortBy(key).option("path", staging).saveAsTable(staging_table))
    spark.sql(f"DROP TABLE IF EXISTS {staging_table}")  # external table: the files stay
    _swap_in(spark, staging, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return path


def _swap_in(spark: SparkSession, staging: str, path: str) -> str:
    """Publish folder ``staging`` as ``path`` (two renames, old one removed)."""
    tag = uuid.uuid4().hex
    fs, target = _fs(spark, path)
    _, new = _fs(spark, staging)
    if fs.exists(target):
        _, old = _fs(spark, f"{path.rstrip('/')}.__old__{tag}")
        if not fs.rename(target, old):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(new, target):
            fs.rename(old, target)
            raise OSError(f"could not publish {staging}")
        fs.delete(old, True)
    elif not fs.rename(new, target):
        raise OSError(f"could not publish {staging}")
    return path


def write_table(df: DataFrame, path: str, if_exists: str = "replace", fmt: str = "parquet") -> str:
    """``if_exists`` in {'replace', 'append', 'fail'}."""
    if if_exists == "replace":
        return replace_table(df, path, fmt)
    if if_exists == "append":
        return append_rows(df, path, fmt)
    if if_exists == "fail":
        df.write.mode("errorifexists").format(fmt).save(path)
        return path
    raise ValueError(f"unknown if_exists={if_exists!r}")


def create_table_like(spark: SparkSession, like: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Empty table with the schema of another (no-op if it exists)."""
    if not table_exists(spark, path):
        spark.createDataFrame([], like.schema).write.format(fmt).save(path)
    return path


def append_rows(rows: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows matched to the target's columns by name; a missing or
    extra column is an error rather than a silent shift."""
    spark = rows.sparkSession
    if table_exists(spark, path):
        target = spark.read.format(fmt).load(path)
        rows = target.limit(0).unionByName(rows)  # by-name check and column order
    rows.write.mode("append").format(fmt).save(path)
    return path


def truncate(df: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return df.sparkSession.createDataFrame([], df.schema)


def truncate_table(spark: SparkSession, path: str, fmt: str = "parquet") -> str:
    current = spark.read.format(fmt).load(path)
    return replace_table(truncate(current), path, fmt)


def latest_per_key(batch: DataFrame, keys: Sequence[str], seq_col: str | None) -> DataFrame:
    """One row per key: the highest ``seq_col`` (ties: the greatest row).
    Grouped ``max(struct)`` so a hot key is reduced map-side."""
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys and c != seq_col]
    order = [seq_col] if seq_col else []
    packed = F.max(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("_mw_last")
    return batch.groupBy(*keys).agg(packed).select(
        *[F.col(c) if c in keys else F.col(f"_mw_last.`{c}`").alias(c) for c in batch.columns if c != seq_col])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], seq_col: str | None = None) -> DataFrame:
    """Insert; on key clash replace every column (last incoming row wins).

    Target rows whose key is in the batch are dropped by a left-anti join and
    the de-duplicated batch is appended. Running it twice gives the same table.
    """
    latest = latest_per_key(batch, keys, seq_col)
    kept = target.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest.select(*target.columns))


def delete_by_keys(target: DataFrame, key_col: str, keys: DataFrame | Iterable) -> DataFrame:
    """``DELETE ... WHERE key IN (...)``. ``keys`` is a frame (one column) or a
    small literal collection; an empty collection deletes nothing."""
    spark = target.sparkSession
    if not isinstance(keys, DataFrame):
        values = list(keys)
        if not values:
            return target
        keys = spark.createDataFrame([(v,) for v in values], [key_col])
    k = keys.select(keys.columns[0]).where(F.col(keys.columns[0]).isNotNull()).distinct()
    k = k.toDF(key_col)
    return target.join(k, key_col, "left_anti").select(*target.columns)


def dump_file_name(table_name: str) -> str:
    """Dump file name for a table: dots become double underscores."""
    return table_name.replace(".", "__") + ".txt"


def dump_table(df: DataFrame, folder: str, table_name: str) -> str:
    """Tab-delimited dump (``\\N`` for NULL, every field quoted so tabs and
    quotes survive a reload). Line breaks and backslashes in text are escaped,
    so a line of the file is a row and the reload can split the file."""
    path = f"{folder.rstrip('/')}/{dump_file_name(table_name)}"
    (escaped_text(df).write.mode("errorifexists")
     .option("sep", "\t").option("header", False)
     .option("quote", '"').option("escape", '"').option("quoteAll", True)
     .option("nullValue", DUMP_NULL)
     .option("emptyValue", '""')
     .csv(path))
    return path


def write_csv(df: DataFrame, path: str, line_sep: str = "\n") -> str:
    """Delimited file with a header row, comma separator, ``"`` enclosure."""
    (df.write.mode("errorifexists")
     .option("header", True).option("sep", ",")
     .option("quote", '"').option("escape", '"')
     .option("lineSep", line_sep)
     .option("emptyValue", '""')
     .csv(path))
    return path


# Fixed values of the partition folder naming: characters written as %XX, and the folder of NULL and "".
ESCAPED_IN_FOLDERS = set('"#%\'*/:=?\\{[]^\x7f') | {chr(c) for c in range(1, 32)}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_folder(col: str, value) -> str:
    text = value.isoformat() if hasattr(value, "isoformat") else "" if value is None else str(value)
    name = "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS else c for c in text)
    return f"{col}={name or NULL_FOLDER}"


def in_partitions(col: str, values: Sequence) -> Column:
    """Rows of the given partitions; ``None`` stands for the NULL partition."""
    known = [v for v in values if v is not None]
    found = F.col(col).isin(known) if known else F.lit(False)
    return found | F.col(col).isNull() if len(known) < len(values) else found


def overwrite_partitions(df: DataFrame, path: str, partition_col: str, touched: Sequence | None = None) -> None:
    """Dynamic overwrite of the ``partition_col`` partitions present in ``df``;
    partitions listed in ``touched`` that end up without rows are removed. A
    large partition is rebalanced over several writing tasks."""
    (df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    if touched:
        present = {r[0] for r in df.select(partition_col).distinct().collect()}  # <= len(touched) rows
        for value in set(touched) - present:
            fs, p = _fs(df.sparkSession, f"{path.rstrip('/')}/{partition_folder(partition_col, value)}")
            if fs.exists(p):
                fs.delete(p, True)


def touched_partitions(staged: DataFrame, batch: DataFrame, keys: Sequence[str], partition_col: str) -> list:
    """Partitions that an upsert of ``batch`` changes: its own, and those where
    one of its keys is now (a semi-join over the key and partition columns).

    Collected to the driver; bounded by the number of partitions of the table
    (e.g. calendar months), not by its rows."""
    moved_from = staged.join(batch.select(*keys), list(keys), "left_semi").select(partition_col)
    return [r[0] for r in batch.select(partition_col).union(moved_from).distinct().collect()]


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_col: str,
                      seq_col: str | None = None) -> list:
    """Upsert into a table partitioned by ``partition_col``, rewriting only the
    partitions that gain or lose rows (the NULL partition included). Returns
    the touched partition values."""
    staged = spark.read.parquet(path)
    touched = touched_partitions(staged, batch, keys, partition_col)
    current = staged.where(in_partitions(partition_col, touched))  # partition pruning
    # materialise before overwriting the folder it reads from
    merged = upsert(current, batch, keys, seq_col).checkpoint(eager=True)
    overwrite_partitions(merged, path, partition_col, touched)
    return touched


def delete_partitions(spark: SparkSession, path: str, key_col: str, keys: DataFrame, partition_col: str) -> list:
    """``DELETE ... WHERE key IN (keys)`` on a table partitioned by
    ``partition_col``: only partitions holding one of the keys (found by a
    semi-join reading the key and partition columns) are rewritten; a
    partition left empty is removed. Returns the touched partition values."""
    staged = spark.read.parquet(path)
    k = keys.select(F.col(keys.columns[0]).alias(key_col)).where(F.col(key_col).isNotNull()).distinct()
    touched = [r[0] for r in staged.join(k, key_col, "left_semi").select(partition_col).distinct().collect()]
    if not touched:
        return touched
    current = staged.where(in_partitions(partition_col, touched))
    kept = current.join(k, key_col, "left_anti").select(*staged.columns).checkpoint(eager=True)
    overwrite_partitions(kept, path, partition_col, touched)
    return touched
