"""Delimited-file sources: bulk CSV load, tab-delimited dump reload, tables.

Schemas are always given (no inference). Line ends: LF and CRLF are both
accepted; quoted fields may hold the separator and doubled quotes. Tables with
free text (quoted line breaks) are read with ``split_records`` (``quoted.py``),
which splits their files like all others; ``multi_line`` is Spark's own reader,
one task per file. An empty unquoted field is NULL.

Ingest order (``src_pos``) is file path (as text), then the split's place in
the file, then the row in the split.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quoted import read_quoted_csv
from .schemas import SOURCES, SRC_POS

DUMP_NULL = "\\N"
CORRUPT = "_corrupt_record"


def _position(row: Column) -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    row.alias("row"))


def _record_position() -> Column:
    return F.struct("file", "block", "row").alias(SRC_POS)


def _csv(spark: SparkSession, path: str, schema: T.StructType, header: bool, sep: str, multi_line: bool, mode: str):
    return (spark.read.schema(schema)
            .option("header", header).option("sep", sep)
            .option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line)
            .option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",",
             with_position: bool = False, multi_line: bool = False, split_records: bool = False) -> DataFrame:
    """Bulk load of a delimited file or folder into a typed frame (separator
    ``,``, enclosure ``"``, one header line).

    ``with_position`` adds ``src_pos``, the row's ingest order, which
    positional keys and keep-first de-duplication use. ``split_records`` reads
    files with quoted line breaks by many tasks.
    """
    if split_records:
        df = read_quoted_csv(spark, path, schema, header, sep)
        return df.select(*[f.name for f in schema.fields], *([_record_position()] if with_position else []))
    df = _csv(spark, path, schema, header, sep, multi_line, "FAILFAST")
    if with_position:
        df = df.select(*[f.name for f in schema.fields], _position(F.monotonically_increasing_id()).alias(SRC_POS))
    return df


# How a backslash and line breaks are written in a dump.
_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def escaped_text(df: DataFrame) -> DataFrame:
    """String columns without line breaks."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.col(f.name)
            for raw, written in _ESCAPES:
                c = F.replace(c, F.lit(raw), F.lit(written))
            out = out.withColumn(f.name, c)
    return out


def _unescaped_text(df: DataFrame) -> DataFrame:
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.col(f.name)
            for raw, written in reversed(_ESCAPES):
                c = F.replace(c, F.lit(written), F.lit(raw))
            out = out.withColumn(f.name, c)
    return out


def reload_dump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a tab-delimited dump written by ``operators.dml.dump_table``."""
    return _unescaped_text(spark.read.schema(schema)
                           .option("sep", "\t").option("header", False)
                           .option("quote", '"').option("escape", '"')
                           .option("nullValue", DUMP_NULL)
                           .option("mode", "FAILFAST")
                           .csv(path))


def read_table(spark: SparkSession, location: str, fmt: str = "parquet", with_position: bool = False,
               **jdbc) -> DataFrame:
    """Full-table scan of a staged table (parquet path) or a JDBC source.

    ``with_position`` adds ``src_pos`` to a parquet scan (file path, then row in
    the file). For JDBC pass ``url``, ``dbtable`` and, for a parallel read,
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``.
    """
    if fmt == "jdbc":
        reader = spark.read.format("jdbc")
        for k, v in jdbc.items():
            reader = reader.option(k, v)
        return reader.load()
    df = spark.read.format(fmt).load(location)
    if with_position:
        df = df.select(*df.columns, _position(F.col("_metadata.row_index")).alias(SRC_POS))
    return df


def get_records(df: DataFrame):
    """Rows of a (query) frame to the driver one partition at a time."""
    return df.toLocalIterator()


def read_csv_with_quarantine(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                             sep: str = ",", with_position: bool = False,
                             multi_line: bool = False, split_records: bool = False) -> tuple[DataFrame, DataFrame]:
    """Bulk load that keeps going past bad rows: (typed good rows, quarantine).

    A row whose fields do not parse as the declared types (or has the wrong
    number of fields) goes to the quarantine frame with its raw text, instead
    of failing the load or being silently coerced.
    """
    names = [f.name for f in schema.fields]
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if split_records:
        parsed = read_quoted_csv(spark, path, full, header, sep, "PERMISSIVE", CORRUPT)
        position = [_record_position()] if with_position else []
    else:
        parsed = _csv(spark, path, full, header, sep, multi_line, "PERMISSIVE")
        position = [_position(F.monotonically_increasing_id()).alias(SRC_POS)] if with_position else []
    parsed = parsed.select(*names, CORRUPT, *position)
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.where(F.col(CORRUPT).isNotNull()).select(*names, CORRUPT)


class CsvSources(Mapping):
    """The nine source tables bulk-loaded from delimited files in a folder.

    ``file_names`` maps a source name to its file (or folder of part files);
    the default is ``<source>.csv``. Geolocation gets its ingest position
    (``src_pos``), which its keep-first de-duplication orders by. With
    ``quarantine`` bad rows do not stop the load: ``rejected(name)`` has them.
    """

    POSITIONED = ("geolocation",)
    FREE_TEXT = ("order_reviews",)

    def __init__(self, spark: SparkSession, folder: str, file_names: Mapping[str, str] | None = None,
                 quarantine: bool = False):
        self.spark, self.folder, self.quarantine = spark, folder.rstrip("/"), quarantine
        self.file_names = {n: f"{n}.csv" for n in SOURCES} | dict(file_names or {})

    def _split(self, name: str) -> tuple[DataFrame, DataFrame]:
        return read_csv_with_quarantine(self.spark, f"{self.folder}/{self.file_names[name]}", SOURCES[name].schema,
                                        with_position=name in self.POSITIONED, split_records=name in self.FREE_TEXT)

    def __getitem__(self, name: str) -> DataFrame:
        if self.quarantine:
            return self._split(name)[0]
        return read_csv(self.spark, f"{self.folder}/{self.file_names[name]}", SOURCES[name].schema,
                        with_position=name in self.POSITIONED, split_records=name in self.FREE_TEXT)

    def rejected(self, name: str) -> DataFrame:
        """The rows of a source's file that do not parse, with their raw text."""
        return self._split(name)[1]

    def __iter__(self):
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)
