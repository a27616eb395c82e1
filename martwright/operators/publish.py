"""Publications: many tables made visible, or replaced, in one step.

A publication is a small JSON manifest ``<root>/_published/<n>.json``. Data goes to folders of its own first; the commit puts
the manifest in place under the next number with a rename that fails if that name exists, so of two writers
that started from the same publication one fails and nothing is half visible. A reader takes the highest
number once (``Snapshot``) and reads only the folders named there, however many publications follow.
``vacuum`` removes what the last publications do not name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_published"


class PublicationConflict(RuntimeError):
    """Another publication was committed since the one this work started from."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, spark.sparkContext._jsc.hadoopConfiguration(), p


def current(spark: SparkSession, root: str) -> int | None:
    """Number of the last publication under ``root``."""
    _, conf, p = _hadoop(spark, f"{root.rstrip('/')}/{FOLDER}")
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return max((int(n.removesuffix(".json")) for n in found if n.removesuffix(".json").isdigit()), default=None)


def load(spark: SparkSession, root: str, number: int) -> dict:
    jvm, conf, p = _hadoop(spark, f"{root.rstrip('/')}/{FOLDER}/{number}.json")
    stream = p.getFileSystem(conf).open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, manifest: dict, after: int | None) -> int:
    """Publish ``manifest`` as the successor of publication ``after`` (None: the first one)."""
    number = 0 if after is None else after + 1
    folder = f"{root.rstrip('/')}/{FOLDER}"
    jvm, conf, target = _hadoop(spark, f"{folder}/{number}.json")
    _, _, part = _hadoop(spark, f"{folder}/.{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    out = fs.create(part, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(part, target, options)                # fails if the name is taken
    except Exception as e:
        fs.delete(part, False)
        if fs.exists(target):
            raise PublicationConflict(f"{root}: publication {number} was committed by another writer") from e
        raise
    return number


class Snapshot(Mapping):
    """Table name -> frame of one publication, resolved once."""

    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        self.spark, self.root = spark, root
        self.number = current(spark, root) if number is None else number
        self.tables: dict[str, str] = {} if self.number is None else load(spark, root, self.number)["tables"]

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.tables[table]}"

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def new_folder(label: str) -> str:
    """A folder name (relative to a root) that no publication has used."""
    return f"_data/{label}-{uuid.uuid4().hex}"


def publish_tables(spark: SparkSession, root: str, folders: Mapping[str, str], after: int | None) -> int:
    """One publication of all ``folders`` (table -> folder relative to ``root``); tables not named keep theirs."""
    kept = load(spark, root, after)["tables"] if after is not None else {}
    return commit(spark, root, {"tables": {**kept, **folders}}, after)


def _named(value) -> set[str]:
    """Folders under ``_data`` that a manifest names."""
    if isinstance(value, str):
        return {"/".join(value.split("/")[:2])} if value.startswith("_data/") else set()
    parts = value.values() if isinstance(value, dict) else value if isinstance(value, list) else []
    return set().union(*map(_named, parts)) if parts else set()


def vacuum(spark: SparkSession, root: str, keep: int = 2, min_age_ms: int = 86_400_000) -> list[str]:
    """Drop all but the last ``keep`` publications and the data folders that only they name; returns the folders.

    A folder that no publication names is dropped once it is ``min_age_ms`` old: until then it may belong to a
    write that is not committed yet."""
    last = current(spark, root)
    if last is None:
        return []
    _, conf, data = _hadoop(spark, f"{root.rstrip('/')}/_data")
    fs = data.getFileSystem(conf)
    live = set().union(*(_named(load(spark, root, n)) for n in range(max(0, last - keep + 1), last + 1)))
    old: set[str] = set()
    for n in range(last - keep, -1, -1):
        _, _, p = _hadoop(spark, f"{root.rstrip('/')}/{FOLDER}/{n}.json")
        if not fs.exists(p):
            break                                           # older ones are gone already
        old |= _named(load(spark, root, n))
        fs.delete(p, False)
    now, gone = spark.sparkContext._jvm.System.currentTimeMillis(), []
    for s in fs.listStatus(data) if fs.exists(data) else []:
        name = f"_data/{s.getPath().getName()}"
        if name not in live and (name in old or now - s.getModificationTime() >= min_age_ms):
            fs.delete(s.getPath(), True)
            gone.append(name)
    return gone
