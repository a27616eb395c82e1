"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are turned into integers ``floor(scale * x)``; the score is the integer inner product. The
candidates are cut into blocks; a block holds, for every dimension, its vectors sorted by that component.
A query walks all lists at once, each from the end its own sign favours, in steps of growing depth: the
vectors met are scored in full (random access), and ``sum(q_j * list_j[depth])`` bounds all
vectors not met yet. It stops when that bound is below the query's k-th score so far; scores found in earlier
blocks of the task count, so later blocks stop sooner. A bound equal to the k-th score goes on, as ties
go to the smaller id.

Queries are a stated set met with all rows in blocks of about ``query_block`` vectors; every block is one scan of the
candidates. Candidates and queries are written once, the queries with a block number; then block after block is read,
searched and its answers written, so the driver holds one block and the plan one scan, however many queries there are. Each
task returns k rows per query, the ranking sees those only.

Defined results: a null vector, or one that holds a null or non-finite component, takes no part; vectors
meet vectors of the same length only; equal (id, vector) rows count once; a query's own id is no candidate;
null ids take no part; fewer than k candidates: all of them; a score beyond 64 bits is cut to the nearest 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import dealt

BLOCK = 4096
QUERY_BLOCK = 4096
FIRST_DEPTH = 8


def quantised(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``id, v array<long>`` of the vectors that take part."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x"))
            .where(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
            .select("id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v")))


def _product(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles or 64-bit integers where these are exact, else in long integers."""
    most = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(np.abs(q.astype(np.float64)).max(initial=0)) * len(q)
    if most < 2.0**53:
        return (rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if most < 2.0**62:
        return rows @ q
    return np.clip(rows.astype(object) @ q.astype(object), -(1 << 63), (1 << 63) - 1).astype(np.int64)


class SortedLists:
    """One block of vectors with its per-dimension lists (ascending)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.float = rows.astype(np.float64)
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
        self.value = np.take_along_axis(self.float, self.order, axis=0)

    def search(self, own: int, q: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge this block's vectors into the best (scores, ids) of a query."""
        n, dims = self.rows.shape
        use = np.flatnonzero(q)                       # a zero component neither scores nor bounds
        up = q[use] > 0
        qf = q.astype(np.float64)
        seen = np.zeros(n, bool)
        at, depth = 0, FIRST_DEPTH
        while at < n:
            to = min(n, at + depth)
            head, tail = self.order[at:to][:, use[~up]], self.order[n - to:n - at][:, use[up]]
            met = np.zeros(n, bool)
            met[head] = True
            met[tail] = True
            if not len(use):
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            if len(new):
                score = _product(self.rows[new], q)
                ids = self.ids[new]
                ok = ids != own
                if len(best[0]) >= k:
                    ok &= score >= best[0][-1]
                best = _top(np.concatenate((best[0], score[ok])), np.concatenate((best[1], ids[ok])), k)
            if len(best[0]) >= k:
                last = np.where(up, self.value[n - to, use], self.value[to - 1, use])
                bound = float(last @ qf[use])
                if bound < float(best[0][-1]) - 1e-6 * max(1.0, abs(bound)):
                    break
            if len(new) == 0 and seen.all():
                break
            at, depth = to, 2 * depth
        return best


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, ~score))[:k]          # ~score falls as score rises, for every 64-bit integer
    return score[order], ids[order]


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows) per vector length."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
    off = np.concatenate(([0], np.cumsum(size)))
    for d in np.unique(size).tolist():
        on = np.flatnonzero(size == d)
        yield ids[on], flat[(off[on][:, None] + np.arange(d)).astype(np.int64)].reshape(len(on), d)


def top_k(spark: SparkSession, vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024,
          query_block: int = QUERY_BLOCK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the queries: rows whose id is divisible by ``every``."""
    path, plain = scratch_path(spark, "quantised"), quantised(vectors, scale, id_col, vec_col).distinct()
    plain.write.parquet(path)                              # every block of queries scans them
    rows = spark.read.schema(plain.schema).parquet(path)

    def block(q_ids: list[int], q_rows: list[list[int]]) -> DataFrame:
        asked: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, v in zip(q_ids, q_rows, strict=True):
            asked.setdefault(len(v), []).append((i, np.array(v, np.int64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            empty = np.zeros(0, np.int64)
            best = {d: [(empty, empty)] * len(qs) for d, qs in asked.items()}
            for batch in batches:
                for ids, mat in _matrix(batch):
                    qs = asked.get(mat.shape[1], [])
                    for a in range(0, len(ids), BLOCK) if qs else ():
                        lists = SortedLists(ids[a:a + BLOCK], mat[a:a + BLOCK])
                        mine = best[mat.shape[1]]
                        for i, (own, q) in enumerate(qs):
                            mine[i] = lists.search(own, q, mine[i], k)
            for d, qs in asked.items():
                got = [(own, s, i) for (own, _), (s, i) in zip(qs, best[d], strict=True) if len(s)]
                if got:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([g[0] for g in got], [len(g[1]) for g in got]).astype(np.int64)),
                         pa.array(np.concatenate([g[2] for g in got])), pa.array(np.concatenate([g[1] for g in got]))],
                        ["query_id", "vec_id", "score"])

        return rows.mapInArrow(run, "query_id long, vec_id long, score long")

    of_block, blocks = dealt(rows.where(F.col("id") % every == 0), "id", F.count(F.lit(1)), query_block, "queries")
    schema = "query_id long, rank int, vec_id long, score long"
    if not blocks:
        return spark.createDataFrame([], schema)
    order, out = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"), scratch_path(spark, "nearest")
    for b in blocks:
        # one block: bounded by query_block, released before the next
        asked = of_block(b).collect()
        found = block([r[0] for r in asked], [r[1] for r in asked]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = r"""
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
