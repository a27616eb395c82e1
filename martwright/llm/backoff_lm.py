"""Language-model scores: stupid backoff over n-gram count tables joined to the documents' n-grams.

Words are lower-cased runs without white space. With counts ``c`` over all documents, N words in all and
``alpha`` = 0.4, the score of a word after its context is ``c(context, word) / c(context)`` of the longest
context whose n-gram was seen at least ``least`` times, times alpha for every step back; a word alone scores
``c(word) / N``. A document's score is the mean logarithm over its words.

As a relational plan:

1. documents are packed into pieces of about two megabytes, written once (compressed); a piece is the
   unit that n-grams are exploded and summed for;
2. every piece's distinct n-grams with their counts there (counted before any shuffle, so a very frequent
   n-gram has one entry per piece) go to the count tables, partitioned by n-gram hash into fragments;
3. a fragment sums the counts of each n-gram and joins them back to the pieces that asked: one packed
   answer per fragment and piece;
4. the answers are joined to the pieces by key, and every document's words are scored and summed.

What is gathered is all n-grams of all documents, nothing is pruned, sampled or sent to the driver but the total N.

Defined results: null or empty texts (no words) have 0 words and a null score; repeated rows count as
often as they occur and each get a row; a null doc_id is counted and scored too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import scratch_path, shuffle_width

from .flat import column, mix, ngrams, pieces, word_spans, words

ALPHA, ORDER, LEAST = 0.4, 2, 2


def _narrow(n: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest (their width follows from the length)."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // max(n, 1) or 1}", n)


def _packed(docs: DataFrame) -> DataFrame:
    """``piece, doc_ids, offsets, data, n_words``: runs of documents with their texts in one compressed blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, pack = TaskContext.get().partitionId() << 32, 0, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for a, b, data, off in pieces(column(batch, "text")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + number]), pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                     pa.array([off.tolist()], pa.list_(pa.int64())), pa.array([pack.compress(data.tobytes())], pa.binary()),
                     pa.array([len(word_spans(data, off)[0])])], ["piece", "doc_ids", "offsets", "data", "n_words"])
                number += 1

    return docs.mapInArrow(run, "piece long, doc_ids array<long>, offsets array<long>, data binary, n_words long")


class PieceGrams:
    """The n-grams of a piece: per order the fingerprint at each word (0 where none ends), distinct ones by fragment."""

    def __init__(self, data: bytes, off: np.ndarray, order: int, fragments: int) -> None:
        self.word, self.woff = words(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), off)
        doc = np.repeat(np.arange(len(self.woff) - 1), np.diff(self.woff))
        self.order, self.place, self.grams, self.counts, self.cuts = order, [], [], [], []
        for n in range(1, order + 1):
            h = ngrams(self.word, n)
            inside = doc[:len(h)] == doc[n - 1:n - 1 + len(h)]
            value, back, count = np.unique(h[inside], return_inverse=True, return_counts=True)
            part = (mix(value) % np.uint64(fragments)).astype(np.int64)
            by = np.argsort(part, kind="stable")          # by fragment, then by fingerprint
            rank = np.empty_like(by)
            rank[by] = np.arange(len(by))
            place = np.full(len(self.word), -1, np.int64)  # of the n-gram that ends at a word
            place[np.flatnonzero(inside) + n - 1] = rank[back]
            self.place.append(place)
            self.grams.append(value[by])
            self.counts.append(count[by].astype(np.uint32))
            self.cuts.append(np.searchsorted(part[by], np.arange(fragments + 1)))

    def asked(self) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
        """Per fragment the distinct n-grams of each order and their counts."""
        for f in range(len(self.cuts[0]) - 1):
            spans = [slice(c[f], c[f + 1]) for c in self.cuts]
            if any(s.stop > s.start for s in spans):
                yield (f, [g[s].tobytes() for g, s in zip(self.grams, spans, strict=True)],
                       [_narrow(c[s]) for c, s in zip(self.counts, spans, strict=True)])

    def scores(self, answers: list[tuple[int, list[bytes]]], total: int, least: int, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, words that backed off, summed logarithms) per document."""
        count = [np.zeros(len(g), np.float64) for g in self.grams]
        for f, got in answers:
            for c, cut, x in zip(count, self.cuts, got, strict=True):
                c[cut[f]:cut[f + 1]] = _wide(x, int(cut[f + 1] - cut[f]))
        here = [np.where(p >= 0, c[p], 0.0) if len(c) else np.zeros(len(p)) for c, p in zip(count, self.place, strict=True)]
        at = np.arange(len(self.word)) - np.repeat(self.woff[:-1], np.diff(self.woff))
        level = np.minimum(at + 1, self.order)                 # the longest n-gram the word could end
        used = np.ones(len(self.word), np.int64)
        value = np.log(here[0] / max(total, 1))
        for n in range(2, self.order + 1):
            seen = here[n - 1] >= least
            context = np.concatenate(([1.0], here[n - 2][:-1]))
            value[seen] = np.log(here[n - 1][seen] / context[seen])
            used[seen] = n
        value += (level - used) * np.log(alpha)
        size, backed = np.diff(self.woff), np.concatenate(([0], np.cumsum(used < level)))
        logs = [float(value[a:b].sum()) for a, b in zip(self.woff[:-1].tolist(), self.woff[1:].tolist(), strict=True)]
        return size, backed[self.woff[1:]] - backed[self.woff[:-1]], np.array(logs)


def score(spark: SparkSession, docs: DataFrame, order: int = ORDER, least: int = LEAST, alpha: float = ALPHA,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_backoff, log_sum`` of every row."""
    path = scratch_path(spark, "lm-pieces")
    _packed(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")).write.option("compression", "uncompressed").parquet(path)
    packed = spark.read.parquet(path)
    width = shuffle_width(spark)
    fragments = 2 * width

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, off, data in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                rows = list(PieceGrams(data, np.array(off, np.int64), order, fragments).asked())
                if rows:
                    f, grams, counts = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f, pa.int32()), pa.array([piece] * len(f), pa.int64()), pa.array(grams, pa.list_(pa.binary())),
                         pa.array(counts, pa.list_(pa.binary()))], ["fragment", "piece", "grams", "counts"])

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The count tables of the fragments, joined back to the pieces."""
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        answers: list[list[bytes]] = [[] for _ in rows]
        for n in range(order):
            size = [len(r[2][n]) // 8 for r in rows]
            gram = np.frombuffer(b"".join(r[2][n] for r in rows), np.uint64)
            value, back = np.unique(gram, return_inverse=True)
            here = np.concatenate([np.zeros(0, np.uint32), *(_wide(r[3][n], s).astype(np.uint32) for r, s in zip(rows, size, strict=True))])
            count = np.bincount(back, here, len(value)).astype(np.uint64)
            at = 0
            for a, s in zip(answers, size, strict=True):
                a.append(_narrow(count[back[at:at + s]]))
                at += s
        for i in range(0, len(rows), 256):
            some = rows[i:i + 256]
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in some], pa.int64()), pa.array([r[0] for r in some], pa.int32()),
                                              pa.array(answers[i:i + 256], pa.list_(pa.binary()))], ["piece", "fragment", "totals"])

    counted = (packed.select("piece", "doc_ids", "offsets", "data").mapInArrow(ask, "fragment int, piece long, grams array<binary>, counts array<binary>")
               .repartition(2 * width, "fragment").mapInArrow(table, "piece long, fragment int, totals array<binary>"))
    path = scratch_path(spark, "lm-answers")
    counted.write.option("compression", "zstd").parquet(path)
    answers = spark.read.parquet(path).groupBy("piece").agg(F.collect_list(F.struct("fragment", "totals")).alias("answers"))
    return _summed(packed, answers, packed.agg(F.sum("n_words")).first()[0] or 0, order, least, alpha, fragments)


def _summed(packed: DataFrame, answers: DataFrame, total: int, order: int, least: int, alpha: float, fragments: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, off, data, got = (batch.column(k)[i].as_py() for k in range(4))
                n, back, logs = PieceGrams(data, np.array(off, np.int64), order, fragments).scores(
                    [(a["fragment"], a["totals"]) for a in got or []], total, least, alpha)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(back, pa.int64()),
                                                  pa.array(logs, pa.float64())], ["doc_id", "n_words", "n_backoff", "log_sum"])

    return (packed.join(answers, "piece", "left").select("doc_ids", "offsets", "data", "answers")
            .mapInArrow(run, "doc_id long, n_words long, n_backoff long, log_sum double"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words that backed off, mean log score to six places."""
    return _means(score(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")))


def op8_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with contexts of up to two words."""
    return _means(score(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), order=3))


def _means(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_backoff",
                        F.when(F.col("n_words") > 0, F.round(F.col("log_sum") / F.col("n_words"), 6)).alias("score"))


OP8_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
b AS (SELECT t.*, lag(x) OVER (PARTITION BY r ORDER BY i) AS p FROM t),
c1 AS (SELECT x, count(*) AS c FROM t GROUP BY x),
c2 AS (SELECT p, x, count(*) AS c FROM b WHERE p IS NOT NULL GROUP BY p, x),
n AS (SELECT count(*) AS total FROM t),
s AS (SELECT b.r, CASE WHEN b.p IS NULL THEN ln(u.c / n.total)
                       WHEN g.c >= 2 THEN ln(g.c / v.c) ELSE ln(0.4) + ln(u.c / n.total) END AS l,
             CASE WHEN b.p IS NOT NULL AND g.c < 2 THEN 1 ELSE 0 END AS back
      FROM b CROSS JOIN n JOIN c1 u ON u.x = b.x LEFT JOIN c1 v ON v.x = b.p LEFT JOIN c2 g ON g.p = b.p AND g.x = b.x),
d AS (SELECT r, count(*) AS k, sum(back) AS back, avg(l) AS m FROM s GROUP BY r)
SELECT w.doc_id, CAST(coalesce(d.k, 0) AS BIGINT) AS n_words, CAST(coalesce(d.back, 0) AS BIGINT) AS n_backoff, round(d.m, 6) AS score
FROM w LEFT JOIN d ON d.r = w.r
"""

OP8_ORDER3_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
b AS (SELECT t.*, lag(x) OVER (PARTITION BY r ORDER BY i) AS p, lag(x, 2) OVER (PARTITION BY r ORDER BY i) AS q FROM t),
c1 AS (SELECT x, count(*) AS c FROM t GROUP BY x),
c2 AS (SELECT p, x, count(*) AS c FROM b WHERE p IS NOT NULL GROUP BY p, x),
c3 AS (SELECT q, p, x, count(*) AS c FROM b WHERE q IS NOT NULL GROUP BY q, p, x),
n AS (SELECT count(*) AS total FROM t),
s AS (SELECT b.r, CASE WHEN h.c >= 2 THEN ln(h.c / k.c)
                       WHEN g.c >= 2 THEN ln(g.c / v.c) + CASE WHEN b.q IS NULL THEN 0 ELSE ln(0.4) END
                       ELSE ln(u.c / n.total) + CASE WHEN b.p IS NULL THEN 0 WHEN b.q IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END END AS l,
             CASE WHEN b.q IS NOT NULL AND h.c < 2 OR b.q IS NULL AND b.p IS NOT NULL AND g.c < 2 THEN 1 ELSE 0 END AS back
      FROM b CROSS JOIN n JOIN c1 u ON u.x = b.x LEFT JOIN c1 v ON v.x = b.p LEFT JOIN c2 g ON g.p = b.p AND g.x = b.x
           LEFT JOIN c2 k ON k.p = b.q AND k.x = b.p LEFT JOIN c3 h ON h.q = b.q AND h.p = b.p AND h.x = b.x),
d AS (SELECT r, count(*) AS k, sum(back) AS back, avg(l) AS m FROM s GROUP BY r)
SELECT w.doc_id, CAST(coalesce(d.k, 0) AS BIGINT) AS n_words, CAST(coalesce(d.back, 0) AS BIGINT) AS n_backoff, round(d.m, 6) AS score
FROM w LEFT JOIN d ON d.r = w.r
"""
