"""N-gram Jaccard join by vertical partitioning: near copies among whole texts.

Documents are sets of five-word shingle fingerprints under one global order (the fingerprint
itself). Two documents link when ``100 * |A and B| >= 75 * |A or B|``. The join is exact:

1. *Classes.* Documents with equal sets form one class; its smallest id stands for it, and from here on a class is one
   document. A class goes by the first half of its set's digest until its document is joined to it.
2. *Extended prefix.* Of a set of n shingles the first ``p = n - ceil(.75 n) + l`` in the global order
   are exploded, ``l = ceil(.15 n)``: two linked documents share at least ``l - 1`` of these (and at
   least one), because what a linked pair shares starts in both prefixes. Document frequencies are counted
   per shingle; a document with fewer than that many shared shingles has no partner and drops out.
3. *Rare first.* Among a document's shared prefix shingles the most frequent ``l - 2`` can be left out
   (pigeonhole), so lines common to a large part of the corpus bring no candidates.
4. *Candidates.* Documents with one shingle in common whose sizes are within the threshold's ratio (neighbouring
   size bands) are candidates. Those connected by candidate groups are compared as a whole: dealt into cells and
   blocks of cells, every block meets every block, so no pair is a row of its own. A connected set of more than
   ``WHOLE`` documents is compared group by group instead where that moves and compares less, and a pair counts in
   the first group the two have in common. Texts are sent, not sets; what is sent at once is bounded (``_links``).
5. *Fragments.* The global order is cut into ranges; the overlaps of two cells are counted fragment by fragment
   (nothing but rows of one fragment meet) and the partial counts are summed per pair.
6. *Links.* Every pair of two cells is verified. Per document and pair of cells one row has its links: the partners
   (each pair once), the documents of their classes, and the smallest document connected in the two cells, which
   the components are made of.

Very frequent shingles (in over a hundredth of a sample of ``ROUTING_SAMPLE`` documents; a bounded list) are
not counted: all of them rank last in "rare first", so their rows never meet in one task. The list only
chooses the route, any list gives the same links. Joins on a hot key are split by the adaptive skew join.

Defined results: null and empty texts, or texts without words, have ``n_shingles`` 0 and are their own
component; texts under five words are one shingle; repeated rows of a doc_id count as one document; of rows of
one doc_id with different texts, the text with the smallest ``xxhash64`` is the document, and every row of the id gets
that document's result; a null doc_id is kept as a row of its own and takes no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import drop_path, scratch_path, scratch_scope, shuffle_width, shuffles_dropped, width_for

from .flat import column, mix, pieces, shingles, tidy
from .graph import components

FRAGMENTS = 8
#: Bytes of text whose shingles are made at once.
SMALL = 1 << 20
#: Documents and bytes of shingles of a cell; candidates compared as a whole (route only: any gives the same links).
CELL, CELL_BYTES, WHOLE = 1024, 4 << 20, 1 << 14
#: Cells of a block: a task holds two blocks' sets. Bytes that the comparison of a pair counts like, in the choice of a route.
BLOCK, PAIR_BYTES = 8, 10
#: Bytes of sets that are sent at once, per shuffle partition, if that is more than all candidates' sets.
ROUND_BYTES = 16 << 20
#: Rows of very frequent shingles that a task holds before it sends them on.
HELD = 1 << 18
#: Documents looked at to find very frequent shingles, and tasks that look at them.
ROUTING_SAMPLE, SAMPLE_TASKS = 8192, 8


def _least(n: np.ndarray | int, percent: int):
    return -(-n * percent // 100)


def _parts(n: int, percent: int) -> tuple[int, int]:
    """(prefix length, shared shingles that a linked document needs) of a set of n."""
    more = max(1, _least(n, 15))
    return min(n, n - _least(n, percent) + more), max(1, more - 1)


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")


def _one_text(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with one text per doc_id, and the rows (``doc_id``) left out: those with another text than their id's."""
    digest = F.xxhash64("text")
    held = docs.where("doc_id IS NOT NULL").select("doc_id", digest.alias("h")).groupBy("doc_id").agg(
        F.min("h").alias("least"), F.max("h").alias("most")).where("least <> most").select("doc_id", "least")
    several = _stored(spark, held, "join-ids")
    if several.isEmpty():
        return docs, docs.select("doc_id").limit(0)
    told = docs.join(several, "doc_id", "left")
    other = F.col("least").isNotNull() & (digest != F.col("least"))
    return told.where(~other).select("doc_id", "text"), told.where(other).select("doc_id")


def _frequent(spark: SparkSession, docs: DataFrame, words: int, percent: int) -> np.ndarray:
    """Prefix shingles in over a hundredth of the routing sample (sorted)."""
    total = docs.count()
    # a few tasks, however many the input has: a shingle that occurs once in one of them is sent as well
    sample = docs.sample(min(1.0, 1.2 * ROUTING_SAMPLE / max(total, 1)), seed=7).select("text").repartition(SAMPLE_TASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b, data, off in pieces(column(batch, "text")):
                value, n = np.unique(np.concatenate([s[:_parts(len(s), percent)[0]] for s in shingles(data, off, words)]),
                                     return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])

    found = (sample.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
             .where(F.col("n") * 100 > min(total, ROUTING_SAMPLE)))
    return np.sort(np.array([r[0] for r in found.collect()], np.int64).view(np.uint64))


def _digests(docs: DataFrame, words: int) -> DataFrame:
    """Per row of ``docs`` the size of its set and the set's digest in two halves (NULL for an empty set or a NULL doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            for a, b, data, off in pieces(column(batch, "text"), SMALL):
                sets = list(shingles(data, off, words))
                ids = batch.column(0).slice(a, b - a)
                none = np.array([len(s) == 0 for s in sets]) | ids.is_null().to_numpy(zero_copy_only=False)
                half = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(s) for s in sets], pa.int64()), *(pa.array(half[:, c].copy(), mask=none)
                                                  for c in (0, 1))], ["doc_id", "n", "digest_a", "digest_b"])

    return docs.mapInArrow(run, "doc_id long, n long, digest_a long, digest_b long")


def _prefixes(docs: DataFrame, words: int, percent: int, hot: np.ndarray, fragments: int) -> DataFrame:
    """Prefix shingles of the classes, packed per fragment of the global order and run of documents.

    ``fragment, shingles, classes, times`` (shingles of each class, one class after the other), ``sizes``. Hot
    shingles have negative fragments, dealt by document. A class occurs once per run.
    """
    kind = [pa.int32(), *[pa.binary()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            for _, _, data, off in pieces(column(batch, "text"), SMALL):
                sets = {xxhash.xxh3_128_digest(s.tobytes()): s for s in shingles(data, off, words) if len(s)}
                if not sets:
                    continue
                ids = np.array([int.from_bytes(k[:8], "big", signed=True) for k in sets], np.int64)
                n = np.array([len(s) for s in sets.values()], np.int32)
                cut = np.array([_parts(int(x), percent)[0] for x in n], np.int64)
                value = np.concatenate([s[:c] for s, c in zip(sets.values(), cut, strict=True)])
                doc = np.repeat(np.arange(len(n)), cut)
                part = (mix(value) % np.uint64(fragments)).astype(np.int32)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
                    part[hot[at] == value] = -1 - int(ids[0]) % fragments
                order = np.argsort(part, kind="stable")
                value, doc, part = value[order], doc[order], part[order]
                rows = []
                for f in np.unique(part).tolist():
                    x, y = np.searchsorted(part, [f, f + 1])
                    who, times = np.unique(doc[x:y], return_counts=True)
                    rows.append((f, value[x:y].tobytes(), ids[who].tobytes(), _narrow(times), _narrow(n[who])))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kind, strict=True)],
                                                 ["fragment", "shingles", "classes", "times", "sizes"])

    return docs.mapInArrow(run, "fragment int, shingles binary, classes binary, times binary, sizes binary")


def _narrow(n: np.ndarray) -> bytes:
    return n.astype(np.uint16 if n.max() < 1 << 16 else np.uint32).tobytes()


def _wide(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * rows else np.uint32).astype(np.int32)


#: Document frequencies of very frequent shingles, and of the most frequent others.
HOT, MOST = (1 << 32) - 1, (1 << 32) - 2
PACKED = "bucket int, classes binary, sizes binary, shingles binary, df binary"


def _counted(buckets: int):
    """The fragments' shingles that more than one class has, with their class frequency, packed per bucket of classes.

    Hot shingles stay where they are: all count as most frequent.
    """
    def packed(cls: np.ndarray, n: np.ndarray, value: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        bucket = (mix(cls.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cls, n, value, df, bucket = cls[order], n[order], value[order], df[order], bucket[order]
        found, first = np.unique(bucket, return_index=True)
        cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(found), *(pa.array([c[a:b].tobytes() for a, b in cuts], pa.binary())
                                           for c in (cls, n.astype(np.int32), value, df.astype(np.uint32)))],
                                          ["bucket", "classes", "sizes", "shingles", "df"])

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        value, cls, n = (np.concatenate(c) for c in zip(*rows, strict=True))
        return packed(cls, n, value, np.full(len(value), HOT, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        got, frequent, held = [], [], 0
        for batch in batches:
            for part, value, ids, times, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value, ids = np.frombuffer(value, np.uint64), np.frombuffer(ids, np.int64)
                times, size = _wide(times, len(ids)), _wide(size, len(ids))
                row = value, np.repeat(ids, times), np.repeat(size, times)
                if part >= 0:
                    got.append(row)
                    continue
                frequent.append(row)
                held += len(value)
                if held >= HELD:
                    yield sent(frequent)
                    frequent, held = [], 0
        if frequent:
            yield sent(frequent)
        if got:
            value, cls, n = (np.concatenate(c) for c in zip(*got, strict=True))
            got.clear()
            order = np.argsort(value)
            value, cls, n = value[order], cls[order], n[order]
            some = np.flatnonzero(_runs(value)[1] > 1)          # now each class once
            value, cls, n = value[some], cls[some], n[some]
            order = np.lexsort((cls, value))
            value, cls, n = value[order], cls[order], n[order]
            once = np.concatenate(([True], (value[1:] != value[:-1]) | (cls[1:] != cls[:-1])))[:len(value)]
            value, cls, n = value[once], cls[once], n[once]
            df = _runs(value)[1]
            on = np.flatnonzero(df > 1)
            if len(on):
                yield packed(cls[on], n[on], value[on], np.minimum(df[on], MOST))

    return run


def _runs(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row at which the run of equal values of each row of sorted ``value`` begins, its length)."""
    first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))[:len(value)])
    count = np.diff(np.append(first, len(value)))
    return np.repeat(first, count), np.repeat(count, count)


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``digest_a, shingle``: of each class with enough shared shingles those that are left in "rare first"."""
    tidy()
    got = [tuple(np.frombuffer(v, k) for v, k in zip(row, (np.int64, np.int32, np.uint64, np.uint32), strict=True))
           for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
    if not got:
        return
    cls, n, value, df = (np.concatenate(c) for c in zip(*got, strict=True))
    got.clear()
    order = np.lexsort((value, df, cls))
    cls, n, value = cls[order], n[order], value[order]
    once = np.concatenate(([True], (value[1:] != value[:-1]) | (cls[1:] != cls[:-1])))   # hot ones come from several runs
    cls, n, value = cls[once], n[once], value[once]
    first, count = _runs(cls)
    need = np.maximum(1, np.maximum(1, _least(n.astype(np.int64), 15)) - 1)
    on = np.flatnonzero((count >= need) & (np.arange(len(cls)) - first <= count - need))
    for i in range(0, len(on), 1 << 16):
        k = on[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(cls[k]), pa.array(value[k].view(np.int64))], ["digest_a", "shingle"])


def _band(n: str, percent: int) -> F.Column:
    """Size band: sets of linked documents lie in the same or in neighbouring ones (a thousandth wider, for rounding)."""
    return F.floor(F.log(n) / math.log(100.1 / percent)).cast("int")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``left`` (distinct ones each) has in common with each of ``right``."""
    x, y = np.concatenate(left), np.concatenate(right)
    i, j = (np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (left, right))
    value, k = np.unique(np.concatenate((x, y)), return_inverse=True)
    kx, ky = k[:len(x)], k[len(x):]
    cx, cy = np.bincount(kx, minlength=len(value)), np.bincount(ky, minlength=len(value))
    shape = len(left), len(right)
    total = np.zeros(shape, np.int64)
    many = cx * cy * 256 > shape[0] * shape[1]              # cheaper as a matrix product than one by one
    on = np.flatnonzero(many & (cx > 0) & (cy > 0))
    place = np.full(len(value), -1)
    place[on] = np.arange(len(on))
    px, py = place[kx], place[ky]
    for a in range(0, len(on), 2048):
        has = []
        for p, row, n in ((px, i, shape[0]), (py, j, shape[1])):
            here = (p >= a) & (p < a + 2048)
            m = np.zeros((n, min(2048, len(on) - a)), np.float32)
            m[row[here], p[here] - a] = 1
            has.append(m)
        total += (has[0] @ has[1].T).astype(np.int64)
    some = np.flatnonzero(~many[kx] & (cy[kx] > 0))
    by, first = j[np.argsort(ky, kind="stable")], np.cumsum(cy) - cy
    times = cy[kx[some]]
    ends = np.cumsum(times)
    a = 0
    while a < len(some):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 21), "right")))
        e, m = some[a:b], times[a:b]
        at = np.repeat(first[kx[e]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        total += np.bincount(np.repeat(i[e], m) * shape[1] + by[at], minlength=total.size).reshape(shape)
        a = b
    return total


def _linked_cells(whole: bool, x: list[tuple], y: list[tuple] | None, percent: int) -> Iterator[tuple]:
    """``doc_id, root, linked, partners`` of the links between two cells, or within one (``y`` None).

    A cell's rows: doc_id, n, weight, groups seen before, the set's fragments."""
    z = x if y is None else y
    (ids, n, weight), (jds, m, height) = (tuple(np.array([r[c] for r in s], np.int64) for c in range(3)) for s in (x, z))
    both = np.zeros((len(x), len(z)), np.int64)
    for f in range(FRAGMENTS):
        both += _common(*([r[4][f] for r in s] for s in (x, z)))
    link = (both > 0) & (100 * both >= percent * (n[:, None] + m[None, :] - both))
    if not whole and link.any():                            # other groups have the pair as well: the first counts it
        link &= _common(*([np.array(r[3], np.int64) for r in s] for s in (x, z))) == 0
    if y is None:
        np.fill_diagonal(link, False)
    i, j = np.nonzero(link)
    if not len(i):
        return
    root, soot = ids.copy(), jds.copy()
    while True:
        was = root.copy(), soot.copy()
        np.minimum.at(soot, j, root[i])
        np.minimum.at(root, i, soot[j])
        if y is None:
            root = soot = np.minimum(root, soot)
        if np.array_equal(was[0], root) and np.array_equal(was[1], soot):
            break
    listed = link if y is not None else np.triu(link)
    for k in np.flatnonzero(link.any(axis=1)).tolist():
        yield int(ids[k]), int(root[k]), int(height[link[k]].sum()), jds[listed[k]]
    if y is not None:
        for k in np.flatnonzero(link.any(axis=0)).tolist():
            yield int(jds[k]), int(soot[k]), int(weight[link[:, k]].sum()), jds[:0]


def _sent(by: str) -> tuple[F.Column, ...]:
    """Documents, cells, bytes of sets and bytes sent of a unit of comparison."""
    size = F.sum(F.col("n") * 8)
    cells = F.greatest(F.ceil(F.count("*") / CELL), F.ceil(size / CELL_BYTES)).cast("int")
    return (F.count("*").alias("m"), cells.alias("cells"), size.alias("own"),
            (size * F.ceil(cells / BLOCK)).alias(by))


def _units(spark: SparkSession, keys: DataFrame, reps: DataFrame, whole: int) -> DataFrame:
    """``doc_id, n, weight, held, parts``: where each document of a candidate group is compared.

    ``parts`` are (whole, unit, cells, sent): the connected set as a whole, or each group of the document."""
    lead = keys.groupBy("shingle").agg(F.min("doc_id").alias("b"))
    near = components(spark, keys.join(lead, "shingle").select(F.col("doc_id").alias("a"), "b").where("a <> b")).select(
        F.col("node").alias("doc_id"), F.col("comp").alias("unit"))
    near = near.join(reps.select("doc_id", "n", "weight"), "doc_id")
    size = _stored(spark, near.groupBy("unit").agg(*_sent("sent")), "join-units")
    large = _stored(spark, keys.select("shingle", "doc_id").join(
        near.join(size.where(F.col("m") > whole).select("unit"), "unit"), "doc_id"), "join-large")
    dealt = _stored(spark, large.groupBy("unit", "shingle").agg(*_sent("sent")), "join-dealt")
    # what a route moves, and what it compares
    cost = F.col("sent") + F.pow(F.col("m").cast("double"), F.lit(2)) * (PAIR_BYTES / 2)
    seen = large.groupBy("unit", "doc_id").agg(F.count("*").alias("k")).groupBy("unit").agg(F.sum(F.col("k") * F.col("k") * 4).alias("seen"))
    each = dealt.groupBy("unit").agg(F.sum(cost).alias("cost")).join(seen, "unit").select("unit", (F.col("cost") + F.col("seen")).alias("by_group"))
    split = _stored(spark, size.where(F.col("m") > whole).select("unit", cost.alias("cost")).join(each, "unit")
                    .where("by_group < cost").select("unit"), "join-split")
    part = "named_struct('whole', {}, 'unit', {}, 'cells', cells, 'sent', sent)"
    one = near.join(split, "unit", "left_anti").join(size.select("unit", "cells", "sent"), "unit").select(
        "doc_id", "n", "weight", F.expr("CAST(array() AS array<bigint>)").alias("held"), F.expr(f"array({part.format('true', 'unit')})").alias("parts"))
    each = (large.join(split, "unit", "left_semi").join(dealt.where("m > 1").select("shingle", "unit", "cells", "sent"), ["unit", "shingle"])
            .groupBy("doc_id", "n", "weight").agg(F.sort_array(F.collect_list("shingle")).alias("held"),
                                                  F.collect_list(F.expr(part.format("false", "shingle"))).alias("parts")))
    return one.unionByName(each)


def _links(spark: SparkSession, keys: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int, whole: int, path: str) -> None:
    """Writes all links between candidates to ``path``: ``doc_id, root, linked, partners``, a few rows per document.

    ``keys(shingle, doc_id)`` are the candidate groups, ``reps(doc_id, n, weight)`` their documents, ``docs(doc_id, text)``
    have their texts. A document is sent once per block that its own meets, so a unit of b blocks is sent b times: that
    is done in rounds, each with some of the pairs of blocks, and the disk holds one round, whatever b is.
    """
    units = _stored(spark, _units(spark, keys, reps, whole), "join-parts")
    held = _stored(spark, docs.join(units, "doc_id"), "join-texts")
    times = F.aggregate("parts", F.lit(0).cast("long"), lambda t, p: t + F.ceil(p.cells / BLOCK))
    own, sent = (8 * (v or 0) for v in units.agg(F.sum("n"), F.sum(F.col("n") * times)).first())
    rounds = max(1, -(-sent // max(own, ROUND_BYTES * shuffle_width(spark))))
    by = ["whole", "unit", "lo", "hi"]
    block = F.floor(F.col("cell") / BLOCK).cast("int")
    grid = (held.select("doc_id", "n", "weight", "held", "text", F.explode("parts").alias("p"))
            .select("doc_id", "n", "weight", "text", "p.whole", "p.unit", "p.cells", F.expr("filter(held, x -> x < p.unit)").alias("seen"))
            .withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.ceil(F.col("cells") / BLOCK).cast("int") - 1)))
            .select("whole", "unit", F.least(block, "other").alias("lo"), F.greatest(block, "other").alias("hi"),
                    "cell", "doc_id", "n", "weight", "seen", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(key, rows):
            whole_, _, lo, hi = key
            cells: dict[int, dict[int, tuple]] = {}             # a document once, however many rows it has
            for cell, *row in rows:
                cells.setdefault(cell, {})[row[0]] = row
            dealt = {c: [(*r[:4], np.split(r[4], np.searchsorted(r[4] >> np.uint64(61), np.arange(1, FRAGMENTS)))) for r in d.values()]
                     for c, d in cells.items()}
            for c, d in ((c, d) for c in sorted(dealt) for d in sorted(dealt) if c <= d and (c // BLOCK, d // BLOCK) == (lo, hi)):
                found = list(_linked_cells(whole_, dealt[c], None if c == d else dealt[d], percent))
                for a in range(0, len(found), 256):
                    f = list(zip(*found[a:a + 256], strict=True))
                    yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in f[:3]), pa.array(f[3], pa.list_(pa.int64()))],
                                                     ["doc_id", "root", "linked", "partners"])

        tidy()
        now, rows = None, []
        for batch in batches:
            for a, b, data, off in pieces(column(batch, "text"), SMALL):
                for w, u, lo, hi, *row, s in zip(*(c.slice(a, b - a).to_pylist() for c in batch.columns[:-1]), shingles(data, off, words), strict=True):
                    if (w, u, lo, hi) != now:
                        if len(rows) > 1:
                            yield from flushed(now, rows)
                        now, rows = (w, u, lo, hi), []
                    rows.append((*row, s))
        if len(rows) > 1:
            yield from flushed(now, rows)

    for r in range(rounds):
        some = grid.where(F.pmod(F.xxhash64(*by), F.lit(rounds)) == r) if rounds > 1 else grid
        some.repartition(2 * shuffle_width(spark), *by).sortWithinPartitions(*by).mapInArrow(
            run, "doc_id long, root long, linked long, partners array<long>").write.mode("append").parquet(path)


def near_copies(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 75,
                id_col: str = "doc_id", text_col: str = "text", whole: int = WHOLE) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, n_links`` per document (all rows of ``docs``).

    ``n_links`` is the number of other documents that the document links with, those of its own class included.
    """
    return linked(spark, docs, words, percent, id_col, text_col, whole)[0]


def linked(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id",
           text_col: str = "text", whole: int = WHOLE) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`near_copies`, and all links between different texts: ``doc_id, partners`` of classes'
    smallest documents, each pair in one of its two documents' rows (the classes' members are ``class_id``)."""
    docs = _docs(docs, id_col, text_col)
    with shuffles_dropped(spark), width_for(spark, [docs]) as width:
        docs, others = _one_text(spark, docs)
        known = docs.where("doc_id IS NOT NULL")

        every = _stored(spark, _digests(docs, words), "join-classes")
        held = every.where("digest_a IS NOT NULL")
        classes = _stored(spark, held.distinct().groupBy("digest_a", "digest_b").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("weight")), "join-reps")

        hot = _frequent(spark, known, words, percent)
        groups, found = scratch_path(spark, "join-groups"), scratch_path(spark, "join-links")
        with scratch_scope(spark):
            packed = _prefixes(known, words, percent, hot, 4 * width)
            shared = packed.repartition(2 * width, "fragment").mapInArrow(_counted(4 * width), PACKED)
            keys = _stored(spark, shared.repartition(2 * width, "bucket").mapInArrow(_rarest, "digest_a long, shingle long"), "join-keys")
            _groups(keys.join(classes.select("digest_a", F.col("rep").alias("doc_id"), "n"), "digest_a"), percent).write.parquet(groups)
        with scratch_scope(spark):
            texts = known if held.count() == held.select("doc_id").distinct().count() else known.dropDuplicates(["doc_id"])
            _links(spark, spark.read.parquet(groups), classes.select(F.col("rep").alias("doc_id"), "n", "weight"), texts,
                   words, percent, whole, found)
        drop_path(spark, groups)
        links = spark.read.parquet(found)
        comp = components(spark, links.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))

    count = links.groupBy("doc_id").agg(F.sum("linked").alias("linked")).withColumnRenamed("doc_id", "rep")
    rep = (classes.join(count, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left").select(
        "digest_a", "digest_b", F.col("rep").alias("class_id"), F.coalesce("comp", "rep").alias("component_id"),
        (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    out = (every.withColumnRenamed("n", "n_shingles").join(rep, ["digest_a", "digest_b"], "left")
           .select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
                   F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    # further rows of an id: the result of its document
    again = others.join(out.dropDuplicates(["doc_id"]), "doc_id")
    return out.unionByName(again), links.where(F.size("partners") > 0).select("doc_id", "partners")


def _groups(keys: DataFrame, percent: int) -> DataFrame:
    """``shingle, doc_id``: the candidate groups of ``keys(shingle, doc_id, n)``, documents with a shingle in common in two
    neighbouring size bands. Of groups with the same documents one is enough: their number, least, largest and hash sum agree."""
    band = F.explode(F.array(_band("n", percent), _band("n", percent) + 1)).alias("band")
    keys = keys.select("shingle", "doc_id", band).select(F.xxhash64("shingle", "band").alias("shingle"), "doc_id")
    each = keys.groupBy("shingle").agg(F.count("*").alias("m"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                       F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("h")).where("m > 1")
    one = each.groupBy("m", "lo", "hi", "h").agg(F.min("shingle").alias("shingle")).select("shingle")
    return keys.join(one, "shingle")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_shingles", "component_id", "class_id", "n_links")
