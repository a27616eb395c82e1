"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``max(least, times * q)`` words
long, that no neighbouring word extends. A piece of whole documents becomes one sequence of word numbers with a
symbol of its own before, between and after the documents, and is compressed into a run-length grammar:

* *block compression* replaces each maximal block of one symbol by a symbol for (symbol, length);
* *pair compression* deals the symbols into left and right ones by a hash and replaces every left-right pair;
* the two alternate (a level without equal neighbours goes straight to pairs) until one symbol is left. Equal stretches
  are parsed alike but for their edges, so a level keeps about three quarters of the symbols.

``Grammar.extend`` answers how far the words from x and from y agree, forwards or backwards, for many (x, y) at
once: climb while both stand at the edge of a node, step over equal nodes (over a block's rest at once), go down where
nodes differ. That takes a few steps a level and no suffix array.

Candidates are harmonic: a run of period p holds ``times`` neighbouring multiples of p with one and the same word, so for
each p only every p-th word is looked at (n/p of them, n log n in all). A candidate is extended exactly both
ways; the rest of its chain is tried behind the stretch that was found. A stretch found with several periods has the
least of them.

Defined results: null texts, and texts without words, have no runs and collapse to ""; repeated rows each give a row; a
null doc_id is kept; columns besides the two named are not read. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .flat import column, mix, pieces, prefix_sums, span_hash, word_spans

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4


class Grammar:
    """Levels of the grammar as flat arrays; level 0 is the sequence, whose first and last symbols occur once."""

    def __init__(self, seq: np.ndarray) -> None:
        sym, size = seq.astype(np.int32), np.ones(len(seq), np.int32)
        names, salt = int(sym.max()) + 1, 0
        self.syms, self.sizes, parents, heads, self.block = [sym], [size], [], [np.zeros(len(sym) + 1, np.int32)], []
        while len(sym) > 1:
            same = sym[1:] == sym[:-1]
            if same.any():
                head = np.flatnonzero(np.concatenate(([True], ~same)))
                count = np.diff(np.append(head, len(sym)))
                many = np.flatnonzero(count > 1)
                key = sym[head[many]].astype(np.int64) << 32 | count[many]
            else:
                salt += 1
                right = (mix(sym.astype(np.uint64) * np.uint64(2) + np.uint64(salt << 34)) >> np.uint64(63)).astype(bool)
                pair = np.flatnonzero(~right[:-1] & right[1:])
                if not len(pair):
                    continue
                keep = np.ones(len(sym), bool)
                keep[pair + 1] = False
                head = np.flatnonzero(keep)
                many = np.searchsorted(head, pair)
                key = sym[pair].astype(np.int64) << 32 | sym[pair + 1]
            self.block.append(bool(same.any()))
            found, name = np.unique(key, return_inverse=True)
            up = sym[head]
            up[many] = names + name
            names += len(found)
            parent = np.zeros(len(sym), np.int32)
            parent[head[1:]] = 1
            parents.append(np.cumsum(parent, dtype=np.int32))
            size = np.add.reduceat(size, head)
            heads.append(np.append(head, len(sym)).astype(np.int32))
            sym = up
            self.syms.append(sym)
            self.sizes.append(size)
        parents.append(np.zeros(len(sym), np.int32))
        self.top = len(self.syms) - 1
        n = np.array([len(s) for s in self.syms])
        self.base = np.concatenate(([0], np.cumsum(n)))
        self.head_base = np.concatenate(([0], np.cumsum(n + 1)))
        self.block = np.array([*self.block, False])
        self.sym, self.size, self.parent, self.head = (np.concatenate(a) for a in (self.syms, self.sizes, parents, heads))
        del self.syms, self.sizes

    def extend(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from x on agree with those from y on (``back``: leftwards, x and y included)."""
        out, lane = np.zeros(len(x), np.int64), np.arange(len(x))
        x, y = x.astype(np.int64), y.astype(np.int64)
        h, climb = np.zeros(len(x), np.int64), np.ones(len(x), bool)
        while len(lane):
            gx, gy = self.base[h] + x, self.base[h] + y
            equal = self.sym[gx] == self.sym[gy]
            above = np.minimum(h + 1, self.top)
            px, py = self.parent[gx].astype(np.int64), self.parent[gy].astype(np.int64)
            at = self.head_base[above]
            if back:
                ex, ey = self.head[at + px + 1] - 1, self.head[at + py + 1] - 1
                rest = np.minimum(x - self.head[at + px], y - self.head[at + py]) + 1
            else:
                ex, ey = self.head[at + px], self.head[at + py]
                rest = np.minimum(self.head[at + px + 1] - x, self.head[at + py + 1] - y)
            rise = equal & climb & (h < self.top) & (ex == x) & (ey == y)
            pace = equal & ~rise
            step = np.where(pace, np.where(self.block[h], rest, 1), 0)
            out[lane] += step * self.size[gx]
            fall = ~equal
            below = self.head_base[h] + back
            nx = np.where(rise, px, np.where(fall, self.head[below + x] - back, x - step if back else x + step))
            ny = np.where(rise, py, np.where(fall, self.head[below + y] - back, y - step if back else y + step))
            live = ~(fall & (h == 0))
            climb = climb & equal
            h = h + rise - fall
            lane, x, y, h, climb = lane[live], nx[live], ny[live], h[live], climb[live]
        return out


def _candidates(seq: np.ndarray, most: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, period, chain) of multiples of a period where it and the next ``times - 1`` hold one word."""
    where, what = [], []
    for p in range(1, most + 1):
        grid = seq[::p]
        same = grid[1:] == grid[:-1]
        n = len(same) - (times - 2)
        if n <= 0:
            break
        ok = same[:n]
        for k in range(1, times - 1):
            ok = ok & same[k:k + n]
        found = np.flatnonzero(ok)
        if len(found):
            where.append(found * p)
            what.append(np.full(len(found), p))
    if not where:
        return (np.zeros(0, np.int64),) * 3
    pos, per = np.concatenate(where), np.concatenate(what)
    new = np.concatenate(([True], (per[1:] != per[:-1]) | (pos[1:] != pos[:-1] + per[1:])))
    return pos, per, np.cumsum(new)


def find(seq: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in ``seq``, sorted by start, then period."""
    pos, per, chain = _candidates(seq, longest // times, times)
    found = []
    grammar = Grammar(seq) if len(pos) else None
    while len(pos):
        first = np.concatenate(([True], chain[1:] != chain[:-1]))
        x, p = pos[first], per[first]
        start = x - grammar.extend(x, x + p, back=True) + 1
        end = x + p + grammar.extend(x, x + p)
        found.append((start, end, p))
        behind = np.repeat(end - p, np.diff(np.append(np.flatnonzero(first), len(pos))))
        left = pos > behind                               # two stretches of a period share fewer words than it has
        pos, per, chain = pos[left], per[left], chain[left]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, p = (np.concatenate(c) for c in zip(*found, strict=True))
    ok = end - start >= np.maximum(least, times * p)
    start, end, p = start[ok], end[ok], p[ok]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    one = np.concatenate((np.ones(min(1, len(p)), bool), (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
    start, end, p = start[one], end[one], p[one]
    order = np.lexsort((p, start))
    return start[order], (end - start)[order], p[order]


def _tails(woff: np.ndarray, seeds: list[int | None]) -> np.ndarray:
    """For each word the word it becomes: documents whose seed ends in 0 repeat their tail (see ``runs``)."""
    become = np.arange(int(woff[-1]))
    for b, e, h in zip(woff[:-1].tolist(), woff[1:].tolist(), seeds, strict=True):
        if h is not None and h % 10 == 0 and e > b:
            n, g = e - b, h // 10
            a = g % n
            become[b + a:e] = b + a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return become


RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text",
         seed_col: str | None = None) -> DataFrame:
    """``doc_id, runs`` (start, length, period; word numbers from 0) and ``collapsed`` per row of ``docs``.

    ``collapsed``: words joined by one space, less those that a run holds after its first period. With ``seed_col``
    (an integer h, g = h // 10) a text of n words whose h ends in 0 has every word i >= a = g % n replaced
    by word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8), before anything else.
    """
    if least < times or times < 3:
        raise ValueError("a run needs three periods and a word for each of them")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column(2).to_pylist()
            for a, b, data, off in pieces(column(batch, "text")):
                starts, ends = word_spans(data, off)
                woff = np.searchsorted(starts, off)
                become = _tails(woff, seeds[a:b])
                _, number = np.unique(span_hash(prefix_sums(data), starts, ends), return_inverse=True)
                docs_, top = b - a, int(number.max(initial=0)) + 1
                doc = np.repeat(np.arange(docs_), np.diff(woff))
                seq = np.arange(top, top + len(number) + docs_ + 1, dtype=np.int32)     # edges: symbols that occur once
                seq[np.arange(len(number)) + doc + 1] = number[become]
                s, n, p = find(seq, int(np.diff(woff).max(initial=0)), least, times)
                whose = np.searchsorted(woff + np.arange(docs_ + 1), s, "right") - 1
                s = s - whose - 1                                                          # word of the piece
                edge = np.zeros(len(number) + 1, np.int64)
                np.add.at(edge, s + p, 1)
                np.add.at(edge, s + n, -1)
                keep = np.cumsum(edge)[:-1] == 0
                cut = np.searchsorted(whose, np.arange(docs_ + 1)).tolist()
                triples = np.stack((s - woff[whose], n, p), axis=1).tolist()
                listed = [[dict(zip(("start", "length", "period"), t, strict=True)) for t in triples[x:y]]
                          for x, y in zip(cut[:-1], cut[1:], strict=True)]
                raw, texts = data.tobytes(), []
                for k, (x, y) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                    words, lo, hi = raw[x:y].split(), int(woff[k]), int(woff[k + 1])
                    if len(words) and (listed[k] or seeds[a + k] is not None):
                        words = [words[i] for i in (become[lo:hi][keep[lo:hi]] - lo).tolist()]
                    texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, docs_), pa.array(listed, RUN), pa.array(texts, pa.string())],
                                                 ["doc_id", "runs", "collapsed"])

    seed = f"CAST(`{seed_col}` AS long)" if seed_col else "CAST(NULL AS long)"
    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text", f"{seed} AS seed").mapInArrow(
        run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the tails of a tenth of them made periodic by the crc32 of their id first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = runs(docs.withColumn("seed", F.crc32(F.col("doc_id").cast("string").cast("binary"))), seed_col="seed")
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
