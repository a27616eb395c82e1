"""Substring dedup on words with a compressed FM-index per shard.

A window is ``length`` consecutive words of one document; a word covered by a window that also starts in a document with
a smaller doc_id goes.

* *Routing.* The ``GRAM``-word hashes of a window have a least one (leftmost on ties), its anchor: equal windows have
  equal anchors. Neighbouring windows of one anchor are a piece; the shard of a piece is the hash of its anchor,
  so all that a window can match is in one shard. Anchors found in one document only have no match and send nothing.
  Equal pieces are collapsed to one with its smallest document before any text moves. An anchor with over
  ``CROWD`` different pieces is cut into pieces of one window, of which only those of two documents go on.
* *Index.* Per shard (of a size that does not grow; more text means more shards) the pieces' words are joined with
  separators and suffix-sorted by prefix doubling; their Burrows-Wheeler transform is kept in a Huffman-shaped
  wavelet tree (about the entropy of the words in bits) with rank counts, beside the pieces' documents in suffix
  order with a minimum over ranges.
* *Search.* Pieces are streamed against the index, twice: for its smallest document and, where the piece has copies, for
  the later ones. Backward search gives the longest match that ends at a position and lies in a document
  smaller than the one asked for; the windows inside are found, those around the word where it broke off are not, and
  the search goes on with the windows that are left (``covered``). All pieces of a shard advance in
  lockstep, a word a step. The stretches of windows whose matching statistic reaches ``length`` are reported.
* The reported stretches go back to the pieces of all documents (copies of very frequent pieces by a bounded broadcast).

Word and window hashes are 64 bits. Defined results: null texts and texts under ``length`` words lose nothing; rows
that share a doc_id are one document as a source of matches (equal ids are not smaller) and each row keeps its own
text; a null doc_id takes no part. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import scratch_path, shuffle_width

from .flat import _POWERS, column, mix, pieces, prefix_sums, span_hash, word_spans
from .skew import spread_join

#: Words of an anchor's gram; pieces of a shard; different pieces of an anchor that are searched as they are.
GRAM, SHARD, CROWD = 16, 1 << 13, 1 << 12


# -- the index

class WaveletTree:
    """Huffman-shaped: level k holds bit k of the code of every symbol with a longer code, by node."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        count = np.bincount(seq, minlength=sigma)
        self.size, self.code = self._codes(count)
        depth = int(self.size.max())
        nodes = np.zeros((depth + 1, sigma), np.int64)         # where a symbol's node starts on a level
        for k in range(depth):
            live = np.flatnonzero(self.size > k)
            prefix = self.code[live] >> (self.size[live] - k)
            order = np.argsort(self.code[live] << (depth - self.size[live]), kind="stable")
            live, prefix = live[order], prefix[order]
            at = np.concatenate(([0], np.cumsum(count[live])[:-1]))
            lead = np.concatenate(([True], prefix[1:] != prefix[:-1]))
            nodes[k, live] = at[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        self.bits, self.ranks, self.nodes, self.before = [], [], nodes, np.zeros((depth + 1, sigma), np.int64)
        cur = seq
        for k in range(depth):
            bit = (self.code[cur] >> (self.size[cur] - 1 - k) & 1).astype(bool)
            packed = np.packbits(np.pad(bit, (0, -len(bit) % 64 + 64)), bitorder="little").view(np.uint64)
            ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.uint32))).astype(np.uint32)
            self.bits.append(packed)
            self.ranks.append(ranks)
            live = np.flatnonzero(self.size > k)
            self.before[k, live] = self._ones(k, nodes[k, live])
            ones = np.cumsum(bit) - bit
            here = np.arange(len(cur)) - nodes[k][cur]
            inner = ones - self.before[k][cur]
            go = self.size[cur] > k + 1
            cur, place = cur[go], (nodes[k + 1][cur] + np.where(bit, inner, here - inner))[go]
            then = np.empty_like(cur)
            then[place] = cur
            cur = then

    @staticmethod
    def _codes(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, code) of every symbol: canonical Huffman codes."""
        some = np.flatnonzero(count).tolist()
        size = np.zeros(len(count), np.int64)
        heap = [(int(count[s]), i) for i, s in enumerate(some)]
        heapq.heapify(heap)
        parent, n = [0] * (2 * len(some)), len(some)
        while len(heap) > 1:
            (x, a), (y, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = n
            heapq.heappush(heap, (x + y, n))
            n += 1
        depth = [0] * n
        for i in range(n - 2, -1, -1):
            depth[i] = depth[parent[i]] + 1
        size[some] = np.maximum(1, depth[:len(some)])
        code, order, last = np.zeros(len(count), np.int64), np.lexsort((some, size[some])), 0
        value = 0
        for i in order.tolist():
            s = some[i]
            value <<= int(size[s]) - last
            last = int(size[s])
            code[s] = value
            value += 1
        return size, code

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ranks[k][word].astype(np.int64) + np.bitwise_count(self.bits[k][word] & low)

    def rank(self, sym: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before its ``lo`` and before its ``hi``."""
        lo, hi = lo.copy(), hi.copy()
        size, code, k, lane = self.size[sym], self.code[sym], 0, np.arange(len(sym))
        while len(lane):
            s = sym[lane]
            node, before = self.nodes[k, s], self.before[k, s]
            one = (code[lane] >> (size[lane] - 1 - k) & 1).astype(bool)
            for end in (lo, hi):
                p = end[lane]
                r = self._ones(k, node + p) - before
                end[lane] = np.where(one, r, p - r)
            k += 1
            lane = lane[size[lane] > k]
        return lo, hi


def suffix_order(seq: np.ndarray, tie: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols, by prefix doubling; ``tie`` makes first symbols distinct."""
    _, rank = np.unique(tie, return_inverse=True)
    n, span, order = len(seq), 1, np.argsort(rank, kind="stable")
    while span < depth:
        key = rank * np.int64(n + 1)
        key[:n - span] += rank[span:] + 1
        order = np.argsort(key)
        step = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], step[1:] != step[:-1])))
        if rank[order[-1]] == n - 1:
            break
        span *= 2
    return order


class FMIndex:
    """FM-index of the pieces of one shard, with the documents of the suffixes."""

    def __init__(self, words: np.ndarray, size: np.ndarray, doc: np.ndarray) -> None:
        """``words``: numbers from 1 on, piece after piece; ``size`` and ``doc`` (dense, from 0) per piece."""
        n = len(size)
        piece = np.repeat(np.arange(n), size + 1)
        last = np.cumsum(size + 1) - 1
        seq = np.zeros(len(piece), np.int64)
        inside = np.ones(len(piece), bool)
        inside[last] = False
        seq[inside] = words
        tie = seq + n
        tie[last] = np.arange(n)                               # separators differ from each other
        order = suffix_order(seq, tie, int(size.max()) + 1)
        sigma = int(seq.max()) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        self.tree = WaveletTree(seq[order - 1], sigma)
        least = doc[piece[order]].astype(np.int32)
        self.least = [least]
        while 2 << (len(self.least) - 1) <= len(least):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))
        self.width = len(least)
        self.table = np.concatenate(self.least)
        self.at = np.concatenate(([0], np.cumsum([len(x) for x in self.least])))
        del self.least

    def back(self, sym: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with ``sym`` and go on as those from ``lo`` to ``hi``."""
        x, y = self.tree.rank(sym, lo, hi)
        return self.first[sym] + x, self.first[sym] + y

    def least_doc(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest document of the suffixes; one past all where there are none."""
        n = np.maximum(hi - lo, 1)
        k = np.frexp(n.astype(np.float64))[1].astype(np.int64) - 1
        x = np.minimum(lo, self.width - (1 << k))
        found = np.minimum(self.table[self.at[k] + x], self.table[self.at[k] + np.maximum(hi - (1 << k), 0)])
        return np.where(hi > lo, found, np.iinfo(np.int32).max)


def covered(index: FMIndex, words: np.ndarray, start: np.ndarray, size: np.ndarray, bound: np.ndarray, length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lane, first, last) windows of each streamed piece that lie in a document below its ``bound``.

    A lane is ``words[start:start + size]``. Its open windows are ``s`` to ``t``. A search from the end of window t to
    the left either reaches s (all are found), or breaks off at f < t (those after f are found) or at f >= t (t is
    not there). A search from the end of window s breaks off at f (all up to f are not there) or
    reaches s. The next search is from s where the last one from t took long and brought nothing.
    """
    lane = np.arange(len(start))
    s, t = np.zeros(len(lane), np.int64), size - length
    from_s = np.zeros(len(lane), bool)
    pos = t + length
    lo, hi = np.zeros(len(lane), np.int64), np.full(len(lane), index.width)
    out = []
    while len(lane):
        x, y = index.back(words[start[lane] + pos - 1], lo, hi)
        broke = index.least_doc(x, y) >= bound[lane]
        f = pos - 1
        over = broke | (f == s)
        pos, lo, hi = f, x, y
        if not over.any():
            continue
        e = np.flatnonzero(over)
        b, first, g, sl, tl = broke[e], from_s[e], f[e], s[e], t[e]
        # from t: windows after the break (or all from s on) are found
        head = np.where(b, g + 1, sl)
        hit = ~first & (head <= tl)
        out.append((lane[e[hit]], head[hit], tl[hit]))
        nt = np.where(first, tl, np.where(b, np.minimum(g, tl - 1), sl - 1))
        long = ~first & b & (g >= tl) & (tl + length - g > length // 2)
        # from s: window s is found, or all up to the break are not there
        got = first & ~b
        out.append((lane[e[got]], sl[got], sl[got]))
        ns = np.where(first, np.where(b, g + 1, sl + 1), sl)
        s[e], t[e], from_s[e] = ns, nt, long
        pos[e] = np.where(long, ns, nt) + length
        lo[e], hi[e] = 0, index.width
        live = s <= t
        if not live.all():
            lane, s, t, from_s, pos, lo, hi = (v[live] for v in (lane, s, t, from_s, pos, lo, hi))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


# -- pieces of documents

def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, word offsets per document, hash sums over words)."""
    starts, ends = word_spans(data, off)
    word = span_hash(prefix_sums(data), starts, ends)
    up, _ = _POWERS.get(len(word) + 1)
    sums = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * up[:len(word)], out=sums[1:])
    return starts, ends, np.searchsorted(starts, off), sums


def _anchored(woff: np.ndarray, sums: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, anchor, first, last window) of all pieces; words are numbered over all documents."""
    n = len(sums) - 1
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    pos = np.arange(n - gram + 1)
    best, reach, span = span_hash(sums, pos, pos + gram) & np.uint64(0xFFFFFFFF00000000) | pos.astype(np.uint64), length - gram + 1, 1
    while span < reach:
        step = min(span, reach - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    ok = np.zeros(len(best), bool)
    for a, b in zip(woff[:-1].tolist(), woff[1:].tolist(), strict=True):
        ok[a:max(a, b - length + 1)] = True
    window = np.flatnonzero(ok)
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)[window]
    new = np.concatenate((np.ones(min(1, len(at)), bool), (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    return np.searchsorted(woff, window[first], "right") - 1, at[first], window[first], window[last]


PLACE = "core long, whole long, doc_id long, text_key long, first int, last int"
_PLACE = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def _place_batch(core, whole, ids, keys, first, last) -> pa.RecordBatch:
    cols = (core.view(np.int64), whole.view(np.int64), ids, keys, first, last)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _PLACE, strict=True)], [c.split()[0] for c in PLACE.split(", ")])


def places(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Pieces of ``docs(doc_id, text_key, text)``: anchor's hash, hash of the piece, document and windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for a, _, data, off in pieces(column(batch, "text")):
                _, _, woff, sums = _words(data, off)
                doc, at, first, last = _anchored(woff, sums, length, gram)
                core = span_hash(sums, at, at + gram)
                whole = mix(span_hash(sums, first, last + length) + (at - first).astype(np.uint64))
                yield _place_batch(core, whole, ids[a + doc], keys[a + doc], first - woff[doc], last - woff[doc])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, PLACE)


def _ranges_of(batch: pa.RecordBatch, a: int, b: int, woff: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
    """(row, window, window) of the stretches listed for rows a to b in array column ``at`` (first << 32 | last)."""
    listed = batch.column(at).slice(a, b - a)
    size = listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(b - a), size)
    return row, woff[row] + (flat >> 32), woff[row] + (flat & 0xFFFFFFFF)


def _singles(docs: DataFrame, length: int) -> DataFrame:
    """The windows listed in ``crowded`` as pieces of one window each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for a, b, data, off in pieces(column(batch, "text")):
                _, _, woff, sums = _words(data, off)
                row, first, last = _ranges_of(batch, a, b, woff, 3)
                n = last - first + 1
                row, w = np.repeat(row, n), np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
                whole = span_hash(sums, w, w + length)
                yield _place_batch(whole, mix(whole), ids[a + row], keys[a + row], w - woff[row], w - woff[row])

    return docs.select("doc_id", "text_key", "text", "crowded").mapInArrow(run, PLACE)


def _texts(docs: DataFrame, length: int) -> DataFrame:
    """The words of the pieces listed in ``sent``, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in pieces(column(batch, "text")):
                starts, ends = word_spans(data, off)
                woff = np.searchsorted(starts, off)
                sent = batch.column(2).slice(a, b - a)
                size = sent.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = sent.flatten()
                row = np.repeat(np.arange(b - a), size)
                place = flat.field("place").to_numpy(zero_copy_only=False)
                first, last = woff[row] + (place >> 32), woff[row] + (place & 0xFFFFFFFF)
                raw = data.tobytes()
                cut = [b" ".join(raw[x:y].split()) for x, y in zip(starts[first].tolist(), ends[last + length - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(flat.field(c) for c in ("core", "whole", "least", "most")), pa.array(cut, pa.binary())],
                                                 ["core", "whole", "least", "most", "words"])

    return docs.select("doc_id", "text", "sent").mapInArrow(run, "core long, whole long, least long, most long, words binary")


def _search(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Index of one shard and all its pieces streamed against it."""
    core, whole, least, most = (np.array(c, np.int64) for c in list(zip(*rows, strict=True))[:4])
    text = [r[4] for r in rows]
    data = np.frombuffer(b" ".join(text), np.uint8)
    size = np.fromiter(map(len, text), np.int64, len(text))
    starts, ends = word_spans(data, np.array([0, len(data)]))
    per = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(size + 1)))))
    _, number = np.unique(span_hash(prefix_sums(data), starts, ends), return_inverse=True)
    words, begin = number.astype(np.int64) + 1, np.cumsum(per) - per
    _, doc = np.unique(least, return_inverse=True)
    index = FMIndex(words, per, doc)
    copied = np.flatnonzero(most > least)
    some = np.flatnonzero(doc)                              # the first document has none before it
    lanes = np.concatenate((some, copied))
    bound = np.concatenate((doc[some], doc[copied] + 1))
    lane, first, last = covered(index, words, begin[lanes], per[lanes], bound, length)
    order = np.lexsort((first, lane))
    lane, spans = lane[order], (first[order] << 32 | last[order])
    piece, later = lanes[lane], lane >= len(some)
    lists = []
    for part in (~later, later):
        n = np.bincount(piece[part], minlength=len(text))
        by = np.argsort(piece[part], kind="stable")
        lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(spans[part][by], pa.int64())))
    return pa.RecordBatch.from_arrays([pa.array(core), pa.array(whole), pa.array(least), *lists], ["core", "whole", "least", "own", "later"])


def _searched(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Shard after shard (the rows come sorted by shard)."""
    now, rows = None, []
    for batch in batches:
        for shard, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard != now:
                if rows:
                    yield _search(rows, length)
                now, rows = shard, []
            rows.append(row)
    if rows:
        yield _search(rows, length)


# -- the job

def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _collapsed(rows: DataFrame) -> DataFrame:
    """Equal pieces as one: ``core, whole, least`` and ``most`` document, ``n`` rows, and a place in the least."""
    place = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))
    # both min_by compare the same ids in the same order, so they take the same row
    return rows.groupBy("core", "whole").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"),
                                             F.min_by("text_key", "doc_id").alias("text_key"), F.min_by(place, "doc_id").alias("place"))


def _cores(one: DataFrame) -> DataFrame:
    """Anchors that two documents have, with their number of different pieces and of rows."""
    return (one.groupBy("core").agg(F.min("least").alias("lo"), F.max("most").alias("hi"), F.count("*").alias("kinds"),
                                    F.sum("n").alias("rows")).where("lo < hi").select("core", "kinds", "rows"))


def repeats(spark: SparkSession, docs: DataFrame, length: int, gram: int = GRAM, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """``doc_id, text_key, spans`` (first << 32 | last window) of ``docs(doc_id, text_key, text)`` that have any."""
    if not 1 <= gram < length:
        raise ValueError("an anchor's gram must be shorter than a window")
    key = ["doc_id", "text_key"]
    every = _stored(spark, places(docs, length, gram), "fm-places")
    one = _stored(spark, _collapsed(every), "fm-pieces")
    cores = _stored(spark, _cores(one), "fm-anchors")
    total = one.count()
    thin = spread_join(one, cores.where(F.col("kinds") <= crowd), ["core"], "kinds", total).select(one.columns)
    many = cores.where(F.col("kinds") > crowd)
    if not many.isEmpty():
        crowded = spread_join(every, many, ["core"], "rows", every.count())
        listed = crowded.groupBy(*key).agg(F.collect_set(F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))).alias("crowded"))
        single = _stored(spark, _singles(docs.join(listed, key), length), "fm-singles")
        both = _stored(spark, _collapsed(single).where("least < most"), "fm-single-pieces")
        thin, every = thin.unionByName(both), every.unionByName(single)
    thin = _stored(spark, thin, "fm-candidates")
    # the text of one of each set of equal pieces, from the document that holds the first
    sent = thin.groupBy(F.col("least").alias("doc_id"), "text_key").agg(
        F.collect_list(F.struct("core", "whole", "least", "most", "place")).alias("sent"))
    text = _texts(docs.join(sent, key), length)
    shards = max(1, -(-thin.count() // shard))
    dealt = text.select(F.pmod(F.xxhash64("core"), F.lit(shards)).cast("int").alias("shard"), "core", "whole", "least", "most", "words")
    found = dealt.repartition(min(shards, 4 * shuffle_width(spark)), "shard").sortWithinPartitions("shard").mapInArrow(
        lambda batches: _searched(batches, length), "core long, whole long, least long, own array<long>, later array<long>")
    found = _stored(spark, found, "fm-matches")
    rows = found.where("size(own) > 0 OR size(later) > 0").join(thin.select("core", "whole", "n"), ["core", "whole"])
    rows = _stored(spark, rows, "fm-found")
    hits = spread_join(every, rows, ["core", "whole"], "n", every.count()).withColumn(
        "span", F.explode(F.expr("IF(doc_id = least, own, later)")))
    # windows of a piece to windows of the document
    by = F.col("first").cast("long")
    return hits.groupBy(*key).agg(F.collect_set(F.col("span") + F.shiftleft(by, 32) + by).alias("spans"))


def remove(spark: SparkSession, docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
           **sizes: int) -> DataFrame:
    """``doc_id, n_words, removed`` (runs of words: start, end) and ``kept`` (words joined by one space) per row."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("text_key"), F.col(f"`{text_col}`").alias("text"))
    gone = repeats(spark, docs.where("doc_id IS NOT NULL"), length, **sizes)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in pieces(column(batch, "text")):
                starts, _ = word_spans(data, off)
                woff = np.searchsorted(starts, off)
                row, first, last = _ranges_of(batch, a, b, woff, 2)
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, last + length, -1)
                keep = np.cumsum(edge)[:-1] == 0
                hit = np.zeros(b - a, bool)
                hit[row] = True
                raw, kept, spans = data.tobytes(), [], []
                for x, y, lo, hi, some in zip(off[:-1].tolist(), off[1:].tolist(), woff[:-1].tolist(), woff[1:].tolist(), hit.tolist(), strict=True):
                    words, turn = raw[x:y].split(), []
                    if some:
                        k = keep[lo:hi]
                        words = [words[i] for i in np.flatnonzero(k).tolist()]
                        turn = np.flatnonzero(np.diff(np.concatenate(([1], k.astype(np.int8), [1])))).reshape(-1, 2).tolist()
                    kept.append(b" ".join(words).decode())
                    spans.append([{"start": x, "end": y} for x, y in turn])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(woff)), pa.array(spans, span),
                                                  pa.array(kept, pa.string())], ["doc_id", "n_words", "removed", "kept"])

    return docs.join(gone, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, removed array<struct<start: long, end: long>>, kept string")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    removed = F.expr("aggregate(removed, 0L, (n, r) -> n + r.end - r.start)")
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
