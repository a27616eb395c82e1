"""Benchmark decontamination: test items found inside documents by size-partitioned MinHash containment.

An item is contained in a document when at least ``percent`` of its distinct five-word shingles occur there;
items of fewer words are one shingle of their own length. A short item in a long document has a tiny Jaccard
similarity, so the search works on containment:

* an item's sketch is its ``n - ceil(n * percent / 100) + 1`` smallest shingle hashes (a bottom-k MinHash whose
  k follows the item's size): a document that contains the item must hold at least one of them, so no
  contained item is missed;
* items are partitioned by size (powers of two). Each partition has one hash threshold, the largest sketch value in
  it; of a document only the hashes up to the threshold (its MinHash sketch at that level) are looked up;
* candidates are verified on the words themselves: the exact shingles of item and document, no hashes.

Documents are never shuffled or joined: items go to the tasks in blocks of about ``block_shingles`` shingles, one scan
of the documents per block. The items are written once with their block number (by hash, as many blocks as their counted words
ask for); then block after block is read, indexed, searched and its finds written, so the driver holds one block
and the plan one scan, however many items there are.

Defined results: null or empty texts and items contain nothing and are contained nowhere; repeated rows of a
document or item count once (one row per doc_id and item_id); null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import dealt
from .flat import column, lowered, ngrams, pieces, tidy, words

BLOCK_SHINGLES = 1 << 21
#: Bytes of text searched at once; a pass takes some 20 times as much memory.
SMALL = 1 << 18


def _tokens(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    return lowered(data).tobytes().split()


def _exact(tokens: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(tokens[i:] for i in range(n)), strict=False))


class ItemIndex:
    """Sketches of one block of items, by size partition."""

    def __init__(self, items: list[tuple[int, str]], words_: int, percent: int) -> None:
        self.ids, self.exact, self.length = [], [], []
        parts: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            tokens = _tokens(text)
            n = min(words_, len(tokens))
            if not n:
                continue
            data = np.frombuffer(text.encode(), np.uint8)
            word, _ = words(data, np.array([0, len(data)]))
            h = np.unique(ngrams(word, n))
            k = len(h) + (-len(h) * percent // 100) + 1
            parts.setdefault((n, len(h).bit_length()), []).append((h[:k], len(self.ids)))
            self.ids.append(item_id)
            self.exact.append(_exact(tokens, n))
            self.length.append(n)
        #: Per size partition: words per shingle, threshold, sorted sketch hashes, item of each.
        self.parts = []
        for (n, _), some in sorted(parts.items()):
            value = np.concatenate([s for s, _ in some])
            item = np.concatenate([np.full(len(s), i) for s, i in some])
            order = np.argsort(value, kind="stable")
            self.parts.append((n, value.max(), value[order], item[order]))
        self.percent = percent

    def candidates(self, word: np.ndarray, woff: np.ndarray) -> np.ndarray:
        """Distinct (document, item) pairs of a piece that share a sketch hash."""
        found, grams = [], {}
        for n, threshold, value, item in self.parts:
            if n not in grams:
                h = ngrams(word, n)
                start = np.arange(len(h))
                doc = np.searchsorted(woff, start, "right") - 1
                on = start + n <= woff[doc + 1]
                grams[n] = h[on], doc[on]
            h, doc = grams[n]
            low = h <= threshold
            h, doc = h[low], doc[low]
            a, b = np.searchsorted(value, h, "left"), np.searchsorted(value, h, "right")
            hit = np.flatnonzero(b > a)
            count = (b - a)[hit]
            at = np.repeat(a[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            found.append(np.column_stack((np.repeat(doc[hit], count), item[at])))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def verify(self, text: bytes, items: list[int]) -> Iterator[tuple[int, int, int]]:
        """(item id, shared shingles, shingles of the item) of the items that the text contains."""
        tokens, sets = lowered(np.frombuffer(text, np.uint8)).tobytes().split(), {}
        for i in items:
            n = self.length[i]
            have = sets.setdefault(n, _exact(tokens, n)) if n not in sets else sets[n]
            shared = len(self.exact[i] & have)
            if 100 * shared >= self.percent * len(self.exact[i]):
                yield self.ids[i], shared, len(self.exact[i])


def _search(index: ItemIndex, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tidy()
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), []
        for a, _, data, off in pieces(column(batch, "text"), SMALL):
            pairs = index.candidates(*words(data, off))
            for d in np.unique(pairs[:, 0]).tolist():
                items_ = pairs[pairs[:, 0] == d, 1].tolist()
                rows += [(ids[a + d], *x) for x in index.verify(data[off[d]:off[d + 1]].tobytes(), items_)]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "shared", "size"])


def contained(spark: SparkSession, docs: DataFrame, items: DataFrame, words_: int = 5, percent: int = 75,
              block_shingles: int = BLOCK_SHINGLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, shared, size``: the items that a document contains."""
    docs = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").where("doc_id IS NOT NULL")
    schema = "doc_id long, item_id long, shared long, size long"

    def scan(index: ItemIndex) -> DataFrame:
        return docs.mapInArrow(lambda batches: _search(index, batches), schema)

    some = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    of_block, blocks = dealt(some, "item_id", F.sum(F.size(F.split("text", r"[\x20\n]"))), block_shingles, "items")
    out = scratch_path(spark, "contained")
    for b in blocks:
        # one block: bounded by block_shingles, released before the next
        index = ItemIndex([(r.item_id, r.text) for r in of_block(b).collect()], words_, percent)
        scan(index).write.mode("append").parquet(out)
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).dropDuplicates(["doc_id", "item_id"])


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id AS id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
di AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 3), lambda k: list_slice(w, k, k + 4))) AS s FROM d WHERE len(w) >= 5),
ii AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 3), lambda k: list_slice(w, k, k + 4))) AS s FROM i WHERE len(w) >= 5),
n AS (SELECT id, count(*) AS size FROM ii GROUP BY id)
SELECT di.id AS doc_id, ii.id AS item_id, count(*) AS shared, any_value(n.size) AS size
FROM di JOIN ii ON di.s = ii.s JOIN n ON n.id = ii.id
GROUP BY di.id, ii.id HAVING 100 * count(*) >= 75 * any_value(n.size)
"""
