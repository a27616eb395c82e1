"""Token-id store: documents as token ids in compressed blocks with a shared zstandard dictionary.

Texts are encoded by the ``tokenizers`` library, an end id closes each document, and the ids of each document
become one zstandard frame, so a short document is read without its neighbours. One dictionary, trained
on the serialized id arrays of a bounded sample (``SAMPLE_DOCS`` documents, the smallest hashes of doc_id; it
only affects the size of the files), is shared by all frames.

The store is a folder of three tables:

* ``dictionary``: hash (sha256) and bytes of the dictionary;
* ``blocks``: runs of documents in ascending (doc_id, text) order: shard, block, ``before`` (ids in the shard before
  the block), the documents' ids and sizes, the *offset index* of their frames, the dictionary's hash and the frames;
* the shards are ranges of doc_id, numbered in order; a document's global start is the ids of all shards
  before its own plus those before it in the shard.

A text is encoded word by word: text parts at a single space between two visible characters, where the
library's own splitting pattern always parts too, so distinct words are encoded once per task and batch.

Defined results: null and empty texts hold the end id alone; repeated rows each have an entry (ties of doc_id
ordered by text); a null doc_id comes first. Too few documents to train a dictionary: frames use none (hash "").
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain
from operator import or_

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.session import scratch_path

SAMPLE_DOCS = 512
DICTIONARY_BYTES = 1 << 16
BLOCK_IDS = 1 << 18
REMEMBER = 1 << 20
#: Size of the files' row groups: a few blocks, so that a short read skips the others.
GROUP_BYTES = 2 << 20

_BESIDE = re.compile(r"\s\s|^ | $")
_PART = re.compile(r"(?<=\S) (?=\S)")
_PAIRS = tuple(x + y for x in " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f" for y in " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f" if " " in (x, y))


def _words(text: str) -> list[str]:
    """The text parted at single spaces between visible characters."""
    if text.isascii():
        odd = text[:1] == " " or text[-1:] == " " or any(p in text for p in _PAIRS)
    else:
        odd = _BESIDE.search(text)
    return _PART.split(text) if odd else text.split(" ")


class WordEncoder:
    """Whole texts to id arrays with the library, each distinct word once.

    New words that end visibly are encoded many in one string, where a word's leading space parts it from the one before;
    the tokens' bytes tell which ids are whose. Words that such a string does not part so are encoded on their own.
    ``special_as_text``: strings of special tokens in a text are plain text (else they are the special ids, as the
    library has it by default).
    """

    def __init__(self, path: str, end_id: int, special_as_text: bool = False) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # tasks share the cores already
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        self.small = max(self.tok.get_vocab_size(), end_id + 1) <= 1 << 16
        self.kind = "<u2" if self.small else "<u4"
        self.end = self._bytes([end_id])
        added = self.tok.get_added_tokens_decoder()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)        # bytes that a token of a byte-level file covers
        for piece, i in vocab.items():
            self.size[i] = len(added[i].content.encode()) if i in added else len(piece)
        #: Whether words can be encoded on their own: no added token takes the space beside it.
        self.parted = not any(t.lstrip or t.rstrip or " " in t.content for t in added.values())
        self.first: dict[str, bytes] = {}      # words at a text's start
        self.later: dict[str, bytes] = {}      # words after a space

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _in_one(self, words: list[str]) -> list[bytes]:
        """Ids of words that start with a space and end visibly."""
        found = self.tok.encode_batch_fast(["".join(words[i:i + 64]) for i in range(0, len(words), 64)], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int64)
        ends = np.cumsum(self.size[ids])
        at = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        n = np.searchsorted(ends, at, "right")
        if not len(ids) or (n == 0).any() or not np.array_equal(ends[n - 1], at):
            return self._alone(words)
        raw, cut = ids.astype(self.kind).tobytes(), (len(self.end) * np.concatenate(([0], n))).tolist()
        return [raw[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w and not w[-1].isspace()]
        rest = [w for w in words if not w or w[-1].isspace()]
        if plain:
            self.later.update(zip(plain, self._in_one([" " + w for w in plain]), strict=True))
        if rest:
            self.later.update(zip(rest, self._alone([" " + w for w in rest]), strict=True))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        if not self.parted:
            yield from (x + self.end for x in self._alone([t or "" for t in texts]))
            return
        if len(self.later) > REMEMBER:
            self.first, self.later = {}, {}
        parts = [_words(t or "") for t in texts]
        heads = [p.pop(0) for p in parts]
        self._learn(list(set().union(*parts).difference(self.later)))
        unknown = list(set(heads).difference(self.first))
        self.first.update(zip(unknown, self._alone(unknown), strict=True))
        for head, words in zip(heads, parts, strict=True):
            yield self.first[head] + b"".join(map(self.later.__getitem__, words)) + self.end


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int) -> WordEncoder:
    """One per Python worker: the words learned in a task serve the next."""
    return WordEncoder(path, end_id)


def _encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``ids`` (binary in the store's id width) per row, order and rows kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path, end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(encoder.encode(part.column(1).to_pylist())), pa.binary())],
                                                 ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """Dictionary bytes from the id arrays of the sample; empty when there is too little to learn from."""
    few = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCS).distinct()
    sample = docs.join(F.broadcast(few), "doc_id")
    arrays = [r[0] for r in _encoded(sample, path, end_id).select("ids").limit(2 * SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


BLOCK_SCHEMA = ("shard int, block int, before long, n_ids long, first_doc long, last_doc long, doc_ids array<long>, sizes array<int>, "
                "frame_offsets array<long>, dictionary string, frames binary")


def write(spark: SparkSession, docs: DataFrame, folder: str, path: str, end_id: int = 0, block_ids: int = BLOCK_IDS,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all rows of ``docs`` and write the store."""
    docs = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    known = train_dictionary(docs, path, end_id)
    digest = hashlib.sha256(known).hexdigest() if known else ""
    spark.createDataFrame([(digest, bytearray(known))], "hash string, bytes binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(known) if known else None)
        encoder, shard = word_encoder(path, end_id), TaskContext.get().partitionId()
        width = np.dtype(encoder.kind).itemsize
        number, before, n, ids, sizes, frames = 0, 0, 0, [], [], []

        def block() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames])))
            known_ids = [x for x in ids if x is not None] or [None]
            row = [[shard], [number], [before], [n], [known_ids[0]], [known_ids[-1]], [ids], [sizes], [offsets.tolist()], [digest], [b"".join(frames)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.list_(pa.int64()), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                                              [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for doc, data in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    ids.append(doc)
                    sizes.append(len(data) // width)
                    frames.append(pack.compress(data))
                    n += sizes[-1]
                    if n >= block_ids:
                        yield block()
                        number, before, n, ids, sizes, frames = number + 1, before + n, 0, [], [], []
        if ids:
            yield block()

    (docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(blocks, BLOCK_SCHEMA)
     .write.option("compression", "uncompressed").option("parquet.block.size", str(GROUP_BYTES)).parquet(f"{folder}/blocks"))


def read(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of all documents, or of the ``wanted`` ids:
    then row groups whose range of doc_ids holds none of them are skipped (the filter on ``first_doc`` and ``last_doc``
    reaches the files; over 64 ids ask for their whole range) and only their frames are decompressed."""
    known = {r.hash: bytes(r.bytes) for r in spark.read.parquet(f"{folder}/dictionary").collect()}
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))               # one row per shard
    starts = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    if wanted is not None:
        ids = sorted({int(x) for x in wanted})
        ranges = [(F.col("first_doc") <= y) & (F.col("last_doc") >= x)
                  for x, y in ([(x, x) for x in ids] if len(ids) <= 64 else [(ids[0], ids[-1])])]
        blocks = blocks.where(reduce(or_, ranges) if ranges else F.lit(False))
    found = blocks.join(F.broadcast(starts), "shard").select(
        (F.col("shard_start") + F.col("before")).alias("start"), "doc_ids", "sizes", "frame_offsets", "dictionary", "frames")
    only = None if wanted is None else set(wanted)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = {h: zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None) for h, d in known.items()}
        for batch in batches:
            for start, ids, sizes, offsets, digest, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                unpack, rows = tools[digest], []
                for doc, size, a, b in zip(ids, sizes, offsets[:-1], offsets[1:], strict=True):
                    if only is None or doc in only:
                        raw = unpack.decompress(data[a:b])
                        wide = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4").astype("<u4").tobytes()
                        rows.append((doc, start, size, wide))
                    start += size
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                        ["doc_id", "start", "n_tokens", "ids"])

    return found.mapInArrow(frames, "doc_id long, start long, n_tokens long, ids binary")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    folder = scratch_path(spark, "token-store")
    write(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, path or default_tokenizer(), end_id=0)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
