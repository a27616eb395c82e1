"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, corpus-wide.

Texts are deduplicated by their whole text first: a shuffle by full text leaves each distinct text once with its
multiplicity, and only that is tokenised and aligned. Tokenizer A is byte-level BPE and encodes space + text, B is
SentencePiece BPE and encodes the text; both give every token a range of bytes. Offsets where both end a token
cut the tokens into groups, and all A-B pairs of a group are links.

1. Blocks of about ``BLOCK_BYTES`` of distinct texts are encoded and aligned, each distinct word of a block once (a
   single space between two visible characters parts the tokens of both). A block row holds the texts' measures
   and words, the words' links, and the block's id pairs with the number of documents that hold them: texts that
   hold the pair, weighted by multiplicity.
2. Pair counts: the blocks' counts summed per pair, and the highest per A id (one row per id of the vocabulary).
3. A block asks for its pairs by a join on the pair (a pair occurs once a block, so no pair is hot) and sums
   counts and best links of each text.
4. The measures are joined to the documents by the text's sha256; texts with very many copies by broadcast.

Defined results: null and empty texts, and texts whose joined token bytes differ from space + text, have zeros and
``groups_sha256`` ""; repeated rows count as documents of their own; a null doc_id is kept.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import scratch_path

from .skew import spread_join
from .token_store import _words

BLOCK_BYTES = 4 << 20
#: Words a Python worker remembers before it starts afresh.
REMEMBER = 1 << 18
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
#: Fixed value: the pattern by which this kind of byte-level vocabulary parts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others
    in order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokenizer:
    """Ids of a byte-level BPE file (ids in the order of its merges); special strings are plain text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte, special = _byte_of(), {t["content"] for t in spec["added_tokens"]}
        self.surface = {i: bytes(byte[c] for c in p) for p, i in spec["model"]["vocab"].items() if p not in special}
        self._engine = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={b: i for i, b in self.surface.items()},
                                         special_tokens={})

    def encode(self, words: list[str]) -> list[list[int]]:
        return list(map(self._engine.encode_ordinary, words))

    def encode_joined(self, words: list[str]) -> list[int]:
        """The ids of all words, one after the other, where each starts with a space and ends visibly."""
        return self._engine.encode_ordinary("".join(words))


class PieceTokenizer:
    """Ids of a SentencePiece file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._engine = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.surface = {i: bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i)
                        else b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode()
                        for i in range(sp.get_piece_size())}
        if any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in self.surface):
            raise ValueError("a piece goes on past a space: words of a text cannot be encoded on their own")

    def encode(self, words: list[str]) -> list[list[int]]:
        return self._engine.encode(words, num_threads=1)


class _Side:
    """Surfaces of one tokenizer by id: bytes, their sizes, and the ids as text before a separator."""

    def __init__(self, tokenizer: ByteTokenizer | PieceTokenizer, last: bytes) -> None:
        self.encode = tokenizer.encode
        self.n = n = max(tokenizer.surface) + 1
        self.bytes = [tokenizer.surface.get(i, b"") for i in range(n)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.printed = [b"%d," % i for i in range(n)] + [b"%d%b" % (i, last) for i in range(n)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(values, size of each list)."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1]))]


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All of ``start[i] ... start[i] + n[i] - 1``, one range after the other."""
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


class Aligner:
    """Both tokenizers' tables and the aligned words; one per Python worker.

    ``known`` numbers the words; by number: ``measures`` (n_a, n_b, n_groups, n_links, ok), ``said`` (the groups as
    text), and ``links`` (a << 32 | b) from ``first`` on.
    """

    def __init__(self, a: str, b: str) -> None:
        self.byte = ByteTokenizer(a)
        self.a, self.b = _Side(self.byte, b"|"), _Side(PieceTokenizer(b), b";")
        self.printed = self.a.printed + self.b.printed
        self.print_size = np.array([len(p) for p in self.printed], np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.said: list[bytes] = []
        self.measures = {c: np.zeros(0, np.int64) for c in (*MEASURES, "ok", "first")}
        self.links = np.zeros(0, np.int64)

    def _encoded(self, words: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of words (in one call where all end visibly) and how many each has."""
        if not any(w[-1].isspace() for w in words):
            ids = np.array(self.byte.encode_joined(words), np.int64)
            ends, at = np.cumsum(self.a.size[ids]), np.cumsum(size)
            n = np.searchsorted(ends, at, "right")
            if len(ids) and (n > 0).all() and np.array_equal(ends[n - 1], at):
                return ids, np.diff(n, prepend=0)
        return _flat(self.a.encode(words))

    def learn(self, words: list[str]) -> None:
        """Align words that are not known (a space stands before each of them)."""
        words = sorted(words, key=lambda w: w[-1:].isspace() or not w)
        odd = next((i for i, w in enumerate(words) if not w or w[-1].isspace()), len(words))
        for part in (words[:odd], words[odd:]):
            if part:
                self._learn(part)

    def _learn(self, words: list[str]) -> None:
        said = [" " + w for w in words]
        whole = "".join(said).encode()
        size = np.fromiter(map(len, said), np.int64, len(said))
        if len(whole) != size.sum():
            size = np.fromiter((len(s.encode()) for s in said), np.int64, len(said))
        (a, na), (b, nb) = self._encoded(said, size), _flat(self.b.encode(words))
        ok = np.ones(len(words), bool)
        for side, ids, n in ((self.a, a, na), (self.b, b, nb)):
            got = b"".join(map(side.bytes.__getitem__, ids.tolist()))
            at = np.concatenate(([0], np.cumsum(side.size[ids])))
            edge = np.concatenate(([0], np.cumsum(n)))
            if got != whole or not np.array_equal(at[edge[1:]], np.cumsum(size)):        # some word differs: look at each
                of, edge = ids.tolist(), edge.tolist()
                ok &= [b"".join(map(side.bytes.__getitem__, of[x:y])) == s.encode()
                       for x, y, s in zip(edge[:-1], edge[1:], said, strict=True)]
        if not ok.all():
            a, b = a[np.repeat(ok, na)], b[np.repeat(ok, nb)]
            na, nb, size = (np.where(ok, x, 0) for x in (na, nb, size))
        ea, eb = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        cut = np.intersect1d(ea, eb, assume_unique=True)
        ga, gb = np.searchsorted(cut, ea), np.searchsorted(cut, eb)
        ma, mb = np.bincount(ga, minlength=len(cut)), np.bincount(gb, minlength=len(cut))
        fa, fb = np.cumsum(ma) - ma, np.cumsum(mb) - mb
        # links: every A token of a group with every B token of it
        links = np.repeat(a, mb[ga]) << 32 | b[_ranges(fb[ga], mb[ga])]
        whose = np.searchsorted(np.cumsum(size), cut)          # word of each group
        groups = np.bincount(whose, minlength=len(words))
        n = np.bincount(whose, ma * mb, minlength=len(words)).astype(np.int64)
        # the printed tokens in order: a group's A tokens, then its B tokens
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + fb[ga]] = a + self.a.n * np.append(ga[1:] != ga[:-1], True)[:len(a)]
        order[np.arange(len(b)) + (fa + ma)[gb]] = 2 * self.a.n + b + self.b.n * np.append(gb[1:] != gb[:-1], True)[:len(b)]
        printed = b"".join(map(self.printed.__getitem__, order.tolist()))
        at = np.concatenate(([0], np.cumsum(self.print_size[order])))[np.concatenate(([0], np.cumsum(na + nb)))].tolist()
        self.known.update(zip(words, range(len(self.said), len(self.said) + len(words)), strict=True))
        self.said += [printed[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
        new = {"n_a": na, "n_b": nb, "n_groups": groups, "n_links": n, "ok": ok, "first": len(self.links) + np.cumsum(n) - n}
        self.measures = {c: np.concatenate((v, new[c])) for c, v in self.measures.items()}
        self.links = np.concatenate((self.links, links))

    def block(self, texts: list[str], times: np.ndarray) -> dict:
        """The columns of a block row of distinct, non-empty texts."""
        parts = [_words(t) for t in texts]
        many = np.fromiter(map(len, parts), np.int64, len(parts))
        every = list(chain.from_iterable(parts))
        parts.clear()
        if len(self.known) > REMEMBER:
            self.forget()
        new = set(every).difference(self.known)
        if new:
            self.learn(list(new))
        number = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        every.clear()
        here = np.zeros(len(self.known), bool)
        here[number] = True
        used = np.flatnonzero(here)
        unit = (np.cumsum(here) - 1)[number]                   # words are numbered within the block from here on
        found = {c: v[used] for c, v in self.measures.items()}
        first = np.cumsum(many) - many
        ok = np.minimum.reduceat(found["ok"][unit], first) > 0
        measures = {c: np.where(ok, np.add.reduceat(found[c][unit], first), 0) for c in MEASURES}
        lists, said = number.tolist(), self.said
        sha = [hashlib.sha256(b"".join([said[u] for u in lists[x:x + n]])[:-1]).hexdigest() if good else ""
               for x, n, good in zip(first.tolist(), many.tolist(), ok.tolist(), strict=True)]
        del lists, number
        n = found["n_links"]
        pairs, link = np.unique(self.links[_ranges(found["first"], n)], return_inverse=True)
        # documents that hold a pair: each text once per pair, as often as it occurs
        held = _distinct((np.repeat(np.arange(len(texts)), many) * len(used) + unit)[np.repeat(ok, many)])
        doc, held = np.divmod(held, len(used))
        in_doc = _distinct(np.repeat(doc, n[held]) * max(1, len(pairs)) + link[_ranges((np.cumsum(n) - n)[held], n[held])])
        doc, pair = np.divmod(in_doc, max(1, len(pairs)))
        weight = np.bincount(pair, times[doc], minlength=len(pairs)).astype(np.int64)
        some = np.flatnonzero(weight > 0)                     # pairs of texts that are left out ask for nothing
        place = np.cumsum(weight > 0) - 1
        return {"keys": [hashlib.sha256(t.encode()).digest() for t in texts], "copies": times, **measures, "sha": sha,
                "ok": ok, "sizes": many, "units": unit.astype("<u4").tobytes(), "unit_links": n.astype("<u4").tobytes(),
                "links": place[link].astype("<i4").tobytes(), "pairs": pairs[some], "weights": weight[some]}


@lru_cache(maxsize=1)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


BLOCK = {"block": pa.int64(), "keys": pa.list_(pa.binary()), "copies": pa.list_(pa.int64()),
         **{c: pa.list_(pa.int64()) for c in MEASURES}, "sha": pa.list_(pa.string()), "ok": pa.list_(pa.bool_()),
         "sizes": pa.list_(pa.int64()), "units": pa.binary(), "unit_links": pa.binary(), "links": pa.binary(),
         "pairs": pa.list_(pa.int64()), "weights": pa.list_(pa.int64())}
_SQL = {pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.binary()): "array<binary>", pa.list_(pa.int64()): "array<long>",
        pa.list_(pa.string()): "array<string>", pa.list_(pa.bool_()): "array<boolean>"}


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(texts: DataFrame, a: str, b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Block rows of ``texts(text, copies)``, each distinct and not empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = aligner(a, b), TaskContext.get().partitionId() << 32
        held, copies, size = [], [], 0

        def row() -> pa.RecordBatch:
            got = {"block": number, **tool.block(held, np.array(copies, np.int64))}
            return pa.RecordBatch.from_arrays([pa.array([got[c]], k) for c, k in BLOCK.items()], list(BLOCK))

        for batch in batches:
            for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(text)
                copies.append(n)
                size += len(text)
                if size >= block_bytes:
                    yield row()
                    held, copies, size, number = [], [], 0, number + 1
        if held:
            yield row()

    return texts.mapInArrow(run, ", ".join(f"{c} {_SQL[k]}" for c, k in BLOCK.items()))


def pair_counts(cut: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold the pair linked; whether no pair of its A id has more."""
    counts = (cut.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("n")))
    top = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("top"))
    # one row per id of A's vocabulary
    return (counts.join(F.broadcast(top), F.shiftright("pair", 32) == F.col("a"))
            .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Measures of a block's texts from its answers (pairs in ascending order)."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(i)[k] for i, c in enumerate(batch.schema.names)}
            flat = {c: row[c].values for c in ("keys", "copies", *MEASURES, "sha", "ok", "sizes")}
            got = row["answers"].values if row["answers"].is_valid else None
            n, best = np.zeros(1, np.int64), np.zeros(1, np.int64)
            if got is not None and len(got):
                order = np.argsort(got.field("pair").to_numpy())
                n, best = (got.field(c).to_numpy(zero_copy_only=False).astype(np.int64)[order] for c in ("n", "best"))
            link = np.frombuffer(row["links"].as_py(), "<i4")
            each = np.frombuffer(row["unit_links"].as_py(), "<u4").astype(np.int64)
            unit = np.frombuffer(row["units"].as_py(), "<u4")
            size = flat["sizes"].to_numpy()
            first, ok = np.cumsum(size) - size, flat["ok"].to_numpy(zero_copy_only=False)
            edge = np.concatenate(([0], np.cumsum(each)))
            sums = []
            for value in (best, n):
                total = np.concatenate(([0], np.cumsum(value[link])))
                of = total[edge[1:]] - total[edge[:-1]]
                sums.append(pa.array(np.where(ok, np.add.reduceat(of[unit], first), 0)))
            yield pa.RecordBatch.from_arrays([flat["keys"], flat["copies"], *(flat[c] for c in MEASURES), *sums, flat["sha"]],
                                             ["key", "copies", *MEASURES, "n_best", "count_sum", "groups_sha256"])


def align(spark: SparkSession, docs: DataFrame, a: str, b: str, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Measures per row of ``docs`` (see ``op13``), and the corpus-wide ``pair, n, best`` (a << 32 | b)."""
    docs = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    cut = _stored(spark, blocks(texts, a, b, block_bytes), "aligned-blocks")
    counts = _stored(spark, pair_counts(cut), "pair-counts")
    answers = (cut.select("block", F.explode("pairs").alias("pair")).join(counts, "pair")
               .groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("answers")))
    measured = cut.drop("pairs", "weights").join(answers, "block", "left").mapInArrow(
        _summed, "key binary, copies long, " + ", ".join(f"{c} long" for c in (*MEASURES, "n_best", "count_sum")) + ", groups_sha256 string")
    measured = _stored(spark, measured, "aligned-texts")
    keyed = _stored(spark, docs.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key")), "aligned-docs")
    total = keyed.count()
    none = keyed.where("key IS NULL").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in (*MEASURES, "n_best", "count_sum")],
                                             F.lit("").alias("groups_sha256"))
    out = spread_join(keyed.where("key IS NOT NULL"), measured, ["key"], "copies", total).select(none.columns)
    return out.unionByName(none), counts


def defaults() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op13(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    first, second = defaults()
    return align(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), a or first, b or second)[0]
