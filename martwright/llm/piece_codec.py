"""SentencePiece (BPE with byte fallback) encoding and decoding, exactly as the library does it.

The model file gives pieces and scores; no library call encodes a text. A text is cut where no
piece can cross (before a word's leading space mark), every distinct word is encoded once per
task, and all new words of a batch are encoded together in vectorised merge rounds on flat arrays:

1. one symbol (code point) per slot, pair ranks looked up in a sorted table of (left, right);
2. the smallest rank per word by a segmented minimum;
3. the leftmost non-overlapping pairs of that rank merge at once in every word (only the first
   one where a merged piece could take part in a pair that would have gone before, see ``hazard``);
4. compaction drops the merged slots; words without a pair leave; until none is left.

Symbols that are no piece fall back to their UTF-8 bytes. Decoding joins the pieces' bytes, turns
the space mark into a space and drops the space that encoding put in front.

Defined results: null and empty texts encode to the begin and end ids alone and decode to "";
repeated rows each give a row; invalid byte sequences decode to U+FFFD.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .flat import column, tidy

MARK = "▁"
#: Distinct words whose ids a task remembers before it starts afresh.
REMEMBER = 1 << 18


class PieceCodec:
    """Tables of one model file; build with ``PieceCodec.load(path)``."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], bos: int, eos: int, unk: int) -> None:
        self.bos, self.eos = bos, eos
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.id_of = {pieces[i]: i for i in normal}
        self.byte_id = np.zeros(256, np.int64)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_id[int(pieces[i][1:-1], 16)] = i
        #: What decoding puts for an id.
        self.surface = [b"" if k == "control" else bytes([int(p[1:-1], 16)]) if k == "byte" else " ⁇ ".encode()
                        if k == "unknown" else p.replace(MARK, " ").encode() for p, k in zip(pieces, kinds, strict=True)]
        # equal scores are equal ranks: the leftmost pair goes first
        levels = {s: r for r, s in enumerate(sorted({scores[i] for i in normal}, reverse=True))}
        rank = {pieces[i]: levels[scores[i]] for i in normal}
        pairs = {}
        risky = set()
        for p, i in self.id_of.items():
            for c in range(1, len(p)):
                a, b = p[:c], p[c:]
                if a in self.id_of and b in self.id_of:
                    pairs[self.id_of[a] << 32 | self.id_of[b]] = (rank[p], i)
                    risky |= {self.id_of[x] for x in (a, b) if len(x) > 1 and rank[p] <= rank[x]}
        self.none = len(levels)
        self._hash(pairs)
        #: Pieces that may at once join a pair of no later rank: such merges go one at a time.
        self.hazard = np.zeros(len(pieces), bool)
        self.hazard[list(risky)] = True
        self.char_id = np.arange(-1, -0x110001, -1, dtype=np.int64)   # negative: a code point that is no piece
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.cut = self._cut()

    def _hash(self, pairs: dict[int, tuple[int, int]]) -> None:
        """Open-addressing table of the pairs: key, rank, result."""
        self.shift = np.uint64(64 - max(4, (8 * len(pairs)).bit_length()))
        size = 1 << int(np.uint64(64) - self.shift)
        self.slot_key = np.full(size, -1, np.int64)
        self.slot_rank = np.full(size, self.none, np.int64)
        self.slot_to = np.full(size, -1, np.int64)
        keys = np.array(list(pairs), np.int64).reshape(-1)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.slot_key[at[left]] < 0
            spot, who = np.unique(at[left[free]], return_index=True)
            put = left[free][who]
            self.slot_key[spot] = keys[put]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & (size - 1)
        for key, (rank, to) in pairs.items():
            at1 = int(self._find(np.array([key], np.int64))[0])
            self.slot_rank[at1], self.slot_to[at1] = rank, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Slot of each key; of an unknown key a slot without a pair."""
        at = self._slot(key)
        open_ = np.flatnonzero((self.slot_key[at] != key) & (self.slot_key[at] >= 0))
        while len(open_):                                          # an unknown key goes on to a free slot: one is always left
            at[open_] = (at[open_] + 1) & (len(self.slot_key) - 1)
            k = self.slot_key[at[open_]]
            open_ = open_[(k != key[open_]) & (k >= 0)]
        return at

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str) -> PieceCodec:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        kinds = ["unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) else "byte" if sp.is_byte(i)
                 else "unused" if sp.is_unused(i) else "normal" for i in n]
        return PieceCodec([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n], kinds,
                          sp.bos_id(), sp.eos_id(), sp.unk_id())

    def _cut(self) -> bool:
        """Whether no piece holds a mark after another character, so words part there."""
        return not any(MARK in p.lstrip(MARK) for p in self.id_of)

    # -- encoding

    def split(self, text: str) -> list[str]:
        """The words of a text with the leading mark put in; their joint encoding is the text's."""
        if not text:
            return []
        whole = MARK + text.replace(" ", MARK)
        if not self.cut:
            return [whole]
        first, *rest = whole[1:].split(MARK)
        if "" not in rest and first:
            return [MARK + first, *[MARK + w for w in rest]]
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", whole)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (little-endian unsigned 32-bit), all words at once."""
        text = "".join(words)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), size)
        sym = self.char_id[code]
        rank, to = self._pairs(sym, word, np.arange(len(sym)))
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, first)
            span = np.diff(np.append(first, len(sym)))
            open_ = np.repeat(best < self.none, span)
            if not open_.all():                                   # words without a pair are ready
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, to = sym[open_], word[open_], rank[open_], to[open_]
                best, span = best[best < self.none], span[best < self.none]
                if len(sym) == 0:
                    break
            take = rank == np.repeat(best, span)
            take = self._leftmost(take, to, word)
            sym = np.where(take, to, sym)
            keep = ~np.concatenate(([False], take[:-1]))
            sym, word, rank, to, new = sym[keep], word[keep], rank[keep], to[keep], np.flatnonzero(take[keep])
            stale = np.concatenate((new, np.maximum(new - 1, 0)))  # only pairs with a merged piece have changed
            rank[stale], to[stale] = self._pairs(sym, word, stale)
        if not done_sym:
            return [b""] * len(words)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        if (sym < 0).any():
            sym, word = self._to_bytes(sym, word)
        ids, off = sym.astype("<u4").tobytes(), (4 * np.searchsorted(word, np.arange(len(words) + 1))).tolist()
        return [ids[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]

    def _pairs(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs that start at the slots ``at`` (``none``: no pair)."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        ok = (nxt > at) & (word[at] == word[nxt]) & (sym[at] >= 0) & (sym[nxt] >= 0)
        slot = self._find(np.where(ok, sym[at] << 32 | sym[nxt], 1 << 62))
        return np.where(ok, self.slot_rank[slot], self.none), np.where(ok, self.slot_to[slot], -1)

    def _leftmost(self, take: np.ndarray, to: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of the chosen slots those that merge in this round."""
        at = np.flatnonzero(take)
        run = np.cumsum(np.concatenate(([True], (np.diff(at) > 1) | (word[at[1:]] != word[at[:-1]]))))
        begin = np.searchsorted(run, run)                          # in a run of touching pairs every second one goes
        ok = (np.arange(len(at)) - begin) % 2 == 0
        head = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
        risky = np.maximum.reduceat(self.hazard[to[at]].astype(np.int8), np.flatnonzero(head)) > 0
        ok &= head | ~risky[np.cumsum(head) - 1]
        out = np.zeros(len(take), bool)
        out[at[ok]] = True
        return out

    def _to_bytes(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = np.where(sym < 0, -1 - sym, 0)
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        code, kind = np.repeat(code, size), np.repeat(size, size)
        nth = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)    # which byte of the character
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[kind]
        byte = np.where(nth == 0, lead | code >> 6 * (kind - 1), 0x80 | code >> 6 * (kind - 1 - nth) & 0x3F)
        sym = np.repeat(sym, size)
        return np.where(sym < 0, self.byte_id[byte & 0xFF], sym), np.repeat(word, size)

    def encode(self, texts: Iterable[str | None], memory: dict[str, bytes]) -> Iterator[bytes]:
        """Per text its ids with begin and end, as little-endian unsigned 32-bit integers."""
        lists = [self.split(t or "") for t in texts]
        new = list(set().union(*lists).difference(memory))
        for i in range(0, len(new), 1 << 14):
            part = new[i:i + (1 << 14)]
            memory.update(zip(part, self.encode_words(part), strict=True))
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        for words in lists:
            yield begin + b"".join(map(memory.__getitem__, words)) + end
        if len(memory) > REMEMBER:
            memory.clear()

    # -- decoding

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 32-bit, with begin and end ids) of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        codec, memory = PieceCodec.load(model), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = list(codec.encode(column(part, "text").to_pylist(), memory))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: the texts that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        codec = PieceCodec.load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), part.column(1),
                     pa.array([codec.decode(x) for x in ids], pa.string())], ["doc_id", "n_tokens", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, text string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    from pyspark.sql import functions as F

    model = model or default_model()
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), model), model)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
