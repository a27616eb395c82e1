"""Token store and piece codec against their libraries."""

import random
import zlib

import numpy as np
import pytest

from martwright.llm import piece_codec, token_store
from martwright.session import scratch_path

PARTS = ["a", "b", "the", "  ", " ", "\n", "\t", "é", "漢", "🙂", "▁", "abab", "aaaa", "ing", "\u0000", "<s>", "in", "er", "0",
         "123", "\r\n", "    ", "​", " ", " ", "\x1c", "'s", "don't", ".", ",", "<|endoftext|>"]


def texts(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + ["", " ", "  ", "▁", " a", "a "]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())


def test_pieces_equal_library(library):
    codec = piece_codec.PieceCodec.load(piece_codec.default_model())
    docs = texts(1, 4000) + [" " * 300 + "x" * 1000 + "ab" * 2000]
    ids = list(codec.encode(docs, {}))
    want = library.encode(docs, add_bos=True, add_eos=True, num_threads=1)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
    assert [codec.decode(x) for x in ids] == [library.decode(w) for w in want]


def test_pairs_of_pieces_that_are_no_piece(library):
    """Their search in the pair table must end at a free slot, however long the run of taken ones."""
    codec = piece_codec.PieceCodec.load(piece_codec.default_model())
    ids = np.array(sorted(codec.id_of.values()), np.int64)
    rnd = np.random.default_rng(7)
    keys = rnd.choice(ids, 500_000) << 32 | rnd.choice(ids, 500_000)
    slots = codec._find(keys)
    assert ((codec.slot_key[slots] == keys) | (codec.slot_key[slots] < 0)).all()
    docs = ["satisfiedottiNODE", "▁Boysprojects", "photographuela Boysprojects Nov"]
    want = library.encode(docs, add_bos=True, add_eos=True, num_threads=1)
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(docs, {})] == want


def test_pieces_memory_is_dropped(monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBER", 3)
    codec, memory = piece_codec.PieceCodec.load(piece_codec.default_model()), {}
    first = list(codec.encode(["one two three four five"], memory))
    assert not memory and list(codec.encode(["one two three four five"], memory)) == first


def test_pieces_edge_rows(session, frame):
    rows = [(1, None), (2, ""), (3, "a  b"), (3, "a  b"), (None, "x")]
    model = piece_codec.default_model()
    out = piece_codec.decode(piece_codec.encode(frame(rows), model), model).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.text) for r in out) == [
        (0, 3, "x"), (1, 2, ""), (2, 2, ""), (3, 5, "a  b"), (3, 5, "a  b")]
    assert piece_codec.encode(frame([]), model).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(token_store.default_tokenizer())


@pytest.mark.parametrize("special_as_text", [False, True])
def test_words_equal_library(special_as_text):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_store.default_tokenizer())
    tokenizer.encode_special_tokens = special_as_text
    docs = texts(2, 4000) + ["x <|endoftext|>", "x<|endoftext|> y", "<|endoftext|>  z", "long " * 20000]
    encoder = token_store.WordEncoder(token_store.default_tokenizer(), 0, special_as_text)
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(docs)]
    assert got == [e.ids + [0] for e in tokenizer.encode_batch(docs, add_special_tokens=False)]


@pytest.mark.parametrize("n", [3, 300])
def test_store_round_trip(session, tokenizer, n):
    docs = list(enumerate(texts(3, n))) + [(2, None), (2, None), (-5, "first here")]
    df = session.createDataFrame(docs, "doc_id long, text string").repartition(5)
    folder = scratch_path(session, "t-store")
    token_store.write(session, df, folder, token_store.default_tokenizer(), block_ids=200)
    got = token_store.read(session, folder).orderBy("start").collect()
    order = sorted(docs, key=lambda r: (r[0], (r[1] is not None, r[1] or "")))
    start = 0
    for (doc, text), r in zip(order, got, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (doc, start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = {r.doc_id: r.start for r in token_store.read(session, folder, wanted=[-5, 1, 999]).collect()}
    assert some == {r.doc_id: r.start for r in got if r.doc_id in (-5, 1)}
    many = {r.doc_id: r.start for r in token_store.read(session, folder, wanted=[*range(-400, 2)]).collect()}
    assert many == {r.doc_id: r.start for r in got if r.doc_id < 2}
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = token_store.read(session, folder, wanted=[1])._jdf.queryExecution().executedPlan().toString()
    session.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(first_doc,1)" in plan and "GreaterThanOrEqual(last_doc,1)" in plan


def test_words_are_forgotten_and_learned_again(monkeypatch):
    docs = texts(4, 300)
    whole = list(token_store.WordEncoder(token_store.default_tokenizer(), 0).encode(docs))
    monkeypatch.setattr(token_store, "REMEMBER", 3)
    encoder = token_store.WordEncoder(token_store.default_tokenizer(), 0)
    assert [x for i in range(0, len(docs), 7) for x in encoder.encode(docs[i:i + 7])] == whole


def test_store_of_nothing(session):
    folder = scratch_path(session, "t-store")
    token_store.write(session, session.createDataFrame([], "doc_id long, text string"), folder, token_store.default_tokenizer())
    assert token_store.read(session, folder).count() == 0


def test_query_crc(session, tmp_path, tokenizer):
    session.createDataFrame([(5, "hello there"), (4, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.op2(session, str(tmp_path)).collect()}
    ids = np.array([*tokenizer.encode("hello there", add_special_tokens=False).ids, 0], "<u4")
    assert got == {4: (0, 1, zlib.crc32(b"\0" * 4)), 5: (1, len(ids), zlib.crc32(ids.tobytes()))}
