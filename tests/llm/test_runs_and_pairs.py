"""FM-index dedup, periodic runs and cross-tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martwright.llm import alignment, fm_dedup, period_runs
from martwright.llm.skew import spread_join

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


def vocabulary(rnd, n=400):
    return ["".join(rnd.choice("abcdéfghij") for _ in range(rnd.randint(2, 9))) for _ in range(n)]


# ---- FM-index

def fm_brute(rows, length):
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - length + 1 if d is not None else 0):
            key = tuple(w[i:i + length])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - length + 1 if d is not None else 0):
            if first[tuple(w[i:i + length])] < d:
                gone |= set(range(i, i + length))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def passages(seed, length):
    rnd = random.Random(seed)
    words = vocabulary(rnd)
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    shared = [say(rnd.randint(length - 2, 5 * length)) for _ in range(6)] + [["la"] * 3 * length]
    rows = []
    for d in range(70):
        text = say(rnd.randint(0, 2 * length))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randrange(len(p))
            text += (p if rnd.random() < .6 else p[a:]) + say(rnd.randint(0, length))
        rows.append((d, rnd.choice([" ", "\n", "  "]).join(text)))
    rows += [(100 + d, "x " * d + " ".join(shared[0]) + " y" * (d % 3)) for d in range(25)]
    rows += [(130 + d, rows[80][1]) for d in range(30)]
    return [*rows, (5, rows[5][1]), (6, rows[80][1]), (200, None), (201, ""), (202, " \n"), (None, rows[81][1]), (203, rows[3][1].upper()),
            (204, " ".join(say(6000) + shared[1] + say(20)))]


@pytest.mark.parametrize(("length", "gram", "crowd"), [(12, 4, 3), (12, 11, 1000), (50, 16, 5)])
def test_fm_dedup_equals_brute_force(session, frame, length, gram, crowd):
    rows = passages(length + gram, length)
    out = fm_dedup.remove(session, frame(rows), length=length, gram=gram, shard=40, crowd=crowd)
    got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), r.kept) for r in out.collect()]
    assert sorted(got, key=repr) == fm_brute(rows, length)
    assert sum(r[2] for r in got) > 1000


def test_fm_index_counts_and_matches():
    rnd = random.Random(4)
    for _ in range(60):
        length = rnd.choice([2, 3, 6])
        pieces = [[rnd.randint(1, rnd.choice([2, 5, 30])) for _ in range(rnd.randint(length, 3 * length))] for _ in range(rnd.randint(1, 20))]
        number = {w: i + 1 for i, w in enumerate(sorted({w for p in pieces for w in p}))}
        pieces = [[number[w] for w in p] for p in pieces]
        doc = np.unique([rnd.randrange(5) for _ in pieces], return_inverse=True)[1]
        size = np.array([len(p) for p in pieces])
        words = np.array([w for p in pieces for w in p])
        index = fm_dedup.FMIndex(words, size, doc)
        for w in number.values():                       # one step from all suffixes counts a word
            lo, hi = index.back(np.array([w]), np.array([0]), np.array([index.width]))
            assert hi[0] - lo[0] == (words == w).sum()
        bound = np.array([rnd.randrange(6) for _ in pieces])
        found = [set() for _ in pieces]
        for lane, a, b in zip(*fm_dedup.covered(index, words, np.cumsum(size) - size, size, bound, length), strict=True):
            found[lane] |= set(range(a, b + 1))
        first = {}
        for p, d in zip(pieces, doc, strict=True):
            for i in range(len(p) - length + 1):
                first[tuple(p[i:i + length])] = min(first.get(tuple(p[i:i + length]), 99), d)
        for p, b, got in zip(pieces, bound, found, strict=True):
            assert got == {i for i in range(len(p) - length + 1) if first[tuple(p[i:i + length])] < b}


def test_fm_dedup_of_nothing(session, frame):
    assert fm_dedup.remove(session, frame([])).count() == 0
    assert [tuple(r)[:2] for r in fm_dedup.remove(session, frame([(1, None)])).collect()] == [(1, 0)]


# ---- periodic runs

def runs_brute(w, least=6, times=4):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for d in range(150):
        words = vocabulary(rnd, rnd.choice([1, 2, 3, 50]))
        w = [rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            a, p, n = rnd.randint(0, len(w)), rnd.randint(1, 9), rnd.randint(0, 50)
            unit = [rnd.choice(words) for _ in range(p)]
            w[a:a] = (unit * n)[:n]
        rows.append((d, rnd.choice([" ", "\n", " \t"]).join(w)))
    long = ["a b c"] * 900 + [f"w{i}" for i in range(5000)] + ["z"] * 700
    return [*rows, (5, rows[5][1]), (200, None), (201, ""), (202, " \n"), (None, "k k k k k k k"), (203, " ".join(long))]


def test_runs_equal_brute_force(session, frame):
    rows = periodic_rows(1)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in period_runs.runs(frame(rows)).collect()), key=repr)
    expected = []
    for d, t in rows:
        w = WORD.findall(t or "")
        found = runs_brute(w)
        expected.append((d, found, collapse(w, found)))
    assert got == sorted(expected, key=repr)
    assert sum(len(r[1]) for r in got) > 100


def test_op12_digests_equal_brute_force(session, tmp_path, frame):
    rows = [(d, t) for d, t in periodic_rows(2)] + [(d, f"w{d} " * 30 + "x y z " * (d % 50)) for d in range(300, 700)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.collapsed_sha256): r for r in period_runs.op12(session, str(tmp_path)).collect()}
    changed = 0
    for d, t in rows:
        w = WORD.findall(t or "")
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w, changed = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)], changed + 1
        found = runs_brute(w)
        r = got[d, hashlib.sha256(collapse(w, found).encode()).hexdigest()]
        assert r.n_runs == len(found)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        best = min(((-n, s, q) for s, n, q in found), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == (
            (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4)
    assert changed > 20


def test_grammar_extends_exactly():
    rnd = random.Random(3)
    for _ in range(40):
        w = [rnd.randint(1, rnd.choice([1, 2, 9])) for _ in range(rnd.randint(2, 200))]
        seq = np.array([98, *w, 99])
        g = period_runs.Grammar(seq)
        x, y = (np.array([rnd.randint(1, len(w)) for _ in range(50)]) for _ in range(2))
        x, y = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]
        for back, step in ((False, 1), (True, -1)):
            for a, b, n in zip(x, y, g.extend(x, y, back), strict=True):
                k = 0
                while seq[a + step * k] == seq[b + step * k]:
                    k += 1
                assert k == n


def test_runs_of_nothing(session, frame):
    assert period_runs.runs(frame([])).count() == 0
    with pytest.raises(ValueError):
        period_runs.runs(frame([]), times=2)


# ---- alignment

def align_brute(rows):
    from tokenizers import Tokenizer
    import sentencepiece

    a_path, b_path = alignment.defaults()
    tok = Tokenizer.from_file(a_path)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    piece = {i: p for p, i in tok.get_vocab().items()}
    byte = alignment._byte_of()
    groups = []
    for _, t in rows:
        text = " " + (t or "")
        a, b = tok.encode(text, add_special_tokens=False).ids, sp.encode(t or "")
        ba = [bytes(byte[c] for c in piece[i]) for i in a]
        bb = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(ba) != text.encode() or b"".join(bb) != text.encode():
            groups.append(None)
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in (ba, bb)]
        cut = sorted(set(ends[0]) & set(ends[1]))
        groups.append([([i for i, e in zip(a, ends[0], strict=True) if lo < e <= hi], [i for i, e in zip(b, ends[1], strict=True) if lo < e <= hi])
                       for lo, hi in zip([0, *cut], cut, strict=False)])
    n = Counter(p for g in groups if g for p in {(x, y) for s, u in g for x in s for y in u})
    top = Counter()
    for (x, _), c in n.items():
        top[x] = max(top[x], c)
    out = []
    for (d, _), g in zip(rows, groups, strict=True):
        if g is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for s, u in g for x in s for y in u]
        text = ";".join(",".join(map(str, s)) + "|" + ",".join(map(str, u)) for s, u in g)
        out.append((d, sum(len(s) for s, _ in g), sum(len(u) for _, u in g), len(g), len(links),
                    sum(n[p] == top[p[0]] for p in links), sum(n[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_texts(seed):
    rnd = random.Random(seed)
    bits = ["a", "the", " ", "  ", "\n", "\t", "é", "中", "▁", "\U0001F600", "1", "23", "'s", "'", "!", " ", "​", "\x00", "\x1c", "<|endoftext|>",
            "<s>", "</s>", "<0x41>", " foo", "Bar", "\r", "　", "é", "ﬁ", "\x7f", "\x85", " running", " tokenization"]
    rows = [(d, "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40)))) for d in range(300)]
    rows += [(400 + d, rnd.choice(["the same text of many", "another, told twice", "the same text of many"])) for d in range(80)]
    return [*rows, (3, rows[3][1]), (3, "another text of the same id"), (600, None), (601, ""), (602, " "), (None, "no id"),
            (603, "long words " * 4000)]


@pytest.mark.parametrize("block_bytes", [200, 1 << 23])
def test_alignment_equals_the_libraries(session, frame, block_bytes):
    rows = odd_texts(block_bytes)
    got, counts = alignment.align(session, frame(rows), *alignment.defaults(), block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = align_brute(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
    assert sum(r[1] > 0 for r in expected) > 200 and sum(r[1] == 0 for r in expected) > 10
    assert counts.groupBy("pair").count().where("count > 1").count() == 0


def test_alignment_forgets_and_learns_again(monkeypatch):
    a, b = alignment.defaults()
    one, other = alignment.Aligner(a, b), alignment.Aligner(a, b)
    texts = [t for _, t in odd_texts(9) if t]
    whole = one.block(texts, np.ones(len(texts), np.int64))
    monkeypatch.setattr(alignment, "REMEMBER", 5)
    sha = [x for i in range(0, len(texts), 7) for x in other.block(texts[i:i + 7], np.ones(len(texts[i:i + 7]), np.int64))["sha"]]
    assert sha == whole["sha"]


def test_alignment_of_nothing(session, frame):
    got, counts = alignment.align(session, frame([]), *alignment.defaults())
    assert got.count() == 0 and counts.count() == 0


def test_spread_join_equals_a_join(session):
    left = session.range(5000).selectExpr("id", "IF(id % 3 = 0, 0, id % 700) AS k")
    right = left.groupBy("k").count().where("k % 2 = 0")
    got = spread_join(left, right, ["k"], "count", left.count())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
