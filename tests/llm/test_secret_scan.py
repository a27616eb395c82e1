"""Combined automaton against the regex engine."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from martwright.llm import secret_scan as S
from martwright.llm.flat import pieces

BASE = ((r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32))
PARTS = ["password", "passwd", "SECRET", "token", "api_key", "apikey", "ApI_Key", '"', "'", " ", "  ", "=", ":", "abc",
         "abcdef0123456789", "AKIA", "AKIAIOSFODNN7", "é", "\n", "0123456789abcdef0123456789abcdef", "Z9", ".", "==", "ſecret",
         "12345678", "ghp_" + "a1" * 20, "x", "-----BEGIN RSA PRIVATE KEY-----"]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (p, g, least) in enumerate(BASE)
                  for m in re.finditer(p, text) if len(m.group(g)) >= least)


@pytest.fixture(scope="module")
def scanner():
    return S.Scanner.compile()


def scanned(scanner, docs, limit):
    return [x for _, _, d, o in pieces(pa.array(docs), limit) for x in S._scan(scanner, d, o)]


@pytest.mark.parametrize("limit", [200, 5000, 1 << 22])
def test_base_spans_equal_regex(scanner, limit):
    rnd = random.Random(limit)
    docs = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    docs += ["", "é" * 7, "a" * 7000 + "x" + "f" * 31, "0" * 50_000, "token=" * 3000]   # runs longer than many blocks
    for text, got in zip(docs, scanned(scanner, docs, limit), strict=True):
        assert [g for g in got if g[1] < 3] == brute(text)


def test_minimised_automaton_has_no_equal_states(scanner):
    d = scanner.starts
    move = d.move.reshape(-1, d.classes) // d.classes
    group = d.accept.copy()
    for _ in range(d.states):
        group = np.unique(np.column_stack((group, group[move])), axis=0, return_inverse=True)[1].reshape(-1)
    assert len(np.unique(group)) == d.states


def test_unsupported_rule_is_an_error():
    with pytest.raises(ValueError):
        S.Scanner.compile((S.Rule("x", r"a(?=b)"),))


def test_further_kinds_and_edge_rows(session, frame):
    pem = "-----BEGIN EC PRIVATE KEY-----"
    rows = [(1, None), (2, ""), (3, "é token: abcdefgh"), (3, "é token: abcdefgh"), (4, pem), (None, "AKIA" + "A" * 12)]
    out = S.scan(session, frame(rows)).collect()
    got = sorted((r.doc_id or 0, [tuple(h) for h in r.hits]) for r in out)
    assert got == [(0, [("access", 0, 16)]), (1, []), (2, []), (3, [("assign", 2, 17)]), (3, [("assign", 2, 17)]),
                   (4, [("pem", 0, len(pem))])]
    assert S.scan(session, frame([])).count() == 0


def test_query_digest(session, tmp_path):
    text = "secret='abcdefgh1' " + "ab" * 16 + " xoxb-123456789012"
    session.createDataFrame([(7, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = S.op1(session, str(tmp_path)).first()
    base = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in brute(text))
    assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (1, 0, 1, hashlib.sha256(base.encode()).hexdigest())
    assert r.spans == base + f",slack:{text.index('xoxb')}:{len(text)}"
