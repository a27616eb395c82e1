"""Secret scan: every rule in one combined automaton, one pass over the bytes.

Rules are regular expressions over bytes (literals, classes, alternation, repetition). Their
reversals are put into one non-deterministic automaton with a loop at its start, determinised by
subset construction and minimised by partition refinement; the result is a dense transition
array over byte classes. Read from right to left, a state's accept mask says which rules have a
match that *starts* at this byte. Leftmost non-overlapping matches of each rule then follow: take
the first marked start not before the last end, and run the rule's own anchored automaton from
there for the longest match.

The pass is vectorised: a batch of documents is one byte array (documents are parted by 0xFF,
which no UTF-8 text holds and which leads back to the start state), cut into equal blocks that
advance in lockstep. A block whose true entry state differs from the assumed one is run again
until it meets the states it had, so the marks are exactly those of a serial scan.

Defined results: null and empty texts have no spans; repeated rows each give a row; spans are in
code points, end exclusive, ordered by (start, kind as listed).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from re import _constants as rc
from re import _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .flat import column, pieces

SEPARATOR = 0xFF
BLOCK = 1024


@dataclass(frozen=True)
class Rule:
    """``pattern`` as Python regex over ASCII; ``least`` characters of ``group`` or the match is dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: The three base kinds, in the order in which equal starts are listed.
BASE = ("assign", "access", "hex")

#: hex counts to 32 inside the automaton (a greedy run of a class of 32 or more is the same match), so ordinary
#: letters do not mark starts.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
)


# ---- regular expression -> non-deterministic automaton ---------------------------------------------------------

@dataclass
class Nfa:
    step: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _either_case(byte: int) -> frozenset[int]:
    return frozenset(chr(byte).swapcase().encode()) | {byte}


def _bytes_of(op, arg, fold: bool) -> frozenset[int]:
    if op is rc.LITERAL:
        one = frozenset([arg])
    elif op is rc.RANGE:
        one = frozenset(range(arg[0], arg[1] + 1))
    elif op is rc.IN:
        negate = arg[0][0] is rc.NEGATE
        one = frozenset().union(*(_bytes_of(o, a, False) for o, a in arg if o is not rc.NEGATE))
        one = frozenset(range(256)) - one if negate else one
    else:
        raise ValueError(f"not supported in a rule: {op}")
    return frozenset().union(*(_either_case(b) for b in one)) if fold else one


def _build(nfa: Nfa, items, start: int, fold: bool, back: bool) -> int:
    """Add a sequence from ``start``; return its end. ``back``: the reversed language."""
    for op, arg in reversed(list(items)) if back else items:
        if op is rc.SUBPATTERN:
            _, on, _, inner = arg
            start = _build(nfa, inner, start, fold or bool(on & re.IGNORECASE), back)
        elif op is rc.BRANCH:
            end = nfa.state()
            for inner in arg[1]:
                nfa.free[_build(nfa, inner, start, fold, back)].append(end)
            start = end
        elif op is rc.MAX_REPEAT:
            low, high, inner = arg
            for _ in range(low):
                start = _build(nfa, inner, start, fold, back)
            if high is rc.MAXREPEAT:
                loop = nfa.state()
                nfa.free[start].append(loop)
                nfa.free[_build(nfa, inner, loop, fold, back)].append(loop)
                start = loop
            else:
                ends = [start]
                for _ in range(high - low):
                    start = _build(nfa, inner, start, fold, back)
                    ends.append(start)
                end = nfa.state()
                for e in ends:
                    nfa.free[e].append(end)
                start = end
        else:
            end = nfa.state()
            nfa.step[start].append((_bytes_of(op, arg, fold), end))
            start = end
    return start


# ---- subset construction and minimisation ----------------------------------------------------------------------

@dataclass(frozen=True)
class Dfa:
    """``move[state * classes + cls[byte]]`` is the next state times ``classes``; state 0 is the start."""

    cls: np.ndarray
    move: np.ndarray
    accept: np.ndarray
    classes: int

    @property
    def states(self) -> int:
        return len(self.accept)


def _byte_classes(nfa: Nfa) -> tuple[np.ndarray, list[int]]:
    sets = list(dict.fromkeys(s for arcs in nfa.step for s, _ in arcs))
    sign: dict[tuple, int] = {}
    cls = np.array([sign.setdefault(tuple(b in s for s in sets), len(sign)) for b in range(256)], np.int32)
    return cls, [int(np.flatnonzero(cls == c)[0]) for c in range(len(sign))]


def determinise(nfa: Nfa, start: int, ends: dict[int, int], loop: bool) -> Dfa:
    """``ends``: final state -> bit; ``loop``: the language may begin anywhere."""
    cls, samples = _byte_classes(nfa)
    first = nfa.closure(frozenset([start]))
    ids, todo, rows = {first: 0}, [first], []
    while todo:
        now = todo.pop(0)
        row = []
        for b in samples:
            to = {t for s in now for chars, t in nfa.step[s] if b in chars}
            nxt = nfa.closure(frozenset(to | ({start} if loop else set())))
            if nxt not in ids:
                ids[nxt] = len(ids)
                todo.append(nxt)
            row.append(ids[nxt])
        rows.append(row)
    move = np.array(rows, np.int64)
    accept = np.array([sum(bit for e, bit in ends.items() if e in s) for s in ids], np.int64)
    return minimise(cls, move, accept)


def minimise(cls: np.ndarray, move: np.ndarray, accept: np.ndarray) -> Dfa:
    """Partition refinement: states stay together while their accept masks and successors' groups agree."""
    _, group = np.unique(accept, return_inverse=True)
    while True:
        key = np.concatenate([group[:, None], group[move]], axis=1)
        _, first, new = np.unique(key, axis=0, return_index=True, return_inverse=True)
        new = new.reshape(-1)
        if len(first) == group.max() + 1:
            break
        group = new
    order = np.full(len(first), -1)
    rank = 0
    for g in new:  # group numbers by first state, so the start is 0
        if order[g] < 0:
            order[g], rank = rank, rank + 1
    group = order[new]
    lead = np.zeros(rank, np.int64)
    lead[group[::-1]] = np.arange(len(group))[::-1]
    k = move.shape[1]
    return Dfa(cls, (group[move[lead]] * k).astype(np.int32).reshape(-1), accept[lead], k)


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    starts: Dfa             # all rules, reversed: marks where matches start
    own: tuple[Dfa, ...]    # each rule, anchored: the longest match from a start

    @staticmethod
    def compile(rules: tuple[Rule, ...] = RULES) -> Scanner:
        back, first = Nfa(), None
        first = back.state()
        ends = {}
        for i, r in enumerate(rules):
            begin = back.state()
            back.free[first].append(begin)
            ends[_build(back, rp.parse(r.pattern), begin, False, True)] = 1 << i
        own = []
        for r in rules:
            nfa = Nfa()
            s = nfa.state()
            own.append(determinise(nfa, s, {_build(nfa, rp.parse(r.pattern), s, False, False): 1}, False))
        return Scanner(rules, determinise(back, first, ends, True), tuple(own))

    def marks(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions where some rule's match starts, and the masks of these rules."""
        d, n = self.starts, len(data)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lanes = -(-n // BLOCK)
        grid = np.full(lanes * BLOCK, d.cls[SEPARATOR], np.int32)
        grid[-n:] = d.cls[data]
        grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)      # column: one block
        seen = np.empty((BLOCK, lanes), np.int32)
        state = np.zeros(lanes, np.int32)
        for t in range(BLOCK - 1, -1, -1):
            state = d.move[state + grid[t]]
            seen[t] = state
        redo = np.flatnonzero(seen[0, 1:])                             # blocks left of a non-start exit
        entry = seen[0, redo + 1].copy()
        while len(redo):
            lane, state, exits = redo, entry, seen[0, redo].copy()
            for t in range(BLOCK - 1, -1, -1):
                state = d.move[state + grid[t, lane]]
                on = state != seen[t, lane]
                lane, state = lane[on], state[on]
                if len(lane) == 0:
                    break
                seen[t, lane] = state
            changed = redo[(seen[0, redo] != exits) & (redo > 0)]
            redo, entry = changed - 1, seen[0, changed].copy()
        hit = d.accept.take(seen // d.classes)
        t, lane = np.nonzero(hit)
        at = lane * BLOCK + t - (lanes * BLOCK - n)
        order = np.argsort(at, kind="stable")
        return at[order], hit[t[order], lane[order]]

    def extent(self, rule: int, text: bytes, start: int) -> int:
        """End of the rule's longest match from ``start``."""
        d, s, end = self.own[rule], 0, start
        for i in range(start, len(text)):
            s = int(d.move[s + d.cls[text[i]]])
            if d.accept[s // d.classes]:
                end = i + 1
            elif not self._alive(rule, s):
                break
        return end

    def _alive(self, rule: int, s: int) -> bool:
        d = self.own[rule]
        k = s // d.classes
        return bool(d.accept[k]) or bool((d.move[s:s + d.classes] != s).any())

    def matches(self, text: bytes, at: list[int], masks: list[int]) -> list[tuple[int, int, int]]:
        """Leftmost non-overlapping (start, rule, end) in bytes, matches that are too short dropped."""
        found = []
        for i, r in enumerate(self.rules):
            past, bit = 0, 1 << i
            for p, m in zip(at, masks, strict=True):
                if not m & bit or p < past:
                    continue
                past = self.extent(i, text, p)
                size = past - p
                if r.group:
                    size = len(re.compile(r.pattern.encode()).fullmatch(text[p:past]).group(r.group))
                if size >= r.least:
                    found.append((p, i, past))
        return sorted(found)


def _scan(scanner: Scanner, data: np.ndarray, off: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Spans of each document of a piece, in code points."""
    n = len(off) - 1
    flat = np.insert(data, off[1:-1], SEPARATOR) if n > 1 else data
    at, masks = scanner.marks(flat)
    begin = off[:-1] + np.arange(n)
    out: list[list] = [[] for _ in range(n)]
    doc = np.searchsorted(begin, at, "right") - 1
    for k in np.unique(doc).tolist():
        a, b = np.searchsorted(doc, [k, k + 1])
        text = data[off[k]:off[k + 1]].tobytes()
        hits = scanner.matches(text, (at[a:b] - begin[k]).tolist(), masks[a:b].tolist())
        if hits:
            chars = np.concatenate(([0], np.cumsum((data[off[k]:off[k + 1]] & 0xC0) != 0x80)))
            out[k] = [(int(chars[s]), r, int(chars[e])) for s, r, e in hits]
    return out



def scan(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, kind, start, end) lists per document: ``doc_id, hits array<struct<kind, start, end>>``."""
    scanner = Scanner.compile(rules)
    kinds = [r.kind for r in rules]
    hit = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for _, _, data, off in pieces(column(batch, "text")):
                hits += [[{"kind": kinds[r], "start": s, "end": e} for s, r, e in one]
                         for one in _scan(scanner, data, off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, pa.list_(hit))], ["doc_id", "hits"])

    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").mapInArrow(
        run, "doc_id long, hits array<struct<kind: string, start: long, end: long>>")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the digest columns of every document, derived from the operator's spans by column functions."""
    from pyspark.sql import functions as F

    hits = scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("hits", lambda h: h["kind"].isin(*BASE))
    joined = lambda a: F.array_join(F.transform(a, lambda h: F.concat_ws(":", h["kind"], h["start"], h["end"])), ",")
    count = lambda kind: F.size(F.filter("hits", lambda h: h["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return hits.select("doc_id", *[count(k) for k in BASE],
                       F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("hits")).alias("spans"))
