"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is lower-cased and read as words (runs of letters) and clause ends. A lexicon gives each
word a class: insult, threat verb, target, negation, reporting verb or other. Sequential
transducers read these classes clause by clause:

* ``negation``: a negating word opens a scope of three words; an insult in it becomes "negated".
* ``report``: a reporting verb puts the rest of the clause into reported speech.
* ``target``: a person or pronoun makes an insult within the next four words "targeted".
* ``threat``: a threatening verb within four words after a target, or before one, becomes "threat".

They are composed into one deterministic machine (product states, one output symbol per word), so a text
is one run over one transition table. What counts is the matched clause: its kind, strongest first,
with the lexicon weight of the words in it. The document score is a logistic function of the clause
weights per kind; the kinds' weights and the bias are fitted.

The insult lexicon is a fixed list of English words plus stems learned from labels: word beginnings
of 4 to 8 bytes whose document frequency in toxic and clean documents of the training rows differs
(log odds over ``MIN_ODDS``, in at least ``MIN_SUPPORT`` toxic documents). Fitting takes at most
``train_rows`` labelled rows (the smallest hashes of doc_id; a documented bound), never rows held out by
the caller. Scoring reads every whole text; language, source and ids are no inputs.

Defined results: null and empty texts score like a text without matched clauses; a label that is
null takes no part in fitting; without both labels among the training rows the score is that of the
fixed list with default weights. Repeated rows each get a row; repeated labels of a doc_id count by their largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .flat import column, pieces, prefix_sums, span_hash

# The words of the classes.
INSULTS = ("idiot", "clown", "loser", "moron", "scum", "trash", "worthless", "pathetic", "disgusting", "stupid",
           "dumb", "imbecile", "vermin", "filth", "garbage", "ugly", "pig")
THREATS = ("kill", "hurt", "destroy", "beat", "crush", "attack", "shoot", "stab")
TARGETS = ("you", "your", "yourself", "he", "she", "they", "him", "her", "them", "everyone", "people")
NEGATIONS = ("not", "never", "no", "isn", "aren", "nicht", "kein", "keine", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "called", "claimed", "quoted", "reported", "told", "sagte", "dit", "dijo")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
#: Kinds of matched clauses, by rising rank.
KINDS = ("negated", "reported", "insult", "targeted", "threat")

STEM_BYTES = (4, 5, 6, 7, 8)
MIN_ODDS, MIN_SUPPORT = 3.0, 3
TRAIN_ROWS = 16384
#: Bytes of text handled at once: every word has a fingerprint per stem length.
SMALL = 1 << 19


# ---- transducers and their composition -------------------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """Sequential: ``step[state][symbol] = (next state, output symbol)``; state 0 is the start."""

    step: list[list[tuple[int, int]]]

    def compose(self, after: Transducer) -> Transducer:
        """The machine that feeds this one's output to ``after`` (reachable product states)."""
        ids, rows, todo = {(0, 0): 0}, [], [(0, 0)]
        while todo:
            a, b = todo.pop(0)
            row = []
            for na, out in self.step[a]:
                nb, out = after.step[b][out]
                if (na, nb) not in ids:
                    ids[na, nb] = len(ids)
                    todo.append((na, nb))
                row.append((ids[na, nb], out))
            rows.append(row)
        return Transducer(rows)


#: Output symbols are the classes, then the kinds.
_KIND = {k: END + 1 + i for i, k in enumerate(KINDS)}
_SYMBOLS = END + 1 + len(KINDS)


def _scoped(opens: int, length: int | None, turn: dict[int, int]) -> Transducer:
    """After ``opens``, for ``length`` words (None: to the clause's end), symbols turn into others."""
    states = 2 if length is None else length + 1      # state k: k words of scope left (None: 1 is "in scope")
    step = []
    for k in range(states):
        row = []
        for s in range(_SYMBOLS):
            out = turn.get(s, s) if k else s
            nxt = 0 if s == END else states - 1 if s == opens else k if length is None else max(0, k - 1)
            row.append((nxt, out))
        step.append(row)
    return Transducer(step)


def grammar() -> Transducer:
    """Threat and target first, then what weakens them."""
    plain = Transducer([[(0, _KIND["insult"] if s == INSULT else s) for s in range(_SYMBOLS)]])
    target = _scoped(TARGET, 4, {_KIND["insult"]: _KIND["targeted"], THREAT: _KIND["threat"]})
    threat = _scoped(THREAT, 4, {TARGET: _KIND["threat"]})
    strong = (_KIND["insult"], _KIND["targeted"], _KIND["threat"])
    negated = _scoped(NEGATION, 3, {s: _KIND["negated"] for s in strong})
    reported = _scoped(REPORT, None, {s: _KIND["reported"] for s in strong})
    return plain.compose(threat).compose(target).compose(negated).compose(reported)


# ---- lexicon and clauses -----------------------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?;\n"]] = True


def _hash_of(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        d = np.frombuffer(w.encode(), np.uint8)
        out.append(span_hash(prefix_sums(d), np.array([0]), np.array([len(d)]))[0])
    return np.array(out, np.uint64)


@dataclass(frozen=True)
class Lexicon:
    """Sorted fingerprints of whole words (class) and of stems (weight)."""

    word: np.ndarray
    word_class: np.ndarray
    stem: np.ndarray
    stem_weight: np.ndarray

    @staticmethod
    def build(stems: dict[int, float]) -> Lexicon:
        fixed = [(w, c) for ws, c in ((INSULTS, INSULT), (THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION),
                                      (REPORTS, REPORT)) for w in ws]
        h = _hash_of([w for w, _ in fixed])
        o = np.argsort(h)
        s = np.array(sorted(stems), np.uint64)
        return Lexicon(h[o], np.array([c for _, c in fixed], np.int64)[o], s,
                       np.array([stems[k] for k in s.tolist()], float))


def _find(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index in the sorted table, -1 if absent."""
    if len(table) == 0:
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, at, -1)


def _filled(col: pa.Array) -> pa.Array:
    return col.fill_null("") if col.null_count else col


def _lowered(col: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.utf8_lower(col)


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | edge[1:])) + 1
    return starts, ends


def _stems(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, stem fingerprint) of all words of a piece."""
    starts, ends = _words(data, off)
    sums = prefix_sums(data)
    doc = np.searchsorted(off, starts, "right") - 1
    docs, stems = [], []
    for k in STEM_BYTES:
        on = ends - starts >= k
        docs.append(doc[on])
        stems.append(span_hash(sums, starts[on], starts[on] + k))
    return np.concatenate(docs), np.concatenate(stems)


def features(lexicon: Lexicon, machine: Transducer, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per document the weight of its matched clauses by kind (documents x kinds)."""
    out = np.zeros((len(off) - 1, len(KINDS)))
    if len(data) == 0:
        return out
    starts, ends = _words(data, off)
    sums = prefix_sums(data)
    at = _find(lexicon.word, span_hash(sums, starts, ends))
    cls = np.where(at >= 0, lexicon.word_class[np.maximum(at, 0)], OTHER)
    weight = np.where(cls == INSULT, 1.0, np.where(cls == THREAT, 1.0, 0.0))
    for k in STEM_BYTES:
        on = np.flatnonzero(ends - starts >= k)
        hit = _find(lexicon.stem, span_hash(sums, starts[on], starts[on] + k))
        on, hit = on[hit >= 0], hit[hit >= 0]
        cls[on] = INSULT
        weight[on] = np.maximum(weight[on], lexicon.stem_weight[hit])
    # the machine only runs over clauses that hold an insult or a threat
    stops = np.union1d(np.flatnonzero(_STOP[data]), off[1:-1])
    clause = np.searchsorted(stops, starts, "right")
    hot = np.unique(clause[(cls == INSULT) | (cls == THREAT)])
    doc = np.searchsorted(off, starts, "right") - 1
    for c in hot.tolist():
        a, b = np.searchsorted(clause, [c, c + 1])
        state, best, strength = 0, -1, 0.0
        for s, w in zip(cls[a:b].tolist(), weight[a:b].tolist(), strict=True):
            state, symbol = machine.step[state][s]
            if symbol > END:
                best = max(best, symbol - END - 1)
            strength = max(strength, w)
        if best >= 0:
            out[doc[a], best] += strength
    return out


# ---- fitting -------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray       # one per kind
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.log1p(x) @ self.weights + self.bias, -30, 30)))


DEFAULT_WEIGHTS, DEFAULT_BIAS = np.array([0.5, 0.5, 4.0, 5.0, 5.0]), -2.0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> tuple[np.ndarray, float]:
    """Newton steps on the penalised likelihood (the bias is free)."""
    z = np.hstack([np.log1p(x), np.ones((len(x), 1))])
    pen = ridge * np.eye(z.shape[1])
    pen[-1, -1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (y - p) - pen @ w
        w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pen, g)
    return w[:-1], float(w[-1])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, min_odds: float = MIN_ODDS,
        min_support: int = MIN_SUPPORT, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``labels(doc_id, toxic)``: only the rows that may be learned from, of which ``train_rows`` are taken.

    A stem is learned if ``min_support`` toxic documents of these hold it and its log odds are over ``min_odds``: all that
    pass are, whatever their number, which the sample bounds.
    """
    rows = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    train = (docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").join(F.broadcast(rows), "doc_id")
             .select("text", F.col("toxic").cast("long").alias("y")))
    train = train.repartition(spark.sparkContext.defaultParallelism)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, data, off in pieces(_lowered(column(batch, "text")), SMALL):
                doc, stem = _stems(data, off)
                pair = np.unique(np.rec.fromarrays([stem, doc]))
                value, back = np.unique(pair.f0, return_inverse=True)
                bad = np.bincount(back, y[a:b][pair.f1], len(value)).astype(np.int64)
                size = np.bincount(back, minlength=len(value))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(bad), pa.array(size - bad)],
                                                 ["stem", "bad", "good"])

    n = {r[0]: r[1] for r in train.groupBy("y").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return Model(Lexicon.build({}), DEFAULT_WEIGHTS, DEFAULT_BIAS)
    odds = F.log((F.col("bad") + 0.5) / (n1 + 1.0)) - F.log((F.col("good") + 0.5) / (n0 + 1.0))
    found = (train.mapInArrow(count, "stem long, bad long, good long").groupBy("stem")
             .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .where((F.col("bad") >= min_support) & (odds > min_odds)).select("stem", odds.alias("odds"))
             .orderBy(F.desc("odds"), "stem").collect())
    top = max([r[1] for r in found], default=1.0)
    lexicon = Lexicon.build({r[0] % (1 << 64): r[1] / top for r in found})
    machine = grammar()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in pieces(_lowered(column(batch, "text")), SMALL):
                x = features(lexicon, machine, data, off)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1).slice(a, b - a)], ["x", "y"])

    got = train.mapInArrow(measure, "x array<double>, y long").collect()
    weights, bias = _logistic(np.array([r[0] for r in got]), np.array([r[1] for r in got], float))
    return Model(lexicon, weights, bias)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` of every row, from its text alone (columns of these names are replaced)."""
    machine = grammar()
    docs = docs.drop("score", "predicted")
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in pieces(_lowered(_filled(batch.column(place))), SMALL):
                s = model.score(features(model.lexicon, machine, data, off))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 [*names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, score double, predicted int")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    return scored(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text"), model).select("doc_id", "score", "predicted")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return fit(spark, docs, labels.where(~held_out()))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(spark, docs, sf_dir)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
