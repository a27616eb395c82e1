"""Line runs, suffix levels, n-gram join and containment against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martwright.llm import blocks, containment, graph, line_runs, ngram_join, suffix_levels


def vocabulary(rnd, n=400):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n)]


# ---- lines

def lines_brute(rows, chars=40, docs=5):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(strip))
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= chars and d is not None:
                holders.setdefault(key(x), set()).add(d)
    common = {k: max(v) for k, v in holders.items() if len(v) >= docs}
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if d is None or key(x) not in common or common[key(x)] == d]
        out.append((d, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return out


def line_rows(seed):
    rnd = random.Random(seed)
    words = vocabulary(rnd)
    pool = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14))) for _ in range(25)] + ["é" * 40, "é" * 39, ""]
    def line():
        x = rnd.choice(pool)
        return rnd.choice(["", " ", "\t", "\x0b", "\xa0"]) + rnd.choice([x, x.upper(), x.title()]) + rnd.choice(["", "  ", "\r"])
    rows = [(d, "\n".join(line() for _ in range(rnd.randint(0, 8)))) for d in range(60)]
    return [*rows, (60, None), (61, ""), (62, "\n\n"), (7, rows[7][1]), (None, "\n".join(pool[:4]))]


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_lines_equal_brute_force(session, frame, batches):
    rows = line_rows(batches)
    out = line_runs.clean(session, frame(rows), batches=batches)
    assert out.columns == ["doc_id", "text", "lang", "score", "source", "n_chars", "n_lines", "n_dropped", "kept"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()), key=repr)
    assert got == sorted(lines_brute(rows), key=repr)
    assert sum(r[2] for r in got) > 20


def test_lines_of_nothing(session, frame):
    assert line_runs.clean(session, frame([])).count() == 0


def test_levels_compact_and_find_fresh_lines(session):
    make = lambda rows: session.createDataFrame(rows, "h1 long, h2 long, doc_id long")
    index = line_runs.LineRuns(session, fanout=2)
    sizes = []
    for b in range(5):
        batch = make([(k, 0, 10 * b + d) for k in range(b, b + 3) for d in range(2)])
        fresh = {r.h1 for r in index.fresh(batch).collect()}
        assert fresh == ({0, 1, 2} if b == 0 else {b + 2})
        index.add(batch)
        sizes.append([len(x) for x in index.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    got = {r.h1: (r.n_docs, r.last_doc) for r in index.merged().collect()}
    assert got == {k: (2 * sum(b <= k < b + 3 for b in range(5)), 10 * min(4, k) + 1) for k in range(7)}


def test_runs_meet_without_a_shuffle(session):
    make = lambda ks: session.createDataFrame([(k, -k, d) for k in ks for d in (1, 2)], "h1 long, h2 long, doc_id long")
    limit = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        index = line_runs.LineRuns(session, fanout=2, buckets=4)
        for b in range(3):
            index.add(make(range(10 * b, 10 * b + 15)))
        own = session.table(index._write(make(range(40)).groupBy("h1", "h2").count()))
        plans = {"anti-join": index.fresh(own), "merged": index.merged(),
                 "compaction": line_runs._combined([session.table(t) for t in (index.levels[0] + index.levels[1])])}
        for name, df in plans.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, name
        assert {r.h1 for r in index.fresh(own).collect()} == set(range(35, 40))
        got = {r.h1: r.n_docs for r in index.merged().collect()}
        assert got == {k: 4 if k in {*range(10, 15), *range(20, 25)} else 2 for k in range(35)}
        held = [r.h1 for run in index.runs() for r in run.collect()]
        assert sorted(held) == list(range(35))                       # a key is in one run only
        index.close()
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# ---- suffixes

def suffix_brute(rows, length):
    known = {d: (t or "").encode() for d, t in rows if d is not None}
    count = Counter(t[i:i + length] for t in known.values() for i in range(len(t) - length + 1))
    out = {}
    for d, t in known.items():
        cover = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                cover[i:i + length] = [True] * length
        runs = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out[d] = (len(t), sum(cover), runs, bytes(b for b, c in zip(t, cover, strict=True) if not c))
    return out


def suffix_rows(seed):
    rnd = random.Random(seed)
    words = vocabulary(rnd)
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = [text(rnd.randint(20, 90)) for _ in range(6)]
    rows = []
    for d in range(40):
        parts = [text(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randint(0, len(s) // 2)
            parts += [s[a:rnd.randint(a, len(s))], text(rnd.randint(0, 9))]
        rows.append((d, rnd.choice([" ", "é"]).join(parts)))
    return rows + [(50, "ab" * 700), (51, "x" * 900), (52, "x" * 199), (53, "x" * 200), (54, None), (55, ""), (56, rows[3][1]),
                   (57, rows[3][1][1:]), (5, rows[5][1])]


@pytest.mark.parametrize("seed,length,batches", [(1, 200, 2), (2, 200, 3), (3, 150, 1), (4, 129, 4)])
def test_suffixes_equal_brute_force(session, frame, seed, length, batches):
    rows = suffix_rows(seed)
    out = suffix_levels.remove(session, frame(rows), length=length, batches=batches).collect()
    want = suffix_brute(rows, length)
    for r in out:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id], r.doc_id
    assert len(out) == len(rows) and sum(r.n_removed for r in out) > 2000


def test_one_id_with_two_texts(session, frame):
    """Rows of one id with different texts are documents of their own; a repeated row is not."""
    rnd = random.Random(2)
    words = vocabulary(rnd)
    long, short = " ".join(rnd.choice(words) for _ in range(300)), " ".join(rnd.choice(words) for _ in range(30))
    rows = [(1, long), (1, short), (1, long[100:700]), (2, short), (2, short), (3, None), (3, short)]
    got = suffix_levels.remove(session, frame(rows)).collect()
    want = suffix_brute([(i, t) for i, (_, t) in enumerate(dict.fromkeys(rows))], 200)
    by_row = {row: want[i] for i, row in enumerate(dict.fromkeys(rows))}
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == sorted((d, *by_row[d, t]) for d, t in rows)
    assert sum(r.n_removed for r in got) > 1000


def test_suffixes_of_nothing_and_null_ids(session, frame):
    assert suffix_levels.remove(session, frame([])).count() == 0
    out = suffix_levels.remove(session, frame([(None, "x" * 500), (None, "x" * 500)])).collect()
    assert [(r.n_removed, bytes(r.kept)) for r in out] == [(0, b"x" * 500)] * 2
    with pytest.raises(ValueError):
        suffix_levels.remove(session, frame([]), length=100)


# ---- shingles

def shingle_set(text, n=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def join_brute(rows):
    sets = {d: shingle_set(t) for d, t in rows if d is not None}
    root = {d: d for d in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def join_rows(seed):
    rnd = random.Random(seed)
    words = vocabulary(rnd, 300)
    line = " ".join(rnd.choice(words) for _ in range(30))               # boilerplate in every third text
    rows, d = [], 0
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(6, 150))]
        for _ in range(rnd.randint(1, 12)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 14))):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append((d, rnd.choice([" ", "\n", "\t"]).join(w) + (" " + line if rnd.random() < 0.3 else "")))
            d += 1
    rows += [(d + i, line + " " + " ".join(rnd.choice(words) for _ in range(i % 9))) for i in range(20)]   # mostly boilerplate
    d += 20
    rnd.shuffle(rows)
    return rows + [(d, "one"), (d + 1, "ONE"), (d + 2, "one two three four"), (d + 3, "one two three four five"), (d + 4, ""),
                   (d + 5, None), (d + 6, " \t\n"), (0, dict(rows)[0]), (d + 7, "One Two three four")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_equals_brute_force(session, frame, seed):
    rows = join_rows(seed)
    out = ngram_join.near_copies(session, frame(rows)).collect()
    want = join_brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want and len(out) == len(rows)
    assert len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("whole", [1, ngram_join.WHOLE])        # group by group, all at once
@pytest.mark.parametrize("cell", [3, 1024])
def test_join_has_every_link(session, frame, monkeypatch, whole, cell):
    monkeypatch.setattr(ngram_join, "CELL", cell)
    rnd = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = join_rows(5)
    rows += [(1000 + d, " ".join(rnd.choice("xyz") if rnd.random() < 0.02 else w for w in base)) for d in range(40)]   # one group
    rows += [(2000 + d, " ".join(base)) for d in range(5)]
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        sets[d] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    want = {(a, b) for a in sets for b in sets if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    out, links = ngram_join.linked(session, frame(rows), whole=whole)
    out = out.collect()
    assert {r.doc_id: r.n_links for r in out} == {d: sum(a == d for a, _ in want) for d in sets}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == join_brute(rows)
    pairs = [(r.doc_id, p) for r in links.collect() for p in r.partners]
    reps = {r.class_id for r in out}
    assert {tuple(sorted(p)) for p in pairs} == {(a, b) for a, b in want if a < b and {a, b} <= reps} and len({tuple(sorted(p)) for p in pairs}) == len(pairs)
    assert len(pairs) > 300


@pytest.mark.parametrize(("pair", "sent"), [(0, 1 << 14), (-10**9, 1 << 17)])      # each connected set as a whole, group by group
def test_join_sends_blocks_in_rounds_and_keeps_no_step(session, frame, monkeypatch, pair, sent):
    """Many blocks and some rounds find the same links, and what the steps wrote is gone: only results are left."""
    rows, split = join_rows(6), []
    for name, value in (("CELL", 2), ("BLOCK", 2), ("ROUND_BYTES", sent), ("PAIR_BYTES", pair)):
        monkeypatch.setattr(ngram_join, name, value)
    stored = ngram_join._stored

    def watched(spark, df, name):
        out = stored(spark, df, name)
        if name == "join-split":
            split.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_stored", watched)
    root = session.sparkContext._jvm.org.apache.hadoop.fs.Path(ngram_join.scratch_path(session, "x")).getParent()
    listed = lambda: {f.getPath().getName() for f in fs.listStatus(root)}
    fs = root.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
    before = listed() if fs.exists(root) else set()
    out = ngram_join.near_copies(session, frame(rows), whole=1)
    kept = {n.rsplit("-", 1)[0] for n in listed() - before}
    assert kept <= {"join-ids", "join-classes", "join-reps", "join-links", "component-links"}
    assert bool(split[0]) == (pair < 0)
    got = out.collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == join_brute(rows)
    sets = {d: shingle_set(t) for d, t in rows}
    want = {a: sum(a != b and bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for b in sets) for a in sets}
    assert {r.doc_id: r.n_links for r in got} == want


def test_join_compares_texts_of_like_size(session):
    """A long text shares lines with many short ones: sizes tell that they cannot link, so they are no candidates."""
    keys = session.createDataFrame([(s, d, 10 + d % 3) for s in (1, 2) for d in range(20)] + [(1, 100, 900), (2, 100, 900), (3, 100, 900), (3, 101, 1199)],
                                   "shingle long, doc_id long, n long")
    of = {}
    for r in ngram_join._groups(keys, 75).collect():
        of.setdefault(r.shingle, set()).add(r.doc_id)
    pairs = {(a, b) for g in of.values() for a in g for b in g if a < b}
    assert pairs == {(a, b) for a in range(20) for b in range(20) if a < b} | {(100, 101)} and len(of) == 4


def test_join_without_hot_list_is_the_same(session, frame, monkeypatch):
    rows = join_rows(4)
    monkeypatch.setattr(ngram_join, "ROUTING_SAMPLE", 10**9)
    a = sorted(map(tuple, ngram_join.near_copies(session, frame(rows)).collect()))
    monkeypatch.setattr(ngram_join, "_frequent", lambda *_: ngram_join.np.zeros(0, "uint64"))
    assert a == sorted(map(tuple, ngram_join.near_copies(session, frame(rows)).collect()))


def test_join_of_one_id_with_two_texts(session, frame):
    """One text stands for the id, whatever the order and partitions of the rows; every row has its result."""
    rows = join_rows(4)
    rows += [(3, "quite another text of this very id"), (3, "a third"), (900, "lonely words"), (900, None), (900, "lonely words")]
    h = {t: x for t, x in frame(rows).selectExpr("text", "xxhash64(text)").collect()}
    text = {}
    for d, t in rows:
        if d is not None and (d not in text or h[t] < h[text[d]]):
            text[d] = t
    want = join_brute(list(text.items()))
    for seed, parts in ((1, 2), (2, 7)):
        random.Random(seed).shuffle(rows)
        got = ngram_join.near_copies(session, frame(rows).repartition(parts)).where("doc_id IS NOT NULL").collect()
        assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows if d is not None)
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(d, n, c) for d, (n, c) in want.items()}


def test_join_of_nothing_and_null_ids(session, frame):
    assert ngram_join.near_copies(session, frame([])).count() == 0
    out = ngram_join.near_copies(session, frame([(None, "a b c d e f"), (3, "a b c d e f")])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr) == [(3, 2, 3), (None, 2, None)]


def test_components(session):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60) if i % 13] + [(100, 200 + i) for i in range(40)] + [(9, 9), (5, 4), (4, 5)]
    links += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(80)]
    root = {x: x for p in links for x in p}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = graph.components(session, session.createDataFrame(links, "a long, b long"))
    assert {r.node: r.comp for r in got.collect()} == {x: find(x) for x in linked}
    assert graph.components(session, session.createDataFrame([], "a long, b long")).count() == 0


# ---- containment

def test_containment_equals_brute_force(session, frame):
    rnd = random.Random(6)
    words = vocabulary(rnd)
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 5, 6, 20, 70])))) for i in range(40)]
    docs = []
    for d in range(60):
        w = [rnd.choice(words) for _ in range(rnd.randint(0, 400))]
        for _, t in rnd.sample(items, 2):
            t = t.split()
            for _ in range(rnd.randint(0, 2)):
                t[rnd.randrange(len(t))] = "zz"
            at = rnd.randint(0, len(w))
            w[at:at] = [x.upper() for x in t]
        docs.append((d, "\n".join(w)))
    docs += [(60, None), (61, ""), (62, items[3][1]), (62, items[3][1]), (None, items[4][1])]
    items += [(90, None), (91, ""), (92, " \t"), (3, items[3][1]), (None, "a b c d e f")]
    want = set()
    for i, t in items:
        n = min(5, len((t or "").split()))
        for d, x in docs:
            if n and i is not None and d is not None:
                have = {tuple(v) for w in [(x or "").lower().split()] for v in zip(*(w[k:] for k in range(n)), strict=False)}
                need = set(zip(*((t.lower().split())[k:] for k in range(n)), strict=False))
                if 100 * len(have & need) >= 75 * len(need):
                    want.add((d, i, len(have & need), len(need)))
    frame_items = session.createDataFrame(items, "item_id long, text string")
    for block in (10, containment.BLOCK_SHINGLES):      # many passes and one
        out = containment.contained(session, frame(docs), frame_items, block_shingles=block).collect()
        assert {tuple(r) for r in out} == want and len(out) == len(want)
    assert len(want) > 60
    assert containment.contained(session, frame([]), frame_items).count() == 0
    assert containment.contained(session, frame(docs), frame_items.limit(0)).count() == 0


def test_rows_are_dealt_into_blocks(session):
    rows = session.range(1000).selectExpr("id AS k", "id % 7 AS v").unionByName(session.createDataFrame([(5, 99)], "k long, v long"))
    of_block, found = blocks.dealt(rows, "k", F.count(F.lit(1)), 100, "t-blocks")
    parts = [sorted(map(tuple, of_block(b).collect())) for b in found]
    assert len(parts) == 11 and max(map(len, parts)) < 200 and sorted(sum(parts, [])) == sorted(map(tuple, rows.collect()))
    assert [sum(k == 5 for k, _ in p) for p in parts if any(k == 5 for k, _ in p)] == [2]      # a key stays together
    assert blocks.dealt(rows.limit(0), "k", F.count(F.lit(1)), 100, "t-blocks")[1] == []


def test_contaminated_rows_without_an_id_go(session, tmp_path):
    item, clean = " ".join(f"w{i}" for i in range(30)), " ".join(f"c{i}" for i in range(50))
    session.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, clean + " " + item), (None, clean), (None, None), (None, ""), (None, clean), (1, item), (2, clean), (3, clean), (3, item), (4, None)]
    docs = session.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, item_id string")
    out = corpus_pipeline.drop_contaminated(session, docs, str(tmp_path))
    assert out.columns == docs.columns
    # both rows of document 3 go together
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, [(None, clean), (None, None), (None, ""), (None, clean), (2, clean), (4, None)]))
    assert corpus_pipeline.drop_contaminated(session, docs.limit(0), str(tmp_path)).count() == 0


def test_queries(session, tmp_path):
    rows = suffix_rows(8)
    session.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in suffix_levels.op5(session, str(tmp_path)).collect():
        n, gone, runs, kept = suffix_brute(rows, 200)[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, runs, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op9(session, str(tmp_path)).collect()}
    assert got == join_brute(rows)


def test_containment_searches_small_pieces():
    """What a search holds follows a piece, not the batch."""
    import tracemalloc

    import pyarrow as pa
    item = "alpha beta gamma delta epsilon zeta eta"
    texts = [" ".join(f"w{i * 700 + k}" for k in range(700)) + (f" {item}" if i % 7 == 0 else "") for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    index = containment.ItemIndex([(5, item)], 5, 75)
    list(containment._search(index, iter([batch.slice(0, 10)])))           # tables that stay
    tracemalloc.start()
    found = [r["doc_id"] for b in containment._search(index, iter([batch])) for r in b.to_pylist()]
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == list(range(0, 1000, 7))
    assert batch.nbytes > 4 << 20 and most < 24 << 20, most
