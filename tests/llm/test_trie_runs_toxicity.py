"""Prefix trie, periodic runs and toxicity on hand-made tables and against brute force."""

import hashlib
import math
import pathlib
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

from crowdlane.llm import prefix_trie, queries, toxicity  # noqa: E402
from crowdlane.llm.periodic_runs import Grammar, find_runs, periodic_runs  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id bigint, turn bigint, role string, text string, depth bigint, place string, n bigint, a string, cell int, seq int"
DOCS = "doc_id bigint, text string, runs int, start int, score double, y int, worst string"


def turns(spark, rows):
    """Rows (conv_id, turn, role, text); the other columns clash with names the operator uses itself."""
    return spark.createDataFrame([(*r, -1, "p", -2, "a", -3, -4) for r in rows], TURNS)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, -1, -2, -1.0, 1, "w") for i, t in rows], DOCS)


# --- prefix trie ---


def brute_trie(rows):
    """The nodes by their prefixes as tuples."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    made = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # the remainder of a negative id is negative, as in SQL
        made[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + mine[h:])
    members = {}
    for c, s in made.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = {}
    for p, m in members.items():
        under = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(m) if len(made[c]) == len(p))
        out[p] = (
            min(m),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(m),
            sum(len(q) == len(p) + 1 for q in under),
            sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in under) for q in under),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def trie(spark, rows, monkeypatch):
    table = turns(spark, rows)
    monkeypatch.setattr(queries, "read", lambda *_: table)
    got = queries.op11_prefix_trie(spark, "")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_trie_equals_brute_force(spark, monkeypatch):
    r = random.Random(5)
    rows = []
    for c in range(60):
        start = r.randrange(4)
        for i in range(r.randrange(13)):
            text = f"t{r.choice([0, 0, 0, r.randrange(3)])}" if i else f"é{start}"
            rows.append((c, i * r.choice([1, 1, 1, 700]) + i, "ab"[i % 2], text))
    rows += [(c, *x) for c in (70, 71, 72, 73, 74) for x in ((None, "a", "early"), (0, None, None), (1, "b", "x" * 5000))]
    rows += [(80, None, "a", "n"), (80, None, "b", "n"), (None, 0, "a", "lost"), (-3, 0, "a", "below")]
    rows += [(90, 2, "a", "same"), (90, 2, "a", "same"), (90, 2, "b", "same")]
    r.shuffle(rows)
    assert trie(spark, rows, monkeypatch) == brute_trie(rows)


def test_long_and_equal_conversations(spark, monkeypatch):
    rows = [(5 * c, i, "a", f"t{i}") for c in range(2) for i in range(2500)]
    rows += [(100 + c, 0, "a", "alone") for c in range(300)]
    got = trie(spark, rows, monkeypatch)
    assert len(got) == 2500 + 1 + 1 and max(r[1] for r in got) == 2500
    # those whose own turns all lie before h begin as their group does, or have no turn left
    assert sum(r[3] for r in got if r[1] == 1) <= 302


def test_trie_of_nothing(spark, monkeypatch):
    assert trie(spark, [], monkeypatch) == []
    assert trie(spark, [(None, 1, "a", "b")], monkeypatch) == []


def test_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 10)
    ends = spark.range(0, 95, numPartitions=7).selectExpr("id as conv_id", "id % 2 as depth", "0L as p1", "0L as p2")
    got = {r.depth: r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    for k in (0, 1):
        assert got[k] == hashlib.sha256(",".join(str(i) for i in range(95) if i % 2 == k).encode()).hexdigest()


# --- periodic runs ---


def brute_runs(s, least=12):
    n, seen, out = len(s), set(), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and (i, j) not in seen and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    r = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(r.randint(1, 4)):
            n, k = r.randint(0, r.choice([15, 60, 150])), r.choice([1, 2, 2, 3, 5, 40])
            t = [r.randrange(k) for _ in range(n)]
            if n > 3 and r.random() < 0.6:
                a = r.randrange(n)
                p = r.randint(1, max(1, (n - a) // 2))
                t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
                if r.random() < 0.3:
                    t[r.randrange(n)] = 99
            texts.append(t)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        ids = np.array([x for t in texts for x in t], np.int64)
        got = list(zip(*(x.tolist() for x in find_runs(ids, first)), strict=True))
        assert got == [(k, *x) for k, t in enumerate(texts) for x in brute_runs(t)]


def test_grammar_derives_the_texts():
    ids = np.array([1, 2, 3] * 50 + [4] * 33 + [1, 2, 3] * 7, np.int64)
    g = Grammar(ids, np.array([0, 183, len(ids)]))

    def words(x):
        return [x] if x < g.terminals else words(g.left[x - g.terminals]) + words(g.right[x - g.terminals])

    assert [w for x in g.symbol.tolist() for w in words(x)] == ids.tolist()
    assert len(g.symbol) < 20


def expected_op13(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
        digest(" ".join(x for k, x in enumerate(w) if k not in gone)),
    )


def test_runs_of_odd_rows(spark, monkeypatch):
    periodic = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = random.Random(2)
    some = " ".join(f"w{r.randrange(400)}" for _ in range(700))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "a " * 11),
        (6, "a\t" * 12),
        (7, "x A a x A a x A a x A a x  A a"),
        (8, "no no " * 30 + some + " " + some),
        (8, "no no " * 30 + some + " " + some),
        (None, "b " * 20),
        (None, None),
        (periodic, some),
        (periodic, ""),
        (-1, "漢字 \U0001f600 é " * 200),
        (9, some * 20),
    ]
    table = docs(spark, rows)
    monkeypatch.setattr(queries, "read", lambda *_: table)
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, "").collect()]
    assert sorted(got, key=str) == sorted((expected_op13(*r) for r in rows), key=str)
    empty = docs(spark, [])
    assert periodic_runs(empty).collect() == []
    spans = {r.doc_id: (r.runs, r.collapsed) for r in periodic_runs(table).collect()}
    assert [tuple(x) for x in spans[6][0]] == [(0, 12, 1)] and spans[6][1] == "a"


def test_runs_of_the_small_table(spark):
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, SF).select("doc_id", "n_runs", "collapsed_sha256").collect())
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000").collect()
    want = [expected_op13(r.doc_id, r.text) for r in rows]
    assert {(w[0], w[1], w[-1]) for w in want} <= set(got)


# --- toxicity ---


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    some = lambda *s: rng.normal(0, 0.3, s)
    h = toxicity.HIDDEN
    net = toxicity.Network(
        some(toxicity.PLACES * 256, toxicity.CHARS),
        some(toxicity.BUCKETS, toxicity.OWN),
        some(toxicity.CHARS + toxicity.OWN + 1, 6 * h),
        some(h, 3 * h),
        some(h, 3 * h),
        some(2 * h, toxicity.HEADS),
        some(toxicity.HEADS),
        some(2 * h + 1),
    )
    texts = [b"hello there world a b c d e f g h " * 6, b"some nice words here " * 3, b"x"]
    t = toxicity.Text.of(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]))
    y, weight = np.array([1.0, 0.0, 1.0]), np.ones(3) / 3

    def loss():
        text, begin, end = t.windows()
        z = toxicity._forward(net, toxicity._inputs(net, t) @ net.into, begin, end)[0]
        doc = np.array([np.log(np.exp(z[text == k]).sum()) for k in range(3)])
        return (weight * (np.log1p(np.exp(doc)) - y * doc)).sum()

    for p, g in zip(net, toxicity._gradients(net, t, y, weight), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 1e-3
        p[at] = old + step
        above = loss()
        p[at] = old - step
        below = loss()
        p[at] = old
        assert g[at] == pytest.approx((above - below) / 2 / step, rel=1e-2)


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        raw = b"w " * n
        t = toxicity.Text.of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        _, begin, end = t.windows()
        assert {w for a, b in zip(begin, end, strict=True) for w in range(a, b)} == set(range(n))
        assert all(b - a <= toxicity.SPAN for a, b in zip(begin, end, strict=True))
        assert all(b == a + toxicity.STEP for a, b in zip(begin, begin[1:], strict=False))


@pytest.fixture(scope="module")
def rude(spark):
    """Texts of invented words; a toxic one has one of four words somewhere."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    bad, rows = ["zork", "quux!", "Vlim", "prax,"], []
    for i in range(500):
        w = [word() for _ in range(r.randint(3, 300))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w) + 1), r.choice(bad))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxic_words_are_found(spark, rude):
    table = docs(spark, [r[:2] for r in rude])
    labels = spark.createDataFrame([(i, y) for i, _, y in rude if i % 5] + [(1, None), (None, 1), (10**6, 1)], "doc_id bigint, y int")
    model = toxicity.train(table, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(table, model, windows=True).collect()}
    held = [r for r in rude if r[0] % 5 == 0]
    right = [got[i].predicted == y for i, _, y in held]
    assert sum(right) >= 0.95 * len(right)
    i, text, _ = next(r for r in held if r[2] and got[r[0]].predicted)
    worst = got[i].worst
    said = [w for w in re.split("[^a-z]+", text.lower()) if w][worst.start : worst.end]
    assert {"zork", "quux", "vlim", "prax"} & set(said)
    assert max(w.score for w in got[i].windows) == got[i].score
    # a bad word at the very end of a very long text
    clean = " ".join(t for i, t, y in rude if not y)[:200_000]
    odd = [(1, None), (2, ""), (3, " .,; \n"), (4, clean + " zork"), (5, "zork"), (5, "zork"), (None, "zork"), (None, None)]
    scored = [(r.doc_id, r.score, r.predicted, r.worst) for r in toxicity.score_toxicity(docs(spark, odd), model).collect()]
    assert len(scored) == len(odd) and all(0 <= s <= 1 for _, s, _, _ in scored)
    assert [p for i, _, p, _ in scored if i in (4, 5)] == [1, 1, 1]
    assert [(s, w) for i, s, _, w in scored if i in (1, 2, 3)] == [(0.0, None)] * 3
    assert toxicity.score_toxicity(docs(spark, []), model).collect() == []
    again = toxicity.score_toxicity(table, toxicity.train(table, labels)).select("doc_id", "score").collect()
    assert {r.doc_id: r.score for r in again} == {i: r.score for i, r in got.items()}


def test_labels_of_one_class_or_none(spark):
    table = docs(spark, [(1, "a b"), (2, None)])
    none = toxicity.train(table, spark.createDataFrame([], "doc_id bigint, y int"))
    assert [r.score for r in toxicity.score_toxicity(table, none).collect()] == [0.5, 0.5]
    one = toxicity.train(table, spark.createDataFrame([(1, 0)], "doc_id bigint, y int"))
    assert [r.score for r in toxicity.score_toxicity(table, one).collect()] == [0.0, 0.0]


def test_toxicity_query(spark):
    got = queries.op12_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    n = got.agg(F.count("*"), F.count_if("held_out"), F.min("score"), F.max("score")).first()
    want = sum(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert n[0] == 200 and n[1] == want and 0 <= n[2] and n[3] <= 1
