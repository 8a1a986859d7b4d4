"""The corpus operators on hand-made tables and against brute force on the small tables."""

import functools
import hashlib
import math
import pathlib
import random
import re
import struct
import sys
import zlib
from collections import Counter

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

from crowdlane.llm import queries  # noqa: E402
from crowdlane.llm.chat_rotation import rotate_perspectives  # noqa: E402
from crowdlane.llm.decontaminate import find_leaks  # noqa: E402
from crowdlane.llm.imatch import fingerprints  # noqa: E402
from crowdlane.llm.language_id import identify_languages, train  # noqa: E402
from crowdlane.llm.license_scan import TEMPLATES, scan_licenses, scan_windows  # noqa: E402
from crowdlane.llm.line_dedup import edit_distance, repeated_lines  # noqa: E402
from crowdlane.llm.mixing import fit, mix_sources  # noqa: E402
from crowdlane.llm.ngram_join import ngram_components  # noqa: E402
from crowdlane.llm.quality import isotonic, score_quality  # noqa: E402
from crowdlane.llm.substring_dedup import repeated_passages  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, score double, key string"


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sentence(n, seed=0):
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{zlib.crc32(f'{seed} {i}'.encode()) % 9973}" for i in range(n)).translate(letters)


def docs(spark, rows):
    """Rows (doc_id, text, source); the other columns clash with names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), -1, -1.0, "k") for i, t, s in rows], DOCS)


ODD = [
    (1, None, "a"),
    (2, "", None),
    (3, " \n\t ", "b"),
    (4, "one", "a"),
    (5, sentence(30), "a"),
    (5, sentence(30), "a"),
    (6, sentence(30), None),
    (None, sentence(30), "a"),
    (None, None, None),
    (7, sentence(20000, 3), "b"),
    (8, "Ünï çödé 漢字 \U0001f600 " * 5, "b"),
]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


def test_join_equals_brute_force(small):
    got = {r[0]: (r[1], r[2]) for r in ngram_components(small).collect()}
    sets = {}
    for r in small.collect():
        w = WORD.findall(low(r.text))
        sets[r.doc_id] = set(zip(w, w[1:], w[2:])) if len(w) >= 3 else {tuple(w)} - {()}
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 90 * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    assert got == {i: (len(sets[i]), root(i)) for i in ids}


def test_join_odd_rows(odd, empty):
    got = sorted(ngram_components(odd).collect(), key=str)
    assert len(got) == len(ODD)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id}
    assert by[1] == (0, 1) and by[3] == (0, 3) and by[4] == (1, 4) and by[5] == by[6] == (28, 5)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert ngram_components(empty).count() == 0


def test_near_group_is_whole_beyond_a_tile(spark):
    # 200 variants of one text, each near the base: one group, over several tiles
    base = sentence(400).split()
    rows = [(0, " ".join(base), "a")]
    for i in range(1, 200):
        w = list(base)
        w[i * 2 % 400] = f"x{i}"
        rows.append((i, " ".join(w), "a"))
    assert {r.component_id for r in ngram_components(docs(spark, rows)).collect()} == {0}


def test_fingerprints(small):
    rows = sorted((r.doc_id, r.text or "") for r in small.collect())
    got = {r.doc_id: r for r in fingerprints(small).collect()}
    by_text = {}
    for k, (i, text) in enumerate(rows):
        after, cut = rows[(k + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
    near = [r.near_edited for r in got.values()]
    assert sum(near) / len(near) > 0.4 > 0.1 > sum(r.near_next for r in got.values()) / len(near)


def test_fingerprints_equal_plain_python(small):
    """Terms, band, subsets, hashes and likeness against a plain version with the same 64-bit hash."""

    def chain(values, seed=42):
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed & (2**64 - 1))
        return seed - 2**64 if seed >> 63 else seed

    def words(text):
        return {chain([w]) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}

    rows = sorted((r.doc_id, r.text or "") for r in small.collect())
    df = Counter(t for _, text in rows for t in words(text))
    band = {t for t, n in df.items() if len(rows) / math.exp(7) <= n <= len(rows) / math.exp(3)}

    def mark(text):
        kept = sorted({t & -2 for t in words(text) if len(text) < 400 or t in band})
        subsets = {}
        for level, shift in enumerate((1, 6, 13, 22)):
            for t in kept:
                if not level or (t >> shift) & (32 * 4**level - 1) < 32:
                    s = 32 * level + ((t >> shift) & 31)
                    subsets.setdefault(s, []).append(s << 56 | (t & (2**64 - 1)) >> 8)
        running = lambda codes: functools.reduce(lambda h, x: chain([h, x]), sorted(codes), 0)
        return chain(kept), {s: running(x) & 65535 for s, x in subsets.items()}

    def shown(m):
        return f"{m[0] & (2**64 - 1):016x}:" + "".join(f"{s << 16 | h:06x}" for s, h in sorted(m[1].items()))

    def like(a, b):
        shares = [0.0]
        for level in range(4):
            held = [s for s in a[1].keys() | b[1].keys() if s // 32 == level]
            if len(held) >= (4 if level else 1):
                shares.append(sum(a[1].get(s) == b[1].get(s) for s in held) / len(held))
        return 1.0 if a[0] == b[0] else max(shares)

    got = {r.doc_id: r for r in fingerprints(small).collect()}
    for k, (i, text) in enumerate(rows):
        after, cut = rows[(k + 1) % len(rows)][1], len(text) // 4
        own, edited, following = mark(text), mark(text[: len(text) - cut] + after[:cut]), mark(after)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (shown(own), shown(edited)), i
        assert got[i].near_edited == pytest.approx(like(own, edited)) and got[i].near_next == pytest.approx(like(own, following))


def test_fingerprints_move_texts_once(spark, small):
    """One exchange of the texts, read by both sides of the join with the next document's beginning."""
    from crowdlane.llm import imatch

    frames = []
    marks = imatch._marks
    imatch._marks = lambda rows, *a: frames.append(rows) or marks(rows, *a)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        imatch.fingerprints(small)
        frames[0].collect()
        plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        imatch._marks = marks
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_fingerprints_odd_rows(odd, empty):
    got = fingerprints(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.near_next == 0 for r in got if r.doc_id is None)
    assert len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1
    assert fingerprints(empty).count() == 0


def test_mix(small, odd, empty):
    a = mix_sources(small).toPandas().sort_values("doc_id").reset_index(drop=True)
    b = mix_sources(small.repartition(7)).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert a.equals(b) and len(a) == small.count()
    per = a.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert abs(per.target.sum() - per["size"].sum()) < 1e-6
    assert (per.target <= 3 * per["size"] + 1e-6).all() and (abs(per.taken - per.target) <= 0.03 * per.target).all()
    assert a.copies.between(0, 3).all() and (a.taken == a.copies * a["size"]).all()
    assert mix_sources(odd).count() == len(ODD) and mix_sources(empty).count() == 0


def test_knapsack_is_exact():
    import numpy as np

    size, count = np.array([7, 11, 60]), np.array([5, 3, 2])
    sums = {7 * a + 11 * b + 60 * c for a in range(6) for b in range(4) for c in range(3)}
    for budget in range(190):
        take = fit(size, count, budget)
        assert (take <= count).all() and (take >= 0).all()
        assert int((take * size).sum()) == min(sums, key=lambda s: (abs(s - budget), s))


def test_lines(spark, odd, empty):
    line = sentence(30, 1)
    near = line.replace(line.split()[3], "other")
    far = sentence(30, 2)
    got = repeated_lines(
        docs(spark, [(1, f"{line}\nshort one\n{far}", "a"), (2, f"short one\n{near.upper()}!\n{far}", "a")])
    ).collect()
    # equal lines of two words repeat like all others
    assert sorted((r.doc_id, r.line_no, r.kept_doc_id, r.kept_line_no) for r in got) == [(2, 0, 1, 1), (2, 1, 1, 0), (2, 2, 1, 2)]
    assert {(r.doc_id, r.kept_doc_id) for r in repeated_lines(odd).collect()} == {(6, 5)}
    assert repeated_lines(empty).count() == 0


def test_short_lines_repeat_only_if_equal(spark):
    rows = [(1, "All rights reserved.\n全部人人生而自由\none two three four", "a"), (2, "all rights reserved\nAll rights\n--- !", "a")]
    rows += [(3, "全部人人生而自由\none two nine ten\n--- !\n\n", "a"), (4, "one two three four five", "b")]
    got = {(r.doc_id, r.line_no, r.kept_doc_id, r.kept_line_no) for r in repeated_lines(docs(spark, rows)).collect()}
    assert got == {(2, 0, 1, 0), (3, 0, 1, 1), (4, 0, 1, 2)}


def _plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_against_brute_force(spark):
    """Pairs at a similarity of exactly 0.8 and above are found, those below it are not."""
    rng, rows, wanted = random.Random(3), [], []
    letters = "abcdefghijklmnop"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    sizes = [(5, 1), (6, 1), (10, 1), (10, 2), (15, 3), (20, 1), (20, 2), (20, 4), (40, 8), (300, 60)]
    for n, edits in sizes + [(10, 3), (20, 6), (40, 11)]:
        for _ in range(40):
            one = [rng.choice(vocabulary) for _ in range(n)]
            other = list(one)
            for at in rng.sample(range(n), edits):
                kind = rng.random()
                other[at] = [rng.choice(vocabulary)] if kind < 0.6 else [] if kind < 0.8 else [other[at], rng.choice(vocabulary)]
            other = [y for x in other for y in (x if isinstance(x, list) else [x])]
            near = _plain_distance(one, other) <= 0.2 * max(len(one), len(other)) + 1e-9
            wanted.append((2 * len(wanted), n, edits, near))
            rows += [(wanted[-1][0], " ".join(one), "a"), (wanted[-1][0] + 1, " ".join(other), "a")]
    got = {r.doc_id: r.kept_doc_id for r in repeated_lines(docs(spark, rows)).collect()}
    assert all(kept == doc - 1 for doc, kept in got.items())
    assert not [i for i, _, _, near in wanted if i + 1 in got and not near]
    found = Counter()
    for i, n, edits, near in wanted:
        found[n, edits, "all"] += near
        found[n, edits, "found"] += near and i + 1 in got
    for n, edits in sizes:
        assert found[n, edits, "found"] >= 0.9 * found[n, edits, "all"] > 0, (n, edits, found)


def test_no_line_at_the_limit_is_missed(spark):
    """Every pair whose words differ in as many places as a link allows is found, however the edits lie."""
    rng, rows, near = random.Random(11), [], set()
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))) for _ in range(6000)]
    # the longer line has n words
    sizes = [(n, n // 5) for n in (5, 6, 9, 10, 13, 15, 20, 25, 40, 100, 300) for _ in range(90)]
    for number, (n, edits) in enumerate(sizes):
        one, kind = [rng.choice(vocabulary) for _ in range(n)], number % 3
        # replaced, taken out, or both; even steps leave the shortest runs
        places = [round((i + 1) * (n - edits) / (edits + 1)) + i for i in range(edits)] if number % 2 else rng.sample(range(n), edits)
        other = [None if kind == 1 or kind == 2 and i % 2 else rng.choice(vocabulary) for i in range(n)]
        other = [x for x in (other[i] if i in places else one[i] for i in range(n)) if x]
        if _plain_distance(one, other) <= 0.2 * n + 1e-9:
            near.add(2 * number + 1)
        rows += [(2 * number, " ".join(one), "a"), (2 * number + 1, " ".join(other), "a")]
    got = {r.doc_id: r.kept_doc_id for r in repeated_lines(docs(spark, rows)).collect()}
    assert len(near) > 900 and got == {i: i - 1 for i in near}


def test_pipeline_drops_every_line_at_the_limit(spark):
    """A line of 25 words that differs in five, so that no longer run is left, goes, whatever its SimHash."""
    import corpus_pipeline

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    rows = []
    for i in range(300):
        one = [rng.choice(words) for _ in range(25)]
        other = [rng.choice(words) if at % 4 == 3 and at < 20 else x for at, x in enumerate(one)]
        rows += [(2 * i, " ".join(one), "a"), (2 * i + 1, " ".join(other), "a")]
    table = docs(spark, rows).withColumn("n_chars", F.length("text").cast("bigint"))
    kept = corpus_pipeline.line_dedup(spark, table, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 600, 2))


@pytest.mark.parametrize("crowd", [1024, 1])
def test_pipeline_compares_lines_without_doc_id(spark, monkeypatch, crowd):
    """Rows without doc_id lose the lines that repeat others, and come after all that have one."""
    import corpus_pipeline

    from crowdlane.llm import line_dedup as ld

    monkeypatch.setattr(ld, "CROWD", crowd)  # groups are compared in one task, or in tiles
    line = [sentence(30, 100 + i) for i in range(8)]
    near = [" ".join("other" if at % 10 == 3 else w for at, w in enumerate(x.split())) for x in line]
    rows = [
        (None, f"{line[0]}\n{line[1]}\n{line[2]}\nAll rights reserved.\n--- !"),
        (None, f"{near[1]}\n{line[3]}"),  # without doc_id the least line_no keeps
        (None, f"{near[4]}\n{line[5]}"),
        (-5, line[4]),
        (9, f"{line[6]}\n{near[0]}"),
        (2**63 - 1, f"{line[5]}\nall rights reserved"),
        (None, line[7]),  # rows that agree in doc_id and text are one
        (None, line[7]),
        (None, None),
        (3, None),
    ]
    table = docs(spark, [(i, t, "a") for i, t in rows]).withColumn("n_chars", F.length("text").cast("bigint"))
    got = corpus_pipeline.line_dedup(spark, table, "")
    assert got.columns == table.columns
    kept = [f"{line[2]}\n--- !", rows[1][1], line[7], line[7], None]
    want = [(None, t) for t in kept] + [rows[i] for i in (3, 4, 5, 9)]
    found = Counter((r.doc_id, r.text, r.n_chars) for r in got.collect())
    assert found == Counter((i, t, len(t) if t is not None else None) for i, t in want)


def test_crowded_keys_are_compared_in_step(monkeypatch):
    """Keys of more than SIDE lines: as many steps as the largest has lines, not as all have, and the same components."""
    import numpy as np

    from crowdlane.llm import line_dedup as ld
    from crowdlane.llm.components import stars

    rng, calls = np.random.default_rng(7), []
    sizes = [70, 200, 3, 65, *[100] * 40, 1, 150]
    key = np.repeat(np.arange(len(sizes)) * 5, sizes)
    n = np.concatenate([np.sort(rng.integers(8, 300, x)) for x in sizes])
    # lines of few families, some bits apart, so that some link over others only
    sketch = rng.integers(0, 1 << 63, (9, 4), dtype=np.uint64)[rng.integers(0, 9, len(key))]
    for _ in range(12):
        sketch[np.arange(len(key)), rng.integers(0, 4, len(key))] ^= np.uint64(1) << rng.integers(0, 64, len(key), dtype=np.uint64)
    wide = n > ld.WIDE
    more = rng.integers(0, 1 << 63, (3, ld.WIDER // 64), dtype=np.uint64)[rng.integers(0, 3, int(wide.sum()))]
    allowed = np.floor((1 - 0.8) * n + 1e-9).astype(int)
    place, links = np.cumsum(wide) - 1, []
    for i in range(len(key)):
        for j in range(i + 1, len(key)):
            if key[i] != key[j]:
                break
            most = max(allowed[i], allowed[j])
            near = n[j] - n[i] <= most and np.bitwise_count(sketch[i] ^ sketch[j]).sum(dtype=int) <= 2 * most
            if near and wide[i] and wide[j]:
                near = np.bitwise_count(more[place[i]] ^ more[place[j]]).sum(dtype=int) <= 2 * most
            if near:
                links.append((i, j))
    want = stars(*np.array(links).T)
    was = ld.Sketched.near
    monkeypatch.setattr(ld.Sketched, "near", lambda *x: calls.append(1) or was(*x))
    got = ld._near(key, np.arange(len(key)) + 1000, ld.Sketched(n, sketch, wide, more, 0.8))
    assert 300 < len(want[0]) < len(key) - len(sizes)
    assert [(x - 1000).tolist() for x in got] == [x.tolist() for x in want]
    assert len(calls) <= ld.SIDE + max(sizes)


def test_edit_distance():
    assert edit_distance("kitten", "sitting") == 3 and edit_distance("", "abc") == 3
    assert edit_distance([1, 2, 3, 4], [2, 3, 5, 4]) == 2


def test_passages(spark, odd, empty):
    passage = sentence(60, 9)
    rows = [(i, f"{sentence(40, 100 + i)} {passage} {sentence(40, 200 + i)}", "a") for i in range(3)]
    got = repeated_passages(docs(spark, [*rows, (9, sentence(140, 300), "a")])).collect()
    assert {r.doc_id for r in got} == {1, 2} and all(0 in r.kept_doc_ids for r in got)
    assert all(40 <= r.start_word and r.end_word <= 100 for r in got)
    assert {r.doc_id for r in repeated_passages(odd).collect()} <= {6, 8}
    assert repeated_passages(empty).count() == 0


def test_leaks(spark, odd, empty):
    item = sentence(40, 5).split()
    edited = [w if i % 6 else f"e{i}" for i, w in enumerate(item)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (None, "x y z"), (3, "")], "item_id bigint, text string")
    rows = [(i, f"{sentence(50, 10 + i)} {' '.join(t)} {sentence(50, 20 + i)}", "a") for i, t in enumerate([item, edited, []])]
    got = {r.doc_id: r for r in find_leaks(docs(spark, rows), items).collect()}
    assert set(got) == {0, 1} and got[0].score == 1 and 0.5 <= got[1].score < 1
    assert (got[0].start_word, got[0].end_word) == (50, 90)
    assert find_leaks(odd, items).count() == 0 and find_leaks(empty, items).count() == 0
    assert find_leaks(odd, items.limit(0)).count() == 0


def test_edited_leaks_beside_a_verbatim_one(spark):
    # the grams that edited copies share are the commonest of the item
    item = sentence(40, 6).split()
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    copies = [item, *([w if i % 5 < 4 else f"e{i}x{c}" for i, w in enumerate(item)] for c in range(3))]
    rows = [(i, f"{sentence(50, 10 + i)} {' '.join(t)} {sentence(50, 20 + i)}", "a") for i, t in enumerate(copies)]
    got = {r.doc_id: r.score for r in find_leaks(docs(spark, rows), items).collect()}
    assert set(got) == {0, 1, 2, 3} and got[0] == 1 and all(0.65 < got[i] < 0.75 for i in (1, 2, 3))


def python_steps(df):
    """The most steps in Python that one task of a plan goes through: each has a worker of its own."""

    def most(node):
        """Of the stage that ``node`` ends, and of all stages below it."""
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.initialPlan()
        below = [most(node.children().apply(i)) for i in range(node.children().size())]
        here, all_ = (max((x[k] for x in below), default=0) for k in (0, 1))
        here += "Arrow" in node.nodeName() or "Python" in node.nodeName()
        return (0 if "Exchange" in node.nodeName() else here), max(here, all_)

    return most(df._jdf.queryExecution().executedPlan())[1]


def test_leaks_take_one_python_worker_a_task(spark, monkeypatch):
    from crowdlane.llm import decontaminate

    stored, store = [], decontaminate.store
    monkeypatch.setattr(decontaminate, "store", lambda df, label: stored.append(df) or store(df, label))
    item = sentence(40, 5)
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    found = find_leaks(docs(spark, [(7, f"{sentence(50, 1)} {item}", "a"), (8, sentence(50, 2), "a")]), items)
    assert [r.doc_id for r in found.collect()] == [7]
    assert stored and max(python_steps(df) for df in [*stored, found]) == 1


def test_quality(spark, odd, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("y"))
    got = queries.op6_quality_classifier(spark, SF).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert ((held.score >= 0.5) == (held.y == 1)).mean() > 0.9
    assert score_quality(odd, labels).count() == len(ODD) and score_quality(empty, labels).count() == 0
    assert {r.score for r in score_quality(odd, labels.limit(0)).collect()} == {0.5}


def test_isotonic():
    import numpy as np

    assert isotonic(np.array([0.0, 3.0, 1.0, 5.0]), np.array([1.0, 1.0, 3.0, 1.0])).tolist() == [0.0, 1.5, 1.5, 5.0]


def test_languages(spark, small, odd, empty):
    got = queries.op1_language_id(spark, SF).join(small.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.9
    net = train(small)
    assert net.names == sorted(net.names)
    rows = identify_languages(odd, net, spans=True).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = next(t for i, t, _ in ODD if i == r.doc_id) if r.doc_id else None
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0)
        if text:
            assert sum(r.bytes_by_lang.values()) == len(text.encode()) == r.spans[-1].end
    assert identify_languages(empty, net).count() == 0
    assert {r.lang_pred for r in identify_languages(odd, train(empty)).collect()} == {"und"}


def test_rotation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|end|>"), (1, 2, "bob", None), (1, 3, " ", "who"), (None, None, "ann", "x")]
    got = {(r.conv_id, r.speaker): r for r in rotate_perspectives(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    ann = got[1, "ann"]
    assert ann.rendered == "<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi < |end|><|end|>\n<|user:bob|>\n<|end|>\n<|user:unknown|>\nwho<|end|>\n"
    assert [ann.rendered[s.start : s.end] for s in ann.mask_spans] == ["Hi < |end|><|end|>\n"]
    assert rotate_perspectives(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_rotation_cuts_long_dialogues(spark):
    turns = spark.range(200).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'a', 'b') as role", "string(id) as text")
    got = rotate_perspectives(turns).collect()
    assert len(got) == 8 and sum(r.n_turns for r in got) == 400


def test_rotation_keeps_prompt_and_participants_in_every_part(spark):
    rows = [(1, 0, "system", "Be kind."), *((1, i, "c" if i == 150 else "ab"[i % 2], f"t{i}") for i in range(1, 200))]
    rows += [(2, 5, "a", f"r{i}") for i in range(100)] + [(None, 0, "a", "x"), (1, None, "d", "y")]
    got = rotate_perspectives(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    one = [r for r in got if r.conv_id == 1]
    assert {(r.part, r.speaker) for r in one} == {(p, s) for p in (-1, 0, 1, 2, 3) for s in "abcd"}
    assert all(r.rendered.count("<|system|>") == 1 and r.rendered.startswith("<|system|>\nBe kind.<|end|>\n") for r in one)
    assert {(r.part, r.n_turns) for r in one} == {(-1, 2), (0, 64), (1, 65), (2, 65), (3, 9)}
    c = {r.part: [r.rendered[s.start : s.end] for s in r.mask_spans] for r in one if r.speaker == "c"}
    assert c == {-1: [], 0: [], 1: [], 2: ["t150<|end|>\n"], 3: []}
    assert sorted((r.part, r.n_turns) for r in got if r.conv_id == 2) == [(0, 64), (1, 36)]
    assert [(r.part, r.speaker) for r in got if r.conv_id is None] == [(0, "a")]


def test_licenses(spark, odd, empty):
    rows = [(1, "Words.\nReleased under the MIT License.\nMore.", "a"), (2, "licensed under the apache license version 2.0", "a"), (3, "Released papers", "a")]
    got = scan_licenses(docs(spark, rows)).collect()
    # the whole first text has six bigrams, four of them in the template's four: 8 / 10, just enough
    assert sorted((r.doc_id, r.line_no, r.license) for r in got) == [(1, -1, "mit"), (1, 1, "mit"), (2, -1, "apache-2.0")]
    assert scan_licenses(odd).count() == 0 and scan_licenses(empty).count() == 0


def test_licenses_across_and_within_lines(spark, odd, empty):
    text = dict(TEMPLATES)
    wrap = lambda t: "\n".join(re.findall(r".{1,60}(?:\s|$)", t))
    rows = [(i, f"{sentence(200, i)}\n{wrap(text[n])}\n{sentence(200, 50 + i)}", "a") for i, n in enumerate(("isc", "mit-permission"))]
    rows += [(2, f"{sentence(40)} {text['mit']} {sentence(40, 2)}\nand\n{sentence(40)} {text['mit']} {sentence(40, 2)}", "a")]
    rows += [(3, "Words.\nReleased under the MIT License.\nMore.", "a"), (3, sentence(30), "a")]
    got = [(r.doc_id, r.line_no, r.license, r.dice) for r in scan_windows(docs(spark, rows)).collect()]
    assert sorted(got) == [(0, 1, "isc", 1), (1, 1, "mit-permission", 1), (2, 0, "mit", 1), (2, 2, "mit", 1)]
    assert scan_windows(odd).count() == 0 and scan_windows(empty).count() == 0


def test_license_stretches_equal_brute_force(spark):
    """The best coefficient of each notice edited and set into other words, against all stretches of words."""
    rng = random.Random(8)
    split = lambda text: [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
    texts = []
    for _, text in TEMPLATES:
        for _ in range(4):
            words = text.split()
            for _ in range(rng.randrange(1 + len(words) // 7)):
                words[rng.randrange(len(words))] = rng.choice(["the", "such", "License,", ""])
            words.insert(rng.randrange(len(words)), "\n")
            texts.append(f"{sentence(90, len(texts))} {' '.join(words)} {sentence(90, 500 + len(texts))}")
    wanted = {}
    for i, text in enumerate(texts):
        words = split(text)
        pairs = list(zip(words, words[1:]))
        for name, template in TEMPLATES:
            known = set(zip(split(template), split(template)[1:]))
            best = 0
            for a in (k for k, p in enumerate(pairs) if p in known):
                for b in range(a + 1, min(len(pairs), a + int(1.5 * len(known) + 1e-6)) + 1):
                    own = set(pairs[a:b])
                    best = max(best, 2 * len(own & known) / (len(own) + len(known)))
            if best >= 0.8:
                wanted[i, name] = best
    got = {}
    for r in scan_windows(docs(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect():
        got[r.doc_id, r.license] = max(r.dice, got.get((r.doc_id, r.license), 0))
    assert got == pytest.approx(wanted) and 20 < len(wanted)


def test_licenses_equal_brute_force(spark):
    rng = random.Random(5)
    pairs = lambda words: set(zip(words, words[1:]))
    split = lambda text: [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
    texts = []
    for _, text in TEMPLATES:
        for _ in range(25):
            words = text.split()
            for _ in range(rng.randrange(1 + len(words) // 5)):
                words[rng.randrange(len(words))] = rng.choice(["the", "such", "License,", ""])
            texts.append(" ".join([*["here"] * rng.randrange(3), *words]))
    wanted = set()
    for i, text in enumerate(texts):
        own = pairs(split(text))
        scores = [(-2 * len(own & pairs(split(t))) / (len(own) + len(pairs(split(t)))), name) for name, t in TEMPLATES]
        if -min(scores)[0] >= 0.8:
            wanted.add((i, min(scores)[1]))
    got = scan_licenses(docs(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    assert {(r.doc_id, r.license) for r in got} == wanted and 100 < len(wanted) < len(texts)


def test_pipeline(spark, odd):
    import corpus_pipeline as pipeline

    got = pipeline.run(spark, SF)
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) > 100 and set(got.columns) >= {"doc_id", "target", "taken"}
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, plain, SF)
        assert out.columns == plain.columns and out.count() <= len(ODD), name
    near = pipeline.ngram_join(spark, plain, SF).collect()
    assert sum(r.text == sentence(30) for r in near) == 1


def test_pipeline_near_copies(spark):
    import corpus_pipeline as pipeline

    # Jaccard 0.885 over 3 words, 0.81 over 5
    text = [f"v{i}" for i in range(100)]
    copy = [{30: "x", 60: "y"}.get(i, w) for i, w in enumerate(text)]
    other = [{30: "x", 50: "y", 70: "z"}.get(i, f"u{w}") for i, w in enumerate(text)]
    far = [{20: "x", 40: "y", 60: "z"}.get(i, w[1:]) for i, w in enumerate(other)]
    rows = [(i, " ".join(t), "a") for i, t in enumerate([text, copy, other, far])]
    plain = docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    assert {r.doc_id for r in pipeline.ngram_join(spark, plain, SF).collect()} == {0, 2, 3}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))
    from check_oracles import compare, connect

    got = queries.QUERIES[name](spark, SF).toArrow()
    assert compare(got, connect(SF).execute(queries.ORACLES[name]).to_arrow_table()) == "ok"


def test_words_are_hashed_a_block_at_a_time(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from crowdlane.llm import words as wd

    texts = ["", None, "A b\tc\r\nA", " \n", "é ü", "w " * 300, None, "same words, same hash"]
    whole = [wd.words(p.data, p.offs) for p in wd.slices([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])]
    monkeypatch.setattr(wd, "BLOCK", 5)
    (part,) = wd.slices([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])
    got = wd.words(part.data, part.offs)
    assert len(whole) == 1 and all(np.array_equal(x, y) for x, y in zip(got, whole[0], strict=True))
    said = [part.data[a:b].tobytes().decode() for a, b in zip(got.start, got.end, strict=True)]
    assert said == " ".join(t or "" for t in texts).split()
    assert got.text.tolist() == [2, 2, 2, 2, 4, 4] + [5] * 300 + [7] * 4 and got.first.tolist() == [0, 0, 0, 4, 4, 6, 306, 306, 310]
    assert got.hash[0] == got.hash[3] and len(set(got.hash[-4:].tolist())) == 3
    assert got.hash[-4] == wd.words(np.frombuffer(b"same", np.uint8), np.array([0, 4])).hash[0]
