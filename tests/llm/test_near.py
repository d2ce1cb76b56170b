import random

import numpy as np
from lawloom.llm import near

r = random.Random(5)
BASE = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5))) for _ in range(900)]


def copies(of, edits, seed):
    q, t = random.Random(seed), of.split()
    for i in q.sample(range(len(t)), edits):
        t[i] = f"new{q.random()}"
    return " ".join(t)


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_similar_texts_meet_and_others_do_not(spark):
    texts = []
    for i in range(150):
        t = " ".join(r.choice(BASE) for _ in range(260))
        texts += [t, copies(t, 1, i), copies(t, 3, i), copies(t, 5, i), copies(t, 40, i)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    of = {x.doc_id: x.component_id for x in near.groups(df).collect()}
    high = low = 0
    for i in range(0, len(texts), 5):
        for j in range(1, 4):
            assert jaccard(texts[i], texts[i + j]) >= 0.8
            high += of[i + j] == of[i]
        low += of[i + 4] != of[i]
        assert all(of[i + j] // 5 == i // 5 for j in range(5))
    assert high >= 0.95 * 450 and low == 150


def test_blocks_give_every_pair_once_and_the_nearest():
    import pyarrow as pa

    g = np.random.default_rng(3)
    base = g.integers(0, 2**63, (30, near.LONG)).astype(np.uint64)
    n = 900
    x = base[g.integers(0, 30, n)] ^ (np.uint64(1) << g.integers(0, 64, (n, near.LONG)).astype(np.uint64))
    cell = np.sort(np.where(g.random(n) < 0.6, 7, g.integers(10, 90, n)))
    own, node, root = g.integers(0, 2, n), g.permutation(n), g.integers(0, 40, n)
    for one_part in (True, False):
        i, j = np.zeros(n, int), np.full(n, 0 if one_part else 1)
        parts = np.zeros(n, int) if one_part else own
        rows = [cell, i, j, parts, node, root]
        batches = [pa.RecordBatch.from_arrays([*(pa.array(v[at : at + 70]) for v in rows), pa.array([y.tobytes() for y in x[at : at + 70]])], ["cell", "i", "j", "own", "node", "root", "x"]) for at in range(0, n, 70)]
        want, nearest = set(), {}
        for p in range(n):
            for q in range(n):
                d = int(np.bitwise_count(x[p] ^ x[q]).sum())
                several = len({*parts[cell == cell[p]].tolist()}) > 1
                if cell[p] == cell[q] and root[p] != root[q] and d <= near.LOOSE and (parts[p] != parts[q] or not several):
                    want.add((max(node[p], node[q]), min(node[p], node[q])))
                    nearest[node[p]] = min(d, nearest.get(node[p], 999))
        got = [tuple(z) for b in near._pairs(batches, True) for z in zip(b["a"].to_pylist(), b["b"].to_pylist())]
        assert set(got) == want and len(got) == len(want)
        some = {tuple(z) for b in near._pairs(batches, False) for z in zip(b["a"].to_pylist(), b["b"].to_pylist())}
        at = {m: p for p, m in enumerate(node)}
        least = {}
        for m, o in some:
            d = int(np.bitwise_count(x[at[m]] ^ x[at[o]]).sum())
            least[m], least[o] = min(d, least.get(m, 999)), min(d, least.get(o, 999))
        assert some <= want and least == nearest


def test_large_families_are_one_group_whatever_the_block(spark, monkeypatch):
    q = random.Random(21)
    rows = []
    for size in (12, 40, 200):
        t = [q.choice(BASE) + q.choice("xyz") for _ in range(220)]
        for _ in range(size):
            one = t[:]
            for at in q.sample(range(220), q.randint(1, 4)):
                one[at] = f"new{q.random()}"
            rows.append((len(rows), " ".join(one)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert {x.doc_id: x.component_id for x in near.groups(df).collect()} == want
    monkeypatch.setattr(near, "BLOCK", 30)
    assert {x.doc_id: x.component_id for x in near.groups(df).collect()} == want
    assert near.drop_near_copies(df).count() == len(set(want.values()))


def test_one_of_each_group_stays(spark):
    t = [" ".join(r.choice(BASE) for _ in range(80)) for _ in range(2)]
    rows = [(9, t[0], 1), (2, t[0].upper(), 2), (2, t[0].upper(), 2), (5, t[1], 3), (None, t[0], 4), (7, None, 5), (8, "", 6), (10, "one two", 7), (11, "two three", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    kept = near.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((x.doc_id or -1, x.component_id) for x in kept.collect()) == [(-1, 4), (2, 2), (5, 3), (7, 5), (10, 7), (11, 8)]
    assert near.drop_near_copies(df.limit(0)).count() == 0


def test_block_edits_and_short_texts_meet(spark):
    q = random.Random(11)
    words = lambda n: [q.choice(BASE) + q.choice("xyz") for _ in range(n)]
    texts = []
    for n in (14, 60, 120, 300):
        for _ in range(20):
            t = words(n)
            one = t[:]
            one[1] = "other"
            more = (n - 4) // 4
            texts += [(t, t + words(more)), (t, t[: n - more // 2] + words(more // 2)), (t, words(more) + t), (t, one)]
    pairs = [(a, b) for a, b in ((" ".join(a), " ".join(b)) for a, b in texts) if jaccard(a, b) >= 0.8]
    assert len(pairs) > 200
    rows = []
    for i, (a, b) in enumerate(pairs):
        # every pair has words of its own
        rows += [(2 * i, " ".join(f"{w}{i}" for w in a.split())), (2 * i + 1, " ".join(f"{w}{i}" for w in b.split()))]
    of = {x.doc_id: x.component_id for x in near.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(of[i] == i - i % 2 for i in range(len(rows)))


def test_an_id_with_different_texts(spark):
    q = random.Random(3)
    t = [" ".join(q.choice(BASE) for _ in range(80)) for _ in range(4)]
    rows = [(1, t[0]), (2, t[0]), (2, t[1]), (2, t[2]), (2, t[2].upper()), (3, t[1]), (4, t[3]), (4, t[3] + " more")]
    kept = sorted((x.doc_id, x.text.lower()[:40]) for x in near.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == sorted([(1, t[0][:40]), (2, t[1][:40]), (2, t[2][:40]), (4, t[3][:40])])


def brute(rows):
    """doc_id -> least id of the group that links of similarity 0.8 or more reach."""
    sets = [(d, shingles(t)) for d, t in rows]
    of = {d: d for d, _ in rows}

    def root(d):
        while of[d] != d:
            d = of[d]
        return d

    for n, (d, a) in enumerate(sets):
        for e, b in sets[:n]:
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and (len(a & b) >= 0.8 * len(a | b) - 1e-9):
                x, y = sorted((root(d), root(e)))
                of[y] = x
    return {d: root(d) for d in of}


def test_like_brute_force(spark):
    q = random.Random(9)
    rows = [(0, "")]
    for i in range(60):
        t = " ".join(q.choice(BASE) for _ in range(q.choice([1, 4, 5, 12, 60, 300])))
        n = len(t.split())
        rows += [(len(rows) + j, x) for j, x in enumerate([t, copies(t, min(n, 1), i), copies(t, min(n, n // 60), i), f"{t} {' '.join(BASE[: n // 8])}", t.upper()])]
    family = " ".join(q.choice(BASE) for _ in range(200))
    rows += [(len(rows) + j, copies(family, 3, 1000 + j)) for j in range(40)]  # more than cells compare all pairs of
    got = {x.doc_id: x.component_id for x in near.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_names_empty_tables_and_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, long, "a", 1, 2, 3), (2, long + " end", "b", 1, 2, 3), (3, None, "c", 1, 2, 3), (4, "", "d", 1, 2, 3), (5, "x", None, 1, 2, 3), (5, "y", "e", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string, key int, node int, OWN int")
    got = near.drop_near_copies(df)
    assert got.schema == df.schema and sorted(x[2] or "" for x in got.collect()) == ["", "a", "c", "e"]
    assert near.drop_near_copies(df.limit(0)).count() == 0
    rows[5] = (6, "y", "e", 1, 2, 3)  # no id is repeated
    assert near.drop_near_copies(spark.createDataFrame(rows, df.schema)).count() == 4
