import random

import xxhash
from lawloom.llm import components, simhash
from pyspark.sql import functions as F


def fp(text, k):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    s = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def groups(fps, bits=4):
    """node -> least node reachable."""
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    xs = sorted(fps)
    for i, a in enumerate(xs):
        for b in xs[:i]:
            if (a ^ b).bit_count() <= bits:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {x: find(x) for x in xs}


def texts():
    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(80)]
    out = []
    for i in range(12):
        t = [r.choice(base) for _ in range(120)]
        out.append(" ".join(t))
        for _ in range(4):
            u = list(t)
            u[r.randrange(120)] = "changed"
            out.append("\t".join(u))
    return [*out, out[0], out[0], None, "", " \n", "One two", "one TWO", "ÀÉ straße Àé"]


def test_equals_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(texts(), 3)] + [(3, texts()[0]), (None, texts()[0])]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, fp string")
    got = simhash.group_by_simhash(df, k=4).withColumn("hex", simhash.hex16(F.col("fp"))).collect()
    fps = [fp(t, 4) for _, t in docs]
    root = groups(set(fps))
    first = {}
    for (d, _), f in zip(docs, fps):
        if d is not None:
            first[root[f]] = min(first.get(root[f], d), d)
    want = sorted(((d, f"{f:016x}", first[root[f]]) for (d, _), f in zip(docs, fps)), key=str)
    assert sorted(((r.doc_id, r.hex, r.component_id) for r in got), key=str) == want


def test_links_of_random_and_dense_fingerprints(spark):
    r = random.Random(8)
    centre = r.getrandbits(64)
    fps = {r.getrandbits(64) for _ in range(300)} | {centre}
    for _ in range(200):  # one dense group, and chains of links
        x = centre
        for _ in range(r.randint(1, 5)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    for _ in range(20):
        x = r.getrandbits(64)
        for _ in range(4):
            fps.add(x)
            for b in r.sample(range(64), 4):
                x ^= 1 << b
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    want = groups(fps)
    members = {}
    for x, y in want.items():
        members.setdefault(y, set()).add(signed(x))
    want_sets = {frozenset(m) for m in members.values() if len(m) > 1}
    for hot, levels in ((simhash.HOT, 3), (30, 1), (30, 3)):  # one grid, grids within grids, words between
        got = {}
        for row in simhash.link_fingerprints(df, hot=hot, levels=levels).collect():
            got.setdefault(row.root, set()).add(row.fp)
        assert {frozenset(m) for m in got.values()} == want_sets


def test_bound_is_a_bound():
    import numpy as np

    a, b = (np.random.RandomState(s).randint(0, 2**63, 2000, np.int64).view(np.uint64) for s in (1, 2))
    counts = lambda x: [[(int(v) >> i & 3).bit_count() for i in range(0, 64, 2)] for v in x]
    d = simhash.manhattan(simhash.embed(a), simhash.embed(b))
    assert d.tolist() == [sum(abs(p - q) for p, q in zip(x, y)) for x, y in zip(counts(a), counts(b))]
    assert (d <= np.bitwise_count(a ^ b)).all()


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, r.randint(101, 160)) for _ in range(50)] + [(5, 5), (300, 200), (300, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {x.node: x.root for x in components.components(df).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == got[200] == 200
    assert {got[x] for a in links for x in a if 100 <= x <= 160} == {100}
    assert components.components(df.limit(0)).count() == 0


def test_grids_within_grids_lose_no_pair():
    import numpy as np

    r = np.random.RandomState(4)
    a = r.randint(0, 2**63, 3000, np.int64).view(np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << r.randint(0, 64, len(a)).astype(np.uint64)
    x, y = simhash.embed(a), simhash.embed(b)
    share = lambda level, path: [n for n, m in enumerate(simhash._masks(level, path)) if not int(u ^ v) & int(m)]
    for u, v in zip(x, y):
        path = 0
        for level in range(simhash.LEVELS):
            same = share(level, path)
            assert same
            path += int(r.choice(same)) * 70**level
    for level, path, counts in ((0, 0, 16), (1, 69, 8), (2, 69 + 70 * 3, 4)):
        assert {int(m).bit_count() for m in simhash._masks(level, path)} == {2 * counts}


def test_a_very_long_text_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e " * 100_000), (2, "a b c d e " * 100_000)], "doc_id long, text string")
    assert {r.component_id for r in simhash.group_by_simhash(df).collect()} == {1}
    assert simhash.group_by_simhash(df.limit(0)).count() == 0
