import hashlib
import random
import re

from lawloom.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        if i is not None and n:
            for a in range(len(w) - n + 1):
                grams.setdefault(tuple(w[a : a + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for a in range(len(w) - n + 1):
                if (g := tuple(w[a : a + n])) in grams:
                    hit |= set(range(a, a + n))
                    ids |= grams[g]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(spark):
    r = random.Random(3)
    some = ["the", "of", "a", "Ünder", "x1", "b", "日本"]
    text = lambda n: " ".join(r.choice(some) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 6, 9]))) for i in range(2, 14)] + [(2, "a b of x1 the a b of"), (None, "a"), (7, None), (8, " .,- ")]
    docs = [(i, text(r.randint(0, 40))) for i in range(60)] + [(1, None), (1, ""), (1, "THE-OF,a!!"), (None, "a b"), (99, text(20000))]
    return docs, items


def test_equals_brute_force_whole_and_in_parts(spark):
    docs, items = tables(spark)
    d = spark.createDataFrame([(*x, 5) for x in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, doc_id string")
    for window, part in ((4, 10**6), (4, 60)):
        got = decontam.report(decontam.find_leaks(d, b, window=window, part_bytes=part))
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, window)


def test_chunks_hold_every_window(spark, monkeypatch):
    monkeypatch.setattr(decontam, "CHUNK", 3)
    r = random.Random(6)
    long = " ".join(f"w{r.randint(0, 5)}" for _ in range(300))
    docs = [(i, " ".join(long.split()[a : a + r.randint(1, 20)])) for i, a in enumerate(range(0, 300, 7))] + [(900, long)]
    items = [(1, long), (2, "w1"), (3, "w2 w3")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for part in (10**6, 50):
        got = decontam.report(decontam.find_leaks(d, b, window=6, part_bytes=part))
        assert sorted((tuple(x) for x in got.collect()), key=str) == brute(docs, items, 6)


def test_filter_keeps_clean_rows_as_they_were(spark):
    docs, items = tables(spark)
    d = spark.createDataFrame([(*x, 5) for x in docs], "doc_id long, text string, hits int")
    b = spark.createDataFrame(items, "item_id long, text string").where("item_id in (4, 5)")
    clean = {(x[0], x[1]) for x, y in zip(sorted(docs, key=str), brute(docs, [i for i in items if i[0] in (4, 5)], 5)) if x}
    kept = decontam.drop_leaks(d, b, window=5, part_bytes=30)
    assert kept.schema == d.schema
    want = [x for x in docs if not brute([x], [i for i in items if i[0] in (4, 5)], 5)[0][5]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert set(want) <= clean | set(docs)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontam.report(decontam.find_leaks(d, none)).collect()] == [(1, 2, 0, 0)]
    assert decontam.find_leaks(d.limit(0), none).count() == 0
    assert decontam.drop_leaks(d, none).count() == 1
