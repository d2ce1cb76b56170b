import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from lawloom.llm import prefixtrie

COLUMNS = "conv_id long, turn long, role string, text string, depth string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def model(rows, every=100, modulus=6):
    """All prefixes as tuples, and every node against its whole subtree."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members, stop = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % modulus, int(c / every) * every
        path = own.get(base, [])[:h] + turns[h:]
        stop[tuple(path)].append(c)
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for p, m in members.items():
        under = [q for q in members if q[: len(p)] == p]
        out.append(
            (
                min(m),
                len(p),
                min(members[p[:-1]]) if p else None,
                len(m),
                sum(len(q) == len(p) + 1 for q in under),
                sum(q in stop and len(stop[q]) == len(members[q]) for q in under),
                sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q),
                hashlib.sha256(",".join(map(str, sorted(stop.get(p, [])))).encode()).hexdigest(),
            )
        )
    return sorted(out)


def got(df, **more):
    t = prefixtrie.trie(df, **more)
    assert t.columns == OUT
    return sorted((tuple(r) for r in t.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_every_prefix_and_its_subtree(spark, seed):
    r = random.Random(seed)
    rows = []
    for conv in [*r.sample(range(-250, 900), 250), 0, 100, 2**62]:
        for turn in range(r.choice([1, 2, 3, 5, 9])):
            text = r.choice(["a", "bb", "", None, "é日", "x" * 50])
            rows.append((r.choice([conv, conv, conv, conv, conv, conv, conv, None]) if seed == 2 else conv, r.choice([turn, turn, turn, None]), r.choice(["user", "assistant", None]), text, "more"))
    rows += rows[:20]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert got(df) == model(rows)
    assert got(df, every=7, modulus=3) == model(rows, 7, 3)


def test_one_turn_and_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 16)
    monkeypatch.setattr(prefixtrie, "PIECE", 40)
    rows = [(1000, t, "user", f"t{t % 3}") for t in range(700)] + [(c, t, "user", "hello") for c in range(5000, 5400) for t in range(8)]
    rows += [(c, 0, "user", f"only {c}") for c in range(7000, 7300)]
    df = spark.createDataFrame([(*x, "f") for x in rows], COLUMNS).repartition(6)
    t = got(df)
    want = defaultdict(int)  # the chain of 700 turns alone: what the model would take long for is known by hand
    small = [x for x in rows if x[0] != 1000]
    for row in model(small):
        want[row[0], row[1]] = row
    base = [x for x in t if x[0] == 1000]
    assert [x[1] for x in base] == list(range(701))
    assert all(x[2] == (None if x[1] == 0 else 1000) and x[6] == 0 for x in base[1:])
    for x in t:
        if x[0] != 1000 and x[1] > 1:
            assert x == want[x[0], x[1]]
    root = base[0]
    assert root[3] == 1 + 400 + 300 and root[5] == 1 + sum(1 for x in model(small) if x[4] == 0 and x[1])


def test_turnless_conversations_and_empty_table(spark):
    rows = [(c, 0, "user", "a") for c in range(301, 340)]
    df = spark.createDataFrame([(*x, None) for x in rows], COLUMNS)
    assert got(df) == model(rows) and any(zlib.crc32(str(c).encode()) % 6 for c in range(301, 340))
    assert got(df.where("turn > 5")) == []
    assert got(spark.createDataFrame([(None, 0, "user", "a", "b")], COLUMNS)) == []
