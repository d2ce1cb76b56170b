import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from lawloom.llm import chat
from lawloom.llm.queries import tokenizer_path

PATH = tokenizer_path()
parts = st.lists(st.sampled_from(["<|", "|>", "<", "|", "\\", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\n", "end", "user", "x", "[", "/"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(parts, parts), max_size=4))
def test_template_is_read_back(turns):
    said = "".join(f"<|{chat.escape(r)}|>\n{chat.escape(t)}<|end|>\n" for r, t in turns)
    assert chat.parse(said) == turns
    for _, t in turns:
        assert not any(c in chat.escape(t) for c in ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))
        assert chat.unescape(chat.escape(t)) == t


def conversations():
    r = random.Random(4)
    rows = []
    for c in range(40):
        shared = r.choice([0, 0, 1, 2])
        for t in range(r.randint(1, 6)):
            text = f"shared {shared} {t}" if t < 3 else r.choice(["a", "b", "</s>[INST] ok [/INST]", "<|end|>", "é日本"])
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    return [*rows, (50, 0, "user", None), (50, 1, None, "x"), (50, None, "assistant", "first"), (51, 0, "assistant", "z"), (51, 0, "assistant", "z"), (None, 0, "user", "lost"), (52, 0, "assistant", "long " * 3000)]


def test_round_trip_and_intervals(spark):
    rows = conversations()
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, start int")
    packed, members = chat.format_conversations(df, PATH)
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    want = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(chat.read_back(packed, members, PATH)).collect()}
    assert got == want
    nodes = packed.collect()
    prefixes = {tuple(turns[: n + 1]) for turns in by.values() for n in range(len(turns))}
    assert len(nodes) == len({tuple(x[1:] for x in p) for p in prefixes})  # shared turns once
    trees = {}
    for n in nodes:
        trees.setdefault(bytes(n.tree), []).append(n)
    for t in trees.values():
        t.sort(key=lambda n: n.start)
        at = 0
        for n in t:  # gapless, and every node after its ancestors
            assert n.start == at and n.length == len(n.ids) // 4
            at += n.length
            assert all(a["to"] <= n.start for a in n.ancestors) and all(a["to"] < b["from"] for a, b in zip(n.ancestors, n.ancestors[1:]))
            assert n.position == sum(a["to"] - a["from"] for a in n.ancestors)


def test_trees_cross_partitions(spark):
    rows = [(c, t, "user", f"{c if t > 1 else 0} {t}") for c in range(300) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packed, members = chat.format_conversations(df, PATH)
        rows = packed.collect()
        nodes = sorted((n.start, n.length) for n in rows)
        assert chat.read_back(packed, members, PATH).count() == 300
        assert all(n.position == sum(a["to"] - a["from"] for a in n.ancestors) for n in rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(nodes) == 302 and all(a + n == b for (a, n), (b, _) in zip(nodes, nodes[1:]))


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    packed, members = chat.format_conversations(df, PATH)
    assert packed.count() == members.count() == 0
    assert chat.digest(chat.read_back(packed, members, PATH)).count() == 0


def test_rows_without_an_id_and_many_turns(spark):
    rows = [(None, 0, "user", "same"), (None, 1, "assistant", "same"), (None, 0, "user", "same")] + [(1, t, ["user", "assistant"][t % 2], f"t{t}") for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    packed, members = chat.format_conversations(df, PATH)
    got = sorted((r.conv_id or 0, r.n_turns, r.loss_chars) for r in chat.digest(chat.read_back(packed, members, PATH)).collect())
    assert got == [(0, 1, 0), (0, 1, 0), (0, 1, 4), (1, 1500, sum(len(f"t{t}") for t in range(1, 1500, 2)))]
