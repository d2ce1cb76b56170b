import random

from lawloom.llm import linededup as ld


def test_patience():
    assert ld.patience("abcd", "abcd") == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert ld.patience("xaybz", "aqb") == [(1, 0), (3, 2)]
    assert ld.patience("ab", "ba") in ([(0, 1)], [(1, 0)])
    assert ld.patience("", "a") == []
    r = random.Random(0)
    for _ in range(300):
        a, b = ([r.choice("abcdefghij") for _ in range(r.randint(0, 12))] for _ in range(2))
        got = ld.patience(a, b)
        assert all(a[i] == b[j] for i, j in got) and bool(got) == bool({*a} & {*b})
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    long = [str(i) for i in range(30000)]
    assert len(ld.patience(long, long)) == 30000


def test_spans():
    assert ld.spans([9, 1], 8) == [(0, 1), (0, 2)] and ld.spans([1, 9], 8) == [(0, 2), (1, 2)]
    assert ld.spans([3, 3, 3], 8) == [(0, 3)] and ld.spans([3], 8) == [] and ld.spans([], 8) == []


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, h string, __gone string, key_ int, `Gone` int")
    out = ld.dedup_lines(df, **more)
    assert out.schema == df.schema
    return sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)


def table(texts, n_chars=0):
    return [(i, t, n_chars, "x", "y", 1, 2) for i, t in texts]


def test_later_documents_lose_blocks(spark):
    block = "one two three four\nfive six seven eight"
    moved = "five six seven eight\nmiddle\none two three four\nthird"
    rows = table([(1, f"first\n{block}\nend"), (2, f"{block}\nsecond"), (3, moved), (4, block), (5, None), (6, ""), (None, block), (7, "short\nend"), (7, "short\nend"), (8, f"  five six seven eight \n{block}")], 9)
    got = {d: (t, n) for d, t, n in run(spark, rows, min_words=5)}
    assert got[1] == (f"first\n{block}\nend", 9) and got[2] == ("second", 6)
    assert got[3] == (moved, 9)  # moved lines are blocks of four words: too short
    assert got[4] == ("", 0) and got[5] == (None, 9) and got[6] == ("", 9) and got[None] == (block, 9)
    assert got[7] == ("short\nend", 9) and got[8][0].strip() == "five six seven eight"


def test_a_block_that_others_hold_the_lines_of(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    assert [t for _, t, _ in run(spark, table([(1, a), (2, f"{a}\n{b}"), (3, f"{a}\n{b}")]))] == [a, f"{a}\n{b}", ""]
    assert [t for _, t, _ in run(spark, table([(2, f"{a}\n{b}"), (3, f"{a}\n{b}")]))] == [f"{a}\n{b}", ""]


def brute(texts, min_words):
    """What is left if every pair is compared: each block of enough words that an earlier document has goes."""
    out = {}
    lines = {d: [x.strip() for x in t.split("\n") if x.strip()] for d, t in texts}
    for d, own in lines.items():
        gone = set()
        for e, other in lines.items():
            for i in range(len(own)):
                for j in range(len(other) if e < d else 0):
                    n = 0
                    while i + n < len(own) and j + n < len(other) and own[i + n] == other[j + n]:
                        n += 1
                    if sum(len(x.split()) for x in own[i : i + n]) >= min_words:
                        gone.update(range(i, i + n))
        out[d] = "\n".join(x for i, x in enumerate(own) if i not in gone)
    return out


def test_like_brute_force(spark):
    r = random.Random(1)
    pool = ["a", "b c", "d e f", "g h i j", "k l m n o", "p q r s t u v w", "x", "y z"]
    texts = [(d, "\n".join(r.choice(pool) for _ in range(r.randint(0, 9)))) for d in range(120)]
    texts += [(200, "\n".join(reversed(texts[3][1].split("\n") * 2))), (201, "\n".join(f"number {i} of so very many more lines" for i in range(60)))]
    texts += [(202, "\n".join(reversed(texts[-1][1].split("\n")))), (203, "\n\n".join(texts[-1][1].split("\n")[5:9] * 3))]
    assert {d: t for d, t, _ in run(spark, table(texts))} == brute(texts, 8)
    for passes in (0, 1, 16):
        assert len(ld.align([{"n": 1, "later": [9 - i], "first": [i]} for i in range(10)], passes)) == 10


def test_a_line_in_all_documents(spark):
    got = run(spark, table((i, f"a line that every one of these documents has\nown {i}") for i in range(200)))
    assert sum("\n" in t for _, t, _ in got) == 1 and {t for _, t, _ in got} >= {f"own {i}" for i in range(1, 200)}


def test_counts_empty_table_and_a_long_text(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h\nx"), (2, "a b c d e f g h\ny")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_lines, r.n_deleted) for r in ld.dedup_lines(df, counts=True).collect()) == [(1, 2, 0), (2, 2, 1)]
    assert ld.dedup_lines(df.limit(0)).count() == 0
    long = "\n".join(f"line {i} of a text that has a hundred thousand" for i in range(100_000))
    df = spark.createDataFrame([(1, long), (2, long), (3, long + "\nand one more")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_deleted) for r in ld.dedup_lines(df, counts=True).collect()) == [(1, 0), (2, 100_000), (3, 100_000)]


def test_an_exact_copy_of_lines_with_other_first_holders_goes(spark):
    own = [f"just {a} words" for a in "abcdef"]
    mixed = "\n".join(own[::2]) + "\n\n" + "\n".join(own[1::2])
    rows = table([*((i, f"{x}\nonly here {i}") for i, x in enumerate(own)), (20, mixed), (21, mixed), (22, "a start\n" + "\n".join(own[::2]) + "\nan end"), (23, own[5] + "\n" + own[0] + "\nno more")])
    got = {d: t for d, t, _ in run(spark, rows)}
    assert got[20] == mixed and got[21] == "" and got[22] == "a start\nan end"
    assert got[23] == rows[9][1]  # six words: too short
