import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from lawloom.llm import fim
from pyspark.sql import functions as F

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é\n<P日1", max_size=30), st.integers(0, 40), st.integers(0, 40))
def test_two_passes_equal_a_list_of_units(text, x, y):
    u = UNIT.findall(text)
    assert fim.units(text) == len(u)
    low, high = sorted((x % (len(u) + 1), y % (len(u) + 1)))
    a, b = fim.cuts(text, low, high)
    assert (text[:a], text[a:b], text[b:]) == ("".join(u[:low]), "".join(u[low:high]), "".join(u[high:]))


def model(doc, text, seed=1, rate=90, spm_rate=20):
    """The rule, with all units in a list."""
    text = text or ""
    u, hexa = UNIT.findall(text), hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(hexa[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    spm = h[3] % 100 < spm_rate
    return len(u), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_every_form_is_as_the_rule_says_and_comes_back(spark):
    texts = ["a b", "", None, "<", "<P", "x <P> y", "<S><M>", "S>M>P>", "<<<P", "tail <", "é日本 a\nb", "word " * 40_000, "\x00\x1c\u2028", "q" * 100_000]
    rows = [(n, texts[n % len(texts)] if n % 3 else f"doc {n} <") for n in range(900)] + [(5, "one id"), (5, "one id"), (None, "no id")]
    df = spark.createDataFrame([(*x, "f", 1) for x in rows], "doc_id long, text string, form string, h1 int")
    got = fim.transform(df).select("*", fim.restored(F.col("output"), F.col("form")).alias("again")).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == sorted(((d, *model(d, t)) for d, t in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(((r.doc_id, r.again) for r in got), key=key) == sorted(((d, t or "") for d, t in rows), key=key)


def test_rates_and_empty_table(spark):
    df = spark.createDataFrame([(n, "a b c") for n in range(200)], "doc_id int, text string")
    assert {r.form for r in fim.transform(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(df, rate=100, spm_rate=100).collect()} == {"spm"}
    other = {r.doc_id: r.output for r in fim.transform(df, seed=2).collect()}
    assert other == {n: model(n, "a b c", seed=2)[-1] for n in range(200)}
    assert fim.transform(df.where("doc_id < 0")).collect() == []
