import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lawloom.llm import packing
from lawloom.llm.queries import tokenizer_path
from lawloom.llm.tokens import Encoder
from tokenizers import Tokenizer

PATH = tokenizer_path()


def check(lengths, capacity):
    of, offset = packing.pack(lengths, capacity)
    bins = {}
    for b, o, n in zip(of, offset, lengths):
        bins.setdefault(b, []).append((o, n))
    for rows in bins.values():
        at = 0
        for o, n in sorted(rows):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_bins_are_gapless_and_few(lengths):
    n = check(lengths, 40)
    assert n <= 11 / 9 * -(-sum(lengths) // 40) + 1 or n <= sum(2 * x > 40 for x in lengths) + 1


def test_real_mixture_is_nearly_full():
    r = random.Random(1)
    lengths = [min(2048, int(r.lognormvariate(6, 1)) + 1) for _ in range(20000)] + [2048] * 3000
    assert check(lengths, 2048) <= 1.01 * sum(lengths) / 2048 + 1


texts = st.text(st.characters(codec="utf-8"), max_size=80) | st.lists(st.sampled_from(["don't", " ", "  ", "\n", "a", "Ünï", "12", "x²", "<|endoftext|>", "\t", "'ll", "日本", "\x1c", "᠎", "é"]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_ids_equal_the_tokenizer(text):
    want = np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids if text else [], "<u4").tobytes()
    e = Encoder.of(PATH)
    assert e.many([text]) == [want]
    assert e.many([None]) == [b""]


def test_cut_points():
    assert packing.cut_points(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut_points(3, 4) == [(0, 3)]


@pytest.mark.parametrize("lot", [7, 1000])
def test_documents_come_back(spark, lot):
    docs = [(1, "hello world, this is a text"), (2, None), (3, ""), (4, "word " * 300), (1, "hello world, this is a text"), (None, "x y")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int")
    rows = packing.pack_documents(df, PATH, capacity=64, lot=lot, with_ids=True).collect()
    tok = Tokenizer.from_file(PATH)
    want = sorted((str(d), np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for d, t in docs)
    by, seqs = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by.setdefault((r.doc_id, r.piece), []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    got = []
    for d in {k[0] for k in by}:
        parts = [by[k] for k in sorted((k for k in by if k[0] == d), key=lambda k: k[1])]
        assert all(p[0].length == 64 for p in parts[1:])
        got += [(str(d), b"".join(bytes(p[n].ids) for p in parts)) for n in range(len(parts[0]))]
    assert sorted(got) == want
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


def test_lots_are_bounded_by_pieces(spark):
    df = spark.createDataFrame([(i, "one two three four " * 120) for i in range(50)], "doc_id long, text string").repartition(3)
    rows = packing.pack_documents(df, PATH, capacity=2, lot=500).collect()
    assert len(rows) > 50 * 200
    lots = {}
    for r in rows:
        lots[r.sequence_id >> 40] = lots.get(r.sequence_id >> 40, 0) + 1
    assert max(lots.values()) <= 500 + 3 and len(lots) == -(-len(rows) // 500)


def test_few_bins_like_the_best_of_all():
    def least(lengths, capacity):
        best = len(lengths)

        def put(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(lengths):
                best = len(rooms)
                return
            for room in {*rooms, capacity}:
                if room >= lengths[i]:
                    rest = list(rooms)
                    if room in rest:
                        rest.remove(room)
                    put(i + 1, [*rest, room - lengths[i]])

        put(0, [])
        return best

    r = random.Random(5)
    worse = 0
    for _ in range(150):
        lengths = [r.randint(1, 20) for _ in range(r.randint(1, 8))]
        n, best = check(lengths, 20), least(lengths, 20)
        assert best <= n <= best + 1
        worse += n > best
    assert worse <= 15
