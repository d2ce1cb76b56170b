import hashlib
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lawloom.llm import bpe, queries

PATH = queries.tokenizer_path()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in bpe.Coder.of(PATH).encode_many(texts)]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(max_size=40) | st.text(alphabet="aehnrst '.\n", max_size=80) | st.text(alphabet=[chr(n) for n in range(128)], max_size=80), max_size=6))
def test_equals_the_tokenizer_on_any_text(own, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert ids_of(texts) == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_most_proposals_hold_and_the_failing_ones_are_merged_exactly(own):
    """Words made of random pieces of the vocabulary, of which many propose what merging would not give."""
    r = random.Random(3)
    letters = [w for w in own.get_vocab() if w.isalpha() and w.isascii()]
    texts = [" ".join("".join(r.choice(letters) for _ in range(r.randint(1, 4))) for _ in range(50)) for _ in range(200)]
    coder = bpe.Coder(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_many(texts)]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < coder.exact < len(coder.known)


def toy(r):
    """Merges over three bytes in a random order, so that greedy proposals are often wrong."""
    made, merges = [b"a", b"b", b"c"], []
    while len(merges) < 12:
        x, y = r.choice(made), r.choice(made)
        if x + y not in made:
            made.append(x + y)
            merges.append((x, y))
    return merges


@pytest.mark.parametrize("seed", range(30))
def test_the_check_of_pairs_equals_merging(seed):
    r = random.Random(seed)
    merges = bpe.Merges(toy(r))
    words = ["".join(r.choice("abc") for _ in range(r.randint(1, 60))).encode() for _ in range(300)]
    got, failed = merges.words(words)
    assert got == [merges.exact(w) for w in words]
    short = [w for w in words if len(w) <= 40]
    by_rank = []
    for w in short:  # the textbook: the least rank first, from the left
        parts = list(w)
        while options := [(merges.product[a * merges.size + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a * merges.size + b in merges.product]:
            m, i = min(options)
            parts[i : i + 2] = [m]
        by_rank.append(parts)
    assert [merges.exact(w) for w in short] == by_rank
    assert failed < len(words)


def test_special_tokens_long_texts_and_words(own):
    texts = ["a<|endoftext|>b <|endoftext|>", "<|endoftext", "<|endoftext|><|endoftext|>", "", None, "x" * 30_000, "word " * 300_000, " \n\t  a　b  c\x1c\x85d", "日本語 ñandú 😀👍🏽 'S 's it's", "﻿​ͅᲉꟋ", "0" * 1000]
    assert ids_of(texts) == [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    coder = bpe.Coder(PATH)
    for t, ids in zip(texts, ids_of(texts)):
        assert coder.decode(ids) == (t or "") == own.decode(ids, skip_special_tokens=False)
    lists = bpe.pa.array([[1, 2], None, [], [-5, 10**9, 3, None]], bpe.pa.list_(bpe.pa.int32()))
    assert coder.decode_many(lists[1:]) == [None, "", coder.decode([3])] and coder.decode_many(lists[:0]) == []
    for ids in ([255, 200], [50256, 128, 5], [], [160]):
        assert coder.decode(ids) == own.decode(ids, skip_special_tokens=False)


def test_odd_rows_and_an_empty_table(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "no id", "x"), (2, None, "x"), (3, "", "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    got = bpe.decode(bpe.encode(df, PATH), PATH, name="IDS")
    assert got.columns == ["doc_id", "ids", "IDS_"]
    assert sorted(((r.doc_id, r.IDS_) for r in got.collect()), key=str) == sorted(((d, t or "") for d, t, _ in rows), key=str)
    assert bpe.decode(bpe.encode(df.where("doc_id < 0"), PATH), PATH).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_query_equals_the_tokenizer(spark, own):
    def row(doc, text):
        ids = own.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return doc, len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False))

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op11_bpe(spark, SF).collect())) == sorted(row(d.doc_id, d.text) for d in docs)
