"""Held-out accuracy and defined results of the trained operators."""

import os
import random

import numpy as np
import pytest
from lawloom.llm import lm, quality, samples, toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, score double"


def corpus(n=600):
    r = random.Random(7)
    word = lambda: "".join(r.choice(["ka", "lo", "mi", "ren", "tu"]) for _ in range(r.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(r.randint(20, 80))]
        grade, bad = r.choice([0, 1, 2]), r.random() < 0.3
        if bad:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(["grobian", "scurrile", "vilificus"])
        text = " ".join(w)
        text = text.upper() + "!!" * 5 if grade == 0 else text.replace(" ", " | ", 8) if grade == 1 else text
        docs.append((i, text, 0.0))
        labels.append((i, grade, int(bad)))
    return docs, labels


def test_toxicity_and_quality(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([*docs, (None, "grobian scurrile vilificus", 0.0), (9000, None, 0.0), (9001, "", 0.0), (9002, "mi lo " * 20000, 0.0), (5, docs[5][1], 0.0)], DOCS)
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (7777, 0, 1), labels[0]], "doc_id long, quality int, toxic int").repartition(3)
    held = {r.doc_id for r in d.where(toxicity.is_held_out()).collect()}
    truth = {i: (q, t) for i, q, t in labels}

    model = toxicity.fit(d, lab, where=~toxicity.is_held_out())
    rows = toxicity.score(d, model).collect()
    assert len(rows) == 605 and all(0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.doc_id in held and r.doc_id in truth]
    assert np.mean([(r.score >= 0.7) == (truth[r.doc_id][1] == 1) for r in tested]) > 0.9
    by = {r.doc_id: r.score for r in rows}
    assert by[9000] == by[9001] < 0.5 and by[None] > 0.7

    q = quality.fit(d, lab, where=~toxicity.is_held_out(), cut=1)
    assert q.grades.tolist() == [0, 1, 2] and (np.diff(q.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.score(d, q).collect()}
    tested = [(truth[i][0], got[i]) for i in held if i in truth]
    assert np.mean([round(r.expected_grade) == g for g, r in tested]) > 0.9
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in got.values())
    kept = quality.select(d, q)
    assert kept.schema == d.schema
    want = [i for i, r in got.items() if r.tail_probability >= quality.KEEP]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in [*want, *([5] if 5 in want else [])])


def held_out_labels(spark, sf):
    """Documents, labels, and the labels that no model of these tests learns from."""
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: (r.quality, r.toxic) for r in labels.where(toxicity.is_held_out()).collect()}
    return docs, labels, truth


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_held_out_labels_of_the_tables(spark):
    docs, labels, truth = held_out_labels(spark, SF)
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = {r.doc_id: r for r in quality.score(known, quality.fit(docs, labels, where=~toxicity.is_held_out())).collect()}
    kept = {i: r.tail_probability >= quality.KEEP for i, r in got.items()}
    assert np.mean([kept[i] for i, (q, _) in truth.items() if q == 1]) >= 0.99
    assert np.mean([not kept[i] for i, (q, _) in truth.items() if q == 0]) >= 0.9
    score = {r.doc_id: r.score for r in toxicity.score(known, toxicity.fit(docs, labels, where=~toxicity.is_held_out())).collect()}
    hit = [t for i, (_, t) in truth.items() if score[i] >= toxicity.THRESHOLD]
    assert np.mean(hit) >= 0.95 and sum(hit) >= 0.85 * sum(t for _, t in truth.values())


def test_words_and_pairs_are_features():
    some = lambda text: dict(zip(*(x.tolist() for x in quality.features(text))))
    a, b = some("the cat sat on the mat."), some("xqz vbn wpr lk zzx vvb.")
    assert {x for x in a if x >= quality._WORDS}.isdisjoint(x for x in b if x >= quality._WORDS)
    assert some("on the mat sat the cat.") != a and quality._TWICE not in a
    assert abs(some("so so so it is")[quality._TWICE] ** 2 - 2 / 5) < 1e-9
    assert some(None) == some("") == {} and all(x < quality._WORDS for x in some(" \n"))
    assert quality.features("a b " * 50_000)[0].max() < quality.COLUMNS


def test_rows_without_entries():
    x = samples.Rows([np.array([], int), np.array([1, 2]), np.array([], int), np.array([0]), np.array([], int)], [np.zeros(0), np.array([2.0, 3.0]), np.zeros(0), np.array([5.0]), np.zeros(0)])
    assert x.dot(np.array([1.0, 10.0, 100.0])).tolist() == [0, 320, 0, 5, 0]
    assert samples.Rows([np.array([], int)], [np.zeros(0)]).dot(np.ones(2)).tolist() == [0]


def test_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "a b", 0.0)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 2, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(d, toxicity.fit(d, none)).first().score < 1e-9
    assert toxicity.score(d, toxicity.fit(d, one)).first().score > 1 - 1e-9
    assert quality.select(d, quality.fit(d, none)).count() == 1
    assert quality.score(d, quality.fit(d, one, cut=1)).first()[1:] == (2.0, 1.0)
    assert toxicity.score(d.limit(0), toxicity.fit(d.limit(0), none)).count() == 0


def test_pseudo_likelihood(spark):
    r = random.Random(1)
    nouns, verbs = [f"n{i}" for i in range(20)], [f"v{i}" for i in range(20)]
    text = lambda: " ".join(x for _ in range(40) for x in ("the", r.choice(nouns), r.choice(verbs), "a", r.choice(nouns), "."))
    good = [text() for _ in range(200)]
    mixed = " ".join(sorted(good[0].split(), key=lambda _: r.random()))
    docs = [(i, t, 0.0) for i, t in enumerate(good)] + [(900, mixed, 0.0), (901, None, 0.0), (902, "", 0.0), (903, good[0], 0.0), (None, "unseen words only", 0.0)]
    d = spark.createDataFrame(docs, DOCS).repartition(2)
    rows = {x.doc_id: x for x in lm.score_corpus(d).collect()}
    assert len(rows) == len(docs)
    assert rows[901].n_tokens == rows[902].n_tokens == 0 and rows[901].log_prob == rows[902].mean_log_prob == 0.0
    assert rows[0].n_tokens == 240 and abs(rows[0].log_prob - rows[903].log_prob) < 1e-3
    assert rows[0].mean_log_prob > rows[900].mean_log_prob + 0.2
    assert all(x.log_prob <= 0 for x in rows.values())
    assert lm.score_corpus(d.limit(0)).count() == 0


def test_network_sums_to_one_and_its_step_is_the_gradient():
    net = lm.Net.new()
    rng = np.random.RandomState(3)
    net.c += rng.normal(0, 0.3, net.c.shape).astype(np.float32)
    net.m += rng.normal(0, 0.3, net.m.shape).astype(np.float32)
    sides = np.repeat(np.array([[1], [5], [lm._PAD], [9]]), lm._V, axis=1)
    assert abs(np.exp(net.log_p(np.arange(lm._V), sides)).sum() - 1) < 1e-4
    w, s = np.array([3, 40, 77, 3]), rng.randint(0, lm._V, (4, 4))
    before, start = net.log_p(w, s).mean(), lm.Net.of(net.flat())
    net.train(w, s, 0.01)
    assert net.log_p(w, s).mean() > before
    step = start.c - net.c
    i = np.unravel_index(np.abs(step).argmax(), step.shape)
    moved = []
    for by in (1e-2, -2e-2):
        start.c[i] += by
        moved.append(start.log_p(w, s).mean())
    assert abs(step[i] / 0.01 + (moved[0] - moved[1]) / 2e-2) < 1e-2


def test_words_of_a_bucket_are_told_apart(spark):
    common = [f"c{i}" for i in range(lm._V - lm.BUCKETS)]
    rare = [f"r{i}é" for i in range(2000)]
    texts = [" ".join(common)] * 20 + [" ".join(rare[: 2000 // 2 ** (i % 4)]) for i in range(9)] + [None, "c1 c2"]
    d = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(texts)], DOCS).repartition(3)
    counted = lm.counts(d)
    vocab = lm.vocabulary(counted)
    n = {bytes(r.word): r.n for r in counted.collect()}
    bucket = lambda w: lm.zlib.crc32(w) % lm.BUCKETS
    of = [sum(k for w, k in n.items() if w not in vocab.ids and bucket(w) == b) for b in range(lm.BUCKETS)]
    want = [sum(np.log(n[w] / of[bucket(w)]) for w in lm.words_of((t or "").encode()) if w not in vocab.ids) for t in texts]
    encoded = lm.encode(d, vocab, 1, 2)
    net = {r.doc_id: r.log_prob for r in lm.score(encoded, lm.train(encoded, vocab.counts, 2)).collect()}
    got = {r.doc_id: r for r in lm.score_corpus(d).collect()}
    assert len(got) == len(texts) and want[20] < -1 and want[0] == 0
    assert all(abs(got[i].log_prob - net[i] - want[i]) < 0.05 + 1e-4 * abs(want[i]) for i in got)


def test_partitions_change_no_score(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(1500)]
    docs = [(i, " ".join(r.choice(words[: 30 + i]) for _ in range(r.randint(0, 60))), 0.0) for i in range(400)] + [(7, None, 0.0), (None, "w1 w2 w3", 0.0)]
    d = spark.createDataFrame(docs, DOCS)
    one, many = ({str(x.doc_id): (x.n_tokens, x.log_prob) for x in lm.score_corpus(d.repartition(n), shard=1500).where("doc_id is null or doc_id <> 7").collect()} for n in (1, 32))
    assert one.keys() == many.keys() and len(one) == 400
    assert all(one[i][0] == many[i][0] and abs(one[i][1] - many[i][1]) <= 1e-5 * abs(one[i][1]) for i in one)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_network_beats_word_counts_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('0.1', '0.01')}/documents.parquet")
    held = docs.where(toxicity.is_held_out())
    seen = docs.where(~toxicity.is_held_out())
    counted = lm.counts(seen)
    vocab = lm.vocabulary(counted)
    score = lambda net: [sum(x) for x in zip(*((r.log_prob, r.n_tokens) for r in lm.score(lm.encode(held, vocab, 1, 1), net).collect()))]
    before, n = score(lm.Net.new(vocab.counts))
    after, _ = score(lm.train(lm.encode(seen, vocab, 2, 2), vocab.counts, 2))
    assert after / n > before / n + 0.05


def test_a_very_long_text_and_names_of_columns(spark):
    d = spark.createDataFrame([(1, "a b c " * 100_000, 1, 2, 3), (2, "a b", 1, 2, 3)], "doc_id long, text string, key int, word int, h int")
    assert sorted((r.doc_id, r.n_tokens) for r in lm.score_corpus(d).collect()) == [(1, 300_000), (2, 2)]


def test_texts_are_read_once_and_lots_change_no_score(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        read.add(1)
        return None if i % 10 == 3 else " ".join(f"w{(i * j * j) % 1993}" for j in range(i % 7 * 40))

    docs = spark.range(300).select(F.col("id").alias("doc_id"), text.asNondeterministic()("id").alias("text"))
    one = {r.doc_id: (r.n_tokens, r.log_prob) for r in lm.score_corpus(docs).collect()}
    assert read.value == 300
    monkeypatch.setattr(lm, "LOT", 500)
    assert lm.lots(docs).count() > 40
    many = {r.doc_id: (r.n_tokens, r.log_prob) for r in lm.score_corpus(docs).collect()}
    assert one.keys() == many.keys() and len(one) == 300
    assert all(one[i][0] == many[i][0] and abs(one[i][1] - many[i][1]) <= 1e-6 * abs(one[i][1]) for i in one)
