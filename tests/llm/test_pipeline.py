"""The pipeline's stages on small tables, against brute force."""

import os
import random
import zlib

import corpus_pipeline
import pytest

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")
def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, DIR).collect(), docs.schema)
        assert after.columns == docs.columns
        ids, was = {r.doc_id for r in after.collect()}, {r.doc_id for r in before.collect()}
        assert ids <= was
        if name == "quality_classifier":
            right = [i for i, q in labels.items() if (i in ids) == (q == 1)]
            assert len(right) >= 0.95 * len(labels)
        if name == "line_dedup":
            assert ids == was
        before = after
    rows = corpus_pipeline.STAGES[-1][1](spark, before, DIR).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}
    whole = corpus_pipeline.run(spark, DIR).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in whole)


def test_odd_tables(spark, tmp_path):
    q = random.Random(1)
    prose = [" ".join(q.choice(["alder", "birch", "cedar", "elm", "fir", "hazel", "larch"]) for _ in range(60)) for _ in range(20)]
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(prose)]
    rows += [(30, None, None, None, None, None), (31, "", "en", "s", 0, None), (None, prose[3] + " no id", "en", "s", 1, "y"), (4, prose[4], "en", "s", 1, "z"), (40, "oak pine " * 40_000, "en", "s", 1, "long")]
    columns = "doc_id long, text string, lang string, source string, n_chars long, __id string"
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("b1", "some words that no document has in any place at all here"), (None, None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, some in (("full", rows), ("none", [])):
        os.makedirs(tmp_path / name)
        for t in ("labels", "benchmark"):
            os.symlink(tmp_path / f"{t}.parquet", tmp_path / name / f"{t}.parquet")
        spark.createDataFrame(some, columns).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()}
        assert got == ({*range(20), None, 30, 40} if some else set())


def test_near_copies_are_those_of_op9(spark):
    from lawloom.llm import simhash

    q = random.Random(7)
    rows = []
    for i in range(60):
        t = [f"w{q.randrange(5000)}" for _ in range(q.choice([3, 80, 300]))]
        rows += [(len(rows) + j, " ".join(t[:at] + [f"new{i}"] + t[at + 1 :])) for j, at in enumerate([0, 0, len(t) // 2, len(t) - 1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [(d, simhash.fingerprint(t.encode(), 4)) for d, t in rows]
    of = {d: d for d, _ in rows}

    def root(d):
        return d if of[d] == d else root(of[d])

    for n, (d, a) in enumerate(fps):
        for e, b in fps[:n]:
            if (a ^ b).bit_count() <= 4:
                low, high = sorted((root(d), root(e)))
                of[high] = low
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, DIR).collect()}
    assert kept == {root(d) for d in of} and 60 < len(kept) < 240
