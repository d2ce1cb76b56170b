import json

import pytest
from lawloom.operators import anomalies, enrich, registry, rules, segment, validate
from lawloom.schemas import ENTRY
from lawloom.sources import publish, volumes
from lawloom.streaming import incremental
from pyspark.sql import functions as F


def kinds(spark, numbers, private=()):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(numbers) if i not in private], "vol int, xml_index int, n long")
    got = anomalies.sequence_anomalies(df, group=["vol"], position="xml_index", number="n").collect()
    return sorted((r.xml_index, r.kind) for r in got)


@pytest.mark.parametrize(
    ("numbers", "want"),
    [
        (range(1, 11), []),
        ([1, 2, 3, 605, 5, 6], [(3, "out_of_place"), (4, "gap")]),
        ([1, 2, 3, 4, 3, 5], [(4, "duplicate")]),
        ([200, 2, 3, 4, 5], [(0, "suspect_endpoint"), (1, "gap")]),
        ([1, 2, 3, 4, 200], [(4, "suspect_endpoint")]),
        ([1, None, 3], [(1, "unparseable")]),
        ([7], []),
    ],
)
def test_sequences(spark, numbers, want):
    got = kinds(spark, numbers)
    assert [x for x in got if x in want or x[1] != "gap"] == want


def test_private_laws_do_not_count(spark):
    assert kinds(spark, [1, 99, 2], private={1}) == []


def test_neighbours_and_duplicates(spark):
    df = spark.createDataFrame([(1, i, "ab"[i % 2]) for i in range(8)], "g int, i int, k string")
    near = df.select("i", anomalies.neighbours(group=["g"], position="i", fields=["k"])).orderBy("i").collect()
    assert [x.i for x in near[4].neighbours] == [1, 2, 3, 5, 6, 7]
    keys = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "b", "a", None, None, *["c"] * 8])], "i int, k string")
    got = {r.k: (r.n, len(r.rows), r.truncated) for r in anomalies.duplicate_groups(keys, key="k", order="i", fields=[]).collect()}
    assert got == {"a": (2, 2, False), "c": (8, 6, True)}


def test_suffixes(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(["k", "k", "k", "m"])], "i int, k string")
    assert [r.k for r in enrich.suffix_keys(df, key="k", order=["i"]).orderBy("i").collect()] == ["k", "k-1", "k-2", "m"]


def test_dictionary_grows(spark):
    known = spark.createDataFrame([("b", 1)], "term string, id long")
    new = spark.createDataFrame([(x,) for x in ["C", " a ", "b", None, "c", "nan", ""]], "term string")
    assert {r.term: r.id for r in enrich.grow_dictionary(known, new).collect()} == {"b": 1, "a": 2, "c": 3}


def test_tags_by_expression_and_by_automaton(spark, monkeypatch):
    df = spark.createDataFrame([("The GNU and gnus", None), (None, None), ("x", "y gnu")], "a string, b string")
    want = [["and", "gnu"], None, ["gnu"]]
    assert [r.t for r in enrich.tag_rows(df, ["a", "b"], ["gnu", "and", "zz"], "t").collect()] == want
    monkeypatch.setattr(enrich, "LITERAL_TERMS", 1)
    assert [r.t for r in enrich.tag_rows(df, ["a", "b"], ["gnu", "and", "zz"], "t").collect()] == want


def test_numpy_draw():
    import numpy as np
    import pandas as pd

    np.random.seed(42)
    idx = pd.DataFrame({"x": range(50)}).sample(n=7).index
    order = np.random.permutation(np.arange(1, 8))
    assert segment.draw_like_numpy(50, 7) == list(zip(idx.tolist(), order.tolist()))


def test_seed_rules(spark):
    df = spark.createDataFrame([("81-175", "Social Security Act"), ("81-208", "Federal Crop Insurance"), ("104–9", "Federal Election Campaign Act of 1971 to improve"), ("1-1", "x")], "i string, t string")
    assert [r.x for r in df.select(rules.cumulative(F.col("i"), F.col("t"), rules.LAW_IDS).alias("x")).collect()] == ["81-174", "81-268", "104-79", "1-1"]
    s = spark.createDataFrame([("n", "106–382", "Use of Pick-Sloan power", None), ("n", "98-1", "x", None)], "n string, i string, h string, t string")
    assert [r.x for r in s.select(rules.first_wins(*(F.col(c) for c in "niht"), rules.SECTION_NUMBERS).alias("x")).collect()] == ["SEC. 6.", "n"]


def entry(id_, kind="law_id", status="pending", **more):
    base = dict.fromkeys(ENTRY.fieldNames())
    return base | {"id": id_, "type": kind, "status": status, "trigger": {"law_id_substring": "1-1", "title_substring": "a"}, "correction": {"replace_with_law_id": "2-2"}, "proposed_at": "t", "seen_again_count": 0} | more


def table(spark, entries):
    return spark.createDataFrame([tuple(e[n] for n in ENTRY.fieldNames()) for e in entries], ENTRY)


def test_registry(spark, tmp_path):
    old = table(spark, [entry(1, status="approved")])
    other = {"type": "other", "trigger": {"pattern": "Sibling <level> here"}, "correction": {"description": "d"}}
    new = table(spark, [entry(None), entry(None, **{"type": "law_id"}), entry(None, kind="other", **{k: v for k, v in other.items() if k != "type"}), entry(None, kind="odd")])
    got = registry.append_pending(old, new, next_id=2)
    rows = sorted(got.collect(), key=lambda r: r.id)
    assert [(r.id, r.type, r.status, r.seen_again_count) for r in rows] == [(1, "law_id", "approved", 2), (2, "other", "pending", 0)]
    assert [r.f for r in got.orderBy("id").select(registry.family().alias("f")).collect()] == ["none", "sibling-level"]
    moved = registry.move(got, [1, 2], to="approved", reviewer="r")
    assert [(r.id, r.status, r.reviewer) for r in moved.orderBy("id").collect()] == [(1, "approved", None), (2, "approved", "r")]
    assert [r.implementation_status for r in registry.backfill(moved).orderBy("id").collect()] == ["not_required", "pending"]
    assert [r.id for r in registry.applied(registry.mark(moved, [2], implementation_status="implemented")).orderBy("id").collect()] == [1, 2]
    assert registry.law_id_rules(moved) == [("1-1", "a", "2-2")]
    assert registry.fingerprint([(1, "a"), (2, "b")]) == registry.fingerprint([(2, "b"), (1, "a")])
    (tmp_path / "r.json").write_text(json.dumps({"schema_version": 1, "next_id": 3, "entries": [{"id": 7, "type": "other", "trigger": {"pattern": "p"}}], "rejected": [{"id": 8}]}))
    assert sorted(r.id for r in volumes.read_registry(spark, str(tmp_path / "r.json")).collect()) == [7, 8]


def test_affected_volumes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"vol": 75, "warnings": ["86 rows share a UniqueKey"], "failed": [], "passed": []}))
    (tmp_path / "b.json").write_text(json.dumps({"vol": 76, "warnings": [], "failed": [], "passed": []}))
    (tmp_path / "c.json").write_text("{broken")
    reports = volumes.read_reports(spark, str(tmp_path))
    assert [r.vol for r in registry.affected_volumes(reports, ["uniquekey"]).collect()] == [75]


def test_append_new(spark, tmp_path):
    (tmp_path / "l.csv").write_text(" agency ,BUREAU\nDept A,\nDept B,Office\n")
    there = volumes.read_csv_lookup(spark, str(tmp_path / "l.csv"), ["Agency", "Bureau"])
    new = spark.createDataFrame([("dept a ", None), ("Dept B", None), ("DEPT b", ""), (None, None), ("C", "x")], "Agency string, Bureau string")
    got = registry.append_new(there, new, ["Agency", "Bureau"]).collect()
    assert sorted((r.Agency or "").lower() for r in got) == ["c", "dept b"]
    assert {r.term for r in enrich.terms(there, ["Agency", "Bureau"]).collect()} == {"dept a", "dept b", "office"}


def test_validation(spark):
    rows = [(114, "a", "Section", "106–382", "t", "Use of Pick-Sloan Power", "SEC. 5.", "x", 1), (114, "a", "Odd", "bad", "t", None, None, None, 0), (114, None, "Division", "81-175", "Social Security", None, None, " ", 0)]
    df = spark.createDataFrame(rows, "vol int, UniqueKey string, EntryType string, LawIdentifier string, LawTitle string, SectionName string, SectionNumber string, Text string, Selection int")
    r = validate.report(validate.measures(df, ["vol"]), spark.createDataFrame([(114, 2)], "vol int, public_count long")).first()
    assert r.status == "failed" and len(r.failed) == 4 and len(r.warnings) == 4
    assert any("Odd" in x for x in r.failed) and any("SEC. 6." in x for x in r.failed) and any("81-174" in x for x in r.failed)
    assert validate.missing_columns(["UniqueKey", "z"])[1] == ["z"]


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    publish.write_workbook(path, ["A", "B"], [["x & <y>", None], [" z", "1"]])
    assert volumes.read_workbook(path) == (["A", "B"], [["x & <y>", None], [" z", "1"]])
    assert volumes.workbook_lookup(spark, path).columns == ["A", "B"]


def test_output_guard(tmp_path):
    (tmp_path / "safe").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "raw")
    publish.check_output(str(tmp_path / "safe"), [str(tmp_path / "raw")])
    with pytest.raises(ValueError, match="not to be written"):
        publish.check_output(str(tmp_path / "link" / "x"), [str(tmp_path / "raw")])


def test_follow_handles_each_file_once(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    (src / "STATUTE-40.xml").write_text("<a/>")
    each = lambda df, n: seen.extend(r.vol for r in df.select("vol").collect())
    incremental.follow(spark, str(src), str(tmp_path / "c"), each)
    (src / "STATUTE-41.xml").write_text("<a/>")
    incremental.follow(spark, str(src), str(tmp_path / "c"), each)
    assert seen == [40, 41]


def test_distinct_first_and_order(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None)], "i int, c string")
    assert sorted(r.i for r in segment.distinct_first(df, ["c"], [F.col("i")]).collect()) == [1, 2]
    with pytest.raises(ValueError, match="within a key"):
        segment.with_order(df, [], [F.col("i")])


def test_null_ordinals_need_one_sort(spark):
    from lawloom.operators import passes

    rows = [(1, n, s) for n, s in enumerate(["1", None, "2"])] + [(2, 0, None), (2, 1, "7"), (2, 2, None), (3, 0, None), (3, 1, "7"), (4, 0, None), (5, 0, None), (5, 1, None), (6, 1, None), (6, 0, "Sec. 1.")]
    df = spark.createDataFrame(rows, "law int, at int, number string")
    out = passes.null_ordinals(df, law=["law"], number="number", order=[F.col("at")])
    got = {(r["law"], r["at"]): r["number"] for r in out.collect()}
    assert got == {(1, 0): "1", (1, 1): "U1", (1, 2): "2", (2, 0): "U1", (2, 1): "7", (2, 2): "U2", (3, 0): None, (3, 1): "7", (4, 0): None, (5, 0): "U1", (5, 1): "U2", (6, 0): "Sec. 1.", (6, 1): "U1"}
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Sort [") == 1
