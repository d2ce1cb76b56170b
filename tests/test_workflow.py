"""Runs over several volumes, the dictionary between them, and the corrections workflow from files to files."""

import json

import pytest
from lawloom.functions import codes
from lawloom.operators import enrich, registry, validate, workflow
from lawloom.plans import corrections, pipeline
from lawloom.sources import publish, volumes, workspace
from pyspark.sql import functions as F

from tests.test_markup import SEC, law, volume, walk


def division(*headings):
    return "".join(f"<appropriations><heading>{h}</heading><content>x</content></appropriations>" for h in headings)


def write(folder, **vols):
    folder.mkdir(exist_ok=True)
    for name, text in vols.items():
        (folder / f"STATUTE-{name[1:]}.xml").write_text(text)


def published(spark, out):
    return sorted((r.vol, r.OriginalOrder, r.LawIdentifier, r.SectionNumber, r.UniqueKey) for r in spark.read.parquet(f"{out}/published").collect())


def test_one_run_or_two_give_the_same_keys(spark, tmp_path):
    write(tmp_path / "in", v113=volume(law(division("Zoo", "Museum"))), v114=volume(law(division("Archive", "Zoo"))))
    one = pipeline.run_volumes(spark, str(tmp_path / "in"), str(tmp_path / "a"), [113, 114], stamp="s", n=1)
    for v in (113, 114):
        run = pipeline.run_volumes(spark, str(tmp_path / "in"), str(tmp_path / "b"), [v], stamp=f"s{v}", n=1)
        assert run.status == {v: "success"} and run.exit_code() == 0
    assert one.status == {113: "success", 114: "success"}
    assert published(spark, tmp_path / "a") == published(spark, tmp_path / "b")
    terms = {r.term: r.id for r in workspace.read_dictionary(spark, f"{tmp_path}/b/dictionary").collect()}
    assert terms == {"museum": 1, "zoo": 2, "archive": 3}
    again = pipeline.run_volumes(spark, str(tmp_path / "in"), str(tmp_path / "b"), [113, 114, 115], stamp="t", n=1)
    assert again.status == {113: "skipped", 114: "skipped", 115: "missing_xml"} and again.exit_code() == 1
    manifest = publish.Manifest(f"{tmp_path}/b/manifest.json").volumes
    assert manifest["114"]["last_run"] == "s114" and len(manifest["114"]["output_sha256"]) == 64
    assert pipeline.main(["--input", "x", "--output", "y", "--volumes", "9-3"]) == 2


def test_only_wanted_volumes_are_read(spark, tmp_path):
    write(tmp_path / "in", v113=volume(law(SEC.format(1))), v114="<broken")
    assert [r.vol for r in volumes.volume_files(spark, f"{tmp_path}/in", [113]).select("vol").collect()] == [113]
    assert volumes.volume_files(spark, f"{tmp_path}/in", []).count() == 0


ANSWER = {
    "proposals": [
        {"type": "law_id", "trigger": {"law_id_substring": "99-911", "title_substring": "Test"}, "correction": {"replace_with_law_id": "Public Law 99-919"}, "confidence": 0.9},
        {"type": "other", "trigger": {"pattern": "SectionNumber is NULL"}, "correction": {"description": "d"}},
        {"type": "strange", "trigger": {}},
    ],
    "issues": [{"citable_as": "Public Law 99-911", "issue": "Wrong", "line_numbers": "3", "text_says": "x" * 40_000, "more": 1}, {"citable_as": "PUBLIC LAW 99-911 ", "issue": "wrong", "line_numbers": " 3"}, {"citable_as": "b", "issue": "c"}],
}


def test_corrections_from_answer_to_publication(spark, tmp_path, capsys):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(tmp_path / "in", v113=volume(law(SEC.format(1)), law(SEC.format(2), cited="Public Law 99-913")), v114=volume(law(SEC.format(1))))
    pipeline.run_volumes(spark, src, out, [113, 114], stamp="s", n=1, stop_before_publish=True)
    said = f"Here: ```json\n{json.dumps(ANSWER)}\n``` done"
    first = corrections.record(spark, out, 113, said, at="t1", expected=5)
    assert first == {"proposals": 2, "seen_again": 0, "issues": 2, "under": True}
    assert corrections.record(spark, out, 113, said, at="t2", expected=3) == {"proposals": 0, "seen_again": 2, "issues": 0, "under": False}
    assert corrections.record(spark, out, 113, "nothing") == {"proposals": 0, "seen_again": 0, "issues": 0, "under": False}
    log = spark.read.parquet(f"{out}/issues").collect()
    assert {len(r["text_says"]) for r in log} == {0, 32_000 + len(workflow.CUT)} and {r["Volume"] for r in log} == {113}
    reg = workspace.Registry(spark, out)
    law_entry = next(e["id"] for e in reg.pending if e["type"] == "law_id")
    other = next(e["id"] for e in reg.pending if e["type"] == "other")
    assert sorted((law_entry, other)) == [1, 2] and reg.next_id == 3
    assert corrections.diff(spark, out, law_entry) == [("99-911", "Test", "Public Law 99-919")]
    assert len(corrections.listing(spark, out, "pending")) == 2 and corrections.show(spark, out, 77) is None

    assert corrections.apply_and_publish(spark, out, 112) == 2
    assert corrections.apply_and_publish(spark, out, 113, at="u") == 0
    assert {r[2] for r in published(spark, out)} == {"Public Law 99–911", "Public Law 99–913"}
    assert corrections.apply_and_publish(spark, out, 113) == 3  # frozen
    assert corrections.apply_and_publish(spark, out, 113, include_pending=True, force=True) == 0
    assert {r[2] for r in published(spark, out)} == {"Public Law 99–919", "Public Law 99–913"}
    assert publish.Manifest(f"{out}/manifest.json").volumes["113"]["corrections_pending"] == [law_entry]

    assert corrections.review(spark, out, [law_entry, other, 9], approve=True, reviewer="r") == [1, 2]
    task = json.loads((tmp_path / "out" / "scratch" / f"coder_task_{other}.json").read_text())
    assert task["entry_ids"] == [other] and task["family"] == "null-num" and task["registry_entries"][0]["trigger"] == {"pattern": "SectionNumber is NULL"}
    assert corrections.show(spark, out, other)["implementation_status"] == "in_progress"
    assert corrections.finalize(spark, out, [other], {"status": "success", "files_modified": ["parser/a.py", "setup.py"], "tests_added": ["t"]}, tests_pass=True) == "out-of-scope file: setup.py"
    assert corrections.show(spark, out, other)["implementation_status"] == "failed"
    assert corrections.finalize(spark, out, [other], {"status": "success", "files_modified": ["parser/a.py"], "tests_added": ["t"]}, tests_pass=True, sha="abc") is None
    got = corrections.show(spark, out, other)
    assert (got["implementation_status"], got["implementation_commit_sha"], got["implementation_notes"]) == ("implemented", "abc", "out-of-scope file: setup.py")
    with pytest.raises(KeyError):
        corrections.republish(spark, src, out, 50)
    assert corrections.republish(spark, src, out, law_entry, dry_run=True) == [113]
    assert corrections.republish(spark, src, out, law_entry, n=1) == [113]
    assert {r[2] for r in published(spark, out)} == {"Public Law 99–919", "Public Law 99–913"}
    runs = corrections.show(spark, out, law_entry)["applied_in_runs"]
    assert runs[0] == {"vol": 113, "run_ts": "t1"} and len(runs) == 2
    assert corrections.main(["--output", out, "list"]) == 0 and "Public Law 99-919" in capsys.readouterr().out
    assert corrections.main(["--output", out, "reject", "1", "--reviewer", "r"]) == 1  # no longer pending


def test_rejected_entries_stay_on_file(spark, tmp_path):
    corrections.record(spark, str(tmp_path), 1, json.dumps(ANSWER))
    assert corrections.review(spark, str(tmp_path), [1], approve=False, reviewer="r", note="no") == [1]
    reg = workspace.Registry(spark, str(tmp_path))
    assert [e["id"] for e in reg.rejected] == [1] and [e["id"] for e in reg.pending] == [2] and reg.next_id == 3


def test_candidates_and_agencies(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    cited = lambda n: f"Public Law 99-{n}"
    write(tmp_path / "in", v113=volume(*(law(SEC.format(1) + SEC.format(1), cited=cited(n)) for n in (1, 2, 2, 4, 5))))
    pipeline.run_volumes(spark, src, out, [113], stamp="s", n=1, stop_before_publish=True)
    checkpoint = spark.read.parquet(f"{out}/checkpoint").withColumn("UniqueKey", F.lit("same")).collect()
    spark.createDataFrame(checkpoint, spark.read.parquet(f"{out}/checkpoint").schema).write.mode("overwrite").parquet(f"{out}/checkpoint")
    corrections.candidates(spark, src, out, 113, f"{out}/c.json")
    got = json.loads((tmp_path / "out" / "c.json").read_text())
    assert got["total_rows"] == 10 and [a["kind"] for a in got["law_number_anomalies"]] == ["duplicate", "gap"]
    group = got["unique_key_duplicates"][0]
    assert group["n"] == 10 and group["truncated"] and len(group["rows"]) == 6 and group["law_identifiers"] == sorted(cited(n) for n in (1, 2, 4, 5))
    assert {c["tag_path"] for c in group["per_law_context"]} == {"uslm/pLaw"} and set(got["xml_excerpts_by_xml_index"]) == {"1", "2", "3"}
    rows = spark.createDataFrame([("Treasury", "Mint"), ("TREASURY ", "mint"), ("War", None), (None, None)], "Agency string, Bureau string")
    assert [corrections.add_agencies(spark, out, rows) for _ in range(2)] == [2, 0]


def test_workspace_files(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "list.csv").write_text("a")
    assert workspace.bootstrap(f"{tmp_path}/w", f"{tmp_path}/src", ("list.csv",)) == ["list.csv"]
    assert workspace.bootstrap(f"{tmp_path}/w", f"{tmp_path}/src", ("list.csv",)) == []
    with pytest.raises(FileNotFoundError):
        workspace.bootstrap(f"{tmp_path}/w", f"{tmp_path}/src", ("none.csv",))
    for mode, volumes_ in (("Mode = Range\nVolumeRange = 70-72", [70, 71, 72]), ("Mode = Selected\nVolumeNumber = 70, 75", [70, 75])):
        (tmp_path / "c.conf").write_text(f"[Dataset]\n{mode}\n[Appropriations]\ndatapath = in\noutputdir = out\n")
        assert workspace.Settings.read(f"{tmp_path}/c.conf") == workspace.Settings(volumes_, "in", "out")
    entry = lambda name, when, folder="true": f"<file><displayLabel>{name}</displayLabel><formattedLastModifiedTime>{when}</formattedLastModifiedTime><folder>{folder}</folder></file>"
    listing = f"<data>{entry(99, 'a')}{entry(137, 'b')}{entry(99, 'a')}{entry('zip', 'c')}{entry(3, 'd', 'false')}</data>".encode()
    index = workspace.index_rows(listing)
    assert index == [(137, "b"), (99, "a")]
    there = spark.createDataFrame([(99,)], "vol int")
    assert [r.vol for r in workspace.to_fetch(spark.createDataFrame(index, "vol int, at string"), there).collect()] == [137]
    t = spark.createDataFrame([(1, "Section", "A", "t", "x"), (1, "Section", "B", "t", "y"), (1, "Division", "A", "t", "z")], "vol int, EntryType string, LawIdentifier string, LawTitle string, Text string")
    assert sorted((r.LawIdentifier, r.isAppropriation) for r in workspace.appropriation_laws(t).collect()) == [("A", True), ("B", False)]
    full = publish.final(t).withColumn("vol", F.lit(1))
    workspace.write_older(full, f"{tmp_path}/older")
    workspace.write_older(full.where("LawIdentifier is not null"), f"{tmp_path}/older", keyed=False)
    assert len(workspace.older_columns(full).columns) == 23 and len(workspace.older_columns(full, keyed=False).columns) == 19
    assert spark.read.parquet(f"{tmp_path}/older").count() == 3
    assert workspace.keys_first(full.select("vol", "KeyVersion", "Text", "UniqueKey")).columns == ["UniqueKey", "KeyVersion", "vol", "Text"]
    new = corrections.refresh_keys(full.withColumn("OriginalOrder", F.monotonically_increasing_id()), workspace.empty_dictionary(spark), version="v2")
    assert new.columns[:2] == ["UniqueKey", "KeyVersion"] and new.select("UniqueKey").distinct().count() == 3


def test_compat_repeats_what_chapters_stand_beside():
    title = f"<title><num>TITLE I</num><level>{SEC.format(1)}</level>{SEC.format(2)}{division('H')}<chapter><num>CHAPTER 1</num></chapter><part><chapter><num>CHAPTER 2</num></chapter></part></title>"
    body = f"<division><num>DIVISION A</num>{title}</division>"
    plain = walk(body, strict=True)
    assert [(r["Chapter"], r["SectionNumber"], r["DivisionHeadingLevel1"]) for r in plain] == [(None, "2", None), (None, None, "H"), (None, "1", None)]
    again = [(r["Division"], r["Title"], r["Chapter"], r["SectionNumber"], r["DivisionHeadingLevel1"]) for r in walk(body, compat=True)[len(plain):]]
    assert again == [("DIVISION A", "TITLE I", f"CHAPTER {n}", *x) for n in (1, 2) for x in (("1", None), ("2", None), (None, "H"))]


def test_reports_name_columns_and_numbers(spark):
    t = spark.createDataFrame([(98, f"98–369-{i}", "Section", "98–369", "t", "Value of used components furnished by first user", f"SEC. {i}.", "x", 0) for i in range(5)], "vol int, UniqueKey string, EntryType string, LawIdentifier string, LawTitle string, SectionName string, SectionNumber string, Text string, Selection int")
    r = validate.report(validate.measures(t, ["vol"]), columns=[*publish.FINAL_COLUMNS[1:], "more"]).first()
    assert "missing columns: UniqueKey" in r.failed and "extra columns: more" in r.warnings
    assert any(x.endswith("should be SEC. 734., not SEC. 0., SEC. 1., SEC. 2.") for x in r.failed)
    whole = validate.report(validate.measures(t, ["vol"]), columns=publish.FINAL_COLUMNS).first()
    assert "missing_columns" in whole.passed and "extra_columns" in whole.passed


def test_older_letter_codes(spark):
    df = spark.createDataFrame([("Division B",), ("b",), ("DIVISION",), ("7",), (None,), (" ",)], "c string")
    assert [r.x for r in df.select(codes.first_letter_code(F.col("c"), "DIVISION").alias("x")).collect()] == ["002", "002", "004", "000", "000", "000"]


def test_states_of_implementation(spark):
    reg = workspace.Registry(spark, "/nowhere")
    t = reg.table([{"id": 1, "type": "law_id", "status": "approved"}, {"id": 2, "type": "other", "status": "approved"}, {"id": 3, "type": "other", "status": "pending"}, {"id": 4, "type": "other", "status": "approved", "implementation_status": "manual_override"}])
    filled = registry.backfill(t)
    assert [r.implementation_status for r in filled.orderBy("id").collect()] == ["not_required", "pending", "pending", "manual_override"]
    assert [r.id for r in registry.applied(filled).orderBy("id").collect()] == [1, 4]
    grown = enrich.grow_dictionary(workspace.empty_dictionary(spark), spark.createDataFrame([(2, "b"), (1, "c"), (2, "a"), (1, "B ")], "vol int, term string"))
    assert {r.term: r.id for r in grown.collect()} == {"b": 1, "c": 2, "a": 3}
