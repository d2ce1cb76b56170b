import xml.etree.ElementTree as ET

from lawloom.functions import ids
from lawloom.operators import passes
from lawloom.plans import pipeline
from lawloom.sources import markup, volumes
from pyspark.sql import functions as F

NS = "http://schemas.gpo.gov/xml/uslm"


def law(body, cited="Public Law 99-911", more=""):
    return f"<pLaw><publicPrivate>public</publicPrivate>{more}<citableAs>{cited}</citableAs><approvedDate>1964-07-07</approvedDate><officialTitle>Test Act</officialTitle><docTitle>AN ACT</docTitle><main>{body}</main></pLaw>"


def volume(*laws):
    return f'<uslm xmlns="{NS}">\n' + "\n".join(laws) + "\n</uslm>"


def walk(body, vol=114, law_id="Public Law 99-911", **more):
    root = ET.fromstring(volume(law(body)))
    meta = {"law_id": law_id, "approved_date": "d", "official_title": "t", "doc_title": "a"}
    return markup.Walker(**more).law(root[0], vol, 0, meta).rows


SEC = "<section><num>{0}</num><heading> Head</heading><content>Text {0}</content></section>"


def test_sections_with_outline_and_skipped_text():
    rows = walk("<section><num>SEC. 1. <sidenote>gone</sidenote></num><heading>Name</heading><chapeau>Lead:</chapeau><paragraph><num>(1) </num><content>one<footnote>f</footnote> more</content><continuation>after</continuation></paragraph></section>")
    assert [(r["SectionNumber"], r["SectionName"]) for r in rows] == [("SEC. 1.", "Name")]
    assert rows[0]["Text"] == "Lead:\n    (1) one more  after"


def test_containers_and_labels():
    rows = walk(f"<division><num>DIVISION A</num><title><num>TITLE I</num><subtitle><num>SUBTITLE B</num><level>{SEC.format(1)}</level></subtitle>{SEC.format(2)}</title></division><title><num>TITLE II</num><part><chapter><num>CHAPTER 3</num>{SEC.format(3)}</chapter></part></title>")
    got = [(r["Division"], r["Title"], r["SubTitle"], r["Chapter"], r["SectionNumber"]) for r in rows]
    assert sorted(got, key=str) == sorted([("DIVISION A", "TITLE I", None, None, "2"), ("DIVISION A", "TITLE I", "SUBTITLE B", None, "1"), (None, "TITLE II", None, "CHAPTER 3", "3")], key=str)
    assert [r["counter"] for r in rows] == [0, 1, 2]


def test_strict_walks_only_known_paths():
    body = f"<title><num>TITLE I</num><part>{SEC.format(1)}</part>{SEC.format(2)}</title>"
    assert [r["SectionNumber"] for r in walk(body, strict=True)] == ["2"]
    assert sorted(r["SectionNumber"] for r in walk(body)) == ["1", "2"]


def test_nested_appropriations():
    rows = walk("<appropriations><heading>A</heading><subheading>sub</subheading><appropriations><heading>B</heading><appropriations><heading>C</heading><content>money</content></appropriations></appropriations><appropriations><heading>D</heading><content><p>more</p></content></appropriations></appropriations>")
    assert [(r["DivisionHeadingLevel1"], r["DivisionHeadingLevel2"], r["DivisionHeadingLevel3"], r["Text"]) for r in rows] == [("A sub", "B", "C", "money"), ("A sub", "D", None, "more")]
    assert {r["EntryType"] for r in rows} == {"Division"}


def test_recovery():
    part = f"<part><num>PART I</num><heading>—X</heading>{SEC.format(1)}{SEC.format(2)}</part>"
    assert [(r["DivisionHeadingLevel1"], r["SectionNumber"]) for r in walk(part)] == [("PART I—X", "1"), ("PART I—X", "2")]
    subs = walk("<subsection><num>(a)</num><content> x</content></subsection><subsection><num>(b)</num><content> y</content></subsection>")
    assert [(r["SectionNumber"], r["Text"]) for r in subs] == [("1", "(a) x\n(b) y")]
    assert [r["Text"] for r in walk("<quotedContent> quoted </quotedContent>")] == ["quoted"]
    assert [r["Text"] for r in walk("<p>one</p><content>two</content>")] == ["one\ntwo"]
    money = walk("<chapter><num>CHAPTER I</num><appropriations><heading>H</heading><content>m</content></appropriations><appropriations><heading>K</heading><content>n</content></appropriations></chapter>")
    assert [(r["EntryType"], r["DivisionHeadingLevel1"], r["DivisionHeadingLevel2"], r["Text"]) for r in money] == [("Section", "CHAPTER I", "H", "m"), ("Section", "CHAPTER I", "K", "n")]
    assert len(walk(SEC.format(1) + part)) == 1  # a law with rows is not recovered


def test_special_laws():
    two = "<section><content>That a</content></section><section><quotedContent>q</quotedContent></section>"
    assert [(r["SectionNumber"], r["Text"]) for r in walk(two, vol=75, law_id="Public Law 87–292")] == [("1", "That a"), ("2", "q")]
    parts = f"<title><num>TITLE I</num><part><num>PART A</num>{SEC.format(7)}</part></title>"
    assert [(r["DivisionHeadingLevel1"], r["DivisionHeadingLevel2"]) for r in walk(parts, vol=78, law_id="Public Law 88–643")] == [("TITLE I", "PART A")]


def files(spark, tmp_path, **volumes_):
    for name, content in volumes_.items():
        (tmp_path / f"STATUTE-{name[1:]}.xml").write_text(content)
    return volumes.volume_files(spark, str(tmp_path))


def test_laws_of_files(spark, tmp_path):
    good = volume(law(SEC.format(1)), law(SEC.format(2), cited="75 Stat. 1", more="<docNumber>7</docNumber><congress>99</congress>"), law("").replace(">public<", ">private<"))
    df = files(spark, tmp_path, v99=good, v98="<uslm><pLaw>", v97=volume(law(SEC.format(1)).replace("<approvedDate>1964-07-07</approvedDate>", "")))
    laws = volumes.read_laws(df)
    by = {(r.vol, r.xml_index): r for r in laws.collect()}
    assert (by[99, 1].first_line, by[99, 1].last_line, by[99, 1].tag_path) == (3, 3, "uslm/pLaw")
    assert by[98, None].error.startswith("parse_failed") if (98, None) in by else any(r.error for r in by.values())
    public = volumes.identified(laws.where("error is null"))
    assert sorted((r.vol, r.law_id) for r in public.collect()) == [(97, "Public Law 99-911"), (99, "Public Law 99-7"), (99, "Public Law 99-911")]
    rows = volumes.law_rows(public).collect()
    assert sorted(str(r.SectionNumber) for r in rows if not r.error) == ["1", "2"]
    assert [r.vol for r in rows if r.error] == [97]
    seq = volumes.sequence(laws).where("vol = 99").orderBy("xml_index").collect()
    assert [(r.law_number, r.is_public) for r in seq] == [(911, True), (7, True), (911, False)]
    assert seq[0].tag_path == "uslm/pLaw"


def rows_of(spark, records):
    names = ["vol", "xml_index", "counter", "LawIdentifier", "EntryType", "Title", "SubTitle", "Chapter", "SubChapter", "SectionNumber", "DivisionHeadingLevel1", "DivisionHeadingLevel2", "DivisionHeadingLevel3"]
    kinds = ["int", "int", "long"] + ["string"] * 10
    return spark.createDataFrame([tuple(r.get(n, {"vol": 1, "xml_index": 0, "LawIdentifier": "L", "EntryType": "Section"}.get(n)) for n in names) for r in records], ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def test_passes(spark):
    numbers = [None, None, "1", "2", "1", "2", "3"]
    df = rows_of(spark, [{"counter": i, "SectionNumber": n, "Title": "TITLE IV" if i > 2 else None} for i, n in enumerate(numbers)])
    got = [(r.SectionNumber, r.SubTitle) for r in passes.repair(df).orderBy("counter").collect()]
    assert got == [("U1", None), ("U2", None), ("1", None), ("2", None), ("1", None), ("2", "B"), ("3", "B")]
    alone = rows_of(spark, [{"counter": 0}, {"counter": 1, "SectionNumber": "2"}])
    assert [r.SectionNumber for r in passes.repair(alone).orderBy("counter").collect()] == [None, "2"]
    heads = rows_of(spark, [{"counter": i, "EntryType": "Division", "DivisionHeadingLevel1": a, "DivisionHeadingLevel2": b} for i, (a, b) in enumerate([("Senate", None), ("SENATE", None), ("Senate", "x"), ("Senate", None), ("senate", "X")])])
    assert [(r.DivisionHeadingLevel1, r.DivisionHeadingLevel2) for r in passes.repair(heads).orderBy("counter").collect()] == [("Senate", None), ("SENATE 2", None), ("Senate", "x"), ("Senate 3", None), ("senate", "X 2")]


def test_block_ordinals_equal_a_model(spark):
    import random

    r = random.Random(1)
    data = [(g, p, r.choice("abcd")) for g in range(40) for p in range(r.randint(1, 12))]
    want = {}
    for g in range(40):
        seen, block = set(), 0
        for _, p, s in (x for x in data if x[0] == g):
            if s in seen:
                block, seen = block + 1, {s}
            seen.add(s)
            want[g, p] = block
    df = spark.createDataFrame(data, "g int, p int, s string")
    got = {(x.g, x.p): x.block for x in passes.block_ordinals(df, group=["g"], suffix=F.col("s"), position="p").collect()}
    assert got == want


def test_malformed_ids(spark):
    df = spark.createDataFrame([("Public Law 102–v", "102", "23"), ("Public Law 102߬23", "102", "23"), ("Public Law 102–5", "102", "23"), ("x", None, None)], "i string, c string, d string")
    got = [r.x for r in df.select(ids.repair(F.col("i"), F.col("c"), F.col("d")).alias("x")).collect()]
    assert got == ["Public Law 102-23", "Public Law 102-23", "Public Law 102–5", "x"]


def test_whole_run(spark, tmp_path):
    from lawloom.sources import publish

    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    body = SEC.format(1) + SEC.format(2) + "<appropriations><heading>Senate</heading><content>pay the treasury</content></appropriations>"
    files(spark, src, v114=volume(law(body), law(SEC.format(1), cited="Public Law 99-912")), v113="<broken")
    run = pipeline.process(spark, str(src), [112, 113, 114], agencies=["treasury"], version="v1", n=2, scratch=str(tmp_path / "scratch"))
    assert run.status == {112: "missing_xml", 113: "parse_failed", 114: "ready_for_publish"} and run.exit_code() == 1
    rows = run.table.orderBy("OriginalOrder").collect()
    assert [r.UniqueKey for r in rows] == ["099-911-000-000-000-000-000-S-000000000000001", "099-911-000-000-000-000-000-S-000000000000002", "099-911-000-000-000-000-000-D-00001-00001-00001", "099-912-000-000-000-000-000-S-000000000000001"]
    assert [r.Agencies_Row for r in rows] == [None, None, ["treasury"], None]
    assert [r.Agencies_Law for r in rows] == [["treasury"]] * 3 + [[]]
    assert [r.IsAppropriation for r in rows] == [True] * 3 + [False]
    assert sum(r.Selection for r in rows) == 2 and sorted(r.Order for r in rows if r.Selection) == [1, 2]
    manifest = publish.Manifest(str(out / "manifest.json"))
    manifest.refresh(volumes.volume_files(spark, str(src)))
    publish.publish(run.table, str(out / "t"), volumes=[114], manifest=manifest, run_ts="now")
    back = spark.read.parquet(str(out / "t"))
    assert [c for c in back.columns if c != "vol"] == publish.FINAL_COLUMNS and back.count() == 4
    assert {r.LawIdentifier for r in back.collect()} == {"Public Law 99–911", "Public Law 99–912"}
    import pytest

    with pytest.raises(publish.FrozenError):
        publish.publish(run.table, str(out / "t"), volumes=[114], manifest=manifest, run_ts="now")
    publish.publish(run.table, str(out / "t"), volumes=[114], manifest=manifest, run_ts="now", force=True)
    assert publish.Manifest(manifest.path).to_do([113, 114]) == [113]
    (src / "STATUTE-114.xml").write_text(volume(law(SEC.format(9))))
    manifest.refresh(volumes.volume_files(spark, str(src)))
    assert manifest.volumes["114"]["status"] == "stale"
    publish.unpublish(spark, str(out / "t"), 114, manifest)
    assert publish.published_volumes(spark, str(out / "t")) == set()


def test_volumes_of_one_partition_are_parsed_by_several_tasks(spark):
    xml = '<uslm><pLaw><publicPrivate>public</publicPrivate><citableAs>Public Law 99-1</citableAs><approvedDate>d</approvedDate><main><section><num>1</num><content>t</content></section></main></pLaw></uslm>'
    files = spark.createDataFrame([(n, xml.encode()) for n in range(64, 264)], "vol int, content binary").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laws = volumes.read_laws(files)
        assert laws.select(F.spark_partition_id()).distinct().count() > 1
        assert laws.count() == 200
        assert volumes.law_rows(volumes.identified(laws)).where("Text = 't'").count() == 200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_are_batched_by_number_and_length():
    arrow = volumes._arrow(volumes.LAWS)
    sizes = lambda texts: [b.num_rows for b in volumes._in_batches(({"vol": 1, "xml": t} for t in texts), arrow, 3, 10)]
    assert sizes([None] * 7) == [3, 3, 1] and sizes(["x" * 9, "xx", "", "x" * 30]) == [2, 2] and sizes([]) == []
