"""Every query with SQL, against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest
from lawloom.operators import segment
from lawloom.plans import oracles, queries
from lawloom.sources import markup

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return c


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


#: Queries that SQL cannot express; each has a test of its own.
NO_SQL = {"selection_places"}


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - NO_SQL))
def test_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, DIR)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    cur = duck.execute(oracles.SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == names
    assert got == sorted((tuple(plain(r[cols.index(c)]) for c in names) for r in cur.fetchall()), key=str)


def test_entry_points():
    import __spark_entry__ as e

    assert set(queries.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_places_are_those_that_numpy_draws(spark, duck):
    got = queries.queries()["selection_places"](spark, DIR).collect()
    rows = duck.execute(f"select vol, original_order, xml_index from ({oracles.SQL['volume_order']}) order by vol, original_order").fetchall()
    assert sorted((r.vol, r.original_order) for r in got) == [x[:2] for x in rows]
    want = {}
    for vol in {x[0] for x in rows}:
        able = [at for v, at, line in rows if v == vol and line % 3]
        want |= {(vol, able[i]): order for i, order in segment.draw_like_numpy(len(able))}
    assert {(r.vol, r.original_order): r.order_no for r in got if r.selection} == want
    assert all(r.order_no is None for r in got if not r.selection)


def test_strict_closes_paths_that_the_free_walk_opens(spark):
    free, strict = ({r.p_partkey: r for r in queries.queries()[n](spark, DIR).collect()} for n in ("walk_paths", "walk_paths_strict"))
    path = {k: queries.WALK_PATHS[k % len(queries.WALK_PATHS)] for k in free}
    known = {k for k in free if path[k] in markup.STRICT_PATHS["section"]}
    assert {k for k in free if strict.get(k) == free[k]} == known
    assert {path[k] for k in free if k not in strict} == {"division/title/chapter", "division/title/part/chapter"}
    recovered = {(path[k], r.Title, r.Chapter, r.SubChapter, r.DivisionHeadingLevel1, r.DivisionHeadingLevel2) for k, r in strict.items() if k not in known}
    assert recovered == {("title/part", None, None, None, "TITLE 1", "PART 1"), ("title/chapter/subchapter", None, None, None, "TITLE 1", "CHAPTER 1")}
    assert all((strict[k].SectionNumber, strict[k].SectionName, strict[k].Text) == (free[k].SectionNumber, free[k].SectionName, free[k].Text) for k in strict)
