"""Numbers and draws within volumes of which one has nearly all rows."""

import random

import numpy as np
import pytest
from lawloom.operators import segment
from pyspark.sql import Window
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    rows = [(r.choice([64] * 19 + [65, None]), f"Public Law 88-{r.randint(1, 90)}" if r.random() < 0.95 else "no number", r.choice(["Section", "Division"]), r.randint(1, 30), i, f"text {i // 2 if i % 10 == 0 else i}", None) for i in range(8000)]
    return spark.createDataFrame(rows, "vol int, LawIdentifier string, EntryType string, counter long, xml_index long, SectionText string, error string").repartition(6)


def test_numbers_are_those_of_a_window(spark, rows):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = segment.build(rows)
        spread = got.where("vol = 64").select(F.spark_partition_id()).distinct().count()
        plan = got._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "Window" not in plan and spread > 8
    want = segment.distinct_first(rows.drop("error"), ["vol", "LawIdentifier", "EntryType", "SectionText"], [F.col("xml_index"), F.col("counter")])
    want = want.withColumn("OriginalOrder", F.row_number().over(Window.partitionBy("vol").orderBy(*segment.law_order())).cast("long"))
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_ties_are_settled_and_empty_tables_stay_empty(spark, rows):
    tied = rows.select("vol", "xml_index", F.lit(None).cast("string").alias("a"), F.col("SectionText").alias("__may"))
    one = segment.numbered(tied, ["vol"], [F.lit(1)]).orderBy("vol", "OriginalOrder").collect()
    assert one == segment.numbered(tied.repartition(3), ["vol"], [F.lit(1)]).orderBy("vol", "OriginalOrder").collect()
    assert segment.build(rows.limit(0)).count() == 0
    assert segment.sample_like_numpy(rows.limit(0), keys=["vol"], order=[F.col("xml_index")]).count() == 0


@pytest.mark.parametrize("n", [1, 600])
def test_draws_like_numpy_in_every_volume(spark, rows, n):
    may = (F.col("EntryType") == "Section") | F.when(F.col("counter") > 5, False)  # null for some
    got = segment.sample_like_numpy(rows.withColumn("Order", F.lit(9)), keys=["vol"], order=[F.col("xml_index")], n=n, where=may).collect()
    assert len(got) == 8000
    for vol in (64, 65, None):
        own = sorted((r for r in got if r.vol == vol), key=lambda r: r.xml_index)
        able = [r for r in own if r.EntryType == "Section"]
        state = np.random.RandomState(42)
        chosen = state.choice(len(able), min(n, len(able)), replace=False)
        shown = dict(zip((able[i].xml_index for i in chosen), state.permutation(np.arange(1, len(chosen) + 1)).tolist()))
        assert {r.xml_index: r.Order for r in own if r.Selection} == shown
        assert all(r.Order is None for r in own if not r.Selection)
