import random

import pytest
from lawloom.operators.scan import carried, running
from pyspark.sql import functions as F


def truth(rows, order):
    """Row by row: (count, sum, xor) after each row of (key, at, value)."""
    out, state = {}, {}
    for k, at, v in sorted(rows, key=order):
        n, s, x = state.get(k, (0, 0, 0))
        state[k] = n + 1, s + (v or 0), x ^ (v or 0)
        out[k, at] = state[k]
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_equals_one_walk_with_a_key_that_holds_most_rows(spark, partitions):
    r = random.Random(partitions)
    rows = [(r.choice(["big"] * 19 + ["a", "z", None]), at, r.choice([None, r.randint(-(2**40), 2**40)])) for at in range(6000)]
    df = spark.createDataFrame([(*x, "same") for x in rows], "k string, at long, v long, __part string").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running(df, ["k"], [F.col("at").desc()], count="n", sums={"s": "v"}, xors={"x": "v"})
        assert got.columns == [*df.columns, "n", "s", "x"]
        spread = got.where("k = 'big'").select(F.spark_partition_id()).distinct().count()
        assert spread > partitions // 2
        assert {(q.k, q.at): (q.n, q.s, q.x) for q in got.collect()} == truth(rows, lambda x: -x[1])
        assert got.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_keys_two_keys_and_no_rows(spark):
    df = spark.createDataFrame([(i % 3, i % 2, i) for i in range(100)], "a int, b int, i int")
    assert sorted((q.i, q.n) for q in running(df, [], [F.col("i")], count="n").collect()) == [(i, i + 1) for i in range(100)]
    got = running(df, ["a", "b"], [F.col("i")], count="n").collect()
    assert {q.i: q.n for q in got} == {i: i // 6 + 1 for i in range(100)}
    assert running(df.where("i < 0"), ["a"], [F.col("i")], count="n").collect() == []


def test_keys_over_many_partitions_are_carried():
    firsts = {0: ("a",), 1: ("a",), 3: ("a",), 4: ("b",), 5: ("b",)}
    lasts = {0: (("a",), True, (2,)), 1: (("a",), True, (3,)), 3: (("b",), False, (4,)), 4: (("b",), True, (1,)), 5: (("c",), False, (9,))}
    assert carried(firsts, lasts, ["sum"]) == {1: (2,), 3: (5,), 4: (4,), 5: (5,)}
