"""Union, distinct, order and sample of extracted rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.functions import ids, text
from lawloom.operators.scan import free_names, running

# Rows that are never drawn.
EXCLUDED_NAMES = ("sense of congress.", "sunset.", "severability.", "short title.", "table of contents.", "short title; table of contents.")
EXCLUDED_TITLES = ("providing for congressional disapproval under chapter 8 of title 5",)
SAMPLE = 600
SEED = 42


def union_tagged(tagged: dict[str, DataFrame], column: str = "EntryType") -> DataFrame:
    """All rows of several tables, each with its tag; columns that one lacks are null."""
    out = None
    for tag, df in tagged.items():
        part = df.withColumn(column, F.lit(tag))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def distinct_first(df: DataFrame, content: list[str], order: list[Column]) -> DataFrame:
    """Of rows with equal content, the first in the given order.

    The order's columns and a hash of the content are what is shuffled by; a content that many rows share is reduced
    before the shuffle.
    """
    first = Window.partitionBy(*content).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def with_order(df: DataFrame, keys: list[str], order: list[Column], name: str = "OriginalOrder") -> DataFrame:
    """Row numbers within each key, from 1, for keys of few rows each, such as a law. ``numbered`` is for larger ones."""
    if not keys:
        raise ValueError("number rows within a key, such as vol")
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "OriginalOrder") -> DataFrame:
    """Row numbers within each key, from 1, for keys of any size: no task holds a whole key.

    Rows that tie in the order are told apart by a hash of all their columns, so the numbers are the same on any cluster
    (but for rows that are equal throughout). Null keys are a key of their own; an empty table gives an empty one.
    """
    return running(df, keys, [*order, F.xxhash64(*_told_apart(df))], count=name)


def _told_apart(df: DataFrame) -> list[Column]:
    """All columns for a hash; a null in one column is not a null in the next."""
    return [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]


def law_order(number: Column | None = None) -> list[Column]:
    """Law number (of the identifier, if no column has it), then place in the law; without a number last; sections before divisions where both tie."""
    number = ids.number(F.col("LawIdentifier")) if number is None else number
    return [number.asc_nulls_last(), F.col("counter"), F.col("EntryType").desc(), F.col("xml_index")]


def eligible(name: str = "SectionName", title: str = "LawTitle") -> Column:
    return ~F.lower(text.strip(F.coalesce(F.col(name), F.lit("")))).isin(*EXCLUDED_NAMES) & ~text.any_contains(F.col(title), EXCLUDED_TITLES)


def sample(df: DataFrame, *, keys: list[str], id_column: str, n: int = SAMPLE, seed: int = SEED, where: Column | None = None) -> DataFrame:
    """Selection (1 for n rows of each key, drawn without replacement) and Order (their order of presentation).

    Rows are drawn by the order of a hash of seed and id, so the draw is the same on any machine and in any engine.
    Only drawn rows' ids go through the second shuffle.
    """
    own = F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))
    drawn = df if where is None else df.where(where)
    w = Window.partitionBy(*keys).orderBy(F.md5(own), F.col(id_column))
    drawn = drawn.select(*keys, id_column, F.row_number().over(w).alias("__n")).where(F.col("__n") <= n).drop("__n")
    shown = Window.partitionBy(*keys).orderBy(F.md5(F.concat(F.lit("order:"), F.lit(f"{seed}:"), F.col(id_column).cast("string"))), F.col(id_column))
    drawn = drawn.withColumn("Order", F.row_number().over(shown)).withColumn("Selection", F.lit(1))
    return df.drop("Selection", "Order").join(drawn, [*keys, id_column], "left").withColumn("Selection", F.coalesce("Selection", F.lit(0)))


def draw_like_numpy(n_eligible: int, n: int = SAMPLE, seed: int = SEED) -> list[tuple[int, int]]:
    """(position among the eligible rows, order) as numpy's legacy generator draws them; for tables drawn that way before."""
    import numpy as np

    state = np.random.RandomState(seed)
    size = min(n, n_eligible)
    chosen = state.choice(n_eligible, size, replace=False)
    return list(zip(chosen.tolist(), state.permutation(range(1, size + 1)).tolist()))


def sample_like_numpy(df: DataFrame, *, keys: list[str], order: list[Column], n: int = SAMPLE, seed: int = SEED, where: Column | None = None) -> DataFrame:
    """Selection and Order as tables have them that numpy's legacy generator drew, each key anew from the seed.

    A row's place among its key's rows that may be drawn is a running sum, so a key of any size is ranked by many tasks;
    a key's draw needs no more than the number of those rows and is made in a task of its own (numpy shuffles all
    places: 8 bytes a row of the key there). Rows that tie in the order are settled by a hash of all their columns.
    Rows that may not be drawn have Selection 0 and no Order; null keys are a key of their own.
    """
    df = df.drop("Selection", "Order")
    may, place, row, here, *own = free_names(df, "__may", "__place", "__row", "__here", *(f"__key{i}" for i in range(len(keys))))
    allowed = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    placed = running(df.withColumn(may, allowed.cast("long")), keys, [*order, F.xxhash64(*_told_apart(df))], count=row, sums={place: may})
    counts = placed.groupBy(*(F.col(f"`{k}`").alias(o) for k, o in zip(keys, own))).agg(F.sum(may).alias("n"))

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, size in enumerate(b["n"].to_pylist()):
                got = draw_like_numpy(size, n, seed)
                key = b.take(pa.array([i] * len(got), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(key[o] for o in own), pa.array([at + 1 for at, _ in got], pa.int64()), pa.array([x for _, x in got], pa.int32())], [*own, here, "Order"])

    fields = [*(T.StructField(o, placed.schema[k].dataType) for k, o in zip(keys, own)), T.StructField(here, T.LongType()), T.StructField("Order", T.IntegerType())]
    drawn = counts.mapInArrow(draw, T.StructType(fields))
    # rows that may not be drawn look for places that nobody has, each for its own, so that they do not meet in one task
    looked = F.when(F.col(may) == 1, F.col(place)).otherwise(-F.col(row))
    met = F.col(here) == F.col(place)
    for k, o in zip(keys, own):
        met &= F.col(f"`{k}`").eqNullSafe(F.col(o))
    out = placed.withColumn(place, looked).join(drawn, met, "left")
    return out.select(*(F.col(f"`{c}`") for c in df.columns), F.col("Order"), F.when(F.col("Order").isNull(), 0).otherwise(1).alias("Selection"))


def build(rows: DataFrame) -> DataFrame:
    """Extracted rows without repeats, numbered within their volume. A volume may hold most of the rows."""
    content = [c for c in rows.columns if c not in ("counter", "xml_index", "error")]
    fine = rows.where("error is null").drop("error")
    first = distinct_first(fine, content, [F.col("xml_index"), F.col("counter")])
    (at,) = free_names(first, "__number")
    return numbered(first.withColumn(at, ids.number(F.col("LawIdentifier"))), ["vol"], law_order(F.col(at))).drop(at)
