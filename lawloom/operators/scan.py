"""Running counts and sums within keys of any size, for tables that one task could not hold.

A window function puts all rows of a key into one task. Here rows are dealt by ranges of (keys, order), so a key with
most of the rows is spread over many tasks; each task runs over its own rows, and what a key has in earlier tasks is
carried in one small row for each task.

Defined results: null keys are a key of their own; null values count as zero; rows that tie in the order get different
counts in any order, and share a task, so give the order a last column that differs where many rows may tie; an empty
table gives an empty one; columns of any name pass.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEPS = {"sum": (np.add.accumulate, np.subtract), "xor": (np.bitwise_xor.accumulate, np.bitwise_xor)}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints; a temporary one only in local mode, where it is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lawloom-checkpoint-"))
    return sc.getCheckpointDir()


def at_rest(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint: its partitions stay as they are, whatever reads them and however often."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _changes(batch: pa.RecordBatch, keys: list[str], last: list) -> np.ndarray:
    """Whether each row's key differs from the row's before; ``last`` holds the keys of the row before the batch."""
    new = np.zeros(batch.num_rows, bool)
    for n, k in enumerate(keys):
        col = batch[k]
        before = pa.concat_arrays([last[n], col[:-1]]) if last else pa.concat_arrays([col[:1], col[:-1]])
        differ = pc.fill_null(pc.not_equal(col, before), False).to_numpy(zero_copy_only=False)
        new |= differ | (col.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))
    if not last:
        new[0] = True
    return new


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of ``df`` has, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def running(df: DataFrame, keys: list[str], order: list[Column], *, count: str | None = None, sums: dict[str, str] | None = None, xors: dict[str, str] | None = None) -> DataFrame:
    """``df`` with running totals within ``keys`` in ``order``, each row's own value included.

    ``count`` names a column of row numbers from 1; ``sums`` and ``xors`` give new columns by name, of whole-number
    columns. Rows stay in the order of keys and order, over partitions and within them. One shuffle, whatever the keys'
    sizes; the result is at rest.
    """
    if not keys:
        df = df.withColumn(key := free_names(df, "__all")[0], F.lit(0))
        return running(df, [key], order, count=count, sums=sums, xors=xors).drop(key)
    asked = [(count, None, "sum")] if count else []
    asked += [(n, c, "sum") for n, c in (sums or {}).items()] + [(n, c, "xor") for n, c in (xors or {}).items()]
    part, head, edge = free_names(df, "__part", "__head", "__edge")
    by = [*(F.col(f"`{k}`") for k in keys), *order]
    sorted_rows = df.repartitionByRange(*by).sortWithinPartitions(*by)

    def run(batches: Iterable[pa.RecordBatch]):
        here, last, totals, keyed, held = TaskContext.get().partitionId(), [], [0] * len(asked), 0, None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                yield held
            new = _changes(b, keys, last)
            starts = np.flatnonzero(new)
            segment = np.cumsum(new)  # 0: the key of the batch before goes on
            out = []
            for n, (_, column, kind) in enumerate(asked):
                accumulate, undo = _STEPS[kind]
                values = np.ones(b.num_rows, np.int64) if column is None else pc.fill_null(b[column].cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                along = accumulate(values)
                before = np.concatenate([[0], along[:-1]])[starts]
                base = np.concatenate([[(0 - totals[n]) if kind == "sum" else totals[n]], before]).astype(np.int64)
                got = undo(along, base[segment])
                totals[n] = int(got[-1])
                out.append(pa.array(got, pa.int64()))
            first = keyed + segment <= 1
            keyed += int(segment[-1])
            edges = np.zeros(b.num_rows, np.int8)
            edges[0] = held is None
            last = [b[k][-1:] for k in keys]
            held = pa.RecordBatch.from_arrays([*b.columns, *out, pa.array([here] * b.num_rows, pa.int32()), pa.array(first), pa.array(edges)], [*b.schema.names, *(n for n, _, _ in asked), part, head, edge])
        if held is not None:
            edges = held[edge].to_numpy(zero_copy_only=False).copy()
            edges[-1] += 2
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.array(edges)], held.schema.names)

    long = T.LongType()
    schema = T.StructType([*sorted_rows.schema.fields, *(T.StructField(n, long) for n, _, _ in asked), T.StructField(part, T.IntegerType()), T.StructField(head, T.BooleanType()), T.StructField(edge, T.ByteType())])
    placed = at_rest(sorted_rows.mapInArrow(run, schema))

    # at most two small rows for each task
    names, kinds = [n for n, _, _ in asked], [kind for _, _, kind in asked]
    ends = placed.where(F.col(edge) > 0).select(part, edge, head, F.struct(*(F.col(f"`{k}`") for k in keys)).alias("key"), F.struct(*(F.col(f"`{n}`") for n in names)).alias("totals")).collect()
    firsts = {r[part]: tuple(r["key"]) for r in ends if r[edge] & 1}
    lasts = {r[part]: (tuple(r["key"]), r[head], tuple(r["totals"])) for r in ends if r[edge] & 2}
    before = carried(firsts, lasts, kinds)
    plain = placed.drop(edge)
    if before:
        more = free_names(plain, *(f"__more{i}" for i in range(len(names))))
        fields = [T.StructField(part, T.IntegerType()), *(T.StructField(m, long) for m in more)]
        small = df.sparkSession.createDataFrame([(p, *x) for p, x in before.items()], T.StructType(fields))
        plain = plain.join(F.broadcast(small), part, "left")
        for n, kind, m in zip(names, kinds, more):
            add = F.when(F.col(head), F.coalesce(F.col(m), F.lit(0))).otherwise(0).cast("long")
            plain = plain.withColumn(n, F.col(f"`{n}`") + add if kind == "sum" else F.col(f"`{n}`").bitwiseXOR(add))
    return plain.select(*(F.col(f"`{c}`") for c in [*df.columns, *names]))


def carried(firsts: dict[int, tuple], lasts: dict[int, tuple[tuple, bool, tuple]], kinds: list[str]) -> dict[int, tuple]:
    """What the first key of each partition has in earlier ones: partition -> totals, where there is something.

    ``firsts`` has the first row's key of each partition; ``lasts`` the last row's key, whether that is the first key
    too, and its totals within the partition.
    """
    out: dict[int, tuple] = {}
    was: tuple[tuple, tuple] | None = None  # the key before, and its totals so far
    for p in sorted(firsts):
        if was and was[0] == firsts[p]:
            out[p] = was[1]
        key, one_key, totals = lasts[p]
        was = key, tuple(_add(a, b, k) for a, b, k in zip(totals, out[p], kinds)) if one_key and p in out else totals
    return out


def _add(a: int, b: int, kind: str) -> int:
    return a ^ b if kind == "xor" else a + b
