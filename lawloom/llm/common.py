"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; make one of our own only in local mode, where it is unset."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lawloom-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint: computed once, read again after an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder in any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of ``df`` has, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return column.cast(pa.binary()).to_pylist()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_of_each(docs: DataFrame, group: DataFrame, with_node: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One row of each group, of the least doc_id. An id with texts of several groups is settled in each of them.

    ``group`` has doc_id, node (what stands for a row's text), component_id (the group's least doc_id) and root (a node
    that names the group); ``with_node`` adds the node to rows under a given name.
    """
    key, own = fresh(docs, "key", "own")
    group = cut(group.withColumnsRenamed({"doc_id": key, "node": own}))
    copies = cut(group.where(F.col(key) != F.col("component_id")).select(key).distinct())
    repeated = cut(group.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.col(key).isNotNull()).select(key))
    docs = docs.withColumn(key, F.col("doc_id").cast("long"))
    if repeated.isEmpty():
        return docs.join(copies, key, "left_anti").select(*(c for c in docs.columns if c != key))
    first = group.join(repeated, key, "left_semi").where(F.col(key) == F.col("component_id")).groupBy(key, "root").agg(F.min(own).alias(own)).select(key, own)
    some = with_node(docs.join(repeated, key, "left_semi"), own)
    once = some.join(first, [key, own], "left_semi").dropDuplicates([key, own]).drop(own)
    others = docs.join(repeated.unionByName(copies).distinct(), key, "left_anti")
    # joins by a name put that first
    return others.unionByName(once).select(*(c for c in docs.columns if c != key))
