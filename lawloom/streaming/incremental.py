"""Incremental runs: volumes whose input is new or changed, as a batch anti-join or as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.functions import ids

BINARY = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def state(old_hash: Column, new_hash: Column, status: Column) -> Column:
    """skip (published from the same input), stale (from another one), or new."""
    return F.when(old_hash.isNull(), "new").when((old_hash == new_hash) & (status == "published"), "skip").when(old_hash != new_hash, "stale").otherwise("new")


def pending(snapshot: DataFrame, seen: DataFrame, *, key: str, digest: str) -> DataFrame:
    """Rows of the snapshot that were not seen with the same digest."""
    return snapshot.join(seen.select(key, digest), [key, digest], "left_anti")


def follow(spark: SparkSession, folder: str, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hand every volume file that has not been handled yet to ``each``, then stop. Handled files are in the checkpoint."""
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "STATUTE-*.xml").load(folder)
    named = files.select(ids.volume_of(F.col("path")).alias("vol"), "path", "content", F.sha2("content", 256).alias("sha256"))
    named.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def grow(spark: SparkSession, stream: DataFrame, checkpoint: str, path: str) -> None:
    """Append a stream's new terms to a dictionary table: term, id in the order of arrival, then of the alphabet."""
    from lawloom.operators.enrich import grow_dictionary

    def each(batch: DataFrame, n: int) -> None:
        known = spark.read.schema("term string, id long").parquet(path)
        grown = grow_dictionary(known, batch.select("term"))
        grown.join(known, "term", "left_anti").write.mode("append").parquet(path)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
