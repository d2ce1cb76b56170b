"""A training corpus from raw documents: selected, without repeated lines, near copies and benchmark text, packed.

Each stage reads what its predecessor wrote. Part of the llm subpackage.

Defined results: null and empty texts pass the stages like any others (the near-dedup keeps one of them) and are packed
as the end id alone; texts of any length are read whole; of equal documents the one of the least doc_id stays, and rows
that repeat an id are settled by their own texts; an empty table gives no piece; other columns stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lawloom.llm import decontam, linededup, packing, quality, simhash
from lawloom.llm.common import remove, shared_folder, table
from lawloom.llm.queries import tokenizer_path


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject."""
    return quality.select(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones have."""
    return linededup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op9's links reach: fingerprints of four-word shingles at 4 or fewer differing bits."""
    return simhash.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids (little-endian, unsigned, 32 bits) and their place in the sequences."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", select_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result but the last is written to the shared folder and read again.

    What a stage wrote is removed when the next one is done with it; the last one's result is read from checkpoints.
    """
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    out = STAGES[-1][1](spark, docs, sf_dir)
    remove(spark, folder)
    return out
