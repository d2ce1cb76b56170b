"""The subpackage's queries, by the names under which ``__spark_entry__`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import bpe, chat, covertree, decontam, fim, html, linededup, lm, packing, prefixtrie, quality, simhash, toxicity
from lawloom.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_corpus(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    packed, members = chat.format_conversations(rows, tokenizer_path())
    return chat.digest(chat.read_back(packed, members, tokenizer_path()))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("keep", F.col("tail_probability") >= quality.KEEP)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), where=~toxicity.is_held_out())
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.is_held_out().alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return clean.select("doc_id", "n_lines", "n_deleted", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.group_by_simhash(table(spark, sf_dir, "documents"), k=4)
    return g.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path()), tokenizer_path())
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return said.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"), every=100, modulus=6)


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), seed=1, rate=90, spm_rate=20)
    again = fim.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontamination, op2_topk, op3_lm, op4_chat, op5_quality, op6_toxicity, op7_packing, op8_linededup, op9_simhash, op10_html, op11_bpe, op12_prefixtrie, op13_fim)}


def oracle_sql() -> dict[str, str]:
    from lawloom.llm import oracles

    return oracles.SQL
