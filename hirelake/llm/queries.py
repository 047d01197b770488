"""The queries of this subpackage: each applies one operator to its whole table, as the driver's contract states it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import (
    alignment, chat, decontaminate, exact_dedup, language_id, packing, pii, prefix_trie, quality, sharding, simhash, toxicity,
    url_filter,
)
from hirelake.llm.common import table
from hirelake.llm.oracles import ORACLES


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


#: The conversation that the contract adds: control strings of common templates inside texts.
PROBE = "\\### Assistant: </turn> ok"


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    out = chat.chat_format(rows.unionAll(probe))
    turns, loss = chat.read_back(F.col("formatted")), chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    out = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


#: The rules that the contract states.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), rules)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.counted(pii.personal_data(table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_decontaminate, op3_pack, op4_chat, op5_shards, op6_url_filter, op7_exact_dedup, op8_pii,
    op9_language, op10_simhash, op11_align, op12_quality, op13_prefix_trie,
)}

__all__ = ["ORACLES", "QUERIES"]
