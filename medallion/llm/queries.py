"""One query per operator over its whole table, with equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import chat, flatgraph, gnat, minmax, mixing, pii, planes, seeds, suffixes, topk, toxicity, warc, whitening
from medallion.llm.oracles import ORACLES  # noqa: F401
from medallion.llm.tokens import tokenizer_file
from medallion.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], given.schema)
    nodes, paths = chat.format_trees(given.unionByName(more), tokenizer_file())
    return chat.read_conversations(nodes, paths, tokenizer_file())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "sentences")


def op3_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("text")


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.token_files(table(spark, sf_dir, "documents"), tokenizer_file())


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.spans(docs, pii.train(docs))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 20)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return gnat.hard_negatives(vectors, F.expr("vec_id % 100 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_trees": op1_chat_trees,
    "op2_toxicity": op2_toxicity,
    "op3_warc_captures": op3_warc_captures,
    "op4_source_mix": op4_source_mix,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_planes": op7_token_planes,
    "op8_pii_spans": op8_pii_spans,
    "op9_exact_topk": op9_exact_topk,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_flat_graph": op12_flat_graph,
    "op13_hard_negatives": op13_hard_negatives,
}
