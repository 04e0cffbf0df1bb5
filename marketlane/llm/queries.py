"""Registered queries of the numbered operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.llm import (
    chat,
    decontamination,
    fill_middle,
    licenses,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    quality,
    secret_scan,
    spelling,
    token_counts,
    url_rules,
)
from marketlane.llm.common import table


def op1_latent_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with the benchmark items it contains, verbatim or paraphrased."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.with_matches(docs, table(spark, folder, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select("doc_id", (F.size(items) > 0).alias("contaminated"), items.alias("item_ids"))


def op2_redirect_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judged(table(spark, folder, "pages"))


def op3_curriculum_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(table(spark, folder, "documents"))


def op4_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    found = neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_randomness_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(table(spark, folder, "documents"))


def op6_license_inheritance(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(table(spark, folder, "documents"))


def op7_typed_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digest(chat.probe(table(spark, folder, "conversations")))


def op8_neighbour_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's quality, learnt from the labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(~quality.held_out())
    out = quality.scored(docs, quality.fit(docs, labels))
    return out.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op9_prefix_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.count_rows(table(spark, folder, "documents"), path)


def op10_bag_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its class of near duplicates, named by its least doc_id."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates.class_rows(docs)


def op11_concatenate_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Where each part of each document stands in the packed sequences."""
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pieces(packing.sequences(table(spark, folder, "documents"), path))


def op12_trie_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words with their neighbours, forms and roots; one of 97 words a document is misspelt."""
    return spelling.variants(table(spark, folder, "documents"), spelling.Words(damage=97))


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digest(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_latent_decontamination": op1_latent_decontamination,
        "op2_redirect_rules": op2_redirect_rules,
        "op3_curriculum_mixing": op3_curriculum_mixing,
        "op4_cross_polytope": op4_cross_polytope,
        "op5_randomness_secrets": op5_randomness_secrets,
        "op6_license_inheritance": op6_license_inheritance,
        "op7_typed_chat": op7_typed_chat,
        "op8_neighbour_quality": op8_neighbour_quality,
        "op9_prefix_tokens": op9_prefix_tokens,
        "op10_bag_minhash": op10_bag_minhash,
        "op11_concatenate_cut": op11_concatenate_cut,
        "op12_trie_variants": op12_trie_variants,
        "op13_fill_middle": op13_fill_middle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_redirect_rules": url_rules.judged_sql(),
        "op3_curriculum_mixing": mixing.DIGEST_SQL,
        "op7_typed_chat": chat.DIGEST_SQL,
        "op12_trie_variants": spelling.variants_sql(),
        "op13_fill_middle": fill_middle.DIGEST_SQL,
    }
