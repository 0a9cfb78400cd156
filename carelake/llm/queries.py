"""The operators of this subpackage as registered queries, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import ctw, dart, decontam, extract, langid, mixing, rules, suffixes, tokens, trees, trie, urls, whitening
from carelake.llm.common import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """Place of the tokenizer's file; the package that brings it is installed beside the library on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_page_difference(spark: SparkSession, folder: str) -> DataFrame:
    return extract.main_text(table(spark, folder, "pages"), Scratch(spark, "op1"))


def op2_redirect_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    return urls.decided(table(spark, folder, "pages"), urls.rule_table(spark), Scratch(spark, "op2"))


def op3_sparse_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.shared_passages(table(spark, folder, "documents"), Scratch(spark, "op3"))


def op4_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.digest(table(spark, folder, "documents"), Scratch(spark, "op4"), vocabulary())


def op5_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return dart.grouped(table(spark, folder, "documents"), Scratch(spark, "op5"))


def op6_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(table(spark, folder, "documents"), Scratch(spark, "op6"))


def op7_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return rules.digest(table(spark, folder, "documents"))


def op8_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.found(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.predicted(docs, langid.learn(docs))


def op10_boosted_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return trees.scored(docs, trees.learn(docs, table(spark, folder, "labels")))


def op11_z_fast_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.trie(table(spark, folder, "conversations"), Scratch(spark, "op11"))


def op12_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.scored(table(spark, folder, "documents"), Scratch(spark, "op12"))


def op13_bit_sliced_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"), Scratch(spark, "op13"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_page_difference, op2_redirect_equivalence, op3_sparse_suffix_array, op4_token_blocks, op5_dart_minhash, op6_curriculum_mix, op7_rule_ledger,
    op8_simhash_windows, op9_string_kernel, op10_boosted_trees, op11_z_fast_trie,
    op12_context_tree, op13_bit_sliced_whitening)}

def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES["pipeline"] = pipeline

ORACLES: dict[str, str] = {
    "op2_redirect_equivalence": urls.SQL,
    "op6_curriculum_mix": mixing.SQL,
    "op7_rule_ledger": rules.SQL,
    "op11_z_fast_trie": trie.SQL,
}
