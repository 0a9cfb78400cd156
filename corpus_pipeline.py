"""From documents to training tokens: quality rules, near-duplicates, benchmark passages, mix, token blocks.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between two stages the result is written as Parquet and
read again. All but the last return the columns of documents. Rows with a null id take part in every stage
but the grouping of near copies, which they pass. The mix writes its rows in training order, and the token blocks keep it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import dart, decontam, mixing, queries, rules, tokens
from carelake.llm.common import Scratch, written_place

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule of the policy."""
    return rules.ledger(docs.select(*COLUMNS), COLUMNS).where(rules.passes("v2")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    return dart.kept(docs.select(*COLUMNS), Scratch(spark, "pipeline-near"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(docs.select(*COLUMNS), queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them; the words that a last reading is cut to come first in the text.

    A document that is read twice and a half is two rows with the whole text and one with the first half of its words,
    each at its position of the curriculum.
    """
    mixed = mixing.curriculum(docs.select(*COLUMNS), Scratch(spark, "pipeline-mix"))
    return mixing.repeated(docs.select(*COLUMNS), mixed).select(*COLUMNS)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: where its ids start in the written blocks, how many there are, and their checksum.

    The blocks hold the rows in the order in which they were written.
    """
    scratch = Scratch(spark, "pipeline-tokens")
    return tokens.digest(written_place(docs, scratch), scratch, queries.vocabulary(), order="place")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mix", mix),
    ("token_blocks", token_blocks),
]

#: Signatures, windows and byte-pair ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = queries.table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
