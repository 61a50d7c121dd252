"""Training-data pipeline over the documents table: one operator per stage."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, mixing, quality, simhash, tokens
from tessera.session import materialize, ship_package
from tessera.sources.tables import Tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a learned rule reject."""
    rules = quality.learn_rules(docs, Tables(spark, sf_dir).labels)
    # one column for the whole row: its names cannot meet those of the measures
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return quality.judge(docs.select(row, "text"), rules, keep=["row"]).where("kept").select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every fingerprint component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontam.decontaminate(docs, Tables(spark, sf_dir).benchmark)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources near their targets."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed documents and, per document copy, its place."""
    import public_tokenizers

    return tokens.tokenise_and_check(docs, public_tokenizers.path("word_bpe_49k.json"))


def _stage(fn):
    """The stage, with the package sent to the executors first."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _stage(quality_rules)),
    ("simhash_near_dedup", _stage(simhash_dedup)),
    ("benchmark_decontamination", _stage(decontamination)),
    ("source_mixing", _stage(source_mixing)),
    ("token_ids", _stage(token_ids)),
]

#: Fingerprint components, hash windows and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
