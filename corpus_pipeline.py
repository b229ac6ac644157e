"""Corpus pipeline over ``documents``; every stage applies one operator of ``stationflow.llm``.

A stage works on all that the one before it kept.  All but the last return the
columns of documents, whatever further columns are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.decontaminate import decontaminated
from stationflow.llm.mixing import mixed_documents
from stationflow.llm.near_duplicates import distinct_documents
from stationflow.llm.queries import WORD_TOKENIZER, tokenizer_path
from stationflow.llm.scratch import Scratch
from stationflow.llm.token_files import token_digests
from stationflow.llm.toxicity import fit_toxicity, toxicity_score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from ``labels``.

    A null text scores as an empty one, repeated rows alike; an empty table stays empty.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity_score(model)(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words are benchmark passages."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more often, so that the sources come nearer to equal weights."""
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files of the mixture, read back: doc_id, start, n_tokens, ids_crc32.

    A null text is encoded as an empty one; every repeated row has its own tokens; an
    empty table gives no rows.
    """
    return token_digests(docs, tokenizer_path(WORD_TOKENIZER), Scratch(spark, "token-files").path("files"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token-files", write_tokens),
]

#: The classifier, the connected components and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
