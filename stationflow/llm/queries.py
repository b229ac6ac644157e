"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``.

Each query applies its operator with production parameters to the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import oracles
from stationflow.llm.decontaminate import decontaminate
from stationflow.llm.licences import licences
from stationflow.llm.mixing import mix
from stationflow.llm.near_duplicates import near_duplicates
from stationflow.llm.neighbours import nearest
from stationflow.llm.page_text import page_texts
from stationflow.llm.quality import fit_quality, quality
from stationflow.llm.ranked_search import ranked_search
from stationflow.llm.scratch import Scratch
from stationflow.llm.token_alignment import aligned_tokens
from stationflow.llm.token_counts import derived_edits, token_counts
from stationflow.llm.token_files import token_digests
from stationflow.llm.toxicity import fit_toxicity, toxicity
from stationflow.llm.warc import archived_pages

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.tiktoken"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(_read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity(docs, fit_toxicity(docs, _read(spark, sf_dir, "labels")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality(docs, fit_quality(docs, _read(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "token-files").path("files")
    return token_digests(_read(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), folder)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_read(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(derived_edits(_read(spark, sf_dir, "documents")), tokenizer_path(BYTE_TOKENIZER))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_read(spark, sf_dir, "pages"), Scratch(spark, "warc").path("archives"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(_read(spark, sf_dir, "pages"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_tokens(_read(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_licences": op2_licences,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_token_files": op7_token_files,
    "op8_neighbours": op8_neighbours,
    "op9_token_counts": op9_token_counts,
    "op10_warc": op10_warc,
    "op11_ranked_search": op11_ranked_search,
    "op12_page_text": op12_page_text,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op10_warc": oracles.WARC,
    "op11_ranked_search": oracles.RANKED_SEARCH,
    "op1_near_duplicates": oracles.NEAR_DUPLICATES,
    "op6_decontamination": oracles.DECONTAMINATE,
}
