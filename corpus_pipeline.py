"""Preparation of a training corpus: the stages, one after the other, over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import remove_contaminated
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.ngram_join import one_of_each
from tidemark.llm.quality import keep_good, train
from tidemark.llm.queries import END_ID, GOOD, VOCABULARY, tokenizer_path
from tidemark.llm.token_packing import read_documents, write_tokens
from tidemark.session import configure, materialize, shared_path

# Near duplicates: similarity of the sets of five-word shingles.
SHINGLE_WORDS = 5
SIMILARITY = (80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return keep_good(docs, train(docs, labels), GOOD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    configure(spark)
    return one_of_each(docs, n=SHINGLE_WORDS, threshold=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return remove_contaminated(docs, configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix of sources takes, once per copy."""
    configure(spark)
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bit-packed token file, as its documents read back from it."""
    path = shared_path(configure(spark))
    write_tokens(docs, path, tokenizer_path(), VOCABULARY, END_ID)
    return read_documents(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", tokens),
]

# Neither a classifier nor a tokenizer can be said in SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written as Parquet and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
