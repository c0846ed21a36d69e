"""From raw documents to packed training sequences, stage by stage.

Each stage takes all rows that its predecessor kept. The first four return the columns of ``documents``: what toxicity scoring or
language identification rejects goes, of each group of near duplicates the document with the smallest id stays, and documents that
hold a benchmark window go. The last one packs what is left and returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from papersieve.llm import decontamination, jaccard_join, language, packing, toxicity
from papersieve.llm.base import table
from papersieve.llm.encoding import public_tokenizer
from papersieve.llm.sampling import outside_fold
from papersieve.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.fit(docs, outside_fold(table(spark, sf_dir, "labels"), 5, 0))
    return toxicity.keep_clean(docs, lexicon)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(outside_fold(docs, 5, 0))
    return language.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"), capacity=2048, end_id=0, release=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unidentified),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

# Trained models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
