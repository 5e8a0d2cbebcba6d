"""A training corpus from raw documents, stage by stage; every stage is a Spark job over all rows.

Each stage takes the documents that the one before kept and gives documents with the same
columns; the last gives their places in packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import langid, mixing, packing, quality, simhash
from gridpulse.llm.common import col, stored
from gridpulse.llm.queries import TOKENIZER


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models know; they learn from a sample of the documents with a label.

    A null or empty text, or one without a letter, has no language and goes. Rows are judged one by one on their
    whole texts, so repeated rows stay or go together; without a label nothing is learned and no row stays.
    """
    found, names = langid.identified(docs, langid.learn(docs, F.lit(True)))
    return found.filter(~F.col(names[2])).select(*[col(c) for c in docs.columns])


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule.

    A null or empty text has no words and goes. Rows are judged one by one on their whole texts, so repeated
    rows stay or go together; no rows give none.
    """
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least doc_id.

    Near duplicates have fingerprints of three-word shingles that differ in at most three bits, and so have
    those linked through others. A null or empty text has fingerprint zero and is linked like any other; of
    rows that repeat a kept doc_id one stays, and all rows without one; no rows give none.
    """
    return simhash.deduplicated(docs, words=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their rows in the order of a mix of the sources.

    Weights are the square roots of the sources' sizes. Nothing is dropped or repeated: what is decided is
    the order, range by range from file to file, and packing keeps to it.
    """
    size = F.length("text")
    return mixing.in_mix_order(docs, mixing.mixed(docs, mixing.tempered(docs, size), size))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences; sequence ids follow the order of the mix, run by run of pieces.

    A null or empty text is the end id alone; longer texts are cut into as many pieces as they need. Repeated rows
    and null ids are packed each on their own; no rows give none.
    """
    cut = packing.pieces(docs, TOKENIZER, stretch=F.col("_metadata.file_name"), position=F.col("_metadata.row_index"))
    return packing.pack(cut)


STAGES = [
    ("language", language),
    ("quality", good),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: Language models, hashes and packing have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
