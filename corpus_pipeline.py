"""From documents to token ids: toxicity, near-duplicates, benchmark passages, mix, output.

Every stage works on all that the one before kept, written as Parquet in the shared folder and read
again. Filtering stages and the mix return the columns of documents, whatever they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from jobledger.llm import dart_minhash, fair_mix, plane_files, string_tiling, subwords
from jobledger.llm.queries import ship
from jobledger.llm.tables import written
from jobledger.plans.session import fresh_dir

TOXIC = 0.7
END_ID = 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labelled ones."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    settings = subwords.TOXICITY
    model = subwords.train(*subwords.labelled(docs, labels, "toxic", settings), settings)
    return subwords.drop_scored(docs, model, TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the smallest id."""
    ship(spark)
    return dart_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return string_tiling.decontaminated(docs, benchmark)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it, up to three times."""
    return fair_mix.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-plane files of the ids of all texts; returned is what the files hold of each document."""
    ship(spark)
    folder = fresh_dir(spark, "ids")
    path = public_tokenizers.path("word_bpe_49k.json")
    plane_files.write_ids(docs, folder, path, END_ID)
    return plane_files.read_documents(spark, folder)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: Scores, signatures and tokens have no SQL; tests/llm compares a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
