"""A corpus pipeline: five operators in turn over ``documents``.

Each stage takes the documents that the one before it returned, as a table read back from
Parquet, and returns documents again; the last returns tokens.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.llm import mixing, pieces, quality, secret_scan, simhash
from quotelane.session import materialize

MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie far from their language go."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within two bits (3-word shingles)
    stays, the one with the smallest id; of rows with that id one, and of null ids one. Texts
    without words share a fingerprint, so one of them stays."""
    return simhash.without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and pass over its source, with the words the mix takes."""
    return mixing.Mix(docs, keep_rows=True).documents()


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, their number, and whether they decode to the text again."""
    model_file = public_tokenizers.path(MODEL)
    made = docs.select("doc_id", "lang", "source", "text", pieces.coded(docs["text"], model_file).alias("made"))
    return made.select(
        "doc_id", "lang", "source", "made.ids",
        F.size("made.ids").cast("long").alias("n_tokens"),
        (F.col("made.decoded") == F.coalesce("text", F.lit(""))).alias("restored"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: SQL cannot express the pieces' merges and the draws of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
