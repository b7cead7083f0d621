"""From raw documents to training tokens: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import minhash, mixing, pii, quality_rules, sentencepiece
from tallyloom.llm.common import session
from tallyloom.session import as_table

# Read on the driver only; its tables go to the tasks.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    session(spark)
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in 80 % of their five-word shingles the one with the smallest id stays."""
    session(spark)
    return minhash.drop_near_duplicates(docs, words=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; lengths follow the new text."""
    session(spark)
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics meet their target shares."""
    session(spark)
    return mixing.sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with its id, language and source."""
    session(spark)
    model = sentencepiece.Model.read(TOKENIZER)
    return sentencepiece.encode(docs, model, ["doc_id", "lang", "source"])


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("target weights", target_weights),
    ("tokens", tokens),
]

# Estimated models, signatures and piece scores decide here, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage is written to the shared folder, as later ones read their input more than once."""
    docs = session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
