"""The corpus pipeline: each stage reads the documents that its predecessor kept, written as Parquet in between.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All stages but the last
return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.llm import decontaminate, ngram_jaccard, packing, secret_scan, toxicity
from codexlake.llm._common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; a document without an id is scored like any other."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.non_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose sets of five-word shingles have a similarity of 0.8 or more, that of the least id.

    Rows without an id all stay, and so do different texts that share an id; of rows equal in id and text one stays.
    """
    return ngram_jaccard.one_of_each(docs, n=5, num=4, den=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, not even a re-parameterised one."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by <secret>; n_chars follows the text."""
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Learned scores, shingle sets, templates and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
