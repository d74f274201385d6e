"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next
stage's ``docs``.  Filtering stages keep whole rows and all columns of documents; the last returns ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import bpe, decontaminate, jaccard, secrets, toxicity
from aerolake.llm.text import shared_folder, spare_driver, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    return toxicity.drop(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the Jaccard join links, the one with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets masked in the text and n_chars brought up to date."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")).select(*docs.columns)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and their digests; the ids decode to the text's bytes."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digest(bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN), "ids")



@contextmanager
def short_plan_texts(spark: SparkSession) -> Iterator[None]:
    """Spark keeps a text of every plan on the driver; those with literal tables of a vocabulary have some MB each unless they are cut."""
    key = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spared(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with short plan texts; the driver hands memory back before it and after it, whoever calls it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spare_driver(spark)  # of what the write of the stage before has left
        with short_plan_texts(spark):
            out = stage(spark, docs, sf_dir)
        spare_driver(spark)  # of models, sketches and tables of words that the stage had on the driver
        return out

    return run_stage


STAGES = [
    ("toxicity", spared(drop_toxic)),
    ("jaccard_join", spared(drop_near_duplicates)),
    ("decontamination", spared(drop_contaminated)),
    ("secrets", spared(mask_secrets)),
    ("byte_bpe", spared(encode_bytes)),
]

#: Edit distances, trained scores and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; stage results go to a new folder of the shared one."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    with short_plan_texts(spark):
        for k, (name, stage) in enumerate(STAGES):
            path = f"{folder}/{k}_{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    spare_driver(spark)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
