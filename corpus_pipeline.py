"""A training corpus from the table ``documents``: five stages, each a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import crf, decontaminate, hyperlang, minhash, packing
from millrace.llm.queries import TOKENIZERS
from millrace.llm.shared import held_out
from millrace.operators.sizing import store
from millrace.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled texts know, and those too short or repetitive to
    judge; texts without letters go."""
    ship_package(spark)
    prototypes = hyperlang.train(docs.where(~held_out("doc_id", 4, 2)))
    least = hyperlang.least_scores(docs.where(held_out("doc_id", 4, 2)), prototypes)
    # Renamed, so that no column of the documents clashes with the prediction.
    names = [f"doc_{c}" for c in docs.columns]
    found = hyperlang.predict(docs.toDF(*names), prototypes, "doc_doc_id", "doc_text")
    return found.where(hyperlang.is_known(least)).select(*names).toDF(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one with the smallest id. Rows that share a
    doc_id are one document, whose rows stay or go together; rows without one all stay."""
    ship_package(spark)
    gone = store(minhash.near_duplicates(docs).where("NOT kept").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item. Rows that share a doc_id go together, if
    one of them has a window; null texts, and rows without an id and window, stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and their new lengths; a null text and
    its length stay as they are."""
    ship_package(spark)
    redacted = crf.redact(docs)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return redacted.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences without padding. A null text is empty; every row is a document
    of its own, also one without an id or with that of another."""
    ship_package(spark)
    return packing.pack(docs, TOKENIZERS, lean=True)


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("packing", pack),
]

#: A language profile and a random field are not SQL; the tests hold a plain version against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
