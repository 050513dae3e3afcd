"""From documents to packed token sequences: five stages, each an operator of ``offermart.llm``.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns a DataFrame; it is written as Parquet and read
again for the next one. All but the last return the columns of ``documents``. The two scoring stages judge every row for itself and carry its
columns along; the other two name rows by id and text, so null and repeated ids are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offermart.llm import packing, postings, quality, simhash, toxicity
from offermart.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # learned scores and fingerprints have no SQL; the tests hold every stage against a plain version


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 0").select("row.*").select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.quality(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return postings.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


run.tested_by = "tests/llm/test_learned_operators.py"
