"""Training-corpus pipeline: ordered stages over ``documents``, each calling one operator of strata.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is
written as Parquet under the shared checkpoint folder and read again as the next stage's input. All
stages but the last return the columns of their input, extra ones included.
"""

from __future__ import annotations

import gc

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, minhash, pii, quality, spm
from strata.llm.common import fresh, importable, remove, written

#: Key of the pseudonyms; a production run passes its own secret.
PII_KEY = "corpus-pipeline-key"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    importable(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    Rows are numbered in a written table first, so repeated rows and ids are told apart and the numbers
    can't change; the row with the least number of a group stays. Documents without words all stay.
    """
    importable(spark)
    (row,) = fresh(docs, "row_number")
    numbered, _ = written(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered")
    groups = minhash.near_duplicates(numbered, id_col=row, width=5, percent=80)
    return numbered.join(groups.where("not kept").select(row), row, "left_anti").drop(row)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    importable(spark)
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by format-preserving pseudonyms."""
    return pii.pseudonymise(docs, PII_KEY)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256, round_trip of every document."""
    importable(spark)
    return spm.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("sentencepiece", sentencepiece),
]

#: Trained classifiers and similarity groups are beyond SQL; see test_pipeline_stages in tests/llm/test_models.py.
ORACLE_SQL = None


def release(spark: SparkSession) -> None:
    """After a stage: Spark drops the shuffle files and broadcasts of a finished stage once the driver has collected
    its garbage, which otherwise happens only when the driver's memory is short."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, in order."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        done, before = path, docs
        docs, path = written(stage(spark, before, sf_dir), f"pipeline-{name}")
        if done:
            remove(spark, done)
        release(spark)
    return docs
