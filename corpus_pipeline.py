"""The training-data pipeline: from raw documents to packed token sequences.

``STAGES`` lists its steps. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame,
which ``run`` writes below ``spark.checkpoint.dir`` and reads again as the next step's
documents, so a lost executor never reaches back over a step. All steps but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.llm.line_dedup import COUNTS, line_dedup
from tripmart.llm.packing import pack_documents
from tripmart.llm.quality import fit_quality, keep_quality
from tripmart.llm.secret_scan import redact_secrets
from tripmart.llm.simhash import simhash_keep
from tripmart.session import configure

#: Score from which a document stays, and the tokens of a sequence.
LEAST_SCORE, SEQUENCE = 0.3, 2048


def _measured(docs: DataFrame) -> DataFrame:
    """Documents whose text changed, with their length brought up to date."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from ``labels``, as op 4 does."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return keep_quality(docs, fit_quality(docs, labels), LEAST_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that near-repeat over the documents stay in one place; every document stays."""
    own = {c: f"__own_{c}" for c in docs.columns if c.lower() in COUNTS}
    found = line_dedup(docs.withColumnsRenamed(own)).drop(*COUNTS)
    return _measured(found.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash_keep(docs, shingle=4, max_distance=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind; every document stays."""
    return _measured(redact_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, path, end_id=0, capacity=SEQUENCE).drop("ids")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: SQL can't express the classifier, MinHash or the packing; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
