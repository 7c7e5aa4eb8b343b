"""The corpus pipeline: stages of the training-data operators, each written as Parquet and read by the next."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm.byte_bpe import encoding_stage
from foliant.llm.common import drop_written, table, written
from foliant.llm.language_id import language_stage
from foliant.llm.mixing import mixing_stage
from foliant.llm.pii import pii_stage
from foliant.llm.simhash import dedup_stage

STAGES = [
    ("language ID", language_stage),
    ("SimHash near-dedup", dedup_stage),
    ("PII", pii_stage),
    ("mixing to target weights", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

#: SQL expresses neither the classifiers nor the encoder; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; the last one's rows. A stage's table goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
        drop_written(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
