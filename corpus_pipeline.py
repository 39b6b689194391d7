"""The corpus pipeline: stages applied in turn to ``documents``, each
written as Parquet to the shared folder and read again by the next.

A null text counts as empty, and an empty text is never toxic by its words,
never near another and never contaminated; the mix leaves it out, as it has
nothing to read.  Rows with a null doc_id are in no near-duplicate class and
stay, equal ones of them once.  Of rows that repeat a doc_id and a text one
stays; rows that repeat a doc_id with other texts are versions of one document.
Ties go to the smaller doc_id.  Other columns pass through, whatever their
names.  An empty table gives an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsgraph.llm import decontaminate, minhash, mixing, suffix, toxicity
from newsgraph.llm.common import keep

STAGES = [
    ("toxicity", toxicity.drop_toxic),
    ("minhash", minhash.drop_near_duplicates),
    ("suffix", suffix.drop_repeats),
    ("decontaminate", decontaminate.drop_contaminated),
    ("mixing", mixing.mix_documents),
]

#: No stage can be stated in SQL; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
