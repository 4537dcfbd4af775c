"""Corpus pipeline: reject toxic documents, drop duplicate lines, keep one document
of each near-duplicate group, mix the sources, encode what is taken.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``docs``. Rows may have null or equal ids, null or empty texts;
an empty table passes every stage; each stage's cases are those of its operator.
"""

from __future__ import annotations

from llm import lines, mixing, pieces, simhash, toxicity
from llm.common import materialize


def toxicity_stage(spark, docs, sf_dir):
    """Documents that the toxicity operator does not reject (score below 0.3)."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark, docs, sf_dir):
    """Documents less the lines that occur earlier, equal or within two edits."""
    return lines.dedup_lines(docs)


def simhash_stage(spark, docs, sf_dir):
    """One document of each group of fingerprints linked at 4 or fewer bits."""
    return simhash.simhash_dedup(docs, shingle=4, max_bits=4)


def mixing_stage(spark, docs, sf_dir):
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def sentencepiece_stage(spark, docs, sf_dir):
    """The documents' columns with sampled segmentations into pieces."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: No SQL: the first stage is a trained model.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
