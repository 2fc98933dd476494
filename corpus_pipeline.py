"""Documents to packed token sequences in five stages.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir), where ``docs`` is what
the stage before it wrote, and gives a DataFrame; all but the last keep the columns of
``documents``. Rows pass with every column they have, NULL texts as they are until the rules
reject them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evstream.llm import lines, minhash, packing, quality, secrets
from evstream.llm.common import ready, saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits or a learned rule go."""
    return quality.keep_good(docs, table(ready(spark), sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks an earlier document holds are cut from texts; texts without a word left go."""
    return lines.line_deduped(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document of smallest id stays."""
    return minhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    return secrets.mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences of 1024."""
    return packing.packed_documents(docs, packing.byte_encoder())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]

# Learned rules, patience alignment, sketches and packing have no SQL form: tests/llm states each
# stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
