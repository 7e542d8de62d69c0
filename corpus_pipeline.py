"""The corpus pipeline: each stage works on all that the one before it kept.

Quality rules reject documents; lines that a source repeats on too many documents go; of near
duplicates (five-word sets alike at 0.8 or more) the one with the smallest id stays, once; sources are mixed to target weights, where a document
is repeated as often as it is read; and each document is segmented, twice, into sampled pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import lines, minhash, mixing, pieces, rules
from skytally.llm.common import stored, table
from skytally.llm.queries import MIX, mix_levels, model_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs, num=80, bands=37)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, mix_levels(), **MIX)


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.sample_segmentations(docs, model_path("piece_bpe_32k.model"), k=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixture", mixture),
    ("segmentation", segmentation),
]

# Signatures and sampled segmentations are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage keeps is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
