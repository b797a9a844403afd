"""A training corpus from raw documents: what is in a known language and well written, each text once, sources mixed
to target weights, and packed into bins."""

from pyspark.sql import DataFrame, SparkSession

from airgrid.llm import jaccard, language, mixing, packing, quality
from airgrid.llm.common import read_table
from airgrid.session import Workspace, bound_batches


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is not clear, go."""
    bound_batches(spark)
    return language.keep_identified(docs, language.fit(docs))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier holds to be bad go."""
    bound_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more over five-word shingles connect, the one with the smallest id stays."""
    bound_batches(spark)
    return jaccard.keep_one(docs, Workspace(spark), size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come once, twice or not at all, as their source's target asks."""
    return mixing.mix_documents(docs, Workspace(spark))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their bins and places; no bin holds two of a source or two copies."""
    return packing.pack_documents(docs, Workspace(spark), near=False)  # near copies are gone


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]

#: Trained networks decide in the first two stages, and hashes draw in the fourth: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written and read again, so the next one never repeats it."""
    work, docs = Workspace(spark), read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs


pipeline = run
