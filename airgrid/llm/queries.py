"""The registered queries of the package, one per operator, and their SQL."""

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.llm import attribution, fertility, jaccard, language, manifest, mincut, mixing, onebit, packing, planes, products, quality, whitening
from airgrid.llm.common import held_out, read_table
from airgrid.llm.oracles import ORACLES
from airgrid.session import Workspace

#: Folder of the public tokenizer files; a parameter, as the files are not part of the repository.
TOKENIZERS = os.environ.get("AIRGRID_TOKENIZERS", "/opt/tokenizers")


def _tokenizers():
    if TOKENIZERS not in sys.path:
        sys.path.append(TOKENIZERS)
    import public_tokenizers

    return public_tokenizers


def tokenizer(name: str) -> str:
    return _tokenizers().path(name)


def vocabularies() -> tuple[str, str, str]:
    """Files of the piece and the byte-level vocabulary, and the pattern that the latter splits by."""
    return tokenizer("piece_bpe_32k.model"), tokenizer("byte_bpe_multi_50k.tiktoken"), _tokenizers().PATTERN


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.plane_report(read_table(spark, sf_dir, "documents"), Workspace(spark), tokenizer("word_bpe_49k.json"))


def op3_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.top_products(read_table(spark, sf_dir, "embeddings"), Workspace(spark))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.link_documents(read_table(spark, sf_dir, "documents"), Workspace(spark))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.count_by_line(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(read_table(spark, sf_dir, "pages"))


def op10_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.nearest(read_table(spark, sf_dir, "embeddings"), Workspace(spark))


def op11_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fertility.apply_rules(read_table(spark, sf_dir, "documents"), Workspace(spark), *vocabularies())
    return found.select("doc_id", *fertility.COUNTS, "base_failed", "kept", *fertility.MEASURES)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tampering(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), Workspace(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_bit_planes, op3_top_products, op4_jaccard_join, op5_language, op6_best_fit_packing, op7_mixing,
        op8_token_counts, op9_main_text, op10_one_bit_neighbours, op11_fertility_rules, op12_merkle_manifest, op13_whitening,
    )
}
