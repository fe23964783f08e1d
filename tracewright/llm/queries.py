"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import contamination, language, licences, mixing, neighbours, oracles, packing, pseudonyms, resampling, simhash, token_output, toxicity, variants, whitening
from tracewright.llm.common import crc_mod, table
from tracewright.llm.tokenizing import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise_report(table(spark, sf_dir, "documents"), pseudonyms.key_of(spark))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_output.write_shards(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_output.digests(*shards)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(crc_mod("doc_id", 3) != 1))
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, language.language_of(spark, model).alias("l")).select("doc_id", "held_out", "l.lang_pred", "l.score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(table(spark, sf_dir, "documents")).drop("licences")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_contamination": op2_contamination,
    "op3_simhash": op3_simhash,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_token_output": op5_token_output,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_neighbours": op8_neighbours,
    "op9_packing": op9_packing,
    "op10_licences": op10_licences,
    "op11_whitening": op11_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_mixing": op13_mixing,
}
#: XXH64, CRC-32, tokenizers, trained models, eigenvectors and unrounded double products have no SQL; tests compare these with brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_contamination": oracles.CONTAMINATION,
    "op4_pseudonyms": oracles.PSEUDONYMS,
    "op10_licences": oracles.LICENCES,
    "op13_mixing": oracles.MIXING,
}
