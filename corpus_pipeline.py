"""A training corpus from raw documents: known languages, one of each group of near duplicates, nothing of the
benchmark, pseudonyms for personal data, packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import contamination, language, pseudonyms, simhash
from tracewright.llm.common import discard, kept, table, temporary, written
from tracewright.llm.queries import packed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents whose language is less certain than this are rejected, as are those without a letter.
MIN_LANGUAGE_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language that is known from the labelled ones (null and empty texts too).

    Ties go to the language that sorts first; repeated rows stay or go together; an empty table stays empty.
    """
    name = next(x for x in ("language", "_language", "__language") if x not in docs.columns)
    marked = docs.withColumn(name, language.language_of(spark, language.fit(docs)))
    known = (F.col(name)["lang_pred"] != language.UNKNOWN) & (F.col(name)["score"] >= MIN_LANGUAGE_SCORE)
    return marked.where(known).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near duplicates (null last, one of repeated rows)."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, its numbers, names or units exchanged or not.

    Null and empty texts hold none; repeated rows, and rows with a null doc_id, are judged by their text alone, so alike. An empty
    table, or an empty benchmark, drops nothing; texts of any length are read whole; other columns stay, whatever their names.
    """
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms under the session's key (pseudonyms.KEY_SETTING); n_chars follows the new text.

    Null texts stay null (n_chars too), empty ones empty; equal values get equal pseudonyms in all rows, repeated ones too; an empty
    table stays empty; other columns stay as they are.
    """
    return pseudonyms.pseudonymise(docs, pseudonyms.key_of(spark)).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in packed sequences; null and empty texts hold the end id, repeated rows are packed each.

    Texts of any length are cut as needed; an empty table gives no rows; of the columns only doc_id and text are read.
    """
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Byte-pair tokens, naive Bayes and SimHash have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each result written as Parquet and read again.

    Each stage says what it does with null, empty, repeated and clashing input; no documents give no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary():
            after = kept(written(stage(spark, docs, sf_dir), name))
        discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
