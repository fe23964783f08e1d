"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of a bounded sample of labelled rows give a matrix of log probabilities (languages x buckets), which is
broadcast; batches of texts are scored in numpy by summing the entries of their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batch_of, slices, small_batches
from tracewright.llm.features import char_ngrams, letter_table

ORDERS = (1, 2, 3, 4)
BITS = 16
#: Distinct labelled texts of each language that are learned from (about), and the most languages that a model may
#: have (half a megabyte each): more are an error, none is left out.
ROWS_PER_LANGUAGE = 5_000
LANGUAGES = 1_000
SMOOTHING = 0.5
UNKNOWN = "und"

_counts = pa.schema([("lang", pa.string()), ("bucket", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # language x bucket


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, most_languages: int = LANGUAGES) -> Model:
    """Learn from rows (text, lang). Rows where either is null are left out.

    A language with more distinct texts than rows_per_language gives about that many, chosen by a hash of the text,
    and one at least; a repeated text is learned once, however many rows have it, but every row counts for the
    prior. No rows: a model without languages. More than most_languages languages: ValueError.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select("text", "lang", F.xxhash64("text").alias("h")).where("text IS NOT NULL AND lang IS NOT NULL")
    known = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h", 0.02).alias("texts"), F.min("h").alias("least"))
    sizes = sorted(known.limit(most_languages + 1).collect(), key=lambda r: r["lang"])
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages: pass a larger most_languages or fewer labels")
    if not sizes:
        return Model([], np.zeros(0), np.zeros((0, 1 << BITS)))
    shares = labelled.sparkSession.createDataFrame([(r["lang"], float(1 << 20) * rows_per_language / max(1, r["texts"]), r["least"]) for r in sizes], "lang string, share double, least long")
    chosen = rows.join(F.broadcast(shares), "lang").where((F.pmod("h", F.lit(1 << 20)) < F.col("share")) | (F.col("h") == F.col("least")))
    sample = chosen.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
            for docs, buckets in char_ngrams(texts, ORDERS, BITS):
                own = langs[docs]
                for lang in set(own):
                    found = np.bincount(buckets[own == lang], minlength=1 << BITS)
                    total[lang] = total[lang] + found if lang in total else found
        for lang, n in total.items():
            seen = np.flatnonzero(n)
            yield batch_of(_counts, lang=[lang], bucket=[seen.tolist()], n=[n[seen].tolist()])

    counts = (
        sample.mapInArrow(count, "lang string, bucket array<int>, n array<long>")
        .select("lang", F.explode(F.arrays_zip("bucket", "n")).alias("x"))
        .groupBy("lang", F.col("x.bucket").alias("bucket"))
        .agg(F.sum("x.n").alias("n"))
        .toPandas()
    )
    languages = [r["lang"] for r in sizes]
    matrix = np.full((len(languages), 1 << BITS), SMOOTHING)
    matrix[counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64), counts["bucket"].to_numpy(np.int64)] += counts["n"].to_numpy(np.float64)
    matrix = np.log(matrix) - np.log(matrix.sum(axis=1, keepdims=True))
    prior = np.array([r["n"] for r in sizes], np.float64)
    return Model(languages, np.log(prior / prior.sum()), matrix)


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    letter = letter_table()
    scores = np.tile(model.log_prior, (len(texts), 1))
    for docs, buckets in char_ngrams(texts, ORDERS, BITS):
        for k in range(len(model.languages)):
            scores[:, k] += np.bincount(docs, weights=model.log_probability[k][buckets], minlength=len(texts))
    known = np.array([bool(t) and bool(letter[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)].any()) for t in texts], bool)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = scores.argmax(axis=1)
    chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, chance, 0.0)


def language_of(spark, model: Model, text: str = "text") -> Column:
    """struct<lang_pred string, score double> of a text column.

    A null text, or one without a letter, is `und` with score 0; ties go to the language that sorts first.
    score is the posterior probability of lang_pred. Rows are independent: repeated rows get equal results.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            langs: list[str] = []
            scores = [np.zeros(0)]
            for lo, hi in slices(texts):
                some, chance = predict_texts(shared.value, texts[lo:hi])
                langs += some
                scores.append(chance)
            yield pd.DataFrame({"lang_pred": langs, "score": np.concatenate(scores)})

    small_batches(spark)
    return predict.asNondeterministic()(F.col(text))
