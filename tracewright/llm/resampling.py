"""Importance resampling: documents are weighted by the ratio of two hashed n-gram models, of target text and of
raw text, and sampled without replacement by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batch_of, ranked, slices, small_batches
from tracewright.llm.features import tokens, word_pairs

BUCKETS = 10_000
SMOOTHING = 1.0
#: About so many labelled rows make the target model.
TARGET_ROWS = 20_000
#: Share of the documents that is sampled.
KEEP = 0.85

_counts = pa.schema([("bucket", pa.list_(pa.int32())), ("raw", pa.list_(pa.int64())), ("target", pa.list_(pa.int64()))])


def _features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for docs, hashes in word_pairs(tokens(texts, marks=True)):
        yield docs, (hashes % np.uint64(BUCKETS)).astype(np.int64)


def log_ratio(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """log(target / raw) of each bucket: raw counts over all docs, target counts over rows whose doc_id is in
    target_ids (one column doc_id; the caller bounds it, it is broadcast). One pass over the texts."""
    marked = docs.select("doc_id", "text").join(F.broadcast(target_ids.select("doc_id").distinct().withColumn("_target", F.lit(True))), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts, chosen = batch.column("text").to_pylist(), np.array([bool(x) for x in batch.column("_target").to_pylist()], bool)
            for docs, buckets in _features(texts):
                raw += np.bincount(buckets, minlength=BUCKETS)
                target += np.bincount(buckets[chosen[docs]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield batch_of(_counts, bucket=[seen.tolist()], raw=[raw[seen].tolist()], target=[target[seen].tolist()])

    sums = (
        marked.select("text", "_target")
        .mapInArrow(count, "bucket array<int>, raw array<long>, target array<long>")
        .select(F.explode(F.arrays_zip("bucket", "raw", "target")).alias("x"))
        .groupBy(F.col("x.bucket").alias("bucket"))
        .agg(F.sum("x.raw").alias("raw"), F.sum("x.target").alias("target"))
        .toPandas()
    )
    at = sums["bucket"].to_numpy(np.int64)
    models = []
    for name in ("target", "raw"):
        n = np.full(BUCKETS, SMOOTHING)
        n[at] += sums[name].to_numpy(np.float64)
        models.append(np.log(n / n.sum()))
    return models[0] - models[1]


def target_sample(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """doc_id of rows with quality 1: all, or about `rows` of them, by a hash of doc_id."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    n = good.count()
    return good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, rows / max(n, 1)))))


def resample(docs: DataFrame, labels: DataFrame, keep: float = KEEP, seed: int = 7, target_rows: int = TARGET_ROWS) -> DataFrame:
    """One row a document: doc_id, log_weight, n_features, gumbel_key, rank, selected.

    log_weight sums the log ratio over the text's tokens and token pairs; gumbel_key adds Gumbel noise from a
    hash of doc_id and seed; selected holds for the ceil(keep * rows) highest keys (ties to smaller doc_id,
    null first). A null or empty text has weight 0. Repeated rows are documents of their own with equal keys.
    Without labelled rows of quality 1 the target model is even over the buckets. Empty docs give no rows; other
    columns are ignored. Counts cover all docs; only the labelled target rows are bounded.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(log_ratio(docs, target_sample(labels, target_rows)))

    @F.pandas_udf("log_weight double, n_features long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ratio = shared.value
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            weight, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for lo, hi in slices(texts):
                for docs, buckets in _features(texts[lo:hi]):
                    weight[lo:hi] += np.bincount(docs, weights=ratio[buckets], minlength=hi - lo)
                    n[lo:hi] += np.bincount(docs, minlength=hi - lo)
            yield pd.DataFrame({"log_weight": weight, "n_features": n})

    uniform = (F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    scored = (
        docs.select("doc_id", weigh.asNondeterministic()("text").alias("w"))
        .select("doc_id", "w.log_weight", "w.n_features")
        .withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    )
    placed = ranked(scored, [F.desc("gumbel_key"), F.asc("doc_id")], "rank")
    total = placed.count()
    return placed.withColumn("selected", F.col("rank") <= F.lit(int(np.ceil(keep * total))))
