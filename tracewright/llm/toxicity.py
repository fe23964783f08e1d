"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

A bounded sample of labelled rows gives the examples and the vocabulary: all of their words, whole, and of scripts
without spaces all pairs of neighbouring characters. Document frequencies are counted over all documents. A term's weight is its TF-IDF times how strongly its presence goes with the label (the
absolute phi coefficient, with a floor, so that no term is without weight): plain TF-IDF finds texts on the same
subject rather than of the same kind. For each text the k nearest examples are found exactly: blocks of examples whose
upper bound is below the k-th best are passed over. Their distance-weighted votes, calibrated on examples set
aside, give the score, and they are its evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batch_of, crc_mod, discard, slices, small_batches, written
from tracewright.llm.features import tokens

#: Labelled rows of each label that are learned from (about), and distinct terms of all of them together: longer texts
#: mean fewer rows. Both bound the sample, so what the driver and the index hold does not grow with the tables.
ROWS_PER_LABEL = 4_000
ENTRIES = 4_000_000
#: Weight of a term that has nothing to do with the label, against 1 for one that settles it.
FLOOR = 0.005
NEIGHBOURS = 25
BLOCK = 64
#: Blocks that are looked at before any can be passed over.
FIRST_BLOCKS = 4
#: Examples that the others are put in order by.
PIVOTS = 32

_rows = pa.schema([("part", pa.int32()), ("toxic", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_terms", pa.int64()), ("term", pa.binary()), ("n", pa.binary())])
_terms = pa.schema([("term", pa.int32()), ("n", pa.int64())])


class Vocabulary:
    """The 64-bit hashes of the terms, ascending, and where those with the same first bits begin."""

    def __init__(self, terms: np.ndarray, bits: int = 20):
        self.terms, self.shift = terms, np.uint64(64 - bits)
        self.starts = np.searchsorted(terms >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.depth = int(np.diff(self.starts).max())

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 for those outside."""
        out, at = np.full(len(hashes), -1, np.int64), self.starts[(hashes >> self.shift).astype(np.int64)]
        for j in range(self.depth):
            here = np.minimum(at + j, len(self.terms) - 1)
            same = self.terms[here] == hashes
            out[same] = here[same]
        return out


def distinct_terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a text as 64-bit hashes, ascending, and their counts."""
    return np.unique(np.concatenate([h for _, h in tokens([text], marks=False, signs=True)] or [np.zeros(0, np.uint64)]), return_counts=True)


def term_counts(texts: list[str | None], known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, places, counts): the distinct terms of each text that the vocabulary has, ascending."""
    n_terms = max(1, len(known.terms))
    keys = [np.zeros(0, np.int64)]
    for docs, hashes in tokens(texts, marks=False, signs=True):
        places = known.places(hashes)
        inside = np.flatnonzero(places >= 0)
        keys.append(docs[inside].astype(np.int64) * n_terms + places[inside])
    found, n = np.unique(np.concatenate(keys), return_counts=True)
    return np.searchsorted(found, np.arange(len(texts) + 1) * n_terms), found % n_terms, n


def _runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


@dataclass
class Index:
    """Unit vectors of examples as inverted lists; each list is cut at the borders of blocks of BLOCK examples and
    keeps the largest weight of each part."""

    lists: np.ndarray  # starts of each term's parts
    blocks: np.ndarray  # block of each part
    most: np.ndarray  # its largest weight
    parts: np.ndarray  # starts of each part's entries
    rows: np.ndarray  # example of each entry
    weights: np.ndarray
    toxic: np.ndarray
    doc_id: np.ndarray
    importance: np.ndarray
    prior: float  # among examples without any term

    @classmethod
    def build(cls, vectors: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, doc_id: np.ndarray, importance: np.ndarray, n_terms: int) -> Index:
        full = np.array([i for i, (t, _) in enumerate(vectors) if len(t)], np.int64)
        empty = np.array([i for i, (t, _) in enumerate(vectors) if not len(t)], np.int64)
        base = importance[empty] @ toxic[empty], importance[empty].sum()
        whole = importance @ toxic, importance.sum()
        prior = (base[0] + whole[0] / max(whole[1], 1e-9)) / (base[1] + 1)
        full = full[_grouped([vectors[i] for i in full], n_terms)]
        # millions of entries: narrow integers, and nothing is held twice for longer than needed
        terms = np.concatenate([*(vectors[i][0] for i in full), np.zeros(0, np.int32)])
        rows = np.repeat(np.arange(len(full), dtype=np.int32), [len(vectors[i][0]) for i in full])
        order = np.argsort(terms, kind="stable").astype(np.int32)  # rows ascend already
        rows = rows[order]
        weights = np.concatenate([*(vectors[i][1] for i in full), np.zeros(0)])[order]
        n_blocks = len(full) // BLOCK + 1
        keys = terms[order].astype(np.int64) * n_blocks + rows // BLOCK
        del terms, order
        parts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        keys = keys[parts]
        most = np.maximum.reduceat(weights, parts) if len(parts) else np.zeros(0)
        lists = np.searchsorted(keys // n_blocks, np.arange(n_terms + 1))
        return cls(lists, (keys % n_blocks).astype(np.int32), most, np.append(parts, len(rows)), rows, weights, toxic[full], doc_id[full], importance[full], float(prior))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines above 0 of the k nearest, nearest first, ties to the smaller row."""
        n = len(self.toxic)
        if not len(terms) or not n:
            return np.zeros(0, np.int64), np.zeros(0)
        starts, ends = self.lists[terms], self.lists[terms + 1]
        parts, weight = _runs(starts, ends), np.repeat(weights, ends - starts)
        block = self.blocks[parts]
        bound = np.bincount(block, weights=self.most[parts] * weight, minlength=n // BLOCK + 1)
        wanted = np.zeros(len(bound), bool)
        wanted[np.argpartition(-bound, FIRST_BLOCKS)[:FIRST_BLOCKS] if len(bound) > FIRST_BLOCKS else slice(None)] = True
        rows, cosine = self._cosines(parts, weight, wanted[block], k)
        rest = ~wanted & (bound > 0)
        if len(cosine) == k:
            rest &= bound * (1 + 1e-9) >= cosine[-1]
        if rest.any():
            more_rows, more = self._cosines(parts, weight, rest[block], k)
            rows, cosine = np.concatenate((rows, more_rows)), np.concatenate((cosine, more))
            order = np.lexsort((rows, -cosine))[:k]
            rows, cosine = rows[order], cosine[order]
        return rows, cosine

    def _cosines(self, parts: np.ndarray, weight: np.ndarray, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows among the entries of the chosen parts."""
        parts, weight = parts[chosen], weight[chosen]
        starts, ends = self.parts[parts], self.parts[parts + 1]
        at = _runs(starts, ends)
        cosine = np.bincount(self.rows[at], weights=self.weights[at] * np.repeat(weight, ends - starts), minlength=len(self.toxic))
        floor = np.partition(cosine, len(cosine) - k)[len(cosine) - k] if len(cosine) > k else 0.0
        rows = np.flatnonzero((cosine >= floor) & (cosine > 0))
        order = np.lexsort((rows, -cosine[rows]))[:k]
        return rows[order], cosine[rows[order]]

    def vote(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[float, np.ndarray, np.ndarray]:
        rows, cosine = self.nearest(terms, weights, k)
        w = self.importance[rows] * cosine**2
        return (w @ self.toxic[rows] + self.prior) / (w.sum() + 1), rows, cosine


@dataclass
class Model:
    known: Vocabulary
    weight: np.ndarray  # of each term: inverse document frequency times strength
    index: Index
    raw: np.ndarray  # calibration: votes and the shares of toxic rows they stand for
    share: np.ndarray

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        starts, found, n = term_counts(texts, self.known)
        weight = (1 + np.log(n)) * self.weight[found] if len(found) else np.zeros(0)
        return [unit(found[lo:hi], weight[lo:hi]) for lo, hi in zip(starts[:-1], starts[1:], strict=True)]

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, self.raw, self.share)) if len(self.raw) else vote


def unit(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return terms, weights / max(np.sqrt(weights @ weights), 1e-300) if len(terms) else weights


def isotonic(vote: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and non-decreasing shares of label 1 (pool adjacent violators), each share drawn in from 0 and 1."""
    merged: list[list[float]] = []
    for x in np.unique(vote):
        own = vote == x
        merged.append([weight[own] @ vote[own], weight[own] @ toxic[own], weight[own].sum()])
        while len(merged) > 1 and merged[-2][1] * merged[-1][2] >= merged[-1][1] * merged[-2][2]:
            last = merged.pop()
            merged[-1] = [a + b for a, b in zip(merged[-1], last, strict=True)]
    n = np.array([m[2] for m in merged])
    return np.array([m[0] for m in merged]) / n, (np.array([m[1] for m in merged]) + 0.05) / (n + 0.1)


def _grouped(vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> np.ndarray:
    """An order in which similar examples lie together: by the nearest of PIVOTS of them, then by nearness to it."""
    if not vectors:
        return np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
    terms, weights = np.concatenate([t for t, _ in vectors]), np.concatenate([w for _, w in vectors])
    best, who = np.full(len(vectors), -1.0), np.zeros(len(vectors), np.int64)
    for j, i in enumerate(np.unique(np.linspace(0, len(vectors) - 1, PIVOTS).astype(np.int64))):
        pivot = np.zeros(n_terms)
        pivot[vectors[i][0]] = vectors[i][1]
        cosine = np.bincount(rows, weights=weights * pivot[terms], minlength=len(vectors))
        closer = cosine > best
        best[closer], who[closer] = cosine[closer], j
    return np.lexsort((-best, who))


def strengths(rows: list[np.ndarray], toxic: np.ndarray, n_terms: int) -> np.ndarray:
    """For each term FLOOR plus the absolute phi coefficient of its presence and the label over the examples."""
    n, n1 = len(rows), toxic.sum()
    if not n or not 0 < n1 < n:
        return np.full(n_terms, FLOOR)
    every = np.bincount(np.concatenate(rows), minlength=n_terms).astype(np.float64)
    ones = np.bincount(np.concatenate([r for r, y in zip(rows, toxic, strict=True) if y]), minlength=n_terms)
    spread = np.sqrt(every * (n - every) * n1 * (n - n1))
    return FLOOR + np.abs(np.divide(n * ones - every * n1, spread, out=np.zeros(n_terms), where=spread > 0))


def examples(docs: DataFrame, labels: DataFrame, learn: Column, rows_per_label: int, entries: int) -> tuple[pd.DataFrame, dict[int, float]]:
    """The sampled rows (part, toxic, doc_id, term, n) in order of doc_id, and the share of each label that they are.

    What comes to the driver is bounded by rows_per_label and entries, however long the texts and however often a
    doc_id is repeated in docs.
    """
    known = labels.where(learn).where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    scale = {y: min(1.0, rows_per_label / n) for y, n in sizes.items()}
    bound = F.when(F.col("toxic") == 1, F.lit(scale.get(1, 1.0))).otherwise(F.lit(scale.get(0, 1.0))) * F.lit(float(1 << 30))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < bound).withColumn("part", crc_mod("doc_id", 5).cast("int"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for lo, hi in slices([r["text"] for r in rows]):
                terms, n = zip(*(distinct_terms(r["text"]) for r in rows[lo:hi]), strict=True)
                yield batch_of(
                    _rows, **{c: [r[c] for r in rows[lo:hi]] for c in ("part", "toxic", "doc_id", "text_hash")}, n_terms=[len(t) for t in terms],
                    term=[t.tobytes() for t in terms], n=[x.astype("<i4").tobytes() for x in n],
                )

    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .select("part", "toxic", "doc_id", F.xxhash64("text").alias("text_hash"), "text")
        .mapInArrow(describe, "part int, toxic int, doc_id long, text_hash long, n_terms long, term binary, n binary")
        .groupBy("text_hash", "toxic")
        .agg(F.min_by(F.struct("part", "doc_id", "n_terms", "term", "n"), "doc_id").alias("r"))
        .select("text_hash", "toxic", "r.*")
    )
    rows = written(found, "examples", wide=True)
    share = min(1.0, entries / max(1, rows.agg(F.sum("n_terms")).first()[0] or 1))
    kept = rows.where(F.pmod(F.xxhash64("text_hash", F.lit(1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).drop("text_hash", "n_terms").toPandas()
    discard(rows)
    return kept.sort_values("doc_id").reset_index(drop=True), {y: s * share for y, s in scale.items()}


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows_per_label: int = ROWS_PER_LABEL, entries: int = ENTRIES) -> Model:
    """Learn from rows of labels where `learn` holds and toxic is 0 or 1, and from document frequencies over docs.

    More than rows_per_label rows of a label, or more than `entries` distinct terms in all of them: about that many,
    by a hash. Repeated label rows count once, the larger label wins; rows without a document are left out; equal
    texts with equal labels count once.
    """
    small_batches(docs.sparkSession)
    rows, scale = examples(docs, labels, learn, rows_per_label, entries)
    toxic = rows["toxic"].to_numpy(np.float64)
    terms = np.unique(np.concatenate([*(np.frombuffer(t, np.uint64) for t in rows["term"]), np.zeros(0, np.uint64)]))
    found = [np.searchsorted(terms, np.frombuffer(t, np.uint64)).astype(np.int32) for t in rows.pop("term")]
    n_docs, df = document_frequencies(docs, known := Vocabulary(terms))
    weight = (np.log((1 + n_docs) / (1 + df)) + 1) * strengths(found, toxic, len(terms))
    vectors = [unit(t, (1 + np.log(np.frombuffer(n, "<i4"))) * weight[t]) for t, n in zip(found, rows["n"], strict=True)]
    importance = np.array([1 / scale[int(y)] for y in toxic])
    importance /= importance.min() if len(importance) else 1
    aside = rows["part"].to_numpy() == 1
    doc_id = rows["doc_id"].to_numpy(np.int64)
    index = Index.build([v for v, a in zip(vectors, aside, strict=True) if not a], toxic[~aside], doc_id[~aside], importance[~aside], len(terms))
    model = Model(known, weight, index, np.zeros(0), np.zeros(0))
    if aside.any():
        vectors, found, rows = [v for v, a in zip(vectors, aside, strict=True) if a], [], rows[:0]
        votes = np.array([index.vote(*v)[0] for v in vectors])
        model.raw, model.share = isotonic(votes, toxic[aside], importance[aside])
    return model


def document_frequencies(docs: DataFrame, known: Vocabulary) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents that hold each term; over all of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_docs = shared.value, 0
        total = np.zeros(len(known.terms), np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_docs += len(texts)
            for lo, hi in slices(texts):
                total += np.bincount(term_counts(texts[lo:hi], known)[1], minlength=len(total))
        seen = np.flatnonzero(total)
        yield batch_of(_terms, term=np.append(seen, -1), n=np.append(total[seen], n_docs))

    sums = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    at, n = sums["term"].to_numpy(np.int64), sums["n"].to_numpy(np.int64)
    df = np.zeros(len(known.terms), np.float64)
    df[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), df


def toxicity_of(spark, model: Model, text: str = "text", evidence: int = 3) -> Column:
    """struct<score, evidence: array<struct<doc_id, cosine, toxic>>> of a text column.

    A text without any word of the examples (null and empty texts too) has the calibrated share of such examples.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence array<struct<doc_id: long, cosine: double, toxic: int>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, seen = shared.value, {}
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            scores, why = [], []
            for lo, hi in slices(texts):
                for terms, weights in model.vectors(texts[lo:hi]):
                    key = terms.tobytes() + weights.tobytes()
                    if key not in seen:
                        vote, rows, cosine = model.index.vote(terms, weights)
                        if len(seen) > 20_000:
                            seen.clear()
                        seen[key] = model.calibrated(vote), [{"doc_id": int(model.index.doc_id[r]), "cosine": float(c), "toxic": int(model.index.toxic[r])} for r, c in zip(rows[:evidence], cosine, strict=False)]
                    score, because = seen[key]
                    scores.append(score)
                    why.append(because)
            yield pd.DataFrame({"score": scores, "evidence": why})

    small_batches(spark)
    return judge.asNondeterministic()(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every row of docs.

    Learned from labels of rows whose crc32(doc_id as text) is not a multiple of 5; held_out marks the others
    (false for a null doc_id). Null and empty texts have the calibrated share of examples without words; of equal cosines at
    the last place the example that comes first in the index counts. Repeated rows are scored alike; empty docs give no rows;
    other columns are ignored.
    """
    model = fit(docs, labels, crc_mod("doc_id", 5) != 0)
    scored = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), toxicity_of(docs.sparkSession, model).alias("t"))
    return scored.select("doc_id", "held_out", "t.score", (F.col("t.score") >= 0.5).cast("int").alias("predicted"), "t.evidence")
