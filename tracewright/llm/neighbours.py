"""Nearest neighbours by cosine as a block matrix join.

Vectors are scaled to length one, rounded to int8 and packed into blocks. Every query block meets every candidate
block once, as a tile: one matrix product of the int8 values (exact: float32 holds the sums of EXACT_DIMS products, and
longer vectors are added up from such parts) gives each cosine within a bound that follows from the two rounding
errors. Pairs that can still be among the k nearest are recomputed in double precision from the original vectors and
pushed onto the query's heap; the heaps of the tasks are merged.

Tasks form a grid: queries are dealt to rows of as many blocks as a task can hold, candidates to columns. So a candidate
block is sent once for each row of the grid, not for each query block, and is read by a task one at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.common import batch_of, kept, small_batches, temporary, written

CANDIDATES = 1024
QUERIES = 1024
#: Bytes of query blocks that a task holds while candidates pass.
HELD_BYTES = 64 << 20
#: 127 * 127 * 1,040 is below 2 ** 24.
EXACT_DIMS = 1_024
#: Pairs recomputed at once.
RECOMPUTED = 1 << 14

_BLOCK = "dim int, n int, ids binary, rounded binary, scale binary, error binary, raw binary"
_block = pa.schema([("dim", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "rounded", "scale", "error", "raw"))])
_hits = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: array<float> or array<double>, as they come) of vectors that take part, repeated rows once.

    Left out: null vec_id, null or empty vectors, null or non-finite components, all components zero.
    """
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kept = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    v = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), kept.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where(~bad & F.exists("v", lambda x: x != 0)).distinct()


def _scaled(given: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to between 1/2 and 1: cosines stay as they are to
    the last bit, and no square is too large or too small."""
    raw = given.astype(np.float64)
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1])


def _pack(ids: np.ndarray, given: np.ndarray) -> dict[str, bytes]:
    unit = _scaled(given)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    rounded = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - rounded * scale[:, None]) ** 2).sum(axis=1))
    return {"ids": ids.astype("<i8").tobytes(), "rounded": rounded.tobytes(), "scale": scale.tobytes(), "error": error.tobytes(), "raw": given.tobytes()}


def _packed(size: int):
    """Blocks of at most `size` vectors of one dimension, from the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids = np.concatenate([x for x, _ in held[dim]])
            raw = np.concatenate([x for _, x in held[dim]])
            held[dim] = [(ids[size:], raw[size:])]
            ids, raw = ids[:size], raw[:size]
            return batch_of(_block, dim=[dim], n=[len(ids)], **{k: [x] for k, x in _pack(ids, raw).items()})

        for batch in batches:
            ids, column = batch.column("vec_id").to_numpy(), batch.column("v")
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy()
            at = np.concatenate(([0], np.cumsum(sizes)))
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                held.setdefault(int(dim), []).append((ids[rows], flat[at[rows][:, None] + np.arange(dim)]))
                while sum(len(x) for x, _ in held[int(dim)]) >= size:
                    yield out(int(dim))
        for dim in held:
            if any(len(x) for x, _ in held[dim]):
                yield out(dim)

    return run


class Side:
    """A block as arrays."""

    def __init__(self, row: dict):
        get = lambda c, t: np.frombuffer(row[c], t)
        self.dim = row["dim"]
        self.ids, self.scale, self.error = get("ids", "<i8"), get("scale", "<f8"), get("error", "<f8")
        self.rounded = get("rounded", np.int8).reshape(-1, self.dim).astype(np.float32)
        wide = len(row["raw"]) == 8 * len(self.ids) * self.dim
        self.raw = _scaled(get("raw", "<f8" if wide else "<f4").reshape(-1, self.dim))
        self.norm = np.sqrt((self.raw * self.raw).sum(axis=1))
        self.length = np.sqrt((self.rounded.astype(np.float64) ** 2).sum(axis=1)) * self.scale


def tile(query: Side, other: Side, heaps: list[list[tuple[float, int]]], k: int) -> None:
    """Push what may be among the k nearest of each query; heaps hold (score, -vec_id), the worst first."""
    near = np.zeros((len(query.ids), len(other.ids)))
    for lo in range(0, query.dim, EXACT_DIMS):
        near += query.rounded[:, lo : lo + EXACT_DIMS] @ other.rounded[:, lo : lo + EXACT_DIMS].T
    near *= query.scale[:, None] * other.scale[None, :]
    near[query.ids[:, None] == other.ids[None, :]] = -np.inf
    slack = query.error[:, None] * other.length[None, :] + (query.length + query.error)[:, None] * other.error[None, :] + 1e-9
    floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps]) - 1e-12
    if near.shape[1] > k:
        floor = np.maximum(floor, np.partition(near - slack, near.shape[1] - k, axis=1)[:, near.shape[1] - k])
    q, c = np.nonzero((near + slack >= floor[:, None]) & (near > -np.inf))
    for lo in range(0, len(q), RECOMPUTED):
        a, b = q[lo : lo + RECOMPUTED], c[lo : lo + RECOMPUTED]
        exact = np.einsum("ij,ij->i", query.raw[a], other.raw[b]) / (query.norm[a] * other.norm[b])
        for i, score, vec_id in zip(a.tolist(), exact.tolist(), other.ids[b].tolist(), strict=True):
            if len(heaps[i]) < k:
                heapq.heappush(heaps[i], (score, -vec_id))
            elif (score, -vec_id) > heaps[i][0]:
                heapq.heapreplace(heaps[i], (score, -vec_id))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row where is_query (on vec_id) holds, exactly.

    Nearness is the cosine in double precision, ties go to the smaller vec_id. Candidates are all rows but those
    with the query's own vec_id, of the query's dimension; fewer than k candidates are all returned. usable() says
    which vectors take part. A vec_id that stands for several vectors is as many candidates; as a query it
    gets one joint list. Of equal vectors only the k + 1 smallest vec_ids can ever be returned, so only these become
    candidates (found by a limit within each task before the shuffle). No rows, or no queries: no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    with temporary():
        rows = written(usable(vectors), "vectors")
        order = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
        candidates = kept(written(rows.withColumn("_n", order).where(F.col("_n") <= k + 1).select("vec_id", "v").mapInArrow(_packed(CANDIDATES), _BLOCK), "blocks", wide=True))
        queries = kept(written(rows.where(is_query).mapInArrow(_packed(QUERIES), _BLOCK), "queries", wide=True))
    n_candidates = candidates.count()
    n_queries, held = queries.agg(F.count("*"), F.sum(F.col("n").cast("long") * F.col("dim") * 12)).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    down = max(1, -(-held // HELD_BYTES))
    across = max(1, min(n_candidates, -(-2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // down)))

    def sent(blocks: DataFrame, side: int, own: int, other: int) -> DataFrame:
        """Blocks of one side, each to the cells of its row or column of the grid."""
        place = F.pmod(F.xxhash64("ids"), F.lit(own)).cast("int")
        cell = place * across + F.col("to") if not side else F.col("to") * across + place
        return blocks.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).select(cell.alias("cell"), F.lit(side).alias("side"), *_block.names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            for side, heaps in held:
                found = [(int(q), -v, s) for q, heap in zip(side.ids, heaps, strict=True) for s, v in heap]
                yield batch_of(_hits, query_id=[x[0] for x in found], vec_id=[x[1] for x in found], score=[x[2] for x in found])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["cell"] != cell:
                    yield from out()
                    cell, held = row["cell"], []
                block = Side(row)
                if not row["side"]:
                    held.append((block, [[] for _ in block.ids]))
                    continue
                for side, heaps in held:
                    if side.dim == block.dim:
                        tile(side, block, heaps, k)
        yield from out()

    cells = sent(queries, 0, down, across).unionByName(sent(candidates, 1, across, down))
    dealt = cells.repartitionById(down * across, F.col("cell")).sortWithinPartitions("cell", "side")
    hits = dealt.mapInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
