"""Token ids as compact binary shards: frequency-ranked ids, byte-aligned lengths, control bytes apart.

File format (a folder of Parquet files, one row a block of whole documents, rows ascending by doc_id):
  part, seq      place of the block: blocks ascend by (part, seq)
  doc_id, start, n_tokens   arrays, one entry a document; start counts all ids of the documents before it
  control        two bits a value, four values a byte, low bits first: its length in bytes less one
  data           the values, each its rank among ids by falling frequency, little-endian, without padding
A second folder holds the rank table (rank, id). Decoding maps each control byte to four lengths by table
lookup, sums them to offsets, gathers the bytes, and maps ranks to ids by the rank table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batch_of, discard, slices, small_batches, written
from tracewright.llm.tokenizing import encoder

#: Distinct pieces that a worker keeps encoded while it makes tokens.
REMEMBERED = 1_000_000
#: Tokens after which a block is closed.
BLOCK_TOKENS = 1 << 16

_TOKENS = "part int, pos long, doc_id long, local_start long, n_tokens long, ids binary, seen_ids array<int>, seen_counts array<long>"
_BLOCKS = "part int, seq long, doc_id array<long>, start array<long>, n_tokens array<long>, control binary, data binary"
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    lengths = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    at = np.cumsum(lengths) - lengths
    data = np.empty(int(lengths.sum()), np.uint8)
    data[at] = values & 0xFF
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        data[at[longer] + k] = (values[longer] >> np.uint32(8 * k)) & 0xFF
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of pack_values."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _tokenise(path: str, end_id: int, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, remembered)
        end = np.array([end_id], enc.dtype).tobytes()
        part, pos, total = TaskContext.get().partitionId(), 0, 0
        counts = np.zeros(max(enc.vocabulary, end_id + 1), np.int64)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in slices(texts):
                made = [x + end for x in enc.encode([t or "" for t in texts[lo:hi]])]
                sizes = [len(x) // len(end) for x in made]
                counts += np.bincount(np.frombuffer(b"".join(made), enc.dtype), minlength=len(counts))
                starts = [total + int(x) for x in np.cumsum([0, *sizes[:-1]])]
                yield batch_of(
                    _arrow_tokens, part=[part] * len(made), pos=range(pos, pos + len(made)), doc_id=ids[lo:hi], local_start=starts, n_tokens=sizes,
                    ids=made, seen_ids=[None] * len(made), seen_counts=[None] * len(made),
                )
                total, pos = total + sum(sizes), pos + len(made)
        seen = np.flatnonzero(counts)
        yield batch_of(_arrow_tokens, part=[part], pos=[-1], doc_id=[None], local_start=[None], n_tokens=[total], ids=[None], seen_ids=[seen.tolist()], seen_counts=[counts[seen].tolist()])

    return run


_arrow_tokens = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("seen_ids", pa.list_(pa.int32())), ("seen_counts", pa.list_(pa.int64()))])
_arrow_blocks = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("start", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 2, remembered: int = REMEMBERED) -> tuple[DataFrame, DataFrame]:
    """Encode whole texts and write the shards; returns (blocks, rank table), both read back from files.

    docs needs doc_id and text. A null text is empty: its document holds the end id alone. Documents ascend by
    doc_id (null first), rows with equal doc_id by a hash of the text; each row is a document of its own. An
    empty table gives no blocks. Other columns are ignored.
    Tokens are made once, in document order, and written; counts of ids (one row a task and id) and one token
    total a task are all that is gathered. `remembered` bounds the pieces that a worker keeps encoded.
    """
    spark = docs.sparkSession
    small_batches(spark)
    in_order = docs.select("doc_id", "text").orderBy("doc_id", F.xxhash64("text"))
    tokens = written(in_order.mapInArrow(_tokenise(tokenizer, end_id, remembered), _TOKENS), "tokens")
    ends = tokens.where("pos = -1")
    counts = ends.select(F.explode(F.arrays_zip("seen_ids", "seen_counts")).alias("s")).groupBy(F.col("s.seen_ids").alias("id")).agg(F.sum("s.seen_counts").alias("n")).toPandas()
    by_rank = counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)
    ranks = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    offsets, total = {}, 0
    for part, n in sorted((r.part, r.n_tokens) for r in ends.select("part", "n_tokens").collect()):
        offsets[part], total = total, total + n
    shared = spark.sparkContext.broadcast((ranks, offsets))
    dtype = encoder(tokenizer).dtype

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, offsets = shared.value
        for batch in batches:
            part, pos, doc_id, local, sizes, ids = (batch.column(c).to_pylist() for c in ("part", "pos", "doc_id", "local_start", "n_tokens", "ids"))
            lo = size = 0
            for i, n in enumerate(sizes):
                size += n
                if size >= BLOCK_TOKENS or i + 1 == len(sizes) or part[i + 1] != part[i]:
                    control, data = pack_values(ranks[np.frombuffer(b"".join(ids[lo : i + 1]), dtype)])
                    starts = [offsets[part[i]] + x for x in local[lo : i + 1]]
                    yield batch_of(_arrow_blocks, part=[part[i]], seq=[pos[lo]], doc_id=[doc_id[lo : i + 1]], start=[starts], n_tokens=[sizes[lo : i + 1]], control=[control], data=[data])
                    lo, size = i + 1, 0

    docs_only = tokens.where("pos >= 0").select("part", "pos", "doc_id", "local_start", "n_tokens", "ids")
    blocks = written(docs_only.mapInArrow(encode, _BLOCKS), "shards", wide=True)
    rank_table = written(spark.createDataFrame([(i, int(t)) for i, t in enumerate(by_rank)], "rank long, id long"), "ranks")
    discard(tokens)
    return blocks, rank_table


def _decoded(blocks: DataFrame, rank_table: DataFrame, last: str, made, kind: pa.DataType) -> DataFrame:
    """doc_id, start, n_tokens of the documents in blocks, and made(ids) as column `last`."""
    by_rank = blocks.sparkSession.sparkContext.broadcast(rank_table.toPandas().sort_values("rank")["id"].to_numpy(np.uint32))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (last, kind)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("doc_id", "start", "n_tokens", "control", "data")}
                ids = by_rank.value[unpack_values(row["control"], row["data"], sum(row["n_tokens"]))].astype("<u4", copy=False)
                ends = np.cumsum(row["n_tokens"]).tolist()
                yield batch_of(schema, doc_id=row["doc_id"], start=row["start"], n_tokens=row["n_tokens"], **{last: [made(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]})

    return blocks.mapInArrow(decode, f"doc_id long, start long, n_tokens long, {last} {'binary' if kind == pa.binary() else 'long'}")


def read_shards(blocks: DataFrame, rank_table: DataFrame) -> DataFrame:
    """One row a document: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    return _decoded(blocks, rank_table, "ids", np.ndarray.tobytes, pa.binary())


def digests(blocks: DataFrame, rank_table: DataFrame) -> DataFrame:
    """One row a document: doc_id, start, n_tokens, ids_crc32, from the ids read back."""
    return _decoded(blocks, rank_table, "ids_crc32", zlib.crc32, pa.int64())
