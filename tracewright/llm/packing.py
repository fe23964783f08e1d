"""Hierarchical packing: documents are routed to context sizes, each size is packed, gaps of long windows
take documents of shorter sizes, and sequences are dealt to step groups of equal token counts: all groups of a task
have STEP_SEQUENCES times the longest size, but the last one, which takes what is left.

Every task packs the documents of its own partition, so nothing is shuffled. Windows are powers of two and
are always filled to the last token (a document is cut only where no whole one fits), so no sequence needs
padding; what is left of a partition goes into ever smaller powers of two.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tracewright.llm.common import batch_of, slices, small_batches
from tracewright.llm.tokenizing import encoder

TIERS = (512, 1024, 2048, 4096)
#: Sequences of the longest size in a step group; shorter sizes get as many tokens.
STEP_SEQUENCES = 64
#: Tokens that wait in a task for a good place.
POOL_TOKENS = 1 << 19

_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
_arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64())])


class Packer:
    """Pieces are (length, arrival, document key, start); tiers hold those that wait, sorted by length."""

    def __init__(self, tiers: tuple[int, ...], base: int, pool_tokens: int, step_sequences: int):
        self.tiers, self.base, self.pool = tuple(sorted(tiers)), base, pool_tokens
        self.waiting: dict[int, list[tuple]] = {t: [] for t in self.tiers}
        self.tokens = {t: 0 for t in self.tiers}
        self.sequences = self.arrivals = 0
        self.step_tokens = step_sequences * self.tiers[-1]
        self.open: dict[int, list[list[tuple]]] = {}  # sequences of a size that wait for a full step group
        self.groups = 0
        self.done: list[tuple] = []

    def add(self, key, n: int) -> None:
        longest = self.tiers[-1]
        whole = n // longest * longest
        for start in range(0, whole, longest):
            self._emit(longest, [(longest, 0, key, start)])
        self._wait(key, whole, n - whole)
        for tier in self.tiers:
            while self.tokens[tier] > self.pool // len(self.tiers):
                self._fill(tier, tier)

    def _wait(self, key, start: int, n: int) -> None:
        if n:
            tier = next(t for t in self.tiers if t >= n)
            self.arrivals += 1
            insort(self.waiting[tier], (n, self.arrivals, key, start))
            self.tokens[tier] += n

    def _take(self, tier: int, i: int) -> tuple:
        piece = self.waiting[tier].pop(i)
        self.tokens[tier] -= piece[0]
        return piece

    def _fill(self, size: int, top: int) -> None:
        """One sequence of exactly `size` tokens, from tiers up to `top`, longest pieces that fit first."""
        got, gap = [], size
        while gap:
            for tier in (t for t in reversed(self.tiers) if t <= top):
                i = bisect_right(self.waiting[tier], (gap, float("inf"))) - 1
                if i >= 0:
                    piece = self._take(tier, i)
                    break
            else:  # nothing fits whole: the shortest of those that wait is cut
                tier = next(t for t in self.tiers if self.waiting[t])
                n, order, key, start = self._take(tier, 0)
                piece = (gap, order, key, start)
                self._wait(key, start + gap, n - gap)
            got.append(piece)
            gap -= piece[0]
        self._emit(size, got)

    def _emit(self, size: int, pieces: list[tuple]) -> None:
        offset, made = 0, []
        for n, _, key, start in pieces:
            made.append((key, start, n, self.base + self.sequences, offset, size))
            offset += n
        self.sequences += 1
        waiting = self.open.setdefault(size, [])
        waiting.append(made)
        if len(waiting) * size >= self.step_tokens:
            self._close(self.open.pop(size))

    def _close(self, sequences: list[list[tuple]]) -> None:
        self.done += [(*piece, self.base + self.groups) for sequence in sequences for piece in sequence]
        self.groups += 1

    def finish(self) -> None:
        for tier in reversed(self.tiers):
            while sum(self.tokens[t] for t in self.tiers if t <= tier) >= tier and self.waiting[tier]:
                self._fill(tier, tier)
        while left := sum(self.tokens.values()):
            self._fill(min(self.tiers[-1], 1 << (left.bit_length() - 1)), self.tiers[-1])
        # sizes are powers of two: the longest first fill every mixed group to the last token
        group, used = [], 0
        for size in sorted(self.open, reverse=True):
            for sequence in self.open[size]:
                group.append(sequence)
                used += size
                if used >= self.step_tokens:
                    self._close(group)
                    group, used = [], 0
        if group:
            self._close(group)
        self.open = {}


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, tiers: tuple[int, ...] = TIERS, step_sequences: int = STEP_SEQUENCES) -> DataFrame:
    """Pack whole texts; one row a piece of a document, with its ids (little-endian unsigned 32-bit).

    docs needs doc_id and text; a null text is empty and its document holds the end id alone. Every row is a
    document of its own, rows with equal doc_id too. Each id lies in exactly one piece; sequences hold at most
    max(tiers) ids, without gaps from offset 0, and as many as a power of two. sequence_id and step_group are
    unique over the table. An empty table gives no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        packer = Packer(tiers, TaskContext.get().partitionId() << 40, POOL_TOKENS, step_sequences)
        held: dict[int, list] = {}  # row number -> doc_id, ids, ids still to place
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            done, packer.done = packer.done, []
            for lo in range(0, len(done), 2000):
                out: dict[str, list] = {f.name: [] for f in _arrow}
                for key, start, n, sequence, offset, size, group in done[lo : lo + 2000]:
                    entry = held[key]
                    doc_id, ids, _ = entry
                    for name, value in zip(_arrow.names, (doc_id, start, n, ids[start : start + n].astype("<u4").tobytes(), len(ids), sequence, offset, size, group), strict=True):
                        out[name].append(value)
                    entry[2] -= n
                    if not entry[2]:
                        del held[key]
                yield batch_of(_arrow, **out)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in slices(texts):
                for doc_id, made in zip(doc_ids[lo:hi], enc.encode([t or "" for t in texts[lo:hi]]), strict=True):
                    ids = np.frombuffer(made + end, enc.dtype)
                    held[rows] = [doc_id, ids, len(ids)]
                    packer.add(rows, len(ids))
                    rows += 1
                yield from flush()
        packer.finish()
        yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)
