"""Spelling variant grouping: words of a corpus that are one edit apart, and the form that each is a variant of.

Of two words that differ by one inserted, deleted or replaced character, the place of the edit is where they first differ: the
length c of their common prefix. Before it they share a prefix, after it a suffix. With l the length of the shorter, c is between 0 and l.
Either c >= l div 2, and they share a prefix of that length: they are near each other in the sorted dictionary. Or
c < l div 2, and they share a suffix of l - l div 2: they are near each other in the dictionary of reversed words.

So a block is an interval of c, lo <= c < up, with the prefix of lo and the suffix of l - up that its words share. A word of length n stands
in blocks of l = n (as the shorter, or of two equal ones) and of l = n - 1 (as the longer). A block of more than BLOCK
words is divided: each of its words goes to the two halves of the interval, with a longer prefix in one and a longer suffix in the
other. This ends, as words that share all but one character are as many as the alphabet has. Every pair has one c and one l, so it is found
in exactly one block. Blocks are dealt to tasks by key and sorted; a task scans them one at a time and verifies.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batch_of, kept, small_batches, temporary, written

SHORTEST = 7
LEAST = 2
#: A form is at least so many times as frequent.
RATIO = 10
#: Occurrences whose crc32 this divides lose a character.
DAMAGED = 31
#: Words of a block that one task compares.
BLOCK = 64
#: Words that a task counts before it passes them on.
HELD = 200_000
#: Frequencies grow by RATIO at each step to a form, so 2 ** 5 steps are more than a long has room for.
STEPS = 5

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_counted = pa.schema([("word", pa.string()), ("n", pa.int64())])
_near = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def words_of(doc_id: int | None, text: str | None) -> Counter[str]:
    """What the long enough runs of letters of a text become, and how often.

    A null doc_id is the empty string before the colon; null and empty texts have no words.
    """
    found: Counter[str] = Counter()
    start = f"{'' if doc_id is None else doc_id}:".encode()
    for run, n in Counter(_RUN.findall(text or "")).items():
        run = run.translate(_LOWER)
        h = zlib.crc32(start + run.encode("utf-8", "surrogatepass"))
        if not h % DAMAGED:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= SHORTEST:
            found[run] += n
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a task's rows, passed on whenever HELD of them have come up."""
    found: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        batch = batch_of(_counted, word=list(found), n=list(found.values()))
        found.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found.update(words_of(doc_id, text))
            if len(found) >= HELD:
                yield out()
    if found:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that occur at least LEAST times."""
    return docs.select("doc_id", "text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _placed(rows: DataFrame) -> DataFrame:
    """rows (word, n, l, lo, up) with the key of their block. Equal keys of different blocks only cost comparisons."""
    prefix, suffix = F.expr("left(word, lo)"), F.expr("right(word, greatest(l - up, 0))")
    return rows.withColumn("key", F.xxhash64("l", "lo", "up", prefix, suffix))


def _halves(rows: DataFrame) -> DataFrame:
    """Every row in both halves of its interval; an interval of one place stays."""
    middle = F.expr("(lo + up) div 2").cast("int")
    side = lambda lo, up: F.struct(lo.cast("int").alias("lo"), up.cast("int").alias("up"))
    lo, up = F.col("lo"), F.col("up")
    both = F.array(side(lo, middle), side(middle, up))
    return rows.withColumn("s", F.explode(both)).select("word", "n", "l", F.col("s.lo").alias("lo"), F.col("s.up").alias("up"))


def blocks(words: DataFrame, most: int = BLOCK) -> list[DataFrame]:
    """Rows (word, n, l, lo, up, key) of blocks with two or more words, in tables of which the later ones divide blocks of
    the earlier; blocks of more than `most` words have one place left."""
    length = F.length("word")
    rows = words.withColumn("l", F.explode(F.array(length, length - 1))).select("word", "n", "l", F.lit(0).alias("lo"), (F.col("l") + 1).alias("up"))
    found = []
    rows = _halves(rows)
    while True:
        rows = written(_placed(rows), "blocks")
        sizes = written(rows.groupBy("key").agg(F.count("*").alias("k"), F.min(F.col("up") - F.col("lo")).alias("width")).where("k > 1"), "sizes")
        heavy = (F.col("k") > most) & (F.col("width") > 1)
        found.append(rows.join(sizes.where(~heavy), "key", "left_semi"))
        if not sizes.where(heavy).head(1):
            return found
        rows = _halves(rows.join(sizes.where(heavy), "key", "left_semi"))


def first_difference(a: str, b: str) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    if n <= 32:
        for i in range(n):
            if a[i] != b[i]:
                return i
        return n
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n - 1  # a[:lo] == b[:lo], and they differ at hi or before
    while lo < hi:
        middle = (lo + hi) // 2
        if a[lo : middle + 1] == b[lo : middle + 1]:
            lo = middle + 1
        else:
            hi = middle
    return lo


def pair_place(a: str, b: str) -> int | None:
    """Where two different words, the first not the longer, are one edit apart; None if they are not."""
    c = first_difference(a, b)
    if len(a) == len(b):
        return c if a[c + 1 :] == b[c + 1 :] else None
    return c if a[c:] == b[c + 1 :] else None


def compared(rows: list[tuple[str, int, int, int, int]]) -> dict[str, list]:
    """Of the rows (word, n, l, lo, up) of one key: word -> [near words, n of the best, the best]."""
    found: dict[str, list] = {}

    def met(word: str, other: str, n: int) -> None:
        best = found.setdefault(word, [0, 0, ""])
        best[0] += 1
        if (-n, other) < (-best[1], best[2]):
            best[1:] = n, other

    short: dict[tuple[int, int, int], list[tuple[str, int]]] = {}
    long: dict[tuple[int, int, int], list[tuple[str, int]]] = {}
    for word, n, l, lo, up in rows:
        (short if len(word) == l else long).setdefault((l, lo, up), []).append((word, n))
    for (l, lo, up), own in short.items():
        others = long.get((l, lo, up), [])
        for i, (a, n) in enumerate(own):
            for b, m in own[i + 1 :] + others:
                c = pair_place(a, b)
                if c is not None and lo <= c < up:
                    met(a, b, m)
                    met(b, a, n)
    return found


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of key: each block is compared as soon as the next begins."""
    key, held = None, []
    out: list[tuple] = []

    def close() -> None:
        out.extend((word, k, n, form) for word, (k, n, form) in compared(held).items())

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "word", "n", "l", "lo", "up")]
        for k, *row in zip(*columns, strict=True):
            if k != key:
                close()
                key, held = k, []
            held.append(tuple(row))
        if out:
            yield batch_of(_near, **dict(zip(_near.names, zip(*out, strict=True), strict=True)))
            out.clear()
    close()
    if out:
        yield batch_of(_near, **dict(zip(_near.names, zip(*out, strict=True), strict=True)))


def neighbours(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """(word, n_near, form_n, form): how many words are near, the largest n of these, and the first word that has it."""
    tables = blocks(words, most)
    spark = words.sparkSession
    small_batches(spark)
    parts = [rows.repartition("key").sortWithinPartitions("key").mapInArrow(_verify, "word string, n_near long, form_n long, form string") for rows in tables]
    pairs = parts[0]
    for more in parts[1:]:
        pairs = pairs.unionByName(more)
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.form").alias("form"))


def rooted(words: DataFrame) -> DataFrame:
    """words (word, form, ...) with root, the last that forms lead to: the way is doubled STEPS times."""
    roots = words.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(STEPS):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return words.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def grouped(docs: DataFrame, most: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of docs.

    Words are runs of Latin letters (A-Z lower-cased, one occurrence in 31 with a character taken out, by the document's id) of at
    least SHORTEST characters with at least LEAST occurrences. The form is the near word with the largest n if that is RATIO times the
    word's own; of equally frequent ones the smallest by code point. Null and empty texts have no words; repeated rows
    count again; empty docs give no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    with temporary():
        words = written(vocabulary(docs), "words")
        near = neighbours(words, most)
        frequent = F.col("form_n") >= F.col("n") * RATIO
        found = words.join(near, "word", "left")
        found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n")), "found")
        return kept(written(rooted(found).select("word", "form", "root", "n", "n_near", "form_n"), "variants"))
