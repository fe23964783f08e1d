"""SimHash near-duplicates by a binary trie self-join.

Every distinct fingerprint is a leaf of a binary trie. The join walks pairs of nodes from the root, adds up the
bits in which their prefixes differ, and drops a pair as soon as the error budget is exceeded. Of two
fingerprints with at most three differing bits, one half of 32 bits differs in at most one; so two tries are
walked, one from either half, with a budget of one for the first 32 bits and of three for all 64.

Upper levels are DataFrames: heavy node pairs are split four levels at a time, by counts of their nodes. Node
pairs that are light enough are walked to the leaves inside a task. There a pair of subtrees that is already
connected is left alone, so a dense ball of near copies gives a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm import near_copies
from tracewright.llm.common import joined, kept, small_batches, temporary, written
from tracewright.llm.components import connected

BUDGET = 3
HALF_BUDGET = 1
SHINGLE = 3
SEED = 42
#: Fingerprints below a node pair that one task may walk.
LEAF = 1 << 16
STEP = 4
_CHUNK = 1 << 12
_BIT = (np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the hashes of the word shingles, repeats included.

    Words are runs without ASCII white space, A-Z lower-cased; fewer words than a shingle are one shingle; no
    words (empty or null text) give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    if len(words) < shingle:
        runs: Iterator[bytes] = iter([b" ".join(words)])
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    left = n
    while left:
        some = min(left, _CHUNK)
        hashes = np.fromiter((digest(next(runs), SEED) for _ in range(some)), ">u8", some)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(some, 8), axis=1).sum(axis=0, dtype=np.int64)
        left -= some
    return int(_BIT[ones * 2 > n].sum(dtype=np.uint64))


def fingerprint_of(spark, text: str = "text") -> Column:
    """The fingerprint of a text column as a signed 64-bit integer; null and empty texts give 0, equal texts the same."""

    @F.pandas_udf("long")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t if isinstance(t, str) else None) for t in batch], np.uint64).view(np.int64))

    small_batches(spark)
    return make(F.col(text))


def walk(left: np.ndarray, right: np.ndarray, start: int, used: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (two arrays of fingerprints) that connect what is within the budgets between two subtrees.

    left, right: sorted fingerprints below two nodes at depth `start`, the left prefix the smaller, whose prefixes
    differ in `used` bits; with `same` they are one node. Of links that close a circle only some are given.
    """
    keys = left if same else np.concatenate((left, right))
    n_left = len(left)
    parent = np.arange(len(keys))

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            up = parent[x]
            if (up == x).all():
                return x
            x = up

    def flat() -> None:
        while True:
            up = parent[parent]
            if (up == parent).all():
                return
            parent[:] = up

    links: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        differing = keys[a] ^ keys[b]
        near = (np.bitwise_count(differing) <= BUDGET) & (np.bitwise_count(differing >> np.uint64(32)) <= HALF_BUDGET)
        if near.any():
            links.append(_forest(parent, a[near], b[near], find, flat))

    root = (0, n_left, 0 if same else n_left, n_left if same else len(keys))
    stack = [(start, np.array([root], np.int64).reshape(1, 4), np.array([used], np.int64))]
    while stack:
        depth, nodes, acc = stack.pop()
        if len(nodes) > 1 << 15:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half], acc[:half]), (depth, nodes[half:], acc[half:])]
            continue
        a, b, c, d = nodes.T
        small = (b - a) * (d - c) <= 16
        if depth >= 64:
            small[:] = True
        if small.any():
            compare(*_products(a[small], b[small], c[small], d[small]))
        nodes, acc = nodes[~small], acc[~small]
        if not len(nodes):
            continue
        nodes, acc = _unconnected(nodes, acc, parent)
        if not len(nodes):
            continue
        a, b, c, d = nodes.T
        m, k = _split(keys, a, b, depth), _split(keys, c, d, depth)
        limit = HALF_BUDGET if depth < 32 else BUDGET
        own = (a == c) & (b == d)
        children = [
            (np.stack((a, m, c, k), 1), acc, np.ones(len(a), bool)),
            (np.stack((m, b, k, d), 1), acc, np.ones(len(a), bool)),
            (np.stack((a, m, k, d), 1), acc + 1, np.ones(len(a), bool)),
            (np.stack((m, b, c, k), 1), acc + 1, ~own),
        ]
        rows = np.concatenate([x for x, _, _ in children])
        cost = np.concatenate([x for _, x, _ in children])
        kept = np.concatenate([x for _, _, x in children]) & (cost <= limit) & (rows[:, 0] < rows[:, 1]) & (rows[:, 2] < rows[:, 3])
        kept &= ~((rows[:, 0] == rows[:, 2]) & (rows[:, 1] - rows[:, 0] == 1) & (rows[:, 3] - rows[:, 2] == 1))
        if kept.any():
            stack.append((depth + 1, rows[kept], cost[kept]))
    if not links:
        return keys[:0], keys[:0]
    x, y = np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])
    return keys[x], keys[y]


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit at `depth` turns to 1 in the sorted keys[lo:hi], which agree in all bits before it."""
    shift = np.uint64(63 - depth)
    return np.clip(np.searchsorted(keys, ((keys[lo] >> shift) | np.uint64(1)) << shift), lo, hi)


def _products(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) with i in a:b and j in c:d of every row; of a node with itself, i < j."""
    wide = d - c
    sizes = (b - a) * wide
    row = np.repeat(np.arange(len(a)), sizes)
    k = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    i, j = a[row] + k // wide[row], c[row] + k % wide[row]
    kept = (a[row] != c[row]) | (i < j)
    return i[kept], j[kept]


def _unconnected(nodes: np.ndarray, acc: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the node pairs whose leaves are all in one component."""
    change = np.concatenate(([0], np.cumsum(parent[1:] != parent[:-1])))
    a, b, c, d = nodes.T
    whole = (change[b - 1] == change[a]) & (change[d - 1] == change[c]) & (parent[a] == parent[c])
    return nodes[~whole], acc[~whole]


def _forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray, find, flat) -> tuple[np.ndarray, np.ndarray]:
    """Join a and b in parent; returns the links that joined two components (some of them may close a circle)."""
    xs, ys = [], []
    while len(a):
        ra, rb = find(a), find(b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        high, low = np.maximum(ra, rb), np.minimum(ra, rb)
        _, first = np.unique(high, return_index=True)  # each root is hung once a round
        parent[high[first]] = low[first]
        xs.append(a[first])
        ys.append(b[first])
    flat()
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (a[:0], b[:0])


def _rotated(turn: int, column: Column) -> Column:
    """The half that a trie starts from comes first."""
    return column if not turn else F.shiftleft(column, 32).bitwiseOR(F.shiftrightunsigned(column, 32))


def _prefix(key: str, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def links(fingerprints: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (column `fp`, written) that are within the budget."""
    spark = fingerprints.sparkSession
    leaves = fingerprints.select(F.lit(0).alias("turn"), F.col("fp").alias("key")).unionByName(fingerprints.select(F.lit(1).alias("turn"), _rotated(1, F.col("fp")).alias("key")))
    n = fingerprints.count()
    work = spark.createDataFrame([(t, 0, 0, 0, 2 * n) for t in (0, 1)], "turn int, p long, q long, used int, size long")
    light, depth = [], 0
    while True:
        light.append((depth, work.where(F.col("size") <= leaf) if depth < 60 else work))
        heavy = work.where(F.col("size") > leaf)
        if depth >= 60 or not heavy.head(1):
            break
        depth += STEP
        counts = leaves.groupBy("turn", _prefix("key", depth).alias("node")).agg(F.count("*").alias("n"))
        counts = counts.withColumn("up", F.shiftrightunsigned("node", STEP))
        left = counts.select("turn", F.col("up").alias("p"), F.col("node").alias("cp"), F.col("n").alias("np"))
        right = counts.select("turn", F.col("up").alias("q"), F.col("node").alias("cq"), F.col("n").alias("nq"))
        children = heavy.join(left, ["turn", "p"]).join(right, ["turn", "q"])
        used = F.col("used") + F.bit_count(F.col("cp").bitwiseXOR(F.col("cq")).bitwiseAND(F.lit((1 << STEP) - 1)))
        limit = HALF_BUDGET if depth <= 32 else BUDGET
        children = children.select("turn", F.col("cp").alias("p"), F.col("cq").alias("q"), used.cast("int").alias("used"), (F.col("np") + F.col("nq")).alias("size"))
        work = written(children.where((F.col("used") <= limit) & ((F.col("p") < F.col("q")) | ((F.col("p") == F.col("q")) & (F.col("used") == 0)))), f"nodes{depth}")
    found = None
    for depth, pairs in light:
        pairs = pairs.withColumn("depth", F.lit(depth))
        sides = F.when(F.col("p") == F.col("q"), F.array(F.struct(F.col("p").alias("node"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("p").alias("node"), F.lit(0).alias("side")), F.struct(F.col("q").alias("node"), F.lit(1).alias("side"))))
        wanted = pairs.select("turn", "p", "q", "used", "depth", F.explode(sides).alias("s")).select("turn", "p", "q", "used", "depth", "s.node", "s.side")
        members = leaves.withColumn("node", _prefix("key", depth)).join(wanted, ["turn", "node"]).select("turn", "depth", "p", "q", "used", "side", "key")
        found = members if found is None else found.unionByName(members)

    def join(group: pa.Table) -> pa.Table:
        turn, depth, used = (group.column(c)[0].as_py() for c in ("turn", "depth", "used"))
        side, key = group.column("side").to_numpy(), group.column("key").to_numpy().view(np.uint64)
        a, b = walk(np.sort(key[side == 0]), np.sort(key[side == 1]), depth, used, group.column("p")[0].as_py() == group.column("q")[0].as_py())
        if turn:
            a, b = (x << np.uint64(32) | x >> np.uint64(32) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return found.groupBy("turn", "depth", "p", "q").applyInArrow(join, "a long, b long")


def classes(marked: DataFrame, first: Column) -> DataFrame:
    """(fp, smallest): for every fingerprint of marked (column fp, written), the least value of the aggregate `first`
    over all rows that links lead to."""
    with temporary():
        distinct = written(marked.groupBy("fp").agg(first.alias("first")), "distinct")
        members = connected(links(distinct))
        roots = distinct.join(members, distinct["fp"] == members["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        linked = roots.where(F.col("root") != F.col("fp")).select("root").distinct()
        smallest = roots.join(linked, "root").groupBy("root").agg(F.min("first").alias("smallest"))
        return kept(written(roots.join(smallest, "root", "left").select("fp", F.coalesce("smallest", "first").alias("smallest")), "classes"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id of every row of docs.

    component_id is the smallest doc_id that is reachable by links of at most three differing bits, the row's own
    included. A null or empty text has fingerprint zero and is linked like any other. Rows with equal doc_id are
    rows of their own; a null doc_id is never the smallest unless there is no other (then component_id is null).
    Empty docs give no rows; other columns are ignored.
    """
    marked = written(docs.select("doc_id", fingerprint_of(docs.sparkSession).alias("fp")), "fingerprints")
    found = classes(marked, F.min("doc_id"))
    return marked.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("smallest").alias("component_id"))


def _candidates(nodes: DataFrame) -> DataFrame:
    """(u, v) of nodes (id, fp): the trie's links between the first nodes of two fingerprints, and the others of a fingerprint with its first."""
    first = written(nodes.groupBy("fp").agg(F.min("id").alias("first")), "first")
    same = nodes.select("id", "fp").join(first, "fp").where("id <> first").select(F.col("first").alias("u"), F.col("id").alias("v"))
    a, b = (first.select(F.col("fp").alias(end), F.col("first").alias(name)) for end, name in (("a", "u"), ("b", "v")))
    return same.unionByName(links(first.select("fp")).join(a, "a").join(b, "b").select("u", "v"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near copies, that of the smallest doc_id (null last), all columns kept.

    Links of the fingerprint's trie, and texts that share a band of min-hashes, for what differs in more bits, are candidates; each is
    confirmed by the similarity of five-word shingles (near_copies).
    Of repeated rows one stays; null and empty texts are one group; empty docs give no rows. Rows are numbered, and
    the numbers of those that go are joined against the rows, so no text is shuffled where these are few.
    """
    mark, row = (next(x for x in (name, f"_{name}", f"__{name}", f"___{name}") if x not in docs.columns) for name in ("mark", "row_number"))
    with temporary():
        marked = written(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(mark, near_copies.described(docs.sparkSession, fingerprint)), "marked")
        who = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col(row).alias("row"))
        nodes = written(marked.groupBy(F.col(mark)["id"].alias("id")).agg(F.min(who).alias("first"), F.first(F.col(mark)["size"]).alias("size"), F.first(F.col(mark)["bands"]).alias("bands"), F.min(F.col(mark)["fp"]).alias("fp")), "nodes")

        def texts(ids: DataFrame) -> DataFrame:
            wanted = written(nodes.join(ids, "id").select("id", F.col("first.row").alias("row")), "wanted")
            return joined(marked.select(F.col(row).alias("row"), "text"), wanted, ["row"]).select("id", "text")

        members = near_copies.components(nodes, texts, written(_candidates(nodes), "candidates"))
        roots = nodes.join(members, nodes["id"] == members["node"], "left").select("first", F.coalesce("root", "id").alias("root"))
        stay = written(roots.groupBy("root").agg(F.min("first").alias("smallest")).select(F.col("smallest.row").alias(row)), "stay")
        go = written(marked.select(row).join(stay, row, "left_anti"), "go")
        return joined(kept(marked), kept(go), [row], "left_anti").select(docs.columns)
