"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Candidates share a band of min-hashes; every link is confirmed by the exact similarity of the shingle sets. Equal sets
are one node. Of each bucket the node that shares most with others is the hub, and all others are compared with it:
these are as many pairs as there are places in buckets, however large a group of copies is.

What is then not connected is found without comparing all pairs of a hub's group. Let h be the hub together with the shingles
that over half of the group has and the hub lacks, and x a set that is not connected to the group's largest component. For any y, |x & y| <= min(|x & h|, |y & h|) + |(x - h) & (y - h)|.
So x and y are compared only if the first term alone is enough (for which x must share nearly as much with h as a link takes) or if they
share, of the shingles that h lacks, one of the rarest: so many that a similar set cannot miss them all. No other pair can be similar. Where
these shingles would still make many more pairs than places, the sets of each are first compared with one of them, its centre, which
joins those that are copies of each other; rounds of this go on while they join anything.

Other candidates may be given beside these. Two texts of similarity s are missed only if they are not among those and share no band, with probability (1 - s ** ROWS) ** BANDS (at 0.8: 0.00007).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import small_batches, written
from tracewright.llm.components import connected
from tracewright.llm.features import mixed

SHINGLE = 5
BANDS, ROWS = 24, 5
SEED = 42
#: Similarity of at least 4 / 5: of two sets of a and b shingles, 9 * shared >= 4 * (a + b).
_CHUNK = 1 << 9
#: Rounds by centres are made, at most so many, while there are more than so many pairs a place.
ROUNDS, PAIRS = 10, 4
_rng = np.random.default_rng(SEED)
_FACTOR = _rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)[:, None] | np.uint64(1)
_OFFSET = _rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)[:, None]
_PLACE = _rng.integers(0, 2**64, max(SHINGLE, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 2**64, BANDS, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles, ascending.

    Words are those of the fingerprint: runs without ASCII white space, A-Z lower-cased; fewer words than a shingle
    are one shingle; no words (empty or null text) are none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    known = {w: xxhash.xxh64_intdigest(w, SEED) for w in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total += hashes[i : i + n] * _PLACE[i]
    return np.unique(mixed(total))


def bands(found: np.ndarray) -> np.ndarray:
    """One key a band: equal for two sets if all min-hashes of the band are."""
    if not len(found):
        return np.zeros(0, np.uint64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for lo in range(0, len(found), _CHUNK):
        np.minimum(least, (found[lo : lo + _CHUNK] * _FACTOR + _OFFSET).min(axis=1), out=least)
    return mixed((mixed(least).reshape(BANDS, ROWS) * _PLACE[:ROWS]).sum(axis=1, dtype=np.uint64) + _BAND)


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _signed(value: int) -> int:
    return value - (value >> 63 << 64)


def described(spark, fingerprint: Callable[[str | None], int], text: str = "text") -> Column:
    """struct<id, size, bands, fp>: the hash of the shingle set, its size, the keys of its bands and the fingerprint of the text.

    All come from one function: each function that Python works in a stage has a worker of its own beside every core, and gets all texts again.
    """

    @F.pandas_udf("id long, size long, bands array<long>, fp long")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                text = text if isinstance(text, str) else None
                found = shingles(text)
                rows.append((_signed(xxhash.xxh64_intdigest(found.tobytes(), SEED)), len(found), _long(bands(found)), _signed(fingerprint(text))))
            yield pd.DataFrame(rows, columns=["id", "size", "bands", "fp"])

    small_batches(spark)
    return make(F.col(text))


def sets_of(spark, text: str = "text") -> Column:
    """array<long>: the shingle set."""

    @F.pandas_udf("array<long>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_long(shingles(t if isinstance(t, str) else None)) for t in batch])

    small_batches(spark)
    return make(F.col(text))


def _near(a: Column, b: Column, shared: Column) -> Column:
    return shared * 9 >= (a + b) * 4


def _sets(ids: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return written(texts(ids).select("id", sets_of(ids.sparkSession).alias("found")), "sets")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (u, v, ...) with a and b, the shingle sets of u and v."""
    left, right = sets.select(F.col("id").alias("u"), F.col("found").alias("a")), sets.select(F.col("id").alias("v"), F.col("found").alias("b"))
    return pairs.join(left, "u").join(right, "v")


def _components(links: DataFrame) -> DataFrame:
    return connected(links.select(F.col("u").alias("a"), F.col("v").alias("b")))


def _spokes(nodes: DataFrame) -> DataFrame:
    """(hub, id) of every node of a bucket with two or more, the hub's own included, once for each hub."""
    members = nodes.select("id", "size", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = written(members.join(sizes, "band"), "members")
    degrees = members.groupBy("id").agg(F.sum("n").alias("degree"))
    hubs = members.select("band", "id").join(degrees, "id").groupBy("band").agg(F.max(F.struct("degree", F.bitwise_not("id").alias("i"), "id")).alias("h")).select("band", F.col("h.id").alias("hub"))
    return members.join(hubs, "band").select("hub", "id", "size").distinct()


def _placed(spokes: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the hubs whose group is not one component: with their root, the group's largest and the least size."""
    placed = spokes.join(roots, spokes["v"] == roots["node"], "left").select(F.col("u").alias("hub"), F.col("v").alias("id"), "size", "shared", "own", F.coalesce("root", "v").alias("root"))
    counts = placed.groupBy("hub", "root").agg(F.count("*").alias("n"), F.min("size").alias("size"))
    largest = counts.groupBy("hub").agg(F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("most"), F.min("size").alias("least")).where("roots > 1").select("hub", F.col("most.root").alias("largest"), "least")
    return placed.join(largest, "hub")


def _rare(placed: DataFrame) -> DataFrame:
    """A row for each of a member's shingles beyond its group's reference set that a similar set must share one of.

    They are placed by how many of the group have them, the rarest first (`at`; of `n`). A set of a shingles, of which the
    reference set has r, shares at least t = 4 / 9 * (a + b) - r of the others with any set of b that is similar to it, so two such sets share
    one of the first n - t + 1 of either. What most of a group has is last and hardly ever among these.
    """
    every = placed.select("hub", "id", F.explode("own").alias("shingle"))
    common = every.groupBy("hub", "shingle").agg(F.count("*").alias("k")).where("k > 1")
    found = every.join(common, ["hub", "shingle"]).groupBy("hub", "id").agg(F.array_sort(F.collect_list(F.struct("k", "shingle"))).alias("found"))
    partner = F.greatest("least", F.floor((F.col("size") * 4 + 4) / 5))
    t = F.floor(((F.col("size") + partner) * 4 + 8) / 9) - F.col("shared")
    rows = placed.join(found, ["hub", "id"]).withColumns({"n": F.size("own"), "last": F.size("own") - F.greatest(t, F.lit(1))})
    rows = rows.select("hub", "id", "size", "root", "shared", "largest", "n", "last", (F.col("n") - F.size("found")).alias("lone"), F.posexplode("found").alias("at", "f"))
    return rows.withColumn("at", F.col("at") + F.col("lone")).where("at <= last").select("hub", "id", "size", "root", "shared", "largest", "n", "at", "f.shingle")


def _shared_apart(rare: DataFrame) -> DataFrame:
    """(hub, shingle, among, outside, centre) of the shingles that sets of two components have; centre shares most with others."""
    weights = rare.groupBy("hub", "shingle").agg(F.count("*").alias("among"), F.count_if(F.col("root") != F.col("largest")).alias("outside"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").drop("lo", "hi")
    met = rare.join(weights, ["hub", "shingle"])
    weight = met.groupBy("hub", "id").agg(F.sum("among").alias("weight"))
    centres = met.join(weight, ["hub", "id"]).groupBy("hub", "shingle").agg(F.max(F.struct("weight", "id", "root")).alias("centre"))
    return weights.join(centres, ["hub", "shingle"])


def _by_centre(rare: DataFrame, met: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of each shingle's centre to the sets of other components that have the shingle: one comparison a place."""
    pairs = rare.join(met, ["hub", "shingle"]).where(F.col("root") != F.col("centre.root"))
    return _confirmed(written(pairs.select(F.least("id", "centre.id").alias("u"), F.greatest("id", "centre.id").alias("v")).distinct(), "centres"), sets)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return _compared(pairs, sets).where(_near(F.size("a"), F.size("b"), F.size(F.array_intersect("a", "b")))).select("u", "v")


def sharing(rare: DataFrame, met: DataFrame) -> DataFrame:
    """(u, v): all pairs of different components that share one of their rare shingles and, by their places, can share enough."""
    there = rare.join(met.select("hub", "shingle"), ["hub", "shingle"])
    here = there.where("root <> largest").select("hub", "shingle", *(F.col(c).alias(f"{c}2") for c in ("id", "size", "root", "shared", "n", "at")))
    once = (F.col("root") == F.col("largest")) | (F.col("id") < F.col("id2"))
    left = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    can = _near(F.col("size"), F.col("size2"), F.least(F.least("size", "size2"), F.least("shared", "shared2") + left))
    return there.join(here, ["hub", "shingle"]).where((F.col("root") != F.col("root2")) & once & can).select(F.least("id", "id2").alias("u"), F.greatest("id", "id2").alias("v"))


def components(nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], candidates: DataFrame) -> DataFrame:
    """(node, root) of what links join; nodes: id, size, bands of every distinct set (written); texts gives (id, text)
    of a table of ids; candidates: pairs (u, v) of ids that may be similar whether or not they share a band (written)."""
    spokes = written(_spokes(nodes), "spokes")
    ids = [spokes.select("id"), candidates.select(F.col("u").alias("id")), candidates.select(F.col("v").alias("id"))]
    sets = _sets(ids[0].unionByName(ids[1]).unionByName(ids[2]).distinct(), texts)
    shared, own = F.size(F.array_intersect("a", "b")), F.array_except("b", "a")
    spokes = written(_compared(spokes.select(F.col("hub").alias("u"), F.col("id").alias("v"), "size"), sets).select("u", "v", "size", F.size("a").alias("hub_size"), shared.alias("shared"), own.alias("own")), "spokes")
    links = spokes.where((F.col("u") != F.col("v")) & _near(F.col("hub_size"), F.col("size"), F.col("shared"))).select("u", "v")
    links = links.unionByName(written(_confirmed(candidates, sets), "links"))

    # the reference set of a group is its hub with what most of the group has and the hub lacks
    group = spokes.groupBy("u").agg(F.count("*").alias("n"))
    often = spokes.select("u", F.explode("own").alias("shingle")).groupBy("u", "shingle").agg(F.count("*").alias("k")).join(group, "u").where("2 * k > n")
    often = often.groupBy("u").agg(F.collect_set("shingle").alias("often"))
    own = F.array_except("own", F.coalesce("often", F.array().cast("array<long>")))
    spokes = spokes.join(often, "u", "left").withColumn("own", own).withColumn("shared", F.col("size") - F.size("own"))
    for turn in range(ROUNDS + 1):
        placed = written(_placed(spokes, written(_components(links), "roots")), "placed")
        rare = written(_rare(placed), "rare")
        met = written(_shared_apart(rare), "met")
        places, pairs = rare.count(), met.agg(F.sum(F.col("among") * F.col("outside"))).first()[0] or 0
        if turn == ROUNDS or pairs <= PAIRS * places:
            break
        more = written(_by_centre(rare, met, sets), "links")
        if more.isEmpty():
            break
        links = links.unionByName(more)

    # what both share with the reference set is enough
    outside = placed.where("root <> largest").select("hub", *(F.col(c).alias(f"{c}2") for c in ("id", "size", "root", "shared")), "least")
    apart = (F.col("root") != F.col("root2")) & _near(F.col("size"), F.col("size2"), F.least("size", "size2"))
    there, here = placed.where(_near(F.col("size"), F.col("least"), F.col("shared"))).drop("own", "least", "largest"), outside.where(_near(F.col("size2"), F.col("least"), F.col("shared2"))).drop("least")
    enough = there.join(here, "hub").where(apart & _near(F.col("size"), F.col("size2"), F.least("shared", "shared2"))).select(F.least("id", "id2").alias("u"), F.greatest("id", "id2").alias("v"))
    pairs = written(sharing(rare, met).unionByName(enough).distinct(), "pairs")
    return _components(links.unionByName(_confirmed(pairs, sets)))
