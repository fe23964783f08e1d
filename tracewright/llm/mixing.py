"""Mixing sources to target weights: fixed-length blocks, source counts per output shard, index permutations, a join by index.

The words of a source are one stream, its documents in a pseudorandom order, cut into blocks of BLOCK words (the last of a
source may be shorter). A source with e = target / (mean words of its blocks) blocks to give gets round(e) slots of the
mix. Slot i of the mix (shard i div SHARD) draws its source: a keyed permutation takes i to a place, and the place lies in
one source's share. The counts of sources in a shard are so multinomial draws, conditioned on their totals over all shards being
round(e): free draws would leave a source of few blocks several per cent off its target.

Counts are added up over the shards of a source, which gives every shard a run of consecutive indexes of that source.
An index is a pass through the source's blocks (index div blocks) and a place in it, and a permutation of
the source and the pass maps the place to a block. So no block is taken twice more often than another, and none over
MOST times, as no target is over MOST times its source's size. Blocks are joined by (source, block).

Permutations are swap-or-not shuffles, which take any range as it is: in each round x may swap with key - x, by a bit of
a keyed hash of the larger of both. All is built-in functions, so every rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import joined, kept, temporary, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
#: Words of a block, slots of a shard, rounds of a permutation.
BLOCK = 64
SHARD = 4_096
ROUNDS = 24
SEED = 42
#: A prime; the products of two numbers below it, and their sums, fit into a long.
PRIME = (1 << 31) - 1
#: Slots that one task numbers.
_TASK = 1 << 17


def number(*parts: Column | int | str) -> Column:
    """32 bits of the MD5 of the parts joined by ':', as a long; null parts are left out."""
    text = F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def keys(seed: int, name: Column, n: Column, rounds: int = ROUNDS) -> Column:
    """The keys of a permutation of 0 to n - 1: array<struct<k, a, b, c>>, one of each round."""
    part = lambda r, what: number(seed, name, r, F.lit(what))
    return F.transform(
        F.sequence(F.lit(1), F.lit(rounds)),
        lambda r: F.struct(
            F.pmod(part(r, "k") * (1 << 31) + part(r, "l"), F.greatest(n, F.lit(1))).alias("k"),
            (part(r, "a") % PRIME).alias("a"),
            (part(r, "b") % PRIME).alias("b"),
            (part(r, "c") % PRIME).alias("c"),
        ),
    )


def permuted(x: Column, n: Column, made: Column) -> Column:
    """Where the permutation of 0 to n - 1 with these keys takes x."""

    def swapped(x: Column, key: Column) -> Column:
        other = F.pmod(key["k"] - x, n)
        most = F.greatest(x, other)
        high, low = F.shiftright(most, 31), most.bitwiseAND(F.lit((1 << 31) - 1))
        return F.when((high * key["a"] + (low % PRIME) * key["b"] + key["c"]) % PRIME > PRIME // 2, other).otherwise(x)

    return F.aggregate(made, x, swapped)


def before(df: DataFrame, value: str, within: list[str], bucket: str, order: list[Column | str], name: str) -> DataFrame:
    """df with the sum of value over all rows of its group that come earlier by (bucket, order).

    Sums of buckets are added up first, so no window spans the rows of a large group.
    """
    sums = df.groupBy(*within, bucket).agg(F.sum(value).alias("_sum"))
    running = F.sum("_sum").over(Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*within, bucket, F.coalesce(running, F.lit(0)).alias("_before"))
    inside = F.sum(value).over(Window.partitionBy(*within, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(sums, [*within, bucket]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def _ranked(sources: DataFrame) -> DataFrame:
    """(source, size, sid): places by code point, null last, from a range sort and one count a partition."""
    rows = written(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()), "sources")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy("_part").count()
    starts = counts.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return rows.join(starts, "_part").withColumn("sid", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_at", "_start")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sources (source, size, sid) with the double column target, in words.

    Weights repeat in the order of sid and share the sum of all sizes. A source whose share is over `most` times its size
    gets that, and the others share the rest by weight; three numbers of each round reach the driver, until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")).cast("decimal(38,0)")
    limit = (F.col("size") * most).cast("decimal(38,0)")
    rest = total = int(sources.agg(F.sum("size")).first()[0] or 0)
    free = whole = int(sources.agg(F.sum(weight)).first()[0] or 0)
    over = F.lit(False)
    while free:
        over = weight * F.lit(rest).cast("decimal(38,0)") > limit * F.lit(free).cast("decimal(38,0)")
        held, heavy = sources.where(over).agg(F.sum(limit), F.sum(weight)).first()
        after = (total - int(held or 0), whole - int(heavy or 0))
        if after == (rest, free):
            break
        rest, free = after
    share = (weight * F.lit(rest).cast("decimal(38,0)")).cast("double") / F.lit(float(max(free, 1)))
    return sources.withColumn("target", F.when(over, limit.cast("double")).otherwise(share))


def sized(docs: DataFrame, text: bool = False) -> DataFrame:
    """doc_id, source, size (words) of every row of docs, and with `text` its words."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *((F.xxhash64("text").alias("tie"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words")) if text else ()))


def placed(docs: DataFrame, block: int = BLOCK, seed: int = SEED, text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, sid, size, start: the words before it in its source's stream) and sources
    (source, sid, size, target, blocks, slots, first: the slots of the sources before)."""
    with temporary():
        rows = written(sized(docs, text), "sizes")
        sources = written(targets(_ranked(rows.groupBy("source").agg(F.sum("size").alias("size")))), "targets")
        blocks = F.ceil(F.col("size") / block).cast("long")
        slots = F.when(F.col("size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("size") + 0.5)).otherwise(0).cast("long")
        sources = sources.withColumn("blocks", blocks).withColumn("slots", slots).withColumn("all", F.lit(0)).withColumn("bucket", F.shiftright("sid", 12))
        sources = kept(written(before(sources, "slots", ["all"], "bucket", ["sid"], "first").drop("all", "bucket"), "sources"))
        buckets = max(1, round(rows.count() ** 0.5))
        named = sources.select(F.col("source").alias("_source"), "sid")
        rows = joined(rows, named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
        rows = rows.withColumn("bucket", F.pmod(number(seed, F.col("doc_id"), F.col("size")), F.lit(buckets)))
        order = [F.col("doc_id").asc_nulls_last(), "size", *(["tie"] if text else [])]
        return kept(written(before(rows, "size", ["sid"], "bucket", order, "start").drop("bucket", "tie"), "placed")), sources


def pieces(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(sid, block, doc_id, doc_start, from, length): what blocks hold of placed documents; `from` counts words within the
    document. With words in docs also the text of the piece, single-spaced."""
    ends = F.col("start") + F.col("size")
    cut = docs.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    lo, hi = F.greatest(F.col("block") * block, F.col("start")), F.least((F.col("block") + 1) * block, ends)
    cut = cut.withColumn("from", lo - F.col("start")).withColumn("length", hi - lo)
    words = [F.array_join(F.slice("words", (F.col("from") + 1).cast("int"), F.col("length").cast("int")), " ").alias("text")] if "words" in docs.columns else []
    return cut.select("sid", "block", "doc_id", F.col("start").alias("doc_start"), "from", "length", *words)


def shard_counts(sources: DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, sid, n): how many slots of each shard go to each source."""
    spark = sources.sparkSession
    slots, n = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    width = max(1, slots // max(n, 1))
    shares = sources.where("slots > 0").select("sid", F.col("first").alias("lo"), (F.col("first") + F.col("slots")).alias("hi"))
    shares = written(shares.withColumn("cell", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}")))), "shares")
    made = spark.range(1).select(keys(seed, F.lit("mix"), F.lit(slots).cast("long")).alias("made")).first()["made"]
    made = F.array(*(F.struct(*(F.lit(v).cast("long").alias(c) for c, v in key.asDict().items())) for key in made))
    drawn = spark.range(0, slots, 1, max(1, -(-slots // _TASK)))
    drawn = drawn.select(F.expr(f"id div {shard}").alias("shard"), permuted(F.col("id"), F.lit(slots).cast("long"), made).alias("at"))
    drawn = joined(drawn.withColumn("cell", F.expr(f"at div {width}")), shares, "cell").where("lo <= at AND at < hi")
    return drawn.groupBy("shard", "sid").agg(F.count("*").alias("n"))


def slots(sources: DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, sid, index, pass, block) of every slot of the mix."""
    counts = written(shard_counts(sources, shard, seed).withColumn("bucket", F.shiftright("shard", 10)), "counts")
    runs = before(counts, "n", ["sid"], "bucket", ["shard"], "lo")
    total = sources.agg(F.sum("slots")).first()[0] or 0
    runs = runs.repartition(max(1, -(-total // _TASK)), "shard", "sid")  # few bytes, but many slots
    each = runs.select("shard", "sid", F.explode(F.sequence(F.col("lo"), F.col("lo") + F.col("n") - 1)).alias("index"))
    passes = sources.where("slots > 0").select("sid", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(slots - 1) div blocks"))).alias("pass"))
    passes = written(passes.withColumn("made", keys(seed, F.concat_ws("/", "sid", "pass"), F.col("blocks"))), "passes")
    sizes = written(sources.select("sid", "blocks"), "blocks")
    each = joined(each, sizes, "sid").withColumn("pass", F.expr("index div blocks")).withColumn("place", F.expr("index % blocks")).drop("blocks")
    return joined(each, passes, ["sid", "pass"]).select("shard", "sid", "index", "pass", permuted(F.col("place"), F.col("blocks"), F.col("made")).alias("block"))


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED, text: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix, with the placed documents and the sources it was drawn from.

    The mix has a row for each piece of a document in each slot: shard, sid, index, pass, block, doc_id, doc_start, from, length,
    and with `text` the words of the piece. Null and empty texts have no words and so no piece; a source without words takes no part. Rows with
    equal doc_id are documents of their own; a null source is a source, the last; empty docs give no rows. Other
    columns are ignored.
    """
    with temporary():
        rows, sources = map(kept, placed(docs, block, seed, text))
        drawn = kept(written(slots(sources, shard, seed), "slots"))
    return drawn.join(pieces(rows, block), ["sid", "block"]), rows, sources


def taken(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target (its source's) and taken (words the mix takes, repeats counted) of every row of docs."""
    mixed, rows, sources = mix(docs, block, shard, seed)
    words = mixed.groupBy("sid", F.col("doc_start").alias("start")).agg(F.sum("length").alias("taken")).withColumn("some", F.lit(True))
    rows = rows.withColumn("some", F.col("size") > 0).join(words, ["sid", "start", "some"], "left")
    about = sources.select("sid", F.col("size").alias("source_size"), "target")
    return joined(rows, about, "sid").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
