import re
from collections import Counter

from llm.helpers import ODD, empty, odd
from pyspark.sql import functions as F

from tracewright.llm import mixing

DOCS = "doc_id long, text string, source string, start long, sid long, size long, block long"


def table(spark, rows):
    """rows: (doc_id, text, source); the other columns clash with those that the operator makes."""
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def aims(rows, weights=(5, 2, 1), most=3):
    """Targets by lifting a common level in small steps, from the text of the contract alone."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    low, high = 0.0, 1.0 + 3 * sum(sizes.values())
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most * sizes[s], mid * weight[s]) for s in order) < sum(sizes.values()):
            low = mid
        else:
            high = mid
    return {s: (sizes[s], min(most * sizes[s], high * weight[s])) for s in order}


ROWS = (
    [(i, "w " * (10 + i % 7), "big") for i in range(400)]
    + [(i, "a b c\nd\x0be " * 3, "Small") for i in range(400, 420)]
    + [(i, "one two", None) for i in range(420, 640)]
    + [(700, None, "none"), (701, "", "none"), (None, "x y z", "a"), (702, "x y z", "a"), (702, "x y z", "a"), (703, "long " * 50_000, "z")]
)


def test_targets_and_words_taken(spark):
    got = mixing.taken(table(spark, ROWS)).collect()
    want = aims(ROWS)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(i), len(words(t))) for i, t, _ in ROWS)
    by_size = {}
    for r in got:
        by_size.setdefault((r["source_size"], round(r["target"], 4)), []).append(r)
    assert sorted(by_size) == sorted({(size, round(aim, 4)) for size, aim in want.values()})
    assert any(aim == 3 * size > 0 for size, aim in want.values())
    for (size, aim), rows in by_size.items():
        taken = sum(r["taken"] for r in rows)
        assert abs(taken - aim) <= mixing.BLOCK, (size, aim, taken)
        assert all(r["taken"] <= 3 * r["size"] for r in rows)
        if aim == 3 * size:
            assert all(r["taken"] == 3 * r["size"] for r in rows)


def test_every_run_agrees_and_the_partitions_do_not_matter(spark):
    run = lambda docs: sorted(map(str, mixing.taken(docs).collect()))
    first = run(table(spark, ROWS))
    assert first == run(table(spark, ROWS[::-1]).repartition(7))


def test_pieces_carry_the_words_of_their_documents(spark):
    docs = table(spark, ROWS[-200:])
    mixed, placed, sources = mixing.mix(docs, block=16, shard=32, text=True)
    rows = mixed.collect()
    texts = {}
    for r in placed.collect():
        texts[r["sid"], r["start"], r["doc_id"]] = r["words"]
    for r in rows:
        assert r["text"].split(" ") == texts[r["sid"], r["doc_start"], r["doc_id"]][r["from"] : r["from"] + r["length"]]
    # slots of a source are numbered without gaps, every pass is a permutation of its blocks, shards are full
    about = {r["sid"]: r for r in sources.collect()}
    slots = {(r["sid"], r["index"]): (r["pass"], r["block"], r["shard"]) for r in rows}
    for sid, s in about.items():
        own = [slots[sid, i] for i in range(s["slots"])]
        assert len(own) == sum(k[0] == sid for k in slots)
        for n in range(0, s["slots"], max(s["blocks"], 1)):
            assert len({x[1] for x in own[n : n + s["blocks"]]}) == len(own[n : n + s["blocks"]])
        assert [x[2] for x in own] == sorted(x[2] for x in own)
    shards = Counter(x[2] for x in slots.values())
    assert all(n == 32 for k, n in shards.items() if k < max(shards))


def test_permutations(spark):
    sizes = [1, 2, 3, 10, 97, 1000, 4096]
    n = spark.createDataFrame([(n,) for n in sizes], "n long").withColumn("made", mixing.keys(1, F.lit("p"), F.col("n")))
    rows = n.select("n", "made", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("x")).select("n", "x", mixing.permuted(F.col("x"), F.col("n"), F.col("made")).alias("to")).collect()
    for size in sizes:
        found = [r["to"] for r in sorted(rows) if r["n"] == size]
        assert sorted(found) == list(range(size))
        assert size < 97 or sum(a == b for a, b in enumerate(found)) < size / 10


def test_permutation_of_a_range_beyond_32_bits(spark):
    n = 10**12 + 7
    made = mixing.keys(1, F.lit("p"), F.lit(n).cast("long"))
    ids = spark.range(10).select((F.col("id") * 90_000_000_000).alias("x"))
    to = [r["to"] for r in ids.select(mixing.permuted(F.col("x"), F.lit(n).cast("long"), made).alias("to")).collect()]
    assert len(set(to)) == 10 and all(0 <= x < n for x in to)


def test_source_counts_of_shards_vary_around_their_share(spark):
    rows = [(i, "w " * 64, "a" if i % 3 else "b") for i in range(6_000)]
    mixed, _, sources = mixing.mix(table(spark, rows), shard=600)
    share = {r["sid"]: r["slots"] for r in sources.collect()}
    counts = mixed.groupBy("shard", "sid").count().collect()
    assert len(counts) == 20
    p = share[0] / sum(share.values())
    off = [(r["count"] - 600 * p) / (600 * p * (1 - p)) ** 0.5 for r in counts if r["sid"] == 0]
    assert max(map(abs, off)) < 4 and 0.2 < sum(x * x for x in off) / len(off) < 3


def test_odd_and_empty_tables(spark):
    got = mixing.taken(odd(spark)).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(d), len(words(t))) for d, t, _ in ODD)
    assert mixing.taken(empty(spark)).collect() == []
    nothing = mixing.taken(table(spark, [(1, None, None), (2, " ", "s")])).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in nothing) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
