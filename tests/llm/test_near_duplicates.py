import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import ODD, documents, empty, odd
from tracewright.llm import simhash
from tracewright.llm.common import table, written
from tracewright.llm.queries import QUERIES


def components(keys, near):
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i], keys[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(keys))]


def near(a, b):
    return (int(a) ^ int(b)).bit_count() <= 3


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 120), st.integers(1, 64), st.integers(0, 6))
def test_walk_connects_what_brute_force_connects(seed, n, width, noise):
    rng = np.random.default_rng(seed)
    keys = rng.integers(0, 2**64, max(1, n // 8), dtype=np.uint64)[rng.integers(0, max(1, n // 8), n)]
    for _ in range(noise):
        keys ^= np.uint64(1) << rng.integers(0, width, n).astype(np.uint64)
    keys = np.unique(keys)
    a, b = simhash.walk(keys, keys[:0], 0, 0, True)
    half = lambda x, y: near(x, y) and ((int(x) ^ int(y)) >> 32).bit_count() <= 1
    at = {int(k): i for i, k in enumerate(keys)}
    linked = {(at[int(x)], at[int(y)]) for x, y in zip(a, b, strict=True)}
    assert components(range(len(keys)), lambda i, j: (i, j) in linked or (j, i) in linked) == components(keys.tolist(), half)


def test_all_levels_of_the_trie_connect_the_same(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**64, 60, dtype=np.uint64)[rng.integers(0, 60, 400)]
    for _ in range(3):
        keys ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    keys = np.unique(keys)
    table = written(spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "fp long"), "test")
    for leaf in (4, 40, 1 << 16):  # many levels, few, none
        at = {int(k): i for i, k in enumerate(keys.view(np.int64))}
        linked = {(at[r["a"]], at[r["b"]]) for r in simhash.links(table, leaf).collect()}
        assert components(range(len(keys)), lambda i, j: (i, j) in linked or (j, i) in linked) == components(keys.tolist(), near)


def test_odd_rows(spark):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd(spark)).collect()), key=repr)
    prints = [plain_fingerprint(t) for _, t, *_ in ODD]
    roots = components(prints, near)
    smallest = {r: min((ODD[i][0] for i in range(len(ODD)) if roots[i] == r and ODD[i][0] is not None), default=None) for r in roots}
    assert got == sorted(((ODD[i][0], format(prints[i], "016x"), smallest[roots[i]]) for i in range(len(ODD))), key=repr)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    base = "one two three four five six seven eight nine ten " * 20
    docs = documents(spark, [(9, base), (4, base), (4, base), (None, base), (5, base + "eleven"), (6, "quite another text about other things"), (None, "alone but unnumbered text of its own kind"), (7, None), (8, "")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([4, 6, None, 7], key=repr)
    assert simhash.keep_one(empty(spark)).count() == 0


def test_query_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], plain_fingerprint(r["text"])) for r in table(spark, sf, "documents").orderBy("doc_id").collect()]
    roots = components([p for _, p in docs], near)
    want = sorted((d, format(p, "016x"), docs[r][0]) for (d, p), r in zip(docs, roots, strict=True))
    assert sorted(tuple(r) for r in QUERIES["op3_simhash"](spark, sf).select("doc_id", "fingerprint", "component_id").collect()) == want
