"""Near copies by the similarity of five-word shingles."""

import numpy as np

from llm.helpers import documents
from llm.test_near_duplicates import components
from tracewright.llm import near_copies, simhash


def plain_shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def prose(rng, n):
    return [f"w{i}" for i in rng.integers(0, 5_000, n)]


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(words), n, replace=False):
        out[at] = f"new{rng.integers(0, 10**9)}"
    return out


def test_edited_copies_of_four_fifths_are_dropped(spark):
    rng = np.random.default_rng(8)
    docs, want = [], []
    for i in range(40):
        words = prose(rng, 400)
        docs.append((2 * i, " ".join(words)))
        while True:  # the share of common shingles from 0.8 to 0.95
            other = " ".join(edited(rng, words, int(rng.integers(2, 10))))
            a, b = plain_shingles(docs[-1][1]), plain_shingles(other)
            if 0.8 <= len(a & b) / len(a | b) <= 0.95:
                break
        docs.append((2 * i + 1, other))
        want.append(2 * i)
    kept = simhash.keep_one(documents(spark, docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_groups_are_those_of_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["", "a few words", "A few  words", "a few other words"]
    for _ in range(8):  # chains, dense groups and copies just below the threshold
        base = prose(rng, 150)
        texts += [" ".join(edited(rng, base, int(rng.integers(0, 6)))) for _ in range(15)]
        for _ in range(5):
            base = edited(rng, base, 2)
            texts.append(" ".join(base))
    sets = [plain_shingles(t) for t in texts]
    roots = components(sets, similar)
    kept = simhash.keep_one(documents(spark, list(enumerate(texts))))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))
    assert [len(near_copies.shingles(t)) for t in texts] == [len(s) for s in sets]


def test_links_of_the_trie_are_candidates_and_confirmed(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "bands", lambda found: np.zeros(0, np.uint64))  # only the trie is left
    rng, texts = np.random.default_rng(5), ["a a a a", "a a a a a"]  # one fingerprint, other shingles
    while len(texts) < 12:
        words = prose(rng, 400)
        other = " ".join(edited(rng, words, 1))
        if (simhash.fingerprint(" ".join(words)) ^ simhash.fingerprint(other)).bit_count() <= simhash.BUDGET:
            texts += [" ".join(words), other]
    kept = simhash.keep_one(documents(spark, list(enumerate(texts))))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 4, 6, 8, 10]


def test_pairs_of_a_group_with_a_common_block_grow_with_the_group(spark, monkeypatch):
    joined, plain = [], near_copies.sharing

    def counted(rare, met):
        joined.append(plain(rare, met).count())
        return plain(rare, met)

    monkeypatch.setattr(near_copies, "sharing", counted)
    for n in (50, 200):
        rng = np.random.default_rng(n)
        base, block = prose(rng, 150), prose(rng, 60)
        texts = [" ".join(edited(rng, base, 1) + block) for _ in range(n)] + [" ".join(edited(rng, base, 1)) for _ in range(n + n // 5)]
        roots = components([plain_shingles(t) for t in texts], similar)
        kept = simhash.keep_one(documents(spark, list(enumerate(texts))))
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))
    assert joined[1] <= 5 * joined[0] + 200


def test_texts_go_to_python_once(spark, capsys):
    """One function a stage: a second one has a worker of its own beside every core, with the texts again."""
    text, fp = "a few words of one text", simhash.fingerprint("a few words of one text")
    rows = documents(spark, [(1, text), (2, None)]).select("doc_id", near_copies.described(spark, simhash.fingerprint).alias("mark"))
    rows.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    found = {r["doc_id"]: r["mark"] for r in rows.collect()}
    assert (found[1]["size"], found[1]["fp"] % 2**64, found[2]["size"], found[2]["fp"]) == (2, fp, 0, 0)


def test_stage_writes_texts_through_one_function(spark, monkeypatch):
    plans, plain = [], simhash.written

    def seen(df, name, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython"))
        return plain(df, name, *more)

    monkeypatch.setattr(simhash, "written", seen)
    simhash.keep_one(documents(spark, [(1, "a few words"), (2, None)])).collect()
    assert max(plans) == 1
