import random
import re
import zlib
from collections import Counter

import pytest
from llm.helpers import ODD, documents, empty, odd

from tracewright.llm import variants
from tracewright.llm.common import table
from tracewright.llm.queries import QUERIES

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counted(docs):
    """The contract's words, occurrence by occurrence."""
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(docs):
    """Words joined by the strings that one deletion makes of them; a pair is near if one edit turns one into the other."""
    words = counted(docs)
    holes, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
            near[w] |= {x for x in holes[short] if len(x) == len(w) and x != w and sum(a != b for a, b in zip(x, w, strict=True)) == 1}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, words[w], len(near[w]), words[forms[w]] if forms[w] else None))
    return out


def result(df):
    rows = df.select(*COLUMNS).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_the_query_equals_brute_force(spark, folder):
    sf = f"/root/testdata/{folder}"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    want = brute(docs)
    assert any(form for _, form, *_ in want)
    assert result(QUERIES["op12_spelling_variants"](spark, sf)) == want


def edited(rng, word, letters):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    return word[:at] + (rng.choice(letters) if kind else "") + word[at + (kind < 2) :]


@pytest.mark.parametrize("most", [2, 3, 64])
def test_dense_blocks_are_divided_and_lose_nothing(spark, most):
    rng = random.Random(most)
    words = []
    for base in ("abababab", "aaaaaaaaaa", "internationalisation", "Éàÿ×÷Àbcd", "zz" * 30):
        for _ in range(150):
            w = base
            for _ in range(rng.randrange(3)):
                w = edited(rng, w, "abÀ")
            words += [w] * rng.choice((1, 2, 3, 30, 300))
    docs = [(i, " ".join(words[i::7]) + "\U0001f600" + words[i]) for i in range(7)]
    assert result(variants.grouped(documents(spark, docs), most=most)) == brute(docs)


def test_forms_lead_to_a_root_step_by_step(spark):
    chain = [("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200), ("abcdefghij", 2000)]
    docs = [(i, f"{w} " * n) for i, (w, n) in enumerate(chain, start=5)]
    docs = [(i, t) for i, t in docs if not any(zlib.crc32(f"{i}:{w}".encode()) % 31 == 0 for w, _ in chain)]
    assert len(docs) == 4
    got = {r[0]: r[1:3] for r in result(variants.grouped(documents(spark, docs)))}
    assert got == {"abcdefg": ("abcdefgh", "abcdefghij"), "abcdefgh": ("abcdefghi", "abcdefghij"), "abcdefghi": ("abcdefghij", "abcdefghij"), "abcdefghij": (None, "abcdefghij")}


def test_frequencies_that_tie(spark):
    docs = [(1, "bbbbbbx " * 40 + "bbbbbby " * 40 + "bbbbbbz " * 4)]
    got = {r[0]: r for r in result(variants.grouped(documents(spark, docs)))}
    assert got["bbbbbbz"][1] == "bbbbbbx" and got["bbbbbbx"][1] is None and got["bbbbbbx"][4] == 2


def test_odd_and_empty_tables(spark):
    rows = [(d, t) for d, t, _ in ODD]
    assert result(variants.grouped(odd(spark))) == brute(rows)
    assert result(variants.grouped(empty(spark))) == set()
    long = [(1, "x" * 300_000 + "y " + "x" * 300_000 + " "), (2, "x" * 300_000 + "y " + "x" * 300_000)]
    got = {(len(r[0]), r[4]) for r in result(variants.grouped(documents(spark, long)))}
    assert got == {(300_001, 1), (300_000, 1)}
