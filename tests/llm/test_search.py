import time

import numpy as np
import pytest

from tracewright.llm import licences, neighbours
from tracewright.llm.common import table
from tracewright.llm.queries import QUERIES
from llm.helpers import ODD, documents, empty, odd
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, score double, rank int"


def brute(rows, k=5):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, x in good:
        if q % 50:
            continue
        for i, y in good:
            if i != q and len(x) == len(y):
                a, b = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                out.setdefault(q, {}).setdefault((i, tuple(y)), []).append(float(a @ b / np.sqrt((a @ a) * (b @ b))))
    return {q: [i for _, i in sorted((-round(max(s), 12), i) for (i, _), s in c.items())[:k]] for q, c in out.items()}


def test_scores_are_the_cosines_of_the_original_vectors(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect() if r["embedding"]}
    got = QUERIES["op8_neighbours"](spark, "/root/testdata/sf0.01").collect()
    ids = np.array(sorted(rows))
    every = np.array([rows[i] for i in ids])
    every /= np.sqrt((every * every).sum(axis=1, keepdims=True))
    want = {}
    for q in ids[ids % 50 == 0]:
        near = every @ every[np.searchsorted(ids, q)]
        order = [j for j in np.lexsort((ids, -near.round(12))) if ids[j] != q][:5]
        want |= {(int(q), n + 1): (int(ids[j]), near[j]) for n, j in enumerate(order)}
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in got} == {k: v[0] for k, v in want.items()}
    assert all(abs(r["score"] - want[r["query_id"], r["rank"]][1]) < 1e-12 for r in got)


def test_very_large_very_small_and_long_vectors(spark):
    schema = "vec_id long, embedding array<double>, score double, rank int"
    rng = np.random.default_rng(9)
    rows = [(50 * i, (rng.normal(size=3000) * 10.0 ** (i - 3)).tolist()) for i in range(6)]
    rows += [(1, [1e200, 1e200]), (2, [1e-200, -1e-200]), (350, [3e200, 1e200]), (3, [5e-324, 0.0])]
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in neighbours.nearest(spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], schema), F.col("vec_id") % 50 == 0).collect()}
    assert abs(got[350, 1] - 4 / np.sqrt(20)) < 1e-12 and abs(got[350, 2] - 2 / np.sqrt(20)) < 1e-12 and abs(got[350, 3] - 3 / np.sqrt(10)) < 1e-12
    a, b = np.array(rows[0][1]), np.array(rows[5][1])
    assert abs(got[0, 250] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12 and len(got) == 6 * 5 + 3


@pytest.mark.parametrize("held", [1, 1 << 12, 64 << 20])
def test_every_grid_gives_the_same(spark, monkeypatch, held):
    monkeypatch.setattr(neighbours, "HELD_BYTES", held)
    monkeypatch.setattr(neighbours, "CANDIDATES", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(700)]
    assert found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows)


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], VECTORS)


def test_exact_on_random_vectors_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    assert found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (50, None), (100, [0.0, 0.0]), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]), (None, [1.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 2.0, 3.0]), (300, []), (5, [-1.0, 0.0])]
    assert found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0)) == {0: [3, 5]}


def test_no_queries_and_no_rows(spark):
    assert neighbours.nearest(frame(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0


def dice_by_brute_force(text):
    best = {}
    seen = licences.words(text or "")
    for name, template in licences.templates_of():
        own = licences.words(template)
        b = licences.bigrams(own)
        every = [licences.bigrams(licences.words(part)) for part in licences.parts(text or "")]
        d = max((dice(a, b) for a in every), default=0)
        pairs = list(zip(seen, seen[1:], strict=False))
        if sum(p in b for p in set(pairs)) * 2 >= licences.THRESHOLD * len(b):
            for i in range(len(pairs)):  # every run of words, from each place on
                run, both = set(), 0
                for p in pairs[i:]:
                    if p not in run:
                        run.add(p)
                        both += p in b
                        d = max(d, 2 * both / (len(run) + len(b)))
        if d >= licences.THRESHOLD:
            best[name] = max(best.get(name, 0), d)
    return best


PROSE = " ".join(f"word{i * i % 397} of the other{i * 7 % 211}" for i in range(150))
MIT = licences.TEMPLATES[3][1]
PARAGRAPHS = MIT.replace("conditions: ", "conditions:\n\n").replace("of the Software. ", "of the Software.\n\n")


TEXTS = [
    "Some words.\nReleased under the MIT License.\nMore words.", "this work is LICENSED under the GNU general public license, version 3", "Licensed under CC BY-NC 4.0. And more text follows here.",
    licences.TEMPLATES[3][1].replace("Software", "Program", 2), "a license to kill", "Copyright 2020 Foo\n\n" + licences.TEMPLATES[6][1] + "\n\nrest", *(t for _, t, *_ in ODD if len(t or "") < 10_000),
    PARAGRAPHS + "\n\n" + PROSE, PROSE + "\n" + PARAGRAPHS + "\n" + PROSE, PROSE + licences.TEMPLATES[6][1].replace(". ", ".\n\n * ") + PROSE,
]


def test_size_bounds_lose_nothing():
    scanner = licences.Scanner(licences.templates_of())
    for text in TEXTS:
        assert scanner.scan(text) == dice_by_brute_force(text)


def test_documents_without_licence_have_null_and_zero(spark):
    got = licences.scan_documents(odd(spark))
    assert got.where("licence IS NULL AND dice = 0 AND n_licences = 0").count() == len(ODD)
    assert licences.scan_documents(documents(spark, [(1, TEXTS[0])])).first()[:3] == (1, "MIT", 1.0)
    assert licences.scan_documents(empty(spark)).count() == 0


def test_licences_inside_longer_texts_are_found_and_nothing_else_is():
    """Recall and precision on planted licences: cut into lines and paragraphs, some words changed, prose around."""
    rng = np.random.default_rng(6)
    scanner = licences.Scanner(licences.templates_of())
    right = wrong = 0
    planted = [(n, t) for n, t in licences.templates_of() if len(licences.words(t)) > 30]
    for name, template in planted:
        own = template.split()
        for at in rng.choice(len(own), len(own) // 40, replace=False):
            own[at] = f"changed{at}"
        breaks = iter(rng.choice(["\n\n", "\n", " ", " ", " "], len(own)))
        found = scanner.scan(PROSE + "\n\n" + "".join(w + next(breaks) for w in own) + "\n\n" + PROSE)
        right += name in found
        wrong += max(found, key=found.get, default=name) != name  # a licence may hold the notice of another
    assert right == len(planted) and wrong == 0
    assert scanner.scan(PROSE * 20) == {}


@pytest.mark.parametrize("share", [0.75, 0.8, 0.9])
def test_shortened_licences_inside_longer_texts_are_found(share):
    scanner = licences.Scanner(licences.templates_of())
    planted = [(n, t.split()) for n, t in licences.templates_of() if len(licences.words(t)) > 30]
    found = [name in scanner.scan(f"{PROSE} {' '.join(own[: round(len(own) * share)])} {PROSE}") for name, own in planted]
    assert sum(found) >= 0.9 * len(planted)


def test_long_texts_of_licence_words_are_scanned_in_time():
    scanner = licences.Scanner(licences.templates_of())
    began = time.time()
    for text in ("the software " * 80_000, "of the " + "x " * 500_000, MIT * 200, " ".join(sorted(MIT.split())) * 100, "." * 1_000_000, "software" * 100_000):
        scanner.scan(text)
    assert time.time() - began < 60
