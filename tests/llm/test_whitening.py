import numpy as np
import pytest

from tracewright.llm import whitening
from tracewright.llm.common import table
from tracewright.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, n long, whitened double, x string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], VECTORS)


def brute(rows):
    """rows: (vec_id, list); the model by the covariance matrix of the distinct vectors."""
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x.tolist()) for _, x in good}))
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:4], q[:, ::-1][:, :4]
    out = [(i, k + 1, n, int(((n * x - sums) ** 2).sum()), abs(float((x - sums / n) @ q[:, k] / np.sqrt(e[k]))), e[k] / np.trace(v)) for i, x in good for k in range(4) if e[k] > 1e-9]
    return sorted(out, key=lambda r: (str(r[0]), r[1], r[3], round(r[4], 6)))


def check(got, want):
    got = sorted(got, key=lambda r: (str(r["vec_id"]), r["component"], r["deviation"], round(abs(r["whitened"]), 6)))
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got] == [w[:4] for w in want]
    assert np.allclose([abs(r["whitened"]) for r in got], [w[4] for w in want], rtol=1e-7, atol=1e-7)
    assert np.allclose([r["explained"] for r in got], [w[5] for w in want], rtol=1e-9)
    assert len({r["identity_error"] for r in got}) <= 1 and all(r["identity_error"] < 1e-9 for r in got)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_the_query_equals_the_covariance_matrix(spark, folder):
    sf = f"/root/testdata/{folder}"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    check(QUERIES["op11_whitening"](spark, sf).collect(), brute(rows))


def test_signs_are_the_same_for_all_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) * [5, 4, 3, 2, 1] + 7).tolist()) for i in range(60)]
    got = whitening.whiten(vectors(spark, rows).repartition(5)).collect()
    w = np.zeros((60, 4))
    for r in got:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(w.mean(axis=0)).max() < 1e-9 and np.abs(w.T @ w / 60 - np.eye(4)).max() < 1e-9


def test_what_takes_part(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 6)).tolist()
    rows = list(enumerate(base)) + [(50 + i, base[0]) for i in range(100)]  # copies of one vector
    rows += [(200, None), (201, [None] * 6), (202, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (203, [float("inf")] * 6), (204, []), (None, base[1]), (3, base[2]), (205, [0.0] * 6), (206, [-0.0] * 6), (207, [-0.001] * 6)]
    check(whitening.whiten(vectors(spark, rows)).collect(), brute(rows))
    assert {r["vec_id"] for r in whitening.whiten(vectors(spark, [*rows, (300, [1.0, 2.0])])).collect()} == {i for i, _ in rows if i not in range(200, 205)}


def test_few_vectors_and_none(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [(r["component"], abs(round(r["whitened"], 9)), r["explained"]) for r in got] == [(1, 1.0, 1.0)] * 2


def test_merging_in_any_grouping_keeps_all_dimensions():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 12)) @ np.diag(10.0 ** -np.arange(12)) + 1000
    whole = whitening.part_of(x)
    parts = [whitening.part_of(x[lo:hi]) for lo, hi in ((0, 1), (1, 3), (3, 200), (200, 500))]
    one = whitening.merged(whitening.merged(parts[0], parts[1]), whitening.merged(parts[3], parts[2]))
    values = lambda p: np.linalg.svd(p.factor, compute_uv=False)[:12]
    assert one.n == 500 and np.allclose(one.mean, x.mean(axis=0), rtol=1e-14)
    assert np.allclose(values(one), values(whole), rtol=1e-6, atol=1e-10)


def test_exact_deviations_beyond_a_long():
    model = whitening.Model(3, np.array([0, 0], dtype=object), np.eye(2), np.ones(2), np.ones(2))
    assert model.deviations(np.array([[1 << 31, 0], [1, 1]])) == [None, 18]
    assert model.deviations(np.array([[1 << 53, 0]])) == [None]
    assert model.deviations(np.array([[5, 5]])) == [450]
