import random
from decimal import Decimal

import pytest

from tracewright.operators import metrics


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("long", [random.Random(1).randrange(10**6) for _ in range(5_000)]),
        ("long", [2**62 + random.Random(2).randrange(900) for _ in range(500)] + [-(2**62), 2**63 - 1, -(2**63)]),
        ("double", [random.Random(3).lognormvariate(0, 20) for _ in range(2_000)] + [float("inf"), float("-inf"), -0.0, 0.0]),
        ("double", [1.7e308, -1.7e308, 1.0, 2.0, -1.5e308]),
        ("decimal(38,2)", [Decimal(x) / 100 for x in (5, 1, 1, 10**30, 10**30 + 1, 7)]),
        ("int", [3] * 100),
        ("int", [1]),
    ],
)
def test_values_at_places(spark, kind, values):
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], f"v {kind}")
    order, n = sorted(values), len(values)
    places = sorted({0, n // 2, int(n * 0.95), n - 1, n // 7})
    assert metrics.values_at(rows, "v", places, ranges=16 if n > 1_000 else 1_024) == [order[k] for k in places]


def test_no_values_and_no_places(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert metrics.values_at(rows, "v", [0, 5]) == [None, None]
    assert metrics.values_at(spark.createDataFrame([(1.0,)], "v double"), "v", [1, -1]) == [None, None]
    assert tuple(metrics.length_percentiles(rows.where("v IS NULL"), "v").first()) == (0, None, None, None)
