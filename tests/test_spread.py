"""Events are dealt to bounded tasks, and what is made of them is made there, whatever a filter asks for."""

import re

from pyspark.sql import functions as F

from tracewright.plans import bridge
from tracewright.plans.queries import QUERIES


def test_tasks_have_bounded_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(bridge, "ROWS", 100, raising=False)
    for rows in (bridge.telemetry(spark, sf), bridge.scores(spark, sf)):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == bridge.table(spark, sf, "events").count() and max(sizes) <= 150


def test_filters_stay_above_the_shuffle(spark, sf, capsys):
    """The tasks that read are as many as a file has row groups: one, for a file of any size; no body or score is made there."""
    for name in ("misses", "flips", "boundary_classify"):
        QUERIES[name](spark, sf).explain()
        above, *below = re.split(r"Exchange hashpartitioning\(event_id", capsys.readouterr().out)
        assert below and "Filter " in above + "".join(below) and not any(re.search(r"^.*\+- \*?(\(\d+\) )?Filter ", b.split("FileScan")[0], re.M) for b in below)


def test_indicators_are_not_made_again_for_a_filter(spark, sf, capsys):
    QUERIES["indicator_frequency"](spark, sf).explain()
    assert not re.search(r"Filter \(+size\(", capsys.readouterr().out)
