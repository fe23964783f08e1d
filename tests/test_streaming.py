"""Stateful streams against plain folds of the same rows, whatever batches these come in."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tracewright.operators import captures, queue
from tracewright.plans import bridge
from tracewright.sources.committed import DecisionWriter, Files, log_decisions, logged_decisions
from tracewright.sources.writers import staged
from tracewright.streaming import live, session

ACTIONS = "signature string, seq long, action string, severity string, rule string"


def fold(actions, depth):
    """What a person at one screen would see, told step by step; signature -> (severity, decided_by, undoable)."""
    now, back, forth = {}, defaultdict(list), defaultdict(list)
    for signature, _, action, severity, rule in sorted(actions, key=lambda a: a[1]):
        before = now.get(signature)
        if action == "undo":
            if back[signature]:
                forth[signature].append(before)
                now[signature] = back[signature].pop()
        elif action == "redo":
            if forth[signature]:
                back[signature].append(before)
                now[signature] = forth[signature].pop()
        elif action in ("label", "drop"):
            back[signature] = (back[signature] + [before])[-depth:]
            forth[signature] = []
            now[signature] = (None if action == "drop" else severity, "human", None if rule is None else rule)
        elif action == "accept" or (action in ("accept all", "drop tail") and before is None):
            by = {"accept": "human: accepted suggestion", "accept all": "human: accepted suggestion (bulk)", "drop tail": "bulk tail drop"}[action]
            now[signature] = (None if action == "drop tail" else severity, by, rule)
    return {s: (*d, len(back[s])) for s, d in now.items() if d is not None}


def some_actions(seed, n=400):
    rng = random.Random(seed)
    kinds = ["label"] * 3 + ["drop", "accept", "accept all", "drop tail", "undo", "undo", "redo", "look"]
    return [(f"s{rng.randrange(12)}", i, rng.choice(kinds), rng.choice(["none", "low", "medium", "high", "critical", None]), rng.choice([None, "r1"])) for i in range(n)]


@pytest.mark.parametrize("depth", [2, 50])
def test_a_session_is_the_fold_of_its_actions(depth):
    for seed in range(30):
        actions, sessions = some_actions(seed), {}
        for s, seq, action, severity, rule in actions:
            sessions.setdefault(s, session.Session()).act(seq, action, severity, rule, depth)
        got = {s: (x.current["severity"], x.current["decided_by"], x.current["rule"], len(x.undo)) for s, x in sessions.items() if x.current}
        assert got == fold(actions, depth)


def test_undo_of_an_undo_and_of_nothing():
    s = session.Session()
    for seq, (action, severity) in enumerate([("undo", None), ("label", "high"), ("label", "low"), ("undo", None), ("undo", None), ("redo", None)]):
        s.act(seq, action, severity, None)
    assert s.current["severity"] == "high"
    s.act(3, "label", "none", None)  # seen before
    assert s.current["severity"] == "high" and s.seq == 5


@pytest.mark.parametrize("cuts", [(), (57, 58, 200)])
def test_the_stream_gives_the_same_in_any_batches(spark, tmp_path, cuts):
    actions = some_actions(99)
    setting = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    bounds = [0, *cuts, len(actions)]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        spark.createDataFrame(actions[lo:hi], ACTIONS).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2 if lo == 0 else 1):  # the second run finds nothing new
            stream = spark.readStream.schema(ACTIONS).parquet(str(tmp_path / "in"))
            session.kept_sessions(stream, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    got = {r["signature"]: (r["severity"], r["decided_by"], r["rule"], r["undoable"]) for r in session.decided(spark, str(tmp_path / "log")).collect()}
    assert got == fold(actions, session.DEPTH)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == setting


def test_scores_follow_the_profile(spark, sf, tmp_path):
    events = staged(bridge.telemetry(spark, sf), "events")
    want = {r["ord"]: (r["score"], r["prelabel"]) for r in queue.scored(events.where("attack"), events.where("NOT attack")).collect()}
    n = events.agg(F.max("ord")).first()[0]
    names = [str(tmp_path / x) for x in ("in", "log", "state", "kept", "kept_state")]
    for lo, hi in ((n // 3, n + 1), (0, n // 3)):  # benign captures may come after the attacks
        events.where((F.col("ord") >= lo) & (F.col("ord") < hi)).write.mode("append").parquet(names[0])
        stream = lambda: spark.readStream.schema(events.schema).parquet(names[0])
        live.kept_bands(stream(), names[1], names[2]).awaitTermination()
        live.kept_events(stream(), names[3], names[4]).awaitTermination()
    got = {r["ord"]: (r["score"], r["prelabel"]) for r in live.scores(spark, spark.read.parquet(names[3]), names[1]).collect()}
    assert got == want
    rows = logged_decisions(spark, names[1], live.BAND)
    assert rows.count() < 8 * rows.select("level", "key").distinct().count()  # a row a bound, not a row an event


def test_texts_are_worked_once_an_event_by_all_tasks(spark, sf, tmp_path, monkeypatch):
    """A batch is one file here; its signatures are made for profiles and scores together, in as many tasks as shuffles have."""
    events = staged(bridge.telemetry(spark, sf), "events")
    want = {r["ord"]: (r["score"], r["prelabel"]) for r in queue.scored(events.where("attack"), events.where("NOT attack")).collect()}
    names = [str(tmp_path / x) for x in ("in", "log", "state", "kept", "kept_state")]
    events.coalesce(1).write.parquet(names[0])
    live.kept_signed(spark.readStream.schema(events.schema).parquet(names[0]), names[3], names[4]).awaitTermination()
    monkeypatch.setattr(live, "with_behaviour", None)  # not again
    live.kept_bands(spark.readStream.schema(live.SIGNED).parquet(names[3]), names[1], names[2]).awaitTermination()
    kept = spark.read.schema(live.SIGNED).parquet(names[3])
    got = {r["ord"]: (r["score"], r["prelabel"]) for r in live.scores(spark, kept.where("attack"), names[1]).collect()}
    assert got == want
    parts = kept.groupBy(F.input_file_name()).count().count()
    assert parts == max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_bands_of_files():
    assert [queue.file_band(n) for n in (0, 1, 2, 3, 4, 7, 8, 100)] == [0, 1, 2, 2, 3, 3, 4, 4]


def test_captures_of_days_are_merged(spark):
    rng = random.Random(5)
    rows = [(f"s{rng.randrange(40)}", None if rng.random() < 0.05 else f"c{rng.randrange(70)}") for _ in range(900)]
    df = lambda some: spark.createDataFrame(some, "signature string, src string")
    known = captures.first_day(df(rows[:300]))
    for lo, hi in ((300, 301), (301, 900), (0, 50)):
        known = captures.merged(known, df(rows[lo:hi]))
    want = defaultdict(set)
    for signature, src in rows:
        if src is not None:
            want[signature].add(src)
    assert {r["signature"]: r["n_files"] for r in captures.ubiquity(known).collect()} == {s: len(c) for s, c in want.items()}
    ids = sorted(r["id"] for r in known.names.collect())
    assert ids == list(range(1, len(ids) + 1))
    assert captures.ubiquity(captures.first_day(df([]))).collect() == []


def test_a_batch_of_decisions_is_logged_once(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "k string, v int"
    assert logged_decisions(spark, path, schema).collect() == []
    first = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema).repartition(3)
    for _ in range(3):
        log_decisions(first, path, "7")
    log_decisions(spark.createDataFrame([("a", 4)], schema), path, "8")
    log_decisions(spark.createDataFrame([], schema), path, "9")
    assert sorted(map(tuple, logged_decisions(spark, path, schema).collect())) == [("a", 1, "7"), ("a", 4, "8"), ("b", 2, "7"), ("c", 3, "7")]
    assert not [p for p in (tmp_path / "log").iterdir() if p.name.startswith("_pending")]


def test_a_task_that_fails_after_it_has_written_runs_again(spark, tmp_path):
    import pyarrow as pa

    path, schema = str(tmp_path / "log"), "k string, v int"
    rows = pa.RecordBatch.from_pydict({"k": ["a", "b"], "v": pa.array([1, 2], pa.int32())})
    writer = DecisionWriter(path, "1")
    writer.write(iter([rows]))  # this attempt's message never arrives
    message = writer.write(iter([rows]))
    writer.commit([message, None, Files()])
    again = DecisionWriter(path, "1")  # the whole job once more, as after a driver that died before it noted the batch
    again.commit([again.write(iter([rows]))])
    lost = DecisionWriter(path, "2")
    lost.abort([lost.write(iter([rows]))])
    assert sorted(map(tuple, logged_decisions(spark, path, schema).collect())) == [("a", 1, "1"), ("b", 2, "1")]
