"""Review scores while captures arrive: profiles as state, scores from what an event says and what the profiles say now.

A score has a part that the event alone decides and one that depends on how often its signature and its coarse
signature were seen in benign captures and in how many captures of attacks. The first is made once an event, with the signatures
that profiles and scores share. For the second, the state
of a signature is a number and at most FILES names, and a row comes out only when one of them passes a bound that
scores depend on. As both only grow, the largest of these rows is the newest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tracewright.functions import rules
from tracewright.functions.contract import body, normalised
from tracewright.functions.signatures import with_behaviour
from tracewright.operators import queue
from tracewright.sources.committed import log_decisions, logged_decisions
from tracewright.sources.files import on_workers
from tracewright.streaming.session import state_in_files

#: A signature in so many captures is everywhere; more are not told apart.
FILES = max(bound for bound, _ in queue.FILE_BANDS)

BAND = "level string, key string, n long, files long"
#: What is kept of an event; own is null where it is not of an attack.
SIGNED = "ord long, src string, attack boolean, EventID string, TargetFilename string, Image string, signature string, coarse string, own double"
_PARTIAL = "level string, key string, n long, files string"
_partial = pa.schema([("level", pa.string()), ("key", pa.string()), ("n", pa.int64()), ("files", pa.string())])
#: Keys that a task adds up before it passes them on.
HELD = 100_000


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a key of what a task has read, so that a frequent signature does not meet its rows one by one."""
    counts: dict[tuple[str, str], int] = {}
    files: dict[tuple[str, str], set[str]] = {}

    def out() -> pa.RecordBatch:
        keys = list(counts)
        batch = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([counts[k] for k in keys], pa.int64()), pa.array([json.dumps(sorted(files.get(k, ()))) for k in keys])], schema=_partial)
        counts.clear(), files.clear()
        return batch

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("signature", "coarse", "src", "attack"))
        for signature, coarse, src, attack in zip(*columns, strict=True):
            fine = ("fine", signature)
            if attack:
                counts.setdefault(fine, 0)
                own = files.setdefault(fine, set())
                if src is not None and len(own) < FILES:
                    own.add(src)
            else:
                counts[fine] = counts.get(fine, 0) + 1
                counts["coarse", coarse] = counts.get(("coarse", coarse), 0) + 1
        if len(counts) >= HELD:
            yield out()
    if counts:
        yield out()


class Profiles(StatefulProcessor):
    """Counts and captures by key; rows of BAND when a bound is passed."""

    def __init__(self, ambient_min: int):
        self.ambient_min = ambient_min

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("profile", "n long, files string")

    def band(self, level: str, n: int, files: list[str]) -> tuple[int, int]:
        bounds = (self.ambient_min, rules.AMBIENT_DROP) if level == "fine" else (queue.COARSE_MIN,)
        return sum(n >= bound for bound in bounds), queue.file_band(len(files))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        level = key[0]
        n, files = (int(x) if i == 0 else json.loads(x) for i, x in enumerate(self.state.get())) if self.state.exists() else (0, [])
        before = self.band(level, n, files)
        known = set(files)
        for part in rows:
            n += int(part["n"].sum())
            for more in part["files"]:
                known.update(json.loads(more))
        files = sorted(known)[:FILES]
        self.state.update((n, json.dumps(files)))
        if self.band(level, n, files) != before:
            yield pd.DataFrame([{"level": level, "key": key[1], "n": n, "files": len(files)}])

    def close(self) -> None:
        pass


def signed(events: DataFrame) -> DataFrame:
    """Contract records with src and attack, with signature, coarse and action."""
    # as in queue.scored(): commands of attacks are normalised first, those of benign captures are taken as they are
    rows = normalised(events.withColumn("_given", F.col("CommandLine")))
    return with_behaviour(rows.withColumn("CommandLine", F.when(F.col("attack"), F.col("CommandLine")).otherwise(F.col("_given"))))


def bands(events: DataFrame, ambient_min: int = queue.AMBIENT_MIN) -> DataFrame:
    """A stream of BAND rows from a stream of contract records with src and attack, or of kept_signed() rows."""
    on_workers(events.sparkSession)
    rows = events if {"signature", "coarse"} <= set(events.columns) else signed(events)
    partial = rows.select("signature", "coarse", "src", "attack").mapInArrow(_added_up, _PARTIAL)
    return partial.groupBy("level", "key").transformWithStateInPandas(statefulProcessor=Profiles(ambient_min), outputStructType=BAND, outputMode="Update", timeMode="None")


def kept_bands(events: DataFrame, path: str, checkpoint: str, ambient_min: int = queue.AMBIENT_MIN) -> StreamingQuery:
    """Take in what has arrived and add the bounds passed to the log at path, each batch once, then stop."""

    def log(rows: DataFrame, batch: int) -> None:
        log_decisions(rows, path, f"{batch:012}")

    with state_in_files(events.sparkSession):
        return bands(events, ambient_min).writeStream.foreachBatch(log).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add the attack events that have arrived, with their own part of the score, to a Parquet table, then stop."""
    own = queue.own_parts(queue.prepared(events.where("attack"))).select("ord", "src", "EventID", "TargetFilename", "Image", "signature", "coarse", "own")
    return own.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_signed(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived to a Parquet table of SIGNED rows, then stop.

    The texts of an event are worked once, for its profile and its score. Rows are dealt to as many tasks as shuffles have: the files
    of a batch may be few and large.
    """
    spark = events.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = signed(events.repartition(tasks, "ord")).withColumn("event", F.when(F.col("attack"), body()))
    own = F.when(F.col("attack"), F.col("own")).alias("own")
    kept = queue.own_parts(rows).select("ord", "src", "attack", "EventID", "TargetFilename", "Image", "signature", "coarse", own)
    return kept.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scores(spark: SparkSession, events: DataFrame, path: str, ambient_min: int = queue.AMBIENT_MIN) -> DataFrame:
    """ord, src, EventID, signature, score, prelabel of kept_events(), or of the attacks of kept_signed(), as the profiles at path say now."""
    newest = logged_decisions(spark, path, BAND).groupBy("level", "key").agg(F.max("n").alias("n"), F.max("files").alias("files"))
    fine = newest.where("level = 'fine'").select(F.col("key").alias("signature"), F.col("n").alias("amb"), F.col("files").alias("n_files"))
    coarse = newest.where("level = 'coarse'").select(F.col("key").alias("coarse"), F.col("n").alias("camb"))
    rows = events.join(fine, "signature", "left").join(coarse, "coarse", "left").fillna(0, ["amb", "camb", "n_files"])
    return queue.judged(rows, ambient_min).select("ord", "src", "EventID", "signature", "score", "prelabel")
