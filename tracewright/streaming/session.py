"""A labelling session as a stateful stream: actions by signature, with undo and redo.

The state of a signature is its decision and two bounded stacks. Actions are numbered (seq) and arrive in that order
for each signature; what has a number that was seen before is passed over, so a batch that is sent twice changes
nothing. A decision comes out whenever a batch changes it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tracewright.functions.rules import BUCKET
from tracewright.sources.committed import log_decisions, logged_decisions
from tracewright.sources.files import on_workers

#: How many decisions of a signature can be taken back.
DEPTH = 50
ACTIONS = ("label", "drop", "accept", "accept all", "drop tail", "undo", "redo")
BY = {"label": "human", "drop": "human", "accept": "human: accepted suggestion", "accept all": "human: accepted suggestion (bulk)", "drop tail": "bulk tail drop"}

_STATE = "seq long, current string, undo string, redo string"
DECISION = "signature string, seq long, severity string, gold string, decided_by string, rule string, undoable int"

Decision = dict[str, str | None]


@dataclass
class Session:
    """The decision of one signature; of an open one, current is None."""

    seq: int = -1
    current: Decision | None = None
    undo: list[Decision | None] = field(default_factory=list)
    redo: list[Decision | None] = field(default_factory=list)

    def act(self, seq: int, action: str, severity: str | None, rule: str | None, depth: int = DEPTH) -> None:
        """Take in one action.

        label and drop decide and can be undone; accept decides as well, accept all and drop tail only what is open. These
        three cannot be undone by themselves: undo takes the last label or drop back, to what was before it. redo takes
        the last undo back, until the next label or drop. An undo or redo of nothing, and unknown actions, do nothing.
        """
        if seq <= self.seq:
            return
        self.seq = seq
        if action == "undo" and self.undo:
            self.redo.append(self.current)
            self.current = self.undo.pop()
        elif action == "redo" and self.redo:
            self.undo.append(self.current)
            self.current = self.redo.pop()
        elif action in BY and (self.current is None or action in ("label", "drop", "accept")):
            if action in ("label", "drop"):
                self.undo = [*self.undo, self.current][-depth:]
                self.redo = []
            dropped = action in ("drop", "drop tail") or severity is None
            self.current = {"severity": None if dropped else severity, "gold": "drop" if dropped else BUCKET.get(severity, "drop"), "decided_by": BY[action], "rule": rule}


class Sessions(StatefulProcessor):
    def __init__(self, depth: int = DEPTH):
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("session", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The rows of a signature in one batch are put in order first; how many they are, the trigger of the query bounds."""
        if self.state.exists():
            seq, current, undo, redo = self.state.get()
            session = Session(int(seq), json.loads(current), json.loads(undo), json.loads(redo))
        else:
            session = Session()
        before = asdict(session)
        actions = pd.concat(list(rows)).sort_values("seq", kind="stable")
        plain = lambda x: None if x is None or x != x else str(x)
        for seq, action, severity, rule in zip(actions["seq"], actions["action"], actions["severity"], actions["rule"], strict=True):
            session.act(int(seq), action, plain(severity), plain(rule), self.depth)
        if asdict(session) == before:
            return
        self.state.update((session.seq, json.dumps(session.current), json.dumps(session.undo), json.dumps(session.redo)))
        now = session.current or {"severity": None, "gold": None, "decided_by": None, "rule": None}
        yield pd.DataFrame([{"signature": key[0], "seq": session.seq, **now, "undoable": len(session.undo)}])

    def close(self) -> None:
        pass


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_in_files(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, which stateful processors need; the setting is put back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def sessions(actions: DataFrame, depth: int = DEPTH) -> DataFrame:
    """A stream of DECISION rows from a stream of actions (signature, seq, action, severity, rule): the decision of every
    signature that a batch has changed, with null gold where it is open again."""
    on_workers(actions.sparkSession)
    rows = actions.select("signature", F.col("seq").cast("long"), "action", "severity", "rule")
    return rows.groupBy("signature").transformWithStateInPandas(statefulProcessor=Sessions(depth), outputStructType=DECISION, outputMode="Update", timeMode="None")


def kept_sessions(actions: DataFrame, path: str, checkpoint: str, depth: int = DEPTH) -> StreamingQuery:
    """Take in what has arrived and add the decisions to the log at path, each batch once, then stop."""

    def log(rows: DataFrame, batch: int) -> None:
        log_decisions(rows, path, f"{batch:012}")

    with state_in_files(actions.sparkSession):
        return sessions(actions, depth).writeStream.foreachBatch(log).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def decided(spark: SparkSession, path: str) -> DataFrame:
    """The decisions that stand: the newest entry of each signature in the log, without those that are open again."""
    rows = logged_decisions(spark, path, DECISION)
    rest = [c for c in ("severity", "gold", "decided_by", "rule", "undoable")]
    last = rows.groupBy("signature").agg(F.max("seq").alias("seq"), F.max_by(F.struct(*rest), "seq").alias("d"))
    return last.select("signature", "seq", "d.*").where("gold IS NOT NULL")
