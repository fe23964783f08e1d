"""Binary event logs as a Spark data source: `evtx`, read by runs of chunks, written a file at a time."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tracewright.sources import evtx
from tracewright.sources.files import listed, located, on_workers, removed
from tracewright.sources.readers import parse_events

#: Chunks of 64 KB that one task reads, and that one file written holds.
TASK_CHUNKS = 256
FILE_CHUNKS = 256
#: Bytes of event data after which a file is closed; encoded, they are fewer than FILE_CHUNKS chunks.
FILE_BYTES = FILE_CHUNKS * evtx.CHUNK // 4

SCHEMA = "src string, chunk long, record_id long, written timestamp, xml string, error string"


@dataclass
class Runs(InputPartition):
    """Runs of chunks (path, src, first, n) for one task."""

    runs: list[tuple[str, str, int, int]]


class EventLogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Runs]:
        """Large files are cut, small ones put together; only paths and sizes pass the driver."""
        store, root = located(self.path)
        out: list[Runs] = []
        held: list[tuple[str, str, int, int]] = []
        room = TASK_CHUNKS
        for info in listed(store, root, r"(?i)^(?!.*/_pending-).*\.evtx$"):
            src = info.path[len(root) :].strip("/") or info.base_name
            n, first = -(-max(0, info.size - evtx.FILE_HEADER) // evtx.CHUNK), 0
            while first < n:
                some = min(room, n - first)
                held.append((info.path, src, first, some))
                first, room = first + some, room - some
                if not room:
                    out.append(Runs(held))
                    held, room = [], TASK_CHUNKS
        if held:
            out.append(Runs(held))
        return out or [Runs([])]

    def read(self, partition: Runs) -> Iterator[tuple]:
        """A row a record, a chunk in memory at a time; what is damaged is a row with an error instead of XML."""
        store, _ = located(self.path)
        for path, src, first, n in partition.runs:
            with store.open_input_file(path) as file:
                file.seek(evtx.FILE_HEADER + first * evtx.CHUNK)
                for chunk in range(first, first + n):
                    for r in evtx.Chunk(file.read(evtx.CHUNK)).records():
                        yield src, chunk, r.record_id, r.written, r.xml, r.error


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class EventLogWriter(DataSourceWriter):
    """One log file or more a task; files get their names when the whole job has ended well."""

    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Written:
        store, root = located(self.path)
        store.create_dir(f"{root}/_pending-{self.job}", recursive=True)
        files: list[str] = []
        held: list[evtx.Event] = []
        size = 0

        def close() -> None:
            name = f"{uuid.uuid4().hex}.evtx"
            with store.open_output_stream(f"{root}/_pending-{self.job}/{name}") as out:
                out.write(evtx.encoded(held))
            files.append(name)
            held.clear()

        for r in rows:
            held.append(evtx.Event(r["record_id"], r["written"], r["event_id"], tuple((x["name"], x["value"]) for x in r["data"])))
            size += sum(2 * len(v or "") + 64 for _, v in held[-1].data) + 128
            if size >= FILE_BYTES:
                close()
                size = 0
        if held:
            close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = located(self.path)
        for m in messages:
            for name in m.files if m else ():
                store.move(f"{root}/_pending-{self.job}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        removed(*located(f"{self.path.rstrip('/')}/_pending-{self.job}"))


class EventLogs(DataSource):
    """Reads SCHEMA; writes rows of record_id, written (no zone: UTC), event_id and data (array of name, value)."""

    @classmethod
    def name(cls) -> str:
        return "evtx"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> EventLogReader:
        return EventLogReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> EventLogWriter:
        return EventLogWriter(self.options["path"])


def registered(spark: SparkSession) -> SparkSession:
    on_workers(spark)
    spark.dataSource.register(EventLogs)
    return spark


def event_log_records(spark: SparkSession, path: str) -> DataFrame:
    """src, chunk, record_id, written, xml, error of every record of a log file, or of all logs below a folder.

    A record that cannot be decoded, and what cannot be found in a damaged chunk, is one row with an error and no xml.
    Files of a job that has not ended are passed over.
    """
    return registered(spark).read.format("evtx").load(path)


def event_logs(spark: SparkSession, path: str) -> DataFrame:
    """Contract records, with src and record_id, of binary event logs; damaged records are left out."""
    rows = event_log_records(spark, path).where(F.col("xml").isNotNull())
    return parse_events(rows.select("src", "record_id", "xml"), "xml")


def write_event_logs(rows: DataFrame, path: str) -> None:
    """rows (record_id, written, event_id, data: array<struct<name, value>>) as log files of all tasks."""
    registered(rows.sparkSession)
    rows.select("record_id", "written", "event_id", "data").write.format("evtx").mode("append").save(path)
