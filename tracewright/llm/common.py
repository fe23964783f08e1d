"""What the operators share: table access, tables written to the shared folder, ranks, batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of a batch are handled in slices of about so many characters, so that long texts do not add up.
SLICE_CHARS = 1 << 20
#: Rows and bytes that Spark hands to Python at once.
ARROW_ROWS = 1_000
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; only with a local master one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = f"file://{tempfile.mkdtemp(prefix='tracewright-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


#: For rows of packed bytes of many kilobytes: their size is looked at row by row, and they are not compressed again.
WIDE_ROWS = {"compression": "uncompressed", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}


#: Tables written inside each open temporary() block of a thread, the innermost block last.
_open: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("open", default=())


def written(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: later stages start from it whatever executors are lost.

    How many files it has is left to adaptive execution, which merges small partitions by their bytes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tracewright/{name}-{uuid.uuid4().hex}"
    df.write.options(**(WIDE_ROWS if wide else {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    if blocks := _open.get():
        blocks[-1].append(out)
    return out


@contextmanager
def temporary() -> Iterator[None]:
    """Tables that are written inside are deleted at its end, but those that kept() names."""
    own: list[DataFrame] = []
    before = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(before)
        for table in own:
            discard(table)


def kept(df: DataFrame) -> DataFrame:
    """A written table that outlives the temporary() block it was written in."""
    *outer, own = _open.get()
    own.remove(df)
    if outer:
        outer[-1].append(df)
    return df


def discard(df: DataFrame) -> None:
    """Delete a table made by written() once nothing reads it any more."""
    path = getattr(df, "written_to", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Texts can be long: hand few rows at once to Python. Its workers find this package where the driver has it."""
    root, given = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in given.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{given}".rstrip(":")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


#: Tables up to so many rows of at most a few hundred bytes are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def joined(left: DataFrame, right: DataFrame, on: list[str] | Column, how: str = "inner") -> DataFrame:
    """A join that broadcasts the right side (a written table) only if its counted rows are few."""
    return left.join(F.broadcast(right) if right.count() <= BROADCAST_ROWS else right, on, how)


def ranked(df: DataFrame, order: list[Column], name: str, first: int = 1, wide: bool = False) -> DataFrame:
    """df with a dense global row number in that order.

    A range sort numbers the rows of each partition; one count per partition goes to the driver and
    comes back as that partition's offset. No window over the whole table, so no single task.
    """
    numbered = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked", wide=wide)
    part = F.shiftright("_at", 33)
    counts = sorted(numbered.groupBy(part.alias("p")).count().collect())
    starts, total = [], first
    for p, n in counts:
        starts.append((p, total))
        total += n
    spark = df.sparkSession
    offsets = F.broadcast(spark.createDataFrame(starts, "_p long, _start long"))
    return (
        numbered.withColumn("_p", part)
        .join(offsets, "_p")
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_p", "_start", "_at")
    )


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about SLICE_CHARS characters each."""
    lo = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= SLICE_CHARS:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
