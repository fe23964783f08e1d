"""Sinks: JSON lines, keyed tables with upsert, tables of rendered events, checksums."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.sources.files import located, on_workers


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share.

    Only with a local master a temporary folder stands in where that setting is not made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(shared or f'file://{tempfile.gettempdir()}').rstrip('/')}/tracewright/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of its own in a fresh() path, read back: computed once for all that follows."""
    spark, path = df.sparkSession, fresh(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def json_lines(df: DataFrame, *paths: str) -> None:
    """Write df to each path, replacing what is there."""
    for path in paths:
        df.write.mode("overwrite").json(path)


def upserted(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """current with the rows of changes in place of those with their keys (unique in changes)."""
    return current.join(changes.select(key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


#: Parts that a keyed table is written in.
BUCKETS = 64


def _bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def keyed_table(rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write rows (keys are unique) as a table that upsert_table() can change, in parts by a hash of the keys."""
    _bucketed(rows, keys, buckets).repartition(buckets, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)


def upsert_table(changes: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> int:
    """Put changes (unique keys, columns of the table or fewer) in place of the rows with their keys, or beside them.

    Only parts that a changed key lies in are read and written again, as copies that replace the old ones when all are
    there; the files of other parts stay as they are. `buckets` is that of keyed_table(). Returns how many parts were written.
    """
    spark = changes.sparkSession
    new = staged(_bucketed(changes, keys, buckets), "changes")
    touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())  # at most `buckets` numbers
    if not touched:
        return 0
    table = spark.read.parquet(path)
    old = table.where(F.col("_bucket").isin(touched))
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    stay = old.alias("o").join(new.select("_bucket", *keys).alias("n"), [F.col("o._bucket") == F.col("n._bucket"), *same], "left_anti")
    rows = stay.unionByName(new, allowMissingColumns=True).select(table.columns)
    rows.repartition(len(touched), "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
    return len(touched)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_bucket")


def append_decisions(decisions: DataFrame, path: str) -> None:
    """Add decisions to the log; nothing that is written is changed, so a crash loses none."""
    decisions.write.mode("append").parquet(path)


def rendered_events(rows: DataFrame, path: str) -> None:
    """rows (id, event, ...) as a table by class; earlier contents of the classes written go."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("gold").parquet(path)


#: Bytes of a file that are in memory at once.
PIECE = 1 << 20
#: Files that a task reads on average, and entries of a folder in a batch.
FILES = 50_000
#: Bytes from which a file is dealt out by itself, not with those beside it.
LARGE = 64 << 20
#: Files that a local disk is asked for at once.
AHEAD = 64


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder; names that begin with . or _ are left out, as Spark's own listing does."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            store, at = located(folder)
            found = store.get_file_info(fs.FileSelector(at))
            for lo in range(0, len(found), FILES):
                some = [f for f in found[lo : lo + FILES] if not f.base_name.startswith(".") and (not f.base_name.startswith("_") or "=" in f.base_name)]
                paths = [f"{folder.rstrip('/')}/{f.base_name}" for f in some]
                folders = [f.type == fs.FileType.Directory for f in some]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(folders, pa.bool_()), pa.array([f.size for f in some], pa.int64())], names=["path", "folder", "length"])


def files_below(spark: SparkSession, path: str) -> DataFrame:
    """path, length of every file below a folder, or of a file itself, written.

    Tasks list the folders, level by level; the driver holds no name but the first. A task holds the entries of one folder.
    """
    on_workers(spark)
    store, at = located(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    root = f"file:{at}" if isinstance(store, fs.LocalFileSystem) else path.rstrip("/")
    if info.type == fs.FileType.File:
        return spark.createDataFrame([(root, info.size)], "path string, length long")
    level, levels = spark.createDataFrame([(root,)], "path string"), []
    while not level.isEmpty():
        found = staged(level.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_entries, "path string, folder boolean, length long"), "listing")
        levels.append(found.where("NOT folder").select("path", "length"))
        level = found.where("folder").select("path")
    return reduce(DataFrame.unionByName, levels)


def _asked(store: fs.FileSystem, file: str) -> None:
    """Have a local disk fetch the first piece of a file, so that it works on many at once, not on one after the other."""
    if isinstance(store, fs.LocalFileSystem) and hasattr(os, "posix_fadvise"):
        handle = os.open(file, os.O_RDONLY)
        try:
            os.posix_fadvise(handle, 0, PIECE, os.POSIX_FADV_WILLNEED)
        finally:
            os.close(handle)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """path, length, sha256 of every file below a folder, in order of path.

    Tasks list the files and read them in pieces, so files of any size, and folders of any number of files, take the same memory.
    Files are put in order before they are read: Spark finds the ranges of an order by running what is below it (some 300
    paths a task come to the driver), so an order of digests reads every file twice. A task then reads files that lie
    together, but large ones are dealt out first.
    """
    files = files_below(spark, path).withColumn("sha256", F.lit(None).cast("string"))
    n, large = files.agg(F.count("*"), F.count_if(F.col("length") >= LARGE)).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // FILES))
    shape = "path string, length long, sha256 string"

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            paths, found = batch.column("path").to_pylist(), batch.column("sha256").to_pylist()
            wanted = [i for i, known in enumerate(found) if known is None]
            for lo in range(0, len(wanted), AHEAD):
                files = []
                for i in wanted[lo : lo + AHEAD]:
                    folder, _, name = paths[i].rpartition("/")
                    if folder != last:
                        last, (store, at) = folder, located(f"{folder}/")
                    files.append((i, store, f"{at.rstrip('/')}/{name}"))
                for _, lies, file in files:
                    _asked(lies, file)
                for i, lies, file in files:
                    digest = hashlib.sha256()
                    with lies.open_input_stream(file) as stream:
                        while piece := stream.read(PIECE):
                            digest.update(piece)
                    found[i] = digest.hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], names=["path", "length", "sha256"])

    if large:
        apart = files.where(F.col("length") >= LARGE).repartition(max(spark.sparkContext.defaultParallelism, -(-large // FILES)), "path")
        files = files.where(F.col("length") < LARGE).unionByName(staged(apart.mapInArrow(digests, shape), "digests"))
    return files.repartitionByRange(tasks, "path").sortWithinPartitions("path").mapInArrow(digests, shape)
