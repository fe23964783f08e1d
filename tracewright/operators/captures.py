"""How many captures a signature occurs in, kept up to date without reading old captures again.

Captures get dense numbers when they first come up. The captures of a signature are a set of such numbers, as bitmaps of
one bucket of numbers each, and sets of different days are merged by OR. Counts are exact.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators.sampling import numbered
from tracewright.sources.writers import staged


class Captures(NamedTuple):
    """names (src, id from 1 without gaps) and sets (signature, bucket, bits), both written."""

    names: DataFrame
    sets: DataFrame


def _sets(events: DataFrame, names: DataFrame) -> DataFrame:
    """The captures of each signature in these events; a null src is no capture."""
    rows = events.select("signature", "src").distinct().join(names, "src")
    return rows.groupBy("signature", F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def first_day(events: DataFrame) -> Captures:
    """Of events (signature, src)."""
    names = staged(numbered(events.select("src").where("src IS NOT NULL").distinct(), [], [F.col("src")], "id"), "captures")
    return Captures(names, staged(_sets(events, names), "capture_sets"))


def merged(so_far: Captures, events: DataFrame) -> Captures:
    """so_far with another day's events; of earlier days only the names and the sets are read."""
    new = events.select("src").where("src IS NOT NULL").distinct().join(so_far.names, "src", "left_anti")
    last = so_far.names.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    more = numbered(new, [], [F.col("src")], "id").withColumn("id", F.col("id") + last)
    names = staged(so_far.names.unionByName(more), "captures")
    both = so_far.sets.unionByName(_sets(events, names))
    return Captures(names, staged(both.groupBy("signature", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")), "capture_sets"))


def ubiquity(captures: Captures) -> DataFrame:
    """signature and n_files, the number of captures that it occurs in."""
    return captures.sets.groupBy("signature").agg(F.sum(F.bitmap_count("bits")).alias("n_files"))
