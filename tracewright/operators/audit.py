"""What tells the classes apart although it should not: fields, identifiers, tokens, binaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.contract import FIELDS
from tracewright.functions.signatures import basename


def field_presence(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """field, spread, leak: largest less smallest share of rows, by class (gold), that carry a contract column.

    One aggregate by class; all else works on a row a class.
    """
    shares = rows.groupBy("gold").agg(*(F.avg(F.col(f).isNotNull().cast("int")).alias(f) for f in fields))
    long = shares.unpivot("gold", list(fields), "field", "share")
    out = long.groupBy("field").agg(F.max("share").alias("_max"), (F.max("share") - F.min("share")).alias("spread")).where("_max > 0")
    return out.select("field", "spread", (F.col("spread") > 0.6).alias("leak"))


def identifier_overlap(rows: DataFrame, column: str = "User") -> DataFrame:
    """gold, accounts, unique_accounts: distinct identifiers of a class and those that no other class has."""
    pairs = rows.where(F.col(column).isNotNull()).select("gold", column).distinct()
    owners = pairs.groupBy(column).agg(F.count("*").alias("_n"), F.collect_set("gold").alias("_all"))
    every = owners.select("_n", F.explode("_all").alias("gold"))
    return every.groupBy("gold").agg(F.count("*").alias("accounts"), F.sum((F.col("_n") == 1).cast("int")).alias("unique_accounts"))


def token_counts(rows: DataFrame, text: str = "event") -> DataFrame:
    """token, gold, n: in how many rows of a class a token of three or more characters occurs."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_.\-]{3,}"), F.lit(0)), F.lower))
    return rows.select("gold", F.explode(found).alias("token")).groupBy("token", "gold").agg(F.count("*").alias("n"))


def _pure(counts: DataFrame, key: str, support: int, purity: float) -> DataFrame:
    by_key = counts.groupBy(key).agg(F.sum("n").alias("total"), F.max_by("gold", F.struct("n", "gold")).alias("gold"), F.max("n").alias("n"))
    return by_key.where((F.col("total") >= support) & (F.col("n") / F.col("total") >= purity))


def token_purity(rows: DataFrame, support: int = 4, purity: float = 0.90, coverage: float = 0.15, k: int = 25) -> DataFrame:
    """The k best supported tokens that nearly all belong to one class and cover a part of it (a top-k report)."""
    sizes = rows.groupBy("gold").agg(F.count("*").alias("size"))
    pure = _pure(token_counts(rows), "token", support, purity).where(F.col("n") >= 4).join(F.broadcast(sizes), "gold")
    return pure.where(F.col("n") / F.col("size") >= coverage).orderBy(F.desc("total"), "token").limit(k).select("token", "gold", "n", "total")


def onesided_binaries(rows: DataFrame, support: int = 6, share: float = 0.85, k: int = 12) -> DataFrame:
    """The k most frequent binaries that occur under a single class nearly always (a top-k report)."""
    counts = rows.where("Image IS NOT NULL").groupBy(basename(F.col("Image")).alias("base"), "gold").agg(F.count("*").alias("n"))
    return _pure(counts, "base", support, share).orderBy(F.desc("total"), "base").limit(k).select("base", "gold", "n", "total")


def quarantine(train: DataFrame, held: DataFrame) -> DataFrame:
    """n, exact, coarse: training rows that share a signature, or only image and parent, with held-out rows.

    The semi-joins' keys are distinct; exact must be 0 before a training set is used.
    """
    s = held.select("signature").distinct().withColumn("_s", F.lit(1))
    c = held.select("coarse").distinct().withColumn("_c", F.lit(1))
    out = train.join(s, "signature", "left").join(c, "coarse", "left")
    return out.agg(F.count("*").alias("n"), F.count("_s").alias("exact"), F.count("_c").alias("coarse"))


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Values of key on both sides of a split."""
    return left.select(key).intersect(right.select(key))

