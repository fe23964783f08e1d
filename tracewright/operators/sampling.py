"""Caps, splits, first-wins deduplication and apportionment. Random choices are orders by a keyed hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import rules
from tracewright.functions.contract import lookup, violations
from tracewright.functions.signatures import basename
from tracewright.sources.writers import staged


def hash_order(seed: str, *columns: str) -> Column:
    """A reproducible pseudo-random order: SHA-256 of the seed and the values."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), 256)


def capped(df: DataFrame, by: list[str], cap: int, order: list[Column]) -> DataFrame:
    """At most `cap` rows of each group, the first by `order`.

    Spark pushes the limit below the shuffle (WindowGroupLimit), so of a hot group at most `cap` rows a task travel.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")


def first_wins(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row by `order` of each value of key (whole body, prefix of it, or signature)."""
    out = df.withColumn("_key", key)
    rest = [c for c in df.columns]
    best = out.groupBy("_key").agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    return best.select(*(F.col("_row")[c].alias(c) for c in rest))


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """df with the place (from 1) of each row in its group, for groups that are few and large.

    A range sort by group and order spreads a group over tasks; each task numbers its part, and one count for each part
    (at most as many as tasks and groups together) gives the offsets. So no task holds a whole group, as a window's
    would. Rows that are equal in `order` are placed in any way.
    """
    keys = [f"_by{i}" for i in range(len(by))]
    marked = df.withColumns({k: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for k, c in zip(keys, by, strict=True)})
    rows = staged(marked.orderBy(*keys, *order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    parts = rows.groupBy(F.shiftright("_at", 33).alias("_part"), *keys).agg(F.min("_at").alias("_from"), F.count("*").alias("_n")).orderBy("_part", "_from").collect()
    before: dict[tuple, int] = {}
    offsets = []
    for r in parts:
        key = tuple(r[k] for k in keys)
        offsets.append((r["_part"], *key, before.get(key, 0) - r["_from"] + 1))
        before[key] = before.get(key, 0) + r["_n"]
    table = df.sparkSession.createDataFrame(offsets, "_part long, " + "".join(f"{k} string, " for k in keys) + "_shift long")
    return rows.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(table), ["_part", *keys]).withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_shift", "_at", *keys)


def tagged_exclusions(members: DataFrame, held: DataFrame, sig_cap: int, seed: str) -> DataFrame:
    """members (ord, signature, gold) with a reason: dropped, reserved, over cap, or kept.

    Only rows within the cap are looked for (a limited window), so a hot signature never meets in one task.
    """
    out = members.join(held.select("signature").distinct().withColumn("_held", F.lit(True)), "signature", "left")
    free = out.where((F.col("gold") != "drop") & F.col("_held").isNull()).select("signature", "ord")
    within = capped(free, ["signature"], sig_cap, [hash_order(seed, "signature", "ord"), F.col("ord")]).select("ord", F.lit(True).alias("_in"))
    reason = F.when(F.col("gold") == "drop", "dropped").when(F.col("_held"), "reserved").when(F.col("_in").isNull(), "over cap").otherwise("kept")
    return out.join(within, "ord", "left").withColumn("reason", reason).drop("_held", "_in")


def training_exclusions(members: DataFrame, held: DataFrame, sig_cap: int, image_cap: int, seed: str) -> DataFrame:
    """members (ord, signature, gold, Image, event) with a reason: those of tagged_exclusions(), then `contract: ` and the
    first violation of the body, then over image cap: of each class and binary the first image_cap rows by hash stay."""
    out = tagged_exclusions(members, held, sig_cap, seed)
    broken = F.get(violations(F.col("event")), F.lit(0))
    out = out.withColumn("reason", F.when((F.col("reason") == "kept") & broken.isNotNull(), F.concat(F.lit("contract: "), broken)).otherwise(F.col("reason")))
    left = out.where("reason = 'kept'").select("ord", "gold", basename(F.col("Image")).alias("_image"))
    within = capped(left, ["gold", "_image"], image_cap, [hash_order(f"{seed}|image", "ord"), F.col("ord")]).select("ord", F.lit(True).alias("_in"))
    reason = F.when((F.col("reason") == "kept") & F.col("_in").isNull(), "over image cap").otherwise(F.col("reason"))
    return out.join(within, "ord", "left").withColumn("reason", reason).drop("_in")


def alternating_split(rows: DataFrame) -> DataFrame:
    """side: malicious rows all eval; of each (gold, family) the even places by ord eval, the odd ones train."""
    out = numbered(rows, ["gold", "family"], [F.col("ord")], "_place")
    return out.withColumn("side", F.when((F.col("gold") == "malicious") | (F.col("_place") % 2 == 1), "eval").otherwise("train")).drop("_place")


def trim_quotas(counts: dict[str, int], size: int) -> dict[str, int]:
    """How many rows leave each class other than malicious so that `size` remain: the largest class gives one at a time.

    counts holds one number a class, so this is a few additions on the driver.
    """
    left, gone = dict(counts), dict.fromkeys(counts, 0)
    classes = [c for c in left if c != "malicious"]
    excess = sum(left.values()) - size
    while excess > 0 and any(left[c] for c in classes):
        tallest = max(left[c] for c in classes)
        at_top = [c for c in classes if left[c] == tallest]
        below = max([left[c] for c in classes if left[c] < tallest], default=0)
        step = min(excess // len(at_top), tallest - below)
        for c in at_top if step else at_top[:excess]:
            left[c] -= max(step, 1)
            gone[c] += max(step, 1)
        excess -= max(step, 1) * len(at_top if step else at_top[:excess])
    return gone


def trimmed(rows: DataFrame, size: int) -> DataFrame:
    """rows (ord, gold) cut to `size`: each class loses its earliest rows, as many as trim_quotas() says."""
    counts = {r["gold"]: r["n"] for r in rows.groupBy("gold").agg(F.count("*").alias("n")).orderBy("gold").collect()}
    gone = trim_quotas(counts, size)
    quota = F.lit(0)
    for c, n in gone.items():
        quota = F.when(F.col("gold") == c, F.lit(n)).otherwise(quota)
    return numbered(rows, ["gold"], [F.col("ord")], "_place").where(F.col("_place") > quota).drop("_place")


def majority(rows: DataFrame) -> DataFrame:
    """signature and its most frequent class; ties go to the class that was seen first."""
    n = rows.groupBy("signature", "gold").agg(F.count("*").alias("n"), F.min("ord").alias("seen"))
    return n.groupBy("signature").agg(F.max_by("gold", F.struct("n", -F.col("seen"))).alias("gold"))


def validation_signatures(rows: DataFrame, fraction: float, seed: str) -> DataFrame:
    """Signatures for validation: of each majority class the first by hash, max(1, round half even of n * fraction)."""
    m = numbered(majority(rows), ["gold"], [hash_order(seed, "signature"), F.col("signature")], "_place")
    sizes = m.groupBy("gold").agg(F.greatest(F.lit(1), F.bround(F.count("*") * F.lit(fraction)).cast("int")).alias("_wanted"))  # a row a class
    return m.join(F.broadcast(sizes), "gold").where(F.col("_place") <= F.col("_wanted")).select("signature", "gold")


def blind_sample(groups: DataFrame, k: int, seed: str) -> DataFrame:
    """k groups in a reproducible random order."""
    return groups.orderBy(hash_order(seed, "signature"), "signature").limit(k)


def apportion(mix: DataFrame, n: int) -> DataFrame:
    """mix (key, share, ord) to whole counts that sum to n: floors, then the largest remainders, ties by ord.

    mix is configuration with a few rows; its window has no partitions for that reason.
    """
    raw = F.col("share") * F.lit(n)
    out = mix.withColumn("_floor", F.floor(raw).cast("long")).withColumn("_rest", raw - F.floor(raw))
    every = Window.partitionBy(F.lit(0))
    spare = F.lit(n) - F.sum("_floor").over(every)
    place = F.row_number().over(every.orderBy(F.desc("_rest"), "ord"))
    return out.select("key", (F.col("_floor") + F.when(place <= spare, 1).otherwise(0)).alias("n"))


def merged(real: DataFrame, synthetic: DataFrame, held: DataFrame, collapse_critical: bool = True) -> DataFrame:
    """Real rows and those synthetic rows whose signature is neither held out nor contributed before.

    A few columns are asked for: ord, signature, gold, severity.
    """
    fresh = synthetic.join(held.select("signature").distinct(), "signature", "left_anti").join(real.select("signature").distinct(), "signature", "left_anti")
    fresh = first_wins(fresh, F.col("signature"), "ord")
    out = real.withColumn("origin", F.lit("real")).unionByName(fresh.withColumn("origin", F.lit("synthetic")), allowMissingColumns=True)
    return out.withColumn("severity", F.when(F.col("severity") == "critical", "high").otherwise(F.col("severity"))) if collapse_critical else out


def expanded_eval(base: DataFrame, blind: DataFrame, candidates: DataFrame, train: DataFrame, old: str = "base", new: str = "expanded") -> DataFrame:
    """An evaluation set and what a blind pass adds to it: id, gold, severity, event, subset, reason.

    blind: signature, severity; candidates: ord, id, signature, EventID, event, action (of several with one signature the
    last by ord counts); train: signature, action. Dropped decisions and signatures without a candidate give nothing;
    where the boundary rules call an event benign or malicious, their class is taken. reason: null for rows that stay
    in, else why training rules them out (kept in the result, so that they can be counted).
    """
    last = candidates.groupBy("signature").agg(F.max_by(F.struct("id", "EventID", "event", "action"), "ord").alias("c"))
    made = blind.where("severity IS NOT NULL AND severity <> 'drop'").select("signature", "severity").join(last, "signature")
    made = made.select("signature", "severity", rules.bucket(F.col("severity")).alias("gold"), "c.*")
    made = made.withColumn("_want", rules.boundary(F.col("id"), F.col("EventID"), F.col("event"))["want"])
    ruled = F.col("_want").isin("benign", "malicious") & (F.col("_want") != F.col("gold"))
    made = made.withColumns({"severity": F.when(ruled, lookup(F.col("_want"), rules.CLASS_SEVERITY)).otherwise(F.col("severity")), "gold": F.when(ruled, F.col("_want")).otherwise(F.col("gold"))})
    added = expansion(made, train).select("id", "gold", "severity", "event", F.lit(new).alias("subset"), F.col("excluded").alias("reason"))
    return base.select("id", "gold", "severity", "event", F.lit(old).alias("subset"), F.lit(None).cast("string").alias("reason")).unionByName(added)


def expansion(candidates: DataFrame, train: DataFrame) -> DataFrame:
    """candidates (id, signature, action) with the reason why training rules them out; null if nothing does."""
    s = train.select("signature").distinct().withColumn("_s", F.lit(True))
    a = train.select("action").distinct().withColumn("_a", F.lit(True))
    out = candidates.join(s, "signature", "left").join(a, "action", "left")
    return out.withColumn("excluded", F.when(F.col("_s"), "exact signature in training").when(F.col("_a"), "same action in training")).drop("_s", "_a")
