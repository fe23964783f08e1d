"""From telemetry to a scored, ranked and grouped review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import rules
from tracewright.functions.contract import body, lookup, normalised
from tracewright.functions.signatures import basename, with_behaviour
from tracewright.sources.writers import staged


# How frequent a signature is ambient and a coarse one common; scores of the captures a signature is in.
AMBIENT_MIN, COARSE_MIN = 2, 20
FILE_BANDS = ((8, -4.0), (4, -1.5))
ALONE = 1.5


def profile(benign: DataFrame) -> DataFrame:
    """How often each signature, with its coarse one, occurs in benign events."""
    return with_behaviour(benign).groupBy("signature", "coarse").agg(F.count("*").alias("n"))


def ubiquity(attack: DataFrame) -> DataFrame:
    """signature and the number of captures that it occurs in; a distinct count, combined before the shuffle."""
    return attack.groupBy("signature").agg(F.countDistinct("src").alias("n_files"))


def prepared(attack: DataFrame) -> DataFrame:
    """attack events with normalised commands, signatures and the rendered body."""
    return with_behaviour(normalised(attack)).withColumn("event", body())


def own_parts(a: DataFrame) -> DataFrame:
    """prepared() events with what they say by themselves: labels of heuristics, words of the capture's name that they hold, an odd
    lineage, and the part of the score that these make."""
    low = F.lower("event")
    a = a.withColumn("labels", rules.heuristic_labels(F.col("event"))).withColumn("named", F.array_sort(F.filter(rules.source_tokens(F.col("src")), lambda t: low.contains(t))))
    n_named = F.size("named")
    a = a.withColumn("lineage", rules.bad_lineage(F.col("ParentImage"), F.col("Image")))
    return a.withColumn("own", F.when(n_named > 0, 2.0 + 0.5 * n_named).otherwise(0.0) + rules.heuristic_score(F.col("labels")) + F.when(F.col("lineage"), 3.0).otherwise(0.0))


def file_band(n: int) -> int:
    """Which captures are told apart: none, one, some, and those from each bound of FILE_BANDS on."""
    return min(n, 2) + sum(n >= bound for bound, _ in FILE_BANDS)


def judged(a: DataFrame, ambient_min: int = AMBIENT_MIN) -> DataFrame:
    """own_parts() rows with their profile (amb, camb, n_files): score, the rule that drops them, and prelabel."""
    files = F.when(F.col("n_files") == 1, ALONE)
    for bound, value in reversed(FILE_BANDS):
        files = F.when(F.col("n_files") >= bound, value).otherwise(files)
    profile = F.when(F.col("amb") >= ambient_min, -6.0).when(F.col("camb") >= COARSE_MIN, -2.5).otherwise(0.0) + F.coalesce(files, F.lit(0.0))
    out = a.withColumns({"score": F.round(profile + F.col("own"), 2), "auto": rules.auto_drop(F.col("EventID"), F.col("TargetFilename"), F.col("Image"), F.col("amb"))})
    prelabel = F.when(F.col("auto").isNotNull(), "drop").when(F.col("score") >= 4.0, "malicious").when(F.col("score") >= 1.0, "review").otherwise("drop")
    return out.withColumn("prelabel", prelabel)


def scored(attack: DataFrame, benign: DataFrame, ambient_min: int = AMBIENT_MIN) -> DataFrame:
    """One row an attack event: ord, src, EventID, signature, event, score, prelabel, why, auto, ambient.

    The three profile joins are on keys that one aggregate makes unique; Spark broadcasts a profile only
    if it is small, and otherwise shuffles both sides by signature. Null signatures cannot occur. The prepared events
    are staged: signatures are made once, for the rows and for the captures they occur in.
    """
    a = staged(prepared(attack), "prepared")
    ambient = profile(benign)  # both counts start from one exchange, which Spark reuses
    fine = ambient.groupBy("signature").agg(F.sum("n").alias("amb"))
    coarse = ambient.groupBy("coarse").agg(F.sum("n").alias("camb"))
    a = a.join(fine, "signature", "left").join(ubiquity(a), "signature").join(coarse, "coarse", "left")
    a = own_parts(a.withColumns({"amb": F.coalesce("amb", F.lit(0)), "camb": F.coalesce("camb", F.lit(0))}))
    ambient, common = F.col("amb") >= ambient_min, F.col("camb") >= COARSE_MIN
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    why = F.array_compact(F.concat(
        F.array(F.when(ambient, text("ambient in real capture (x", F.col("amb"), ")")).when(common, text("common image/parent pair on a real host (x", F.col("camb"), ")"))),
        F.array(F.when(F.col("n_files") >= 8, text("appears in ", F.col("n_files"), " unrelated captures")).when(F.col("n_files") >= 4, text("appears in ", F.col("n_files"), " captures")).when(F.col("n_files") == 1, F.lit("unique to this capture"))),
        F.array(F.when(F.size("named") > 0, text("matches sample name (", F.array_join(F.slice("named", 1, 3), ", "), ")"))),
        F.col("labels"),
        F.array(F.when(F.col("lineage"), text("anomalous lineage ", basename(F.col("ParentImage")), " -> ", basename(F.col("Image"))))),
    ))
    return judged(a, ambient_min).select("ord", "src", "EventID", "signature", "event", "score", why.alias("why"), "auto", "amb", "prelabel")


def top(queue: DataFrame, n: int) -> DataFrame:
    """The n highest scores (ties to the earlier event) with ids T00001, T00002, ...; TakeOrdered, no full sort."""
    first = queue.orderBy(F.desc("score"), "ord").limit(n)
    place = F.row_number().over(Window.orderBy(F.desc("score"), "ord"))
    return first.withColumn("id", F.format_string("T%05d", place))


def groups(queue: DataFrame) -> DataFrame:
    """One row a signature: n, n_src, score with its src and why (earliest of the highest), prelabel and EventID of the
    first, and the rule that dropped its earliest dropped event (null if none did): all in one aggregate."""
    best, first = F.struct("score", -F.col("ord")), F.struct("ord")
    return queue.groupBy("signature").agg(
        F.count("*").alias("n"), F.countDistinct("src").alias("n_src"), F.max("score").alias("score"), F.max_by("src", best).alias("src"), F.max_by("why", best).alias("why"),
        F.min_by("prelabel", first).alias("prelabel"), F.min_by("EventID", first).alias("EventID"), F.min("ord").alias("first_ord"),
        F.min_by("auto", F.when(F.col("auto").isNotNull(), F.col("ord"))).alias("rule"), F.min_by("amb", F.when(F.col("auto").isNotNull(), F.col("ord"))).alias("rule_amb"),
    )


def in_order(groups: DataFrame) -> DataFrame:
    """Groups as they are worked on: highest score first, then the largest, then the earliest."""
    return groups.orderBy(F.desc("score"), F.desc("n"), "first_ord")


def auto_labels(groups: DataFrame) -> DataFrame:
    """Of groups(): signatures that a rule dropped, with the size of the group, the rule and its reason in full."""
    g = groups.where("rule IS NOT NULL")
    return g.select("signature", "n", "rule", rules.drop_reason(F.col("rule"), F.col("rule_amb")).alias("reason"))


def proposals(groups: DataFrame) -> DataFrame:
    """Of groups(): a suggested severity, its rule and the reason for every group that no rule dropped."""
    p = rules.propose(F.col("why"), F.col("score"), F.col("src"))
    made = groups.where("rule IS NULL").select("signature", "n", p.alias("p"))
    return made.select("signature", "n", "p.severity", "p.rule", rules.strength(F.col("p.rule")).alias("strength"), lookup(F.col("p.rule"), rules.REASONS).alias("why"))
