"""Label propagation and correction. Nothing changes its input: each operator returns the rows it would change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import rules
from tracewright.functions.contract import let


def first_by(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """The earliest row of each key. An aggregate with partial combination, so a hot key never meets in one task."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    return best.select(key, *(F.col("_row")[c].alias(c) for c in rest))


def known_bad(labelled: DataFrame, threshold: float = 0.6, executions_only: bool = False) -> DataFrame:
    """Image paths (lower case) whose share of malicious signatures reaches the threshold, program folders excepted.

    labelled has one row a signature: EventID, Image, gold.
    """
    rows = labelled.where("Image IS NOT NULL AND Image <> ''")
    if executions_only:
        rows = rows.where(F.col("EventID").isin("1", "4688"))
    path = F.lower("Image")
    shares = rows.groupBy(path.alias("path")).agg(F.count("*").alias("n"), F.avg((F.col("gold") == "malicious").cast("int")).alias("share"))
    return shares.where((F.col("share") >= threshold) & ~rules.in_program_dir(F.col("path")))


def with_known_bad(labelled: DataFrame, bad: DataFrame, parent: str = "bad_parent", image: str = "bad_image") -> DataFrame:
    """labelled with two flags, by two equi-joins instead of one join with OR."""
    p = bad.select(F.col("path").alias("_p"), F.lit(True).alias(parent))
    i = bad.select(F.col("path").alias("_i"), F.lit(True).alias(image))
    out = labelled.join(p, F.lower("ParentImage") == F.col("_p"), "left").join(i, F.lower("Image") == F.col("_i"), "left").drop("_p", "_i")
    return out.withColumns({parent: F.coalesce(parent, F.lit(False)), image: F.coalesce(image, F.lit(False))})


def lineage_raises(labelled: DataFrame, threshold: float = 0.6, floor: str = "high") -> DataFrame:
    """Signatures scored below the floor whose parent, or whose loader, is known to be bad."""
    flagged = with_known_bad(labelled, known_bad(labelled, threshold))
    below = rules.ranked_severity(F.col("severity")) < rules.RANK[floor]
    hit = F.col("bad_parent") | (F.col("EventID").startswith("7") & F.col("bad_image"))
    raised = F.when(F.col("bad_parent"), F.lower("ParentImage")).otherwise(F.lower("Image"))
    return flagged.where(below & hit).select("signature", "severity", F.lit(floor).alias("new_severity"), raised.alias("because"))


def recalibrations(labelled: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Signatures that one of the severity floors raises to high."""
    flagged = with_known_bad(labelled, known_bad(labelled, threshold, executions_only=True))
    rule = rules.severity_floor(F.col("bad_parent") | ((F.col("EventID") == "7") & F.col("bad_image")), F.col("event"))
    out = flagged.withColumn("rule", rule)
    return out.where(F.col("rule").isNotNull() & (rules.ranked_severity(F.col("severity")) < rules.RANK["high"])).select("signature", "severity", F.lit("high").alias("new_severity"), "rule")


def boundary_changes(rows: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """id, gold, new_gold, reason where the boundary rules change a row (id, EventID, event, gold, action).

    With train, an observation is reconciled: if all training rows of the same action are of lower class, the highest
    of these classes is taken. Training classes meet rows by an aggregate on the action and one join.
    """
    # bound once: where the filter below is moved to where the body is made, it would be made again for every pattern
    verdict = lambda: let(F.col("event"), lambda e: rules.boundary(F.col("id"), F.col("EventID"), e))
    if train is None:
        out = rows.withColumn("_top", F.lit(None).cast("int"))
    else:
        settled = let(verdict(), lambda v: F.when(v["want"] == "malicious", F.lit("malicious")).otherwise(F.col("gold")))
        tops = train.groupBy("action").agg(F.max(rules.class_rank(settled)).alias("_top"))
        out = rows.join(tops, "action", "left")
    now = rules.class_rank(F.col("gold"))

    def changed(v: Column) -> Column:
        reconciled = F.when(F.col("_top") < now, F.get(F.array(*map(F.lit, rules.CLASS_RANK)), F.col("_top")))
        ruled = F.when((now < rules.class_rank(v["want"])) | ((v["want"] == "benign") & (now > 0)), v["want"])
        observed = v["want"] == "observe"
        new = F.when(observed, reconciled).otherwise(ruled)
        reason = F.when(observed, F.concat(F.lit("reconcile: training is unanimously "), reconciled)).otherwise(v["reason"])
        return F.when(new.isNotNull(), F.struct(new.alias("new_gold"), reason.alias("reason")))

    return out.select("id", "gold", let(verdict(), changed).alias("_c")).where("_c IS NOT NULL").select("id", "gold", "_c.new_gold", "_c.reason")


def applied(rows: DataFrame, changes: DataFrame, key: str, **values: str) -> DataFrame:
    """rows with changes taken over: values names, for a column of rows, the column of changes (a row a key) that holds
    its new value. A guarded rewrite: without it the changes alone show what would be done. `changed` marks the rows."""
    new = changes.select(key, *(F.col(c).alias(f"_new_{name}") for name, c in values.items()), F.lit(True).alias("_hit"))
    out = rows.join(new, key, "left").withColumn("changed", F.coalesce("_hit", F.lit(False)))
    return out.withColumns({name: F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)) for name in values}).drop("_hit", *(f"_new_{name}" for name in values))


def with_defaults(decisions: DataFrame, defaults: DataFrame) -> DataFrame:
    """Decisions by signature; where there is none, the default. One full outer join on unique keys."""
    d = defaults.select("signature", *(F.col(c).alias(f"_{c}") for c in defaults.columns if c != "signature"))
    out = decisions.withColumn("_own", F.lit(True)).join(d, "signature", "full_outer")
    return out.select("signature", *(F.when(F.col("_own"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in decisions.columns if c != "signature"))


def latest_decisions(log: DataFrame) -> DataFrame:
    """State of an append-only decision log (signature, seq, action, severity): the newest entry that is not undone.

    An undo entry names the seq it takes back.
    """
    undone = log.where("action = 'undo'").select(F.col("undoes").alias("seq")).distinct()
    live = log.where("action = 'label'").join(undone, "seq", "left_anti")
    return live.groupBy("signature").agg(F.max("seq").alias("seq"), F.max_by("severity", "seq").alias("severity"))


def decision_tokens(lines: DataFrame) -> DataFrame:
    """gid, severity, ok of each `Gxxxx=severity` token of text lines (ord, text); # begins a comment. Bad ones stay, ok false.

    Words without = are no tokens.
    """
    words = lines.select("ord", F.explode(F.filter(F.split(F.element_at(F.split("text", "#"), 1), r"\s+"), lambda t: t.contains("="))).alias("token"))
    severity = F.lower(F.substring_index("token", "=", -1))
    ok = F.col("token").rlike(r"^[Gg]\d+=\w+$") & severity.isin(*rules.RANK)
    return words.select("ord", "token", F.upper(F.substring_index("token", "=", 1)).alias("gid"), severity.alias("severity"), ok.alias("ok"))

