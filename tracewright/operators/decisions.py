"""Work lists and decisions: what is left to decide, bulk decisions, tokens, verification, routing."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import contract, prompts, rules, targets
from tracewright.functions.contract import lookup

# Fixed values of the routing contract.
ESCALATED_SEVERITIES = ("high", "critical")
ESCALATED_THREATS = ("lateral_movement", "data_exfiltration", "ransomware", "privilege_escalation", "supply_chain", "rce", "zero_day")
CONFIDENCE = {"none": 0.05, "low": 0.2, "medium": 0.5, "high": 0.85, "critical": 0.95}


#: What a blind reader must not see.
JUDGED = ("score", "why", "prelabel", "rule", "rule_amb")


def worklist(groups: DataFrame, decided: DataFrame, min_score: float | None = None, prelabel: str | None = None, blind: bool = False) -> DataFrame:
    """groups that are not decided, from a score on, of one prelabel; blind: without anything that a rule said of them.

    For a blind pass `decided` holds human decisions only, so that groups that a rule decided are read as well.
    """
    out = groups.join(decided.select("signature"), "signature", "left_anti")
    out = out if min_score is None else out.where(F.col("score") >= min_score)
    out = out if prelabel is None else out.where(F.col("prelabel") == prelabel)
    return out.drop(*JUDGED) if blind else out


def decision(severity: Column, by: str) -> list[Column]:
    return [severity.alias("severity"), rules.bucket(severity).alias("gold"), F.lit(by).alias("decided_by")]


def accepted(work: DataFrame, proposals: DataFrame, rule: str) -> DataFrame:
    """Decisions that take over the proposals of one rule for all open groups."""
    p = proposals.where(F.col("rule") == rule).select("signature", "severity", "rule")
    return work.select("signature", "n").join(p, "signature").select("signature", *decision(F.col("severity"), "accepted in bulk"), "rule", "n")


def tail_dropped(work: DataFrame, score: float) -> DataFrame:
    """Decisions that drop all open groups up to a score."""
    return work.where(F.col("score") <= score).select("signature", *decision(F.lit(None).cast("string"), "bulk tail drop"), F.lit(f"below score {score} at bulk drop").alias("rule"), "n")


def applied_tokens(tokens: DataFrame, index: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions of valid tokens (ord, gid, severity, ok), the last of a group counts, and the tokens that are not valid.

    index: gid, signature; counts: signature, n.
    """
    known = tokens.join(index, "gid", "left").withColumn("valid", F.col("ok") & F.col("signature").isNotNull())
    last = known.where("valid").groupBy("signature").agg(F.max_by("severity", "ord").alias("s"), F.max_by("gid", "ord").alias("gid"))
    severity = F.when(F.col("s") != "drop", F.col("s"))
    made = last.join(counts, "signature", "left").select("signature", *decision(severity, "model"), "gid", F.coalesce("n", F.lit(0)).alias("n"))
    return made, known.where("NOT valid").select("ord", "token")


def verified(rows: DataFrame, human: DataFrame, rule: str = "max") -> DataFrame:
    """rows (id, severity, gold) with the higher of their and the human severity, or the human one."""
    j = rows.join(human.select("id", F.col("severity").alias("_h")), "id", "left")
    higher = rules.ranked_severity(F.col("_h")) > rules.ranked_severity(F.col("severity"))
    new = F.when(F.col("_h").isNull(), F.col("severity")).when(F.lit(rule == "human") | higher, F.col("_h")).otherwise(F.col("severity"))
    out = j.withColumn("_new", new).withColumn("changed", ~F.col("_new").eqNullSafe(F.col("severity")))
    return out.withColumns({"gold": F.when(F.col("_h").isNull(), F.col("gold")).otherwise(rules.bucket(F.col("_new"))), "severity": F.col("_new")}).drop("_h", "_new")


def complete(rows: DataFrame, human: DataFrame) -> bool:
    """Whether every row was verified."""
    return not rows.join(human, "id", "left_anti").head(1)


def routed(rows: DataFrame) -> DataFrame:
    """rows (severity, threat_type) with escalate and confidence."""
    escalate = F.col("severity").isin(*ESCALATED_SEVERITIES) | F.coalesce(F.col("threat_type").isin(*ESCALATED_THREATS), F.lit(False))
    return rows.withColumns({"escalate": escalate, "confidence": lookup(F.col("severity"), CONFIDENCE)})


def expanded(labels: DataFrame, queue: DataFrame, held: DataFrame) -> DataFrame:
    """Events of labelled groups, without dropped groups and those that are held out."""
    kept = labels.where("gold <> 'drop'").join(held.select("signature").distinct(), "signature", "left_anti")
    return queue.join(kept.select("signature", "severity", "gold"), "signature")


def contract_document(scale: str = "4way", template: str = prompts.SYSTEM) -> dict:
    """What a host must know to use a model that was trained on these targets: configuration, not data."""
    return {
        "input": {"field_order": list(contract.FIELDS), "max_cmdline": contract.MAX_COMMAND, "truncation_marker": contract.TRUNCATED, "user_message_template": "Event:\n{body}\n\nClassify."},
        "severity": {"scale": list(prompts.SCALES[scale]), "accepted_on_input": list(prompts.SCALES["5way"]), "bucket": {k: v for k, v in rules.BUCKET.items() if k != "drop"}, "classes": list(rules.CLASS_RANK), "score_prefix": prompts.PREFIX},
        "routing": {"escalate_severities": list(ESCALATED_SEVERITIES), "escalate_threat_types": list(ESCALATED_THREATS), "confidence_reported_by_model": False, "confidence_from_severity": CONFIDENCE},
        "indicators": sorted(targets.PHRASES),
        "output_fields": ["severity", "isThreat", "threatType", "indicators", "reasoning"],
        "prompt_sha256": hashlib.sha256(prompts.system_prompt(scale, template).encode()).hexdigest(),
    }
