"""Classification, agreement and gate metrics; every one a single aggregate with conditional sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import rules
from tracewright.functions.contract import let

SEVERITIES = ("none", "low", "medium", "high")
CLASSES = ("benign", "suspicious", "malicious")
#: Metric, bound, direction.
GATES = (("accuracy", 0.80, "ge"), ("under_call", 0.10, "le"), ("missed_threat", 0.05, "le"), ("over_call", 0.20, "le"), ("malicious_recall", 0.90, "ge"))


def _share(condition: Column, among: Column) -> Column:
    """Share of the rows of `among` where condition holds; NaN if there are none."""
    return F.coalesce(F.avg(F.when(among, condition.cast("int"))), F.lit(float("nan")))


def class_metrics(predictions: DataFrame, by: list[str] | None = None, rollup: bool = False) -> DataFrame:
    """Metrics of (gold, pred, margin), over all rows or by columns; rows with an unknown gold class are left out."""
    p = predictions.where(F.col("gold").isin(*CLASSES))
    right, gold, pred, every = F.col("gold") == F.col("pred"), rules.class_rank(F.col("gold")), rules.class_rank(F.col("pred")), F.lit(True)
    is_gold = lambda c: F.col("gold") == c
    margin = lambda c: F.coalesce(F.avg(F.when(c, F.col("margin"))), F.lit(float("nan")))
    grouped = p.rollup(*by) if rollup else p.groupBy(*(by or []))
    return grouped.agg(
        F.count("*").alias("n"), _share(right, every).alias("accuracy"), _share(pred < gold, every).alias("under_call"), _share(pred > gold, every).alias("over_call"),
        _share(right, is_gold("malicious")).alias("malicious_recall"), _share(right, is_gold("suspicious")).alias("suspicious_recall"),
        _share(F.col("pred") == "benign", is_gold("malicious")).alias("missed_threat"), _share(right, F.col("pred") == "benign").alias("benign_precision"),
        margin(right).alias("margin_correct"), margin(~right).alias("margin_wrong"),
    )


def gates(metrics: DataFrame) -> DataFrame:
    """metric, value, target, met for the metrics that have a target."""
    long = metrics.unpivot([], [m for m, _, _ in GATES], "metric", "value")
    target = reduce(lambda out, g: out.when(F.col("metric") == g[0], F.lit(g[1])), GATES[1:], F.when(F.col("metric") == GATES[0][0], F.lit(GATES[0][1])))
    at_least = F.col("metric").isin(*(m for m, _, d in GATES if d == "ge"))
    return long.select("metric", "value", target.alias("target"), F.when(at_least, F.col("value") >= target).otherwise(F.col("value") <= target).alias("met"))


def softmax_margin(scores: DataFrame) -> DataFrame:
    """Predictions from log-likelihood columns ll_none .. ll_high: severity, class (pred), its probabilities, margin.

    The predicted class sums the probabilities of its severities, so it can differ from the class of the top severity.
    """
    log = {s: F.col(f"ll_{s}") for s in SEVERITIES}
    # each step is bound once: a filter on the result, moved below it, would else repeat every exponential in every place that uses it
    raw = let(F.greatest(*log.values()), lambda top: F.struct(*(F.exp(c - top).alias(s) for s, c in log.items())))
    shares = let(raw, lambda e: let(reduce(lambda a, b: a + b, [e[s] for s in SEVERITIES]), lambda total: F.struct(*((e[s] / total).alias(f"p_{s}") for s in SEVERITIES))))
    classes = lambda p: [reduce(lambda a, b: a + b, [p[f"p_{s}"] for s in SEVERITIES if rules.BUCKET[s] == c]).alias(f"p_{c}") for c in CLASSES]
    both = let(shares, lambda p: F.struct(*(p[f"p_{s}"].alias(f"p_{s}") for s in SEVERITIES), *classes(p)))
    best = lambda p, names: F.array_max(F.array(*(F.struct(p[f"p_{n}"].alias("p"), F.lit(-i).alias("i"), F.lit(n).alias("name")) for i, n in enumerate(names))))["name"]
    ordered = lambda p: F.sort_array(F.array(*(p[f"p_{c}"] for c in CLASSES)), asc=False)
    margin = lambda p: let(ordered(p), lambda x: F.get(x, F.lit(0)) - F.get(x, F.lit(1)))
    names = [f"p_{n}" for n in (*SEVERITIES, *CLASSES)]
    made = let(both, lambda p: F.struct(*(p[n].alias(n) for n in names), best(p, SEVERITIES).alias("severity"), best(p, CLASSES).alias("pred"), margin(p).alias("margin")))
    return scores.withColumn("_made", made).select(*scores.columns, *(F.col("_made")[n].alias(n) for n in (*names, "severity", "pred", "margin")))


def paired(human: DataFrame, machine: DataFrame) -> DataFrame:
    """signature, human, auto, rule of signatures that both have decided (signature, severity; a rule of the machine's)."""
    rule = F.col("rule") if "rule" in machine.columns else F.lit(None).cast("string").alias("rule")
    m = machine.select("signature", F.col("severity").alias("auto"), rule)
    return human.select("signature", F.col("severity").alias("human")).join(m, "signature")


def disagreements(pairs: DataFrame) -> DataFrame:
    """Pairs with different severities (null: drop), and on which side the machine is: under the human one or over it."""
    h, a = (F.coalesce(F.col(c), F.lit("drop")) for c in ("human", "auto"))
    side = F.when(rules.ranked_severity(a) < rules.ranked_severity(h), "under").otherwise("over")
    return pairs.where(h != a).select("signature", h.alias("human"), a.alias("auto"), "rule", side.alias("side"))


def histograms(decisions: DataFrame, columns: list[str]) -> DataFrame:
    """of, value, groups, events: how many decisions (with n events each) have each value of each column, in one aggregate."""
    counted = decisions.select("n", F.explode(F.array(*(F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x"))
    return counted.groupBy("x.of", "x.value").agg(F.count("*").alias("groups"), F.sum("n").alias("events"))


def agreement(pairs: DataFrame) -> DataFrame:
    """n, exact, same_class, under, over of severities (human, auto) by joined signature."""
    h, a = rules.ranked_severity(F.col("human")), rules.ranked_severity(F.col("auto"))
    n = lambda c: F.sum(c.cast("long"))
    same = F.coalesce(F.col("human"), F.lit("drop")) == F.coalesce(F.col("auto"), F.lit("drop"))
    return pairs.agg(F.count("*").alias("n"), n(same).alias("exact"), n(rules.bucket(F.col("human")) == rules.bucket(F.col("auto"))).alias("same_class"), n(a < h).alias("under"), n(a > h).alias("over"))


def confusion(rows: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """A row for each value of `row`, a count column for each of `values`."""
    out = rows.groupBy(row).agg(*(F.sum((F.col(column) == v).cast("long")).alias(v) for v in values))
    return out


def misses(predictions: DataFrame, k: int) -> DataFrame:
    """The k worst misses (a top-k report): furthest below the gold class first, then by margin."""
    gap = rules.class_rank(F.col("pred")) - rules.class_rank(F.col("gold"))
    return predictions.where(F.col("pred") != F.col("gold")).withColumn("gap", gap).orderBy("gap", F.desc("margin"), "id").limit(k).select("id", "gold", "pred", "gap", "margin")


def flips(before: DataFrame, after: DataFrame) -> DataFrame:
    """id, gold, before, after, mark of predictions (id, gold, pred) that changed."""
    j = before.select("id", "gold", F.col("pred").alias("before")).join(after.select("id", F.col("pred").alias("after")), "id")
    mark = F.when(F.col("after") == F.col("gold"), "better").when(F.col("before") == F.col("gold"), "worse").otherwise("same")
    return j.where(F.col("before") != F.col("after")).withColumn("mark", mark)


def quantised(answers: DataFrame, current: DataFrame, full: DataFrame) -> DataFrame:
    """Answers (id, severity) of a smaller model beside the evaluation set (id, gold) and the full model (id, pred).

    id, gold, pred (null where the answer could not be read), before, mark: better, worse or same where the two models
    disagree. Answers without a row of the evaluation set are left out, a missing full prediction is no disagreement.
    """
    pred = F.when(F.col("severity") != "PARSE-FAIL", rules.bucket(F.col("severity")))
    out = answers.select("id", pred.alias("pred")).join(current.select("id", "gold"), "id").join(full.select("id", F.col("pred").alias("before")), "id", "left")
    mark = F.when(F.col("pred") == F.col("gold"), "better").when(F.col("before") == F.col("gold"), "worse").otherwise("same")
    return out.select("id", "gold", "pred", "before", F.when(F.col("pred") != F.col("before"), mark).alias("mark"))


def quantised_summary(rows: DataFrame) -> DataFrame:
    """n read, parse failures, accuracy, threats dismissed, malicious recall, under-call rate and flips of quantised()."""
    read = F.col("pred").isNotNull()
    share = lambda c, among: _share(c, read & among)
    gold, pred, threat = rules.class_rank(F.col("gold")), rules.class_rank(F.col("pred")), F.col("gold") == "malicious"
    return rows.agg(
        F.sum(read.cast("long")).alias("n"), F.sum((~read).cast("long")).alias("parse_fail"), share(F.col("pred") == F.col("gold"), F.lit(True)).alias("accuracy"),
        share(F.col("pred") == "benign", threat).alias("dismissed"), share(F.col("pred") == "malicious", threat).alias("malicious_recall"), share(pred < gold, F.lit(True)).alias("under_call"), F.count("mark").alias("flips"),
    )


def by_number(runs: DataFrame, column: str, final: str | None = None) -> DataFrame:
    """Checkpoints in the order of the number that ends their name, the final one (by name) last."""
    number = F.regexp_extract(column, r"-([0-9]+)$", 1).try_cast("long")
    return runs.orderBy(F.col(column).eqNullSafe(F.lit(final)), F.asc_nulls_last(number), column)


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the highest accuracy, then the lowest under-call rate, of (run, accuracy, under_call)."""
    return runs.agg(F.max_by("run", F.struct("accuracy", -F.col("under_call"))).alias("run"))


#: Ranges that a pass counts for each place that is looked for.
RANGES = 1_024


def values_at(rows: DataFrame, column: str, places: list[int], ranges: int = RANGES) -> list:
    """The values at these places (from 0) of the ascending order of a numeric column; nulls and NaN have no place.

    A pass divides the range that a place is known to lie in into equal parts and counts the values of each, with
    their least and largest; the next pass looks into one part only. It ends when a part holds one value. Each pass is one
    aggregate, combined before the shuffle, whose few rows come to the driver; no rows are sorted. Beyond the last
    place: None.
    """
    v = F.col(column)
    known = rows.where(v.isNotNull() & ~F.isnan(v.cast("double"))).select(v.alias("v"))
    low, high, n = known.agg(F.min("v"), F.max("v"), F.count("*")).first()
    found: dict[int, object] = {k: None for k in places}
    open_: dict[tuple, list[int]] = {(low, high, 0): sorted({k for k in places if 0 <= k < n})} if n else {}
    while open_:
        for part in [p for p in open_ if p[0] == p[1]]:
            found |= dict.fromkeys(open_.pop(part), part[0])
        if not open_:
            break
        parts = list(open_)

        def place(i: int, lo, hi) -> Column:
            inside = F.col("v").between(F.lit(lo), F.lit(hi))
            width = float(hi) - float(lo)
            if width == float("inf"):  # too far apart for a double: the ends by themselves, and by sign
                at = F.when(F.col("v") == F.lit(lo), 0).when(F.col("v") == F.lit(hi), 3).otherwise(F.when(F.col("v") > 0, 2).otherwise(1))
            elif width > 0:
                at = F.least(F.floor((F.col("v").cast("double") - float(lo)) / width * ranges), F.lit(ranges - 1)).cast("int")
            else:  # too close for doubles
                at = (F.col("v") - F.lit(lo)).cast("int") if isinstance(lo, int) else (F.col("v") != F.lit(lo)).cast("int")
            return F.when(inside, F.struct(F.lit(i).alias("part"), at.alias("at")))

        each = known.select("v", F.explode(F.array_compact(F.array(*(place(i, lo, hi) for i, (lo, hi, _) in enumerate(parts))))).alias("p"))
        counted = each.groupBy("p").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("p").collect()
        after: dict[tuple, list[int]] = {}
        for i, (_, _, before) in enumerate(parts):
            for r in (r for r in counted if r["p"]["part"] == i):
                inside = [k for k in open_[parts[i]] if before <= k < before + r["n"]]
                if inside:
                    after[r["lo"], r["hi"], before] = inside
                before += r["n"]
        open_ = after
    return [found[k] for k in places]


def length_percentiles(rows: DataFrame, column: str) -> DataFrame:
    """n, p50, p95, longest: values at the places n // 2 and int(n * 0.95) of the ascending order, without interpolation.

    Nulls do not count. No rows: n is 0 and the values are null.
    """
    n = rows.agg(F.count(column)).first()[0]
    p50, p95, longest = values_at(rows, column, [n // 2, int(n * 0.95), n - 1])
    kind = rows.schema[column].dataType.simpleString()
    return rows.sparkSession.createDataFrame([(n, p50, p95, longest)], f"n long, p50 {kind}, p95 {kind}, longest {kind}")


def refreshed(results: DataFrame, current: DataFrame) -> DataFrame:
    """results with gold and subset as they are now, by id; rows that no longer exist keep theirs."""
    c = current.select("id", F.col("gold").alias("_gold"), F.col("subset").alias("_subset"))
    return results.join(c, "id", "left").withColumns({"gold": F.coalesce("_gold", "gold"), "subset": F.coalesce("_subset", "subset")}).drop("_gold", "_subset")


def weighted_loss(tokens: DataFrame) -> DataFrame:
    """Weighted mean of per-token losses (ce, w)."""
    return tokens.agg((F.sum(F.col("ce") * F.col("w")) / F.sum("w")).alias("loss"))
