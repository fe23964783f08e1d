"""Queries of the engine's own operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions import contract, prompts, rewriting, rules, signatures, targets
from tracewright.operators import audit, decisions, generate, labels, metrics, queue, sampling
from tracewright.plans import bridge, stateful  # noqa: F401 (its queries are registered)
from tracewright.plans import oracles as o
from tracewright.plans.registry import ORACLE_SQL, QUERIES, query
from tracewright.sources.readers import parse_events
from tracewright.sources.writers import staged, upserted
from tracewright.streaming import ingest

def _attack(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.telemetry(spark, sf).where("attack")


def _queue(spark: SparkSession, sf: str) -> DataFrame:
    t = bridge.telemetry(spark, sf)
    return queue.scored(t.where("attack"), t.where("NOT attack"))


def _signed(spark: SparkSession, sf: str) -> DataFrame:
    return queue.prepared(bridge.telemetry(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    first = labels.first_by(_signed(spark, sf).where("attack"), "signature")
    return staged(first.withColumns({"severity": F.expr(o.SEVERITY_OF), "gold": F.expr(o.GOLD_OF)}), "labelled")


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of the queue, a row a signature, staged: work lists read them more than once."""
    return staged(queue.groups(_queue(spark, sf)), "groups")


def _gold_events(spark: SparkSession, sf: str) -> DataFrame:
    return _signed(spark, sf).withColumns({"gold": F.expr(o.GOLD_OF), "severity": F.expr(o.SEVERITY_OF)})


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.softmax_margin(bridge.scores(spark, sf))


# ---- contract and scalar functions

_RENDER = o.BODY.replace("EventType IS NOT NULL", f"{o.EVENT_TYPE} IS NOT NULL").replace("|| EventType", f"|| {o.EVENT_TYPE}")


@query(f"{o.SIGNED_EVENTS}, pol AS (SELECT * REPLACE (CASE WHEN EventID IN ('1', '7', '4688') THEN {o.SIGNED} END AS Signed, CASE WHEN EventID IN ('1', '7', '4688') THEN {o.SIGNER} END AS Signer) FROM norm) SELECT ord, {_RENDER} AS event FROM pol")
def contract_render(spark: SparkSession, sf: str) -> DataFrame:
    return contract.rendered(bridge.telemetry(spark, sf)).select("ord", "event")


@query(f"{o.SIGNED_EVENTS} SELECT ord, {_RENDER} AS event FROM norm")
def contract_render_strip(spark: SparkSession, sf: str) -> DataFrame:
    return contract.rendered(bridge.telemetry(spark, sf), "strip").select("ord", "event")


_DEFECTS = "CASE ord % 6 WHEN 0 THEN event WHEN 1 THEN event || chr(10) || 'stray words' WHEN 2 THEN 'Extra: 1' || chr(10) || event WHEN 3 THEN event || chr(10) || 'EventID: 1' WHEN 4 THEN 'User:  ' || chr(10) || event ELSE '' END"


@query(f"""{o.SIGNED_EVENTS}, bodies AS (SELECT ord, {_DEFECTS} AS event FROM sig), lines AS (SELECT ord, CASE WHEN event = '' THEN [] ELSE string_split(event, chr(10)) END AS ls FROM bodies),
 keyed AS (SELECT ord, ls, list_transform(list_filter(ls, lambda x: contains(x, ':')), lambda x: trim(split_part(x, ':', 1))) AS ks FROM lines),
 placed AS (SELECT *, list_filter(list_transform(ks, lambda k: list_position([{', '.join(map(bridge.quoted, contract.FIELDS))}], k)), lambda p: p > 0) AS ps FROM keyed)
 SELECT ord, array_to_string(list_concat(flatten(list_transform(ls, lambda x: CASE WHEN NOT contains(x, ':') THEN ['no colon: ' || x] ELSE list_concat(
 CASE WHEN trim(split_part(x, ':', 1)) NOT IN {o.in_list(contract.FIELDS)} THEN ['off-contract field: ' || trim(split_part(x, ':', 1))] ELSE [] END,
 CASE WHEN trim(regexp_replace(x, '^[^:]*:', '')) = '' THEN ['empty value: ' || trim(split_part(x, ':', 1))] ELSE [] END) END)),
 CASE WHEN ps <> list_sort(ps) THEN ['field order violated'] ELSE [] END, CASE WHEN len(list_distinct(ks)) <> len(ks) THEN ['duplicate fields'] ELSE [] END), '; ') AS violations FROM placed""")
def contract_validate(spark: SparkSession, sf: str) -> DataFrame:
    bodies = _signed(spark, sf).select("ord", F.expr(_DEFECTS).alias("event"))
    return bodies.select("ord", F.array_join(contract.violations(F.col("event")), "; ").alias("violations"))


@query(f"{o.TELEMETRY} SELECT Image, {o.SIGNED} AS signed, {o.SIGNER} AS signer, count(*) AS n FROM telemetry GROUP BY ALL")
def authenticode(spark: SparkSession, sf: str) -> DataFrame:
    a = contract.authenticode(F.col("Image"))
    return bridge.telemetry(spark, sf).groupBy("Image", a["signed"].alias("signed"), a["signer"].alias("signer")).agg(F.count("*").alias("n"))


@query(f"{o.TELEMETRY} SELECT ord, {o.normalise('CommandLine')} AS command, {o.normalise('TargetFilename')} AS target FROM telemetry")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.telemetry(spark, sf).select("ord", signatures.normalise(F.col("CommandLine")).alias("command"), signatures.normalise(F.col("TargetFilename")).alias("target"))


@query(f"{o.TELEMETRY} SELECT {o.basename('Image')} AS base, {o.dirname('Image')} AS dir, count(*) AS n FROM telemetry GROUP BY ALL")
def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.telemetry(spark, sf).groupBy(signatures.basename(F.col("Image")).alias("base"), signatures.dirname(F.col("Image")).alias("dir")).agg(F.count("*").alias("n"))


@query(f"{o.TELEMETRY} SELECT {o.port_bucket('DestinationPort')} AS bucket, count(*) AS n FROM telemetry GROUP BY ALL")
def port_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.telemetry(spark, sf).groupBy(signatures.port_bucket(F.col("DestinationPort")).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"{o.TELEMETRY} SELECT {o.cmd_shape('CommandLine', 'Image')} AS shape, count(*) AS n FROM telemetry GROUP BY ALL")
def cmd_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.telemetry(spark, sf).groupBy(signatures.cmd_shape(F.col("CommandLine"), F.col("Image")).alias("shape")).agg(F.count("*").alias("n"))


# ---- profiles and the review queue


def _counts(name: str) -> None:
    @query(f"{o.SIGNED_EVENTS} SELECT {name}, count(*) AS n FROM sig GROUP BY ALL")
    def counts(spark: SparkSession, sf: str) -> DataFrame:
        return _signed(spark, sf).groupBy(name).agg(F.count("*").alias("n"))

    for registry in (QUERIES, ORACLE_SQL):
        registry[f"{name}_counts"] = registry.pop("counts")


for _name in ("signature", "coarse", "action"):
    _counts(_name)


@query(f"{o.QUEUE} SELECT signature, n_files FROM files")
def ubiquity(spark: SparkSession, sf: str) -> DataFrame:
    return queue.ubiquity(_signed(spark, sf).where("attack"))


@query(f"{o.QUEUE} SELECT ord, src, EventID, signature, score, prelabel, array_to_string(why, '; ') AS why, auto FROM queue")
def queue_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _queue(spark, sf).select("ord", "src", "EventID", "signature", "score", "prelabel", F.array_join("why", "; ").alias("why"), "auto")


@query(f"{o.QUEUE} SELECT printf('T%05d', row_number() OVER (ORDER BY score DESC, ord)) AS id, ord, score FROM queue ORDER BY score DESC, ord LIMIT 100")
def queue_top(spark: SparkSession, sf: str) -> DataFrame:
    return queue.top(_queue(spark, sf), 100).select("id", "ord", "score")


@query(f"{o.QUEUE} SELECT prelabel, EventID, count(*) AS n FROM queue GROUP BY ALL")
def prelabel_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _queue(spark, sf).groupBy("prelabel", "EventID").agg(F.count("*").alias("n"))


@query(f"{o.GROUPS} SELECT signature, n, n_src, score, src, array_to_string(why, '; ') AS why, prelabel, EventID FROM grouped")
def triage_groups(spark: SparkSession, sf: str) -> DataFrame:
    return queue.groups(_queue(spark, sf)).select("signature", "n", "n_src", "score", "src", F.array_join("why", "; ").alias("why"), "prelabel", "EventID")


@query(f"""{o.GROUPS} SELECT signature, rule, n, CASE rule WHEN 'ambient' THEN 'signature occurs ' || amb || 'x in the real benign capture' ELSE 'system module loaded by a system-path binary -- image loads carry signal only for sideloading' END AS reason
 FROM autos JOIN groups USING (signature)""")
def auto_labels(spark: SparkSession, sf: str) -> DataFrame:
    return queue.auto_labels(queue.groups(_queue(spark, sf))).select("signature", "rule", "n", "reason")


@query(f"""{o.GROUPS}, p AS (SELECT signature, n, {o.PROPOSED_SEVERITY} AS severity, {o.PROPOSED_RULE} AS rule FROM grouped WHERE signature NOT IN (SELECT signature FROM autos))
 SELECT *, CASE WHEN rule = 'unclassified' THEN 'none' WHEN starts_with(rule, 'tactic:') THEN 'weak' ELSE 'strong' END AS strength, {o.case_of('rule', rules.REASONS)} AS why FROM p""")
def proposals(spark: SparkSession, sf: str) -> DataFrame:
    return queue.proposals(queue.groups(_queue(spark, sf))).select("signature", "n", "severity", "rule", "strength", "why")


@query(f"{o.GROUPS} SELECT row_number() OVER (ORDER BY score DESC, n DESC, first_ord) AS place, signature, score, n FROM grouped ORDER BY score DESC, n DESC, first_ord LIMIT 40")
def group_order(spark: SparkSession, sf: str) -> DataFrame:
    first = queue.in_order(queue.groups(_queue(spark, sf))).limit(40)
    return first.select(F.row_number().over(Window.orderBy(F.desc("score"), F.desc("n"), "first_ord")).alias("place"), "signature", "score", "n")


# ---- labels


@query(f"{o.KNOWN_BAD} SELECT path, n, share FROM bad")
def known_bad_paths(spark: SparkSession, sf: str) -> DataFrame:
    return labels.known_bad(_labelled(spark, sf), 0.3).select("path", "n", "share")


@query(f"""{o.KNOWN_BAD} SELECT signature, severity, 'high' AS new_severity, CASE WHEN lower(ParentImage) IN (SELECT path FROM bad) THEN lower(ParentImage) ELSE lower(Image) END AS because FROM labelled
 WHERE {o.RANK.format('severity')} < 3 AND (coalesce(lower(ParentImage) IN (SELECT path FROM bad), false) OR (starts_with(EventID, '7') AND coalesce(lower(Image) IN (SELECT path FROM bad), false)))""")
def lineage_raise(spark: SparkSession, sf: str) -> DataFrame:
    return labels.lineage_raises(_labelled(spark, sf), 0.3)


@query(f"""{o.KNOWN_BAD_RUN}, flagged AS (SELECT *, coalesce(lower(ParentImage) IN (SELECT path FROM bad), false) OR (EventID = '7' AND coalesce(lower(Image) IN (SELECT path FROM bad), false)) AS bad FROM labelled),
 ruled AS (SELECT *, {o.FLOOR} AS rule FROM flagged) SELECT signature, severity, 'high' AS new_severity, rule FROM ruled WHERE rule IS NOT NULL AND {o.RANK.format('severity')} < 3""")
def recalibrate_floor(spark: SparkSession, sf: str) -> DataFrame:
    return labels.recalibrations(_labelled(spark, sf), 0.3)


_ROWS = "SELECT CASE WHEN ord % 50 = 0 THEN 'B010' ELSE 'T' || ord END AS id, EventID, event, CASE WHEN gold = 'drop' THEN 'benign' ELSE gold END AS gold, action, attack FROM"
_CHANGED = f"(rank_gold < {o.CLASS_RANK.format('want')} OR (want = 'benign' AND rank_gold > 0))"
_VERDICTS = f"""{o.SIGNED_EVENTS}, base AS ({_ROWS} (SELECT *, {o.GOLD_OF} AS gold FROM sig)), verdicts AS (SELECT *, {o.WANT} AS want, {o.REASON} AS reason, {o.CLASS_RANK.format('gold')} AS rank_gold FROM base)"""


def _boundary_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(f"{_ROWS} {{rows}}", rows=_gold_events(spark, sf))


@query(f"{_VERDICTS} SELECT id, gold, want AS new_gold, reason FROM verdicts WHERE want <> 'observe' AND {_CHANGED}")
def boundary_classify(spark: SparkSession, sf: str) -> DataFrame:
    return labels.boundary_changes(_boundary_rows(spark, sf))


@query(f"""{_VERDICTS}, tops AS (SELECT action, max(CASE WHEN want = 'malicious' THEN 2 ELSE rank_gold END) AS top FROM verdicts WHERE NOT attack GROUP BY 1),
 news AS (SELECT id, gold, CASE WHEN want = 'observe' THEN CASE WHEN top < rank_gold THEN (['benign', 'suspicious', 'malicious'])[top + 1] END WHEN {_CHANGED} THEN want END AS new_gold, want, reason FROM verdicts LEFT JOIN tops USING (action) WHERE attack)
 SELECT id, gold, new_gold, CASE WHEN want = 'observe' THEN 'reconcile: training is unanimously ' || new_gold ELSE reason END AS reason FROM news WHERE new_gold IS NOT NULL""")
def boundary_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boundary_rows(spark, sf)
    return labels.boundary_changes(rows.where("attack"), rows.where("NOT attack"))


_LINES = "SELECT conv_id * 1000 + turn AS ord, 'G' || (conv_id % 90) || '=' || CASE turn % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'NONE' WHEN 2 THEN 'bogus' ELSE 'low' END || ' x' || conv_id || ' # ' || role AS text FROM"


@query(f"""WITH lines AS ({_LINES} conversations), words AS (SELECT ord, unnest(list_filter(string_split_regex(split_part(text, '#', 1), '\\s+'), lambda t: contains(t, '='))) AS token FROM lines)
 SELECT ord, token, upper(split_part(token, '=', 1)) AS gid, lower(regexp_extract(token, '[^=]*$')) AS severity, regexp_matches(token, '^[Gg]\\d+=\\w+$') AND lower(regexp_extract(token, '[^=]*$')) IN {o.in_list(rules.RANK)} AS ok FROM words""")
def decision_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return labels.decision_tokens(spark.sql(f"{_LINES} {{c}}", c=bridge.table(spark, sf, "conversations")))


_LOG = "SELECT event_id AS seq, 'S' || (user_id % 500) AS signature, CASE WHEN event_id % 7 = 6 THEN 'undo' ELSE 'label' END AS action, CASE event_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'high' ELSE 'low' END AS severity, event_id - 1 AS undoes FROM"


@query(f"WITH log AS ({_LOG} events) SELECT signature, max(seq) AS seq, arg_max(severity, seq) AS severity FROM log WHERE action = 'label' AND seq NOT IN (SELECT undoes FROM log WHERE action = 'undo') GROUP BY 1")
def decision_latest(spark: SparkSession, sf: str) -> DataFrame:
    return labels.latest_decisions(spark.sql(f"{_LOG} {{e}}", e=bridge.table(spark, sf, "events")))


_TOKENS = f"""WITH lines AS ({_LINES} conversations), words AS (SELECT ord, unnest(list_filter(string_split_regex(split_part(text, '#', 1), '\\s+'), lambda t: contains(t, '='))) AS token FROM lines),
 toks AS (SELECT ord, token, upper(split_part(token, '=', 1)) AS gid, lower(regexp_extract(token, '[^=]*$')) AS severity FROM words), valid AS (SELECT * FROM toks WHERE severity IN {o.in_list(rules.RANK)} AND TRY_CAST(substr(gid, 2) AS INT) % 3 <> 0),
 last AS (SELECT 'S' || substr(gid, 2) AS signature, arg_max(severity, ord) AS s, gid FROM valid GROUP BY gid)"""


@query(f"""{_TOKENS} SELECT signature, CASE WHEN s <> 'drop' THEN s END AS severity, CASE s {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.BUCKET.items())} END AS gold, 'model' AS decided_by, gid, coalesce(n, 0) AS n
 FROM last LEFT JOIN (SELECT 'S' || (user_id % 500) AS signature, count(*) AS n FROM events GROUP BY 1) USING (signature)""")
def apply_decisions(spark: SparkSession, sf: str) -> DataFrame:
    tokens = labels.decision_tokens(spark.sql(f"{_LINES} {{c}}", c=bridge.table(spark, sf, "conversations")))
    gids = spark.range(90).where("id % 3 <> 0")
    index = gids.select(F.concat(F.lit("G"), "id").alias("gid"), F.concat(F.lit("S"), "id").alias("signature"))
    counts = bridge.table(spark, sf, "events").groupBy(F.concat(F.lit("S"), F.col("user_id") % 500).alias("signature")).agg(F.count("*").alias("n"))
    return decisions.applied_tokens(tokens, index, counts)[0]


@query(f"""{o.GROUPS} SELECT signature, n, score, prelabel FROM grouped WHERE signature NOT IN (SELECT signature FROM autos) AND score >= 1.0 AND prelabel = 'review'""")
def open_groups(spark: SparkSession, sf: str) -> DataFrame:
    g = _groups(spark, sf)
    return decisions.worklist(g, queue.auto_labels(g), 1.0, "review").select("signature", "n", "score", "prelabel")


@query(f"""{o.GROUPS} SELECT signature, CAST(NULL AS VARCHAR) AS severity, 'drop' AS gold, 'bulk tail drop' AS decided_by, 'below score 0.5 at bulk drop' AS rule, n FROM grouped WHERE signature NOT IN (SELECT signature FROM autos) AND score <= 0.5""")
def tail_drop(spark: SparkSession, sf: str) -> DataFrame:
    g = _groups(spark, sf)
    return decisions.tail_dropped(decisions.worklist(g, queue.auto_labels(g)), 0.5)


@query(f"""{o.GROUPS}, proposed AS (SELECT signature, n, {o.PROPOSED_SEVERITY} AS severity, {o.PROPOSED_RULE} AS rule FROM grouped WHERE signature NOT IN (SELECT signature FROM autos))
 SELECT signature, severity, 'malicious' AS gold, 'accepted in bulk' AS decided_by, rule, n FROM proposed WHERE rule = 'payload-drop'""")
def bulk_accept(spark: SparkSession, sf: str) -> DataFrame:
    g = _groups(spark, sf)
    return decisions.accepted(decisions.worklist(g, queue.auto_labels(g)), queue.proposals(g), "payload-drop")


_HUMAN = "CASE ord % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'high' WHEN 2 THEN 'low' END"


@query(f"""{o.SIGNED_EVENTS}, rows AS (SELECT ord AS id, coalesce({o.SEVERITY_OF}, 'none') AS severity, {_HUMAN} AS human FROM sig), news AS (SELECT id, severity AS old, CASE WHEN human IS NOT NULL AND {o.RANK.format('human')} > {o.RANK.format('severity')} THEN human ELSE severity END AS severity FROM rows)
 SELECT id, severity, CASE severity {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.BUCKET.items())} END AS gold, severity <> old AS changed FROM news""")
def verified_max(spark: SparkSession, sf: str) -> DataFrame:
    rows = bridge.telemetry(spark, sf).select(F.col("ord").alias("id"), F.expr(f"coalesce({o.SEVERITY_OF}, 'none')").alias("severity"), F.expr(_HUMAN).alias("human"))
    human = rows.where("human IS NOT NULL").select("id", F.col("human").alias("severity"))
    return decisions.verified(rows.select("id", "severity", rules.bucket(F.col("severity")).alias("gold")), human)


@query(f"""{o.SIGNED_EVENTS}, l AS (SELECT signature, {o.SEVERITY_OF} AS severity, {o.GOLD_OF} AS gold FROM sig WHERE attack QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1), held AS (SELECT signature FROM sig WHERE NOT attack AND ord % 9 = 0)
 SELECT ord, signature, l.severity, l.gold FROM sig JOIN l USING (signature) WHERE attack AND l.gold <> 'drop' AND signature NOT IN (SELECT signature FROM held)""")
def label_expand(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signed(spark, sf)
    return decisions.expanded(_labelled(spark, sf), rows.where("attack"), rows.where("NOT attack AND ord % 9 = 0")).select("ord", "signature", "severity", "gold")


@query(f"{o.TELEMETRY} SELECT src, ord FROM telemetry QUALIFY row_number() OVER (PARTITION BY src ORDER BY ord) <= 3")
def per_file_cap(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.capped(bridge.telemetry(spark, sf), ["src"], 3, [F.col("ord")]).select("src", "ord")


# ---- caps, splits and sets


@query(f"{o.SIGNED_EVENTS} SELECT ord, signature FROM sig WHERE attack QUALIFY row_number() OVER (PARTITION BY signature ORDER BY sha256('s1|' || signature || '|' || ord), ord) <= 6")
def signature_cap(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.capped(_signed(spark, sf).where("attack"), ["signature"], 6, [sampling.hash_order("s1", "signature", "ord"), F.col("ord")]).select("ord", "signature")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY sha256('s2|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber) <= 4")
def image_cap(spark: SparkSession, sf: str) -> DataFrame:
    rows = bridge.table(spark, sf, "lineitem")
    order = [sampling.hash_order("s2", "l_orderkey", "l_linenumber"), F.col("l_orderkey"), F.col("l_linenumber")]
    return sampling.capped(rows, ["l_returnflag", "l_partkey"], 4, order).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""{o.SIGNED_EVENTS}, members AS (SELECT ord, signature, {o.GOLD_OF} AS gold FROM sig WHERE attack), held AS (SELECT DISTINCT signature FROM sig WHERE NOT attack AND ord % 9 = 0),
 tagged AS (SELECT *, signature IN (SELECT signature FROM held) AS h FROM members), placed AS (SELECT *, row_number() OVER (PARTITION BY signature, gold <> 'drop' AND NOT h ORDER BY sha256('s3|' || signature || '|' || ord), ord) AS place FROM tagged)
 SELECT CASE WHEN gold = 'drop' THEN 'dropped' WHEN h THEN 'reserved' WHEN place > 3 THEN 'over cap' ELSE 'kept' END AS reason, count(*) AS n FROM placed GROUP BY 1""")
def exclusion_reasons(spark: SparkSession, sf: str) -> DataFrame:
    rows = _gold_events(spark, sf)
    tagged = sampling.tagged_exclusions(rows.where("attack").select("ord", "signature", "gold"), rows.where("NOT attack AND ord % 9 = 0"), 3, "s3")
    return tagged.groupBy("reason").agg(F.count("*").alias("n"))


@query(f"{o.CORPUS} SELECT ord, gold FROM corpus QUALIFY row_number() OVER (PARTITION BY substr(event, 1, 300) ORDER BY ord) = 1")
def prefix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.first_wins(bridge.corpus(spark, sf), F.substring("event", 1, 300), "ord").select("ord", "gold")


@query(f"""{o.SIGNED_EVENTS}, rows AS (SELECT ord, signature, {o.GOLD_OF} AS gold, {o.SEVERITY_OF} AS severity, attack FROM sig), real AS (SELECT * FROM rows WHERE attack AND ord % 4 = 0),
 fresh AS (SELECT * FROM rows WHERE NOT attack AND signature NOT IN (SELECT signature FROM rows WHERE attack AND ord % 11 = 1) AND signature NOT IN (SELECT signature FROM real) QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1)
 SELECT ord, signature, gold, CASE WHEN severity = 'critical' THEN 'high' ELSE severity END AS severity, origin FROM (SELECT *, 'real' AS origin FROM real UNION ALL SELECT *, 'synthetic' FROM fresh)""")
def merge_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = _gold_events(spark, sf).select("ord", "signature", "gold", "severity", "attack")
    real, held = rows.where("attack AND ord % 4 = 0").drop("attack"), rows.where("attack AND ord % 11 = 1")
    return sampling.merged(real, rows.where("NOT attack").drop("attack"), held).select("ord", "signature", "gold", "severity", "origin")


@query(f"""{o.SIGNED_EVENTS}, train AS (SELECT * FROM sig WHERE NOT attack) SELECT ord, CASE WHEN signature IN (SELECT signature FROM train) THEN 'exact signature in training' WHEN action IN (SELECT action FROM train) THEN 'same action in training' END AS excluded FROM sig WHERE attack""")
def expansion(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signed(spark, sf)
    return sampling.expansion(rows.where("attack"), rows.where("NOT attack")).select("ord", "excluded")


@query(f"""{o.SIGNED_EVENTS}, held AS (SELECT * FROM sig WHERE NOT attack) SELECT count(*) AS n, count(CASE WHEN signature IN (SELECT signature FROM held) THEN 1 END) AS exact, count(CASE WHEN coarse IN (SELECT coarse FROM held) THEN 1 END) AS coarse FROM sig WHERE attack""")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signed(spark, sf)
    return audit.quarantine(rows.where("attack"), rows.where("NOT attack"))


@query(f"{o.SIGNED_EVENTS} SELECT signature FROM sig WHERE attack INTERSECT SELECT signature FROM sig WHERE NOT attack")
def split_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = _signed(spark, sf)
    return audit.overlap(rows.where("attack"), rows.where("NOT attack"), "signature")


@query(f"{o.SIGNED_EVENTS}, sides AS (SELECT ord % 1000 AS id, event, attack FROM sig) SELECT 'id' AS key, CAST(id AS VARCHAR) AS value FROM (SELECT id FROM sides WHERE attack INTERSECT SELECT id FROM sides WHERE NOT attack) UNION ALL SELECT 'event', event FROM (SELECT event FROM sides WHERE attack INTERSECT SELECT event FROM sides WHERE NOT attack)")
def split_body_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Ids and bodies on both sides of a split."""
    rows = _signed(spark, sf).select((F.col("ord") % 1000).alias("id"), "event", "attack")
    sides = rows.where("attack"), rows.where("NOT attack")
    both = [audit.overlap(*sides, key).select(F.lit(key).alias("key"), F.col(key).cast("string").alias("value")) for key in ("id", "event")]
    return both[0].unionByName(both[1])


@query(f"{o.SIGNED_EVENTS} SELECT ord FROM sig WHERE ord % 7 <> 3")
def filled_in_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(_signed(spark, sf).select("ord", F.expr("CASE WHEN ord % 7 = 3 THEN 'PASTE_' || event ELSE event END").alias("event")), "rows")
    return prompts.filled_in(rows).select("ord")


_SIDES = f"{o.CORPUS}, sides AS (SELECT ord, gold, family, CASE WHEN gold = 'malicious' OR (row_number() OVER (PARTITION BY gold, family ORDER BY ord) - 1) % 2 = 0 THEN 'eval' ELSE 'train' END AS side FROM corpus)"


@query(f"{_SIDES} SELECT * FROM sides")
def alternating_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.alternating_split(bridge.corpus(spark, sf)).select("ord", "gold", "family", "side")


@query(f"""{_SIDES}, ev AS (SELECT * FROM sides WHERE side = 'eval'), c AS (SELECT count(*) FILTER (gold = 'benign') AS b, count(*) FILTER (gold = 'suspicious') AS s, count(*) FILTER (gold = 'malicious') AS m FROM ev),
 q AS (SELECT *, 60 - m AS room, greatest(0, b + s + m - 60) AS x FROM c), r AS (SELECT CASE WHEN x = 0 THEN 0 WHEN b - s >= x THEN x WHEN s - b >= x THEN 0 ELSE least(b, greatest(0, b - CAST(floor(greatest(room, 0) / 2.0) AS BIGINT))) END AS rb, x FROM q)
 SELECT ord, gold FROM (SELECT *, row_number() OVER (PARTITION BY gold ORDER BY ord) AS place FROM ev), r WHERE place > CASE gold WHEN 'benign' THEN rb WHEN 'suspicious' THEN x - rb ELSE 0 END""")
def trim_waterfill(spark: SparkSession, sf: str) -> DataFrame:
    split = sampling.alternating_split(bridge.corpus(spark, sf)).where("side = 'eval'")
    return sampling.trimmed(split.select("ord", "gold"), 60)


_MAJORITY = f"""{o.SIGNED_EVENTS}, counted AS (SELECT signature, {o.GOLD_OF} AS gold, count(*) AS n, min(ord) AS seen FROM sig GROUP BY 1, 2), major AS (SELECT signature, gold FROM counted QUALIFY row_number() OVER (PARTITION BY signature ORDER BY n DESC, seen) = 1)"""


@query(f"{_MAJORITY} SELECT signature, gold FROM major QUALIFY row_number() OVER (PARTITION BY gold ORDER BY sha256('s4|' || signature), signature) <= greatest(1, CAST(round_even(count(*) OVER (PARTITION BY gold) * 0.1, 0) AS BIGINT))")
def validation_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.validation_signatures(_gold_events(spark, sf), 0.1, "s4")


@query(f"{o.SIGNED_EVENTS} SELECT signature FROM (SELECT DISTINCT signature FROM sig) ORDER BY sha256('s5|' || signature), signature LIMIT 60")
def blind_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.blind_sample(_signed(spark, sf).select("signature").distinct(), 60, "s5")


#: Share of each EventID.
EVENT_MIX = ((1, 0.514), (13, 0.130), (11, 0.122), (3, 0.080), (4624, 0.068), (7, 0.050), (12, 0.032), (4625, 0.002))


@query(f"""WITH mix AS (SELECT * FROM (VALUES {', '.join(f'({k}, {s}::DOUBLE, {i})' for i, (k, s) in enumerate(EVENT_MIX))}) t(key, share, ord)), n AS (SELECT count(*) AS n FROM documents),
 raw AS (SELECT key, ord, share * n AS r, n FROM mix, n), placed AS (SELECT key, floor(r) AS f, n - sum(floor(r)) OVER () AS spare, row_number() OVER (ORDER BY r - floor(r) DESC, ord) AS place FROM raw)
 SELECT key, CAST(f + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS n FROM placed""")
def apportion(spark: SparkSession, sf: str) -> DataFrame:
    mix = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(EVENT_MIX)], "key int, share double, ord int")
    return sampling.apportion(mix, bridge.table(spark, sf, "documents").count())


# ---- targets


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    rows = contract.rendered(bridge.telemetry(spark, sf)).withColumns({
        "gold": F.expr("CASE ord % 3 WHEN 0 THEN 'benign' WHEN 1 THEN 'suspicious' ELSE 'malicious' END"),
        "severity": F.expr("CASE ord % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'medium' ELSE 'high' END"),
    })
    return targets.with_targets(rows)


@query(f"{o.TARGETS} SELECT ord, array_to_string(list_transform(indicators, lambda x: x.key || '=' || x.value), '; ') AS indicators FROM argued")
def indicators(spark: SparkSession, sf: str) -> DataFrame:
    return _targets(spark, sf).select("ord", F.array_join(F.transform("indicators", lambda x: F.concat(x["key"], F.lit("="), x["value"])), "; ").alias("indicators"))


@query(f"{o.TARGETS} SELECT ord, EventID, {o.THREAT} AS threat_type FROM argued")
def threat_types(spark: SparkSession, sf: str) -> DataFrame:
    return _targets(spark, sf).select("ord", "EventID", "threat_type")


@query(f"""{o.TARGETS}, typed AS (SELECT ord, CASE ord % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'medium' ELSE 'high' END AS severity, {o.THREAT} AS threat_type FROM argued)
 SELECT ord, threat_type, severity IN {o.in_list(decisions.ESCALATED_SEVERITIES)} OR coalesce(threat_type IN {o.in_list(decisions.ESCALATED_THREATS)}, false) AS escalate, CASE severity WHEN 'none' THEN 0.05::DOUBLE WHEN 'medium' THEN 0.5 ELSE 0.85 END AS confidence FROM typed""")
def routing(spark: SparkSession, sf: str) -> DataFrame:
    return decisions.routed(_targets(spark, sf)).select("ord", "threat_type", "escalate", "confidence")


@query(f"{o.TARGETS} SELECT ord, {o.REASONING} AS reasoning FROM argued")
def reasoning(spark: SparkSession, sf: str) -> DataFrame:
    return _targets(spark, sf).select("ord", "reasoning")


@query(f"{o.TARGETS}, names AS (SELECT unnest([{', '.join(map(bridge.quoted, targets.PHRASES))}]) AS key), counted AS (SELECT key, count(*) AS n FROM (SELECT unnest(keys) AS key FROM argued) GROUP BY 1) SELECT key, coalesce(n, 0) AS n FROM names LEFT JOIN counted USING (key)")
def indicator_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return targets.indicator_frequency(_targets(spark, sf))


# ---- audit


@query(f"""{o.SIGNED_EVENTS}, g AS (SELECT *, {o.GOLD_OF} AS gold FROM sig), shares AS ({' UNION ALL '.join(f"SELECT '{f}' AS field, gold, avg(CASE WHEN {f} IS NOT NULL THEN 1 ELSE 0 END) AS share FROM g GROUP BY gold" for f in contract.FIELDS)})
 SELECT field, round(max(share) - min(share), 9) AS spread, max(share) - min(share) > 0.6 AS leak FROM shares GROUP BY 1 HAVING max(share) > 0""")
def field_presence(spark: SparkSession, sf: str) -> DataFrame:
    return audit.field_presence(_gold_events(spark, sf)).withColumn("spread", F.round("spread", 9))


@query("""WITH pairs AS (SELECT DISTINCT l_returnflag AS gold, l_suppkey AS acct FROM lineitem), owners AS (SELECT acct, count(*) AS k FROM pairs GROUP BY 1)
 SELECT gold, count(*) AS accounts, count(*) FILTER (k = 1) AS unique_accounts FROM pairs JOIN owners USING (acct) GROUP BY 1""")
def identifier_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return audit.identifier_overlap(bridge.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("gold"), F.col("l_suppkey").alias("acct")), "acct")


@query(f"""{o.CORPUS}, toks AS (SELECT gold, unnest(list_distinct(list_transform(regexp_extract_all(event, '[A-Za-z0-9_.\\-]{{3,}}'), lambda t: lower(t)))) AS token FROM corpus), counts AS (SELECT token, gold, count(*) AS n FROM toks GROUP BY ALL),
 by_token AS (SELECT token, sum(n)::BIGINT AS total, arg_max(gold, (n, gold)) AS gold, max(n) AS n FROM counts GROUP BY 1), sizes AS (SELECT gold, count(*) AS size FROM corpus GROUP BY 1)
 SELECT token, gold, n, total FROM by_token JOIN sizes USING (gold) WHERE total >= 4 AND n / total >= 0.6 AND n >= 4 AND n / size >= 0.05 ORDER BY total DESC, token LIMIT 25""")
def token_purity(spark: SparkSession, sf: str) -> DataFrame:
    return audit.token_purity(bridge.corpus(spark, sf), purity=0.6, coverage=0.05)


@query(f"""{o.SIGNED_EVENTS}, counts AS (SELECT {o.basename('Image')} AS base, CASE WHEN ord % 7 = 0 THEN 'benign' ELSE 'malicious' END AS gold, count(*) AS n FROM sig WHERE Image IS NOT NULL GROUP BY ALL),
 by_binary AS (SELECT base, sum(n)::BIGINT AS total, arg_max(gold, (n, gold)) AS gold, max(n) AS n FROM counts GROUP BY 1) SELECT base, gold, n, total FROM by_binary WHERE total >= 6 AND n / total >= 0.85 ORDER BY total DESC, base LIMIT 12""")
def onesided_binaries(spark: SparkSession, sf: str) -> DataFrame:
    return audit.onesided_binaries(_signed(spark, sf).withColumn("gold", F.expr("CASE WHEN ord % 7 = 0 THEN 'benign' ELSE 'malicious' END")))


# ---- metrics


@query(f"{o.PREDICTIONS} SELECT id, severity, pred, round(benign, 9) AS p_benign, round(suspicious, 9) AS p_suspicious, round(malicious, 9) AS p_malicious, round(margin, 9) AS margin FROM preds")
def softmax_margin(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf).select("id", "severity", "pred", *(F.round(c, 9).alias(c) for c in ("p_benign", "p_suspicious", "p_malicious", "margin")))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6 if c.startswith("margin") else 9) for c, t in df.dtypes if t == "double"})


@query(f"{o.PREDICTIONS} {o.metrics_sql('', '')}")
def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.class_metrics(_predictions(spark, sf)))


@query(f"{o.PREDICTIONS} {o.metrics_sql('subset,', 'GROUP BY GROUPING SETS ((subset), ())')}")
def metrics_by_subset(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.class_metrics(_predictions(spark, sf), ["subset"], rollup=True))


@query(f"""{o.PREDICTIONS}, m AS ({o.metrics_sql('', '')}) SELECT metric, value, target, CASE WHEN metric IN ('accuracy', 'malicious_recall') THEN value >= target ELSE value <= target END AS met FROM
 (SELECT 'accuracy' AS metric, accuracy AS value, 0.8::DOUBLE AS target FROM m UNION ALL SELECT 'under_call', under_call, 0.1 FROM m UNION ALL SELECT 'missed_threat', missed_threat, 0.05 FROM m
 UNION ALL SELECT 'over_call', over_call, 0.2 FROM m UNION ALL SELECT 'malicious_recall', malicious_recall, 0.9 FROM m)""")
def gate_check(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.gates(_rounded(metrics.class_metrics(_predictions(spark, sf))))


@query(f"{o.PREDICTIONS} SELECT gold, count(*) FILTER (pred = 'benign') AS benign, count(*) FILTER (pred = 'suspicious') AS suspicious, count(*) FILTER (pred = 'malicious') AS malicious FROM preds GROUP BY 1")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(_predictions(spark, sf), "gold", "pred", list(metrics.CLASSES))


@query(f"{o.PREDICTIONS}, gaps AS (SELECT id, gold, pred, {o.CLASS_RANK.format('pred')} - {o.CLASS_RANK.format('gold')} AS gap, round(margin, 9) AS margin FROM preds WHERE pred <> gold) SELECT * FROM gaps ORDER BY gap, margin DESC, id LIMIT 50")
def misses(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.misses(_predictions(spark, sf).withColumn("margin", F.round("margin", 9)), 50)


_AFTER = "CASE WHEN id % 10 = 0 THEN 'malicious' WHEN id % 10 = 1 THEN gold ELSE pred END"


@query(f"{o.PREDICTIONS}, j AS (SELECT id, gold, pred AS before, {_AFTER} AS after FROM preds) SELECT id, gold, before, after, CASE WHEN after = gold THEN 'better' WHEN before = gold THEN 'worse' ELSE 'same' END AS mark FROM j WHERE before <> after")
def flips(spark: SparkSession, sf: str) -> DataFrame:
    before = _predictions(spark, sf)
    return metrics.flips(before, before.withColumn("pred", F.expr(_AFTER)))


@query(f"{o.PREDICTIONS}, runs AS (SELECT subset AS run, avg(CASE WHEN pred = gold THEN 1 ELSE 0 END) AS a, avg(CASE WHEN {o.CLASS_RANK.format('pred')} < {o.CLASS_RANK.format('gold')} THEN 1 ELSE 0 END) AS u FROM preds GROUP BY 1) SELECT run FROM runs ORDER BY a DESC, u LIMIT 1")
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.best_run(metrics.class_metrics(_predictions(spark, sf), ["subset"]).withColumnRenamed("subset", "run"))


_PAIRS = f"SELECT signature, {o.SEVERITY_OF} AS human, CASE ord % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' END AS auto FROM"


@query(f"""{o.SIGNED_EVENTS}, firsts AS (SELECT * FROM sig WHERE attack QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1), pairs AS ({_PAIRS} firsts),
 r AS (SELECT *, {o.RANK.format('human')} AS h, {o.RANK.format('auto')} AS a, CASE coalesce(human, 'drop') {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.BUCKET.items())} END AS hb, CASE coalesce(auto, 'drop') {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.BUCKET.items())} END AS ab FROM pairs)
 SELECT count(*) AS n, count(*) FILTER (h = a) AS exact, count(*) FILTER (hb = ab) AS same_class, count(*) FILTER (a < h) AS under, count(*) FILTER (a > h) AS over FROM r""")
def agreement(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.agreement(spark.sql(f"{_PAIRS} {{firsts}}", firsts=labels.first_by(_signed(spark, sf).where("attack"), "signature")))


@query("""WITH s AS (SELECT n_chars AS v, row_number() OVER (ORDER BY n_chars) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT max(n) AS n, max(v) FILTER (i = n // 2) AS p50, max(v) FILTER (i = CAST(floor(n * 0.95) AS BIGINT)) AS p95, max(v) AS longest FROM s""")
def length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.length_percentiles(bridge.table(spark, sf, "documents"), "n_chars")


# ---- prompts, sources, streams, generators

_SYSTEM_SQL = bridge.quoted(prompts.system_prompt())


@query(f"SELECT conv_id, turn, sha256({_SYSTEM_SQL}) AS prompt_hash, {_SYSTEM_SQL} AS system, 'Event:' || chr(10) || text || chr(10) || chr(10) || 'Classify.' AS user FROM conversations")
def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    m = prompts.messages(F.col("text"))
    return bridge.table(spark, sf, "conversations").select("conv_id", "turn", prompts.prompt_hash().alias("prompt_hash"), m[0]["content"].alias("system"), m[1]["content"].alias("user"))


_COMPLETION = """'{"severity":"' || severity || '","isThreat":' || CASE gold WHEN 'benign' THEN 'false' ELSE 'true' END || ',"threatType":' || coalesce(CAST(to_json(threat_type) AS VARCHAR), 'null') || ',"indicators":{'
 || array_to_string(list_transform(indicators, lambda x: CAST(to_json(x.key) AS VARCHAR) || ':' || CAST(to_json(x.value) AS VARCHAR)), ',') || '},"reasoning":' || CAST(to_json(reasoning) AS VARCHAR) || '}'"""


@query(f"""{o.TARGETS}, counted AS (SELECT signature, {o.GOLD_OF} AS gold, count(*) AS n, min(ord) AS seen FROM sig GROUP BY 1, 2), major AS (SELECT signature, gold FROM counted QUALIFY row_number() OVER (PARTITION BY signature ORDER BY n DESC, seen) = 1),
 val AS (SELECT signature FROM major QUALIFY row_number() OVER (PARTITION BY gold ORDER BY sha256('s4|' || signature), signature) <= greatest(1, CAST(round_even(count(*) OVER (PARTITION BY gold) * 0.1, 0) AS BIGINT))),
 said AS (SELECT *, CASE ord % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'medium' ELSE 'high' END AS severity, {o.THREAT} AS threat_type, {o.REASONING} AS reasoning, {_RENDER} AS body FROM argued)
 SELECT said.ord AS id, severity, CASE WHEN sig.signature IN (SELECT signature FROM val) THEN 'val' ELSE 'train' END AS split, {_SYSTEM_SQL} AS system, 'Event:' || chr(10) || body || chr(10) || chr(10) || 'Classify.' AS user, {_COMPLETION} AS completion FROM said JOIN sig ON said.ord = sig.ord""")
def training_pairs(spark: SparkSession, sf: str) -> DataFrame:
    signed = staged(_gold_events(spark, sf).select("ord", "signature", "gold"), "signed")
    rows = _targets(spark, sf).join(signed.select("ord", "signature"), "ord").withColumn("id", F.col("ord"))
    pairs = prompts.training_pairs(rows, sampling.validation_signatures(signed, 0.1, "s4"))
    return pairs.select("id", "severity", "split", F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("user"), "completion")


@query(stateful.EVENTS_SQL)
def xml_events(spark: SparkSession, sf: str) -> DataFrame:
    data = F.concat_ws("", *(F.when(F.col(f).isNotNull(), F.concat(F.lit(f"<Data Name='{stateful.NAMED.get(f, f)}'>"), F.col(f), F.lit("</Data>"))) for f in stateful.CARRIED))
    xml = F.concat(F.lit('<Event xmlns="http://schemas.microsoft.com/win/2004/08/events/event"><System><EventID Qualifiers="0">'), F.col("EventID"), F.lit("</EventID></System><EventData>"), data, F.lit("</EventData></Event>"))
    return parse_events(bridge.telemetry(spark, sf).select("ord", xml.alias("xml")), "xml").select("ord", "EventID", *stateful.CARRIED)


@query(f"{o.SIGNED_EVENTS}, raw AS (SELECT {o.SIGNATURE} AS signature FROM telemetry) SELECT signature, count(*) AS n FROM raw GROUP BY 1")
def stream_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The running profile after all events of a file stream have arrived."""
    records = staged(bridge.telemetry(spark, sf).select(*contract.FIELDS), "stream")
    folder = records.inputFiles()[0].rsplit("/", 1)[0]
    stream = ingest.running_profile(spark.readStream.schema(records.schema).parquet(folder))
    ingest.kept_profile(stream, f"{folder}-profile", f"{folder}-state").awaitTermination()
    return spark.read.parquet(f"{folder}-profile")


@query()
def generated_benign(spark: SparkSession, sf: str) -> DataFrame:
    return generate.generated(spark, bridge.table(spark, sf, "benchmark").count() * 5, "benign")


@query()
def generated_suspicious(spark: SparkSession, sf: str) -> DataFrame:
    return generate.generated(spark, bridge.table(spark, sf, "benchmark").count() * 5, "suspicious", prefix="S")


#: Tool names of the bridge's events, and what may stand for them.
_NAMES, _NEUTRAL = ("tool", "drop", "backdoor"), ("svc", "upd", "helper", "task", "agent")


@query(f"""{o.SIGNED_EVENTS}, cut AS (SELECT ord, regexp_extract_all(event, '[A-Za-z0-9]+') AS words, string_split_regex(event, '[A-Za-z0-9]+') AS gaps FROM sig),
 news AS (SELECT ord, gaps, list_transform(words, lambda w: CASE WHEN lower(w) IN {o.in_list(_NAMES)} THEN {o.drawn_of(_NEUTRAL, "'s6'", 'ord', 'lower(w)')} || CASE WHEN {o.drawn(2, "'s6'", 'ord', 'lower(w)', "'half'")} = 0
 THEN CAST({o.drawn(89, "'s6'", 'ord', 'lower(w)', "'number'")} + 10 AS VARCHAR) ELSE '' END ELSE w END) AS words FROM cut)
 SELECT ord, array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce(words[i], '')), '') AS event FROM news""")
def scrub_names(spark: SparkSession, sf: str) -> DataFrame:
    return _signed(spark, sf).select("ord", rewriting.scrub_names(F.col("event"), F.col("ord"), _NAMES, _NEUTRAL, "s6").alias("event"))


_TOOL = f"([{', '.join(map(bridge.quoted, rewriting.TOOL_NAMES))}])[1 + ord % {len(rewriting.TOOL_NAMES)}]"
_NEW = f"""({o.drawn_of(rewriting.NEUTRAL_NAMES, "'scrub'", 'ord', 'tool')} || CASE WHEN {o.drawn(2, "'scrub'", 'ord', 'tool', "'half'")} = 0 THEN CAST({o.drawn(89, "'scrub'", 'ord', 'tool', "'number'")} + 10 AS VARCHAR) ELSE '' END)"""


def _with_tools(name: str, same: str) -> str:
    """A line that names a tool alone, in capitals, with a suffix, and as part of other words."""
    return f"event || chr(10) || 'ParentCommandLine: run ' || {name} || ' /x C:/' || {same} || '.exe ' || replace(tool, '-', '') || 'x z' || replace(tool, '-', '')"


@query(f"{o.SIGNED_EVENTS}, named AS (SELECT ord, event, {_TOOL} AS tool FROM sig), drawn AS (SELECT *, {_NEW} AS new FROM named) SELECT ord, {_with_tools('new', 'new')} AS event FROM drawn")
def scrub_all_names(spark: SparkSession, sf: str) -> DataFrame:
    """Every tool name of the list, one an event."""
    tool = F.element_at(F.array(*map(F.lit, rewriting.TOOL_NAMES)), (F.col("ord") % len(rewriting.TOOL_NAMES) + 1).cast("int"))
    named = _signed(spark, sf).withColumn("tool", tool)
    return named.select("ord", rewriting.scrub_names(F.expr(_with_tools("tool", "upper(tool)")), F.col("ord")).alias("event"))


#: The bridge's events with hosts of a laboratory, an application pool and a shared profile among them.
_LAB = "CASE ord % 4 WHEN 0 THEN replace(event, 'CORP', 'IEWIN7') WHEN 1 THEN replace(event, 'CORP', 'IIS APPPOOL') WHEN 2 THEN replace(event, 'Users\\\\alice', 'Users\\\\Public') ELSE event END"


@query(f"""{o.SIGNED_EVENTS}, lab AS (SELECT ord, {_LAB.replace(chr(92) * 2, chr(92))} AS event, {o.drawn_of(rewriting.HOSTS, "'s7'", 'ord', "'host'")} AS host, {o.drawn_of(rewriting.LOCAL_USERS, "'s7'", 'ord', "'user'")} AS name, {o.drawn(3, "'s7'", 'ord', "'kind'")} AS kind FROM sig),
 drawn AS (SELECT *, CASE WHEN kind = 2 THEN '{rewriting.DOMAIN}' ELSE host END AS realm, string_split(event, chr(10)) AS ls FROM lab),
 lines AS (SELECT ord, realm, name, list_transform(ls, lambda x: CASE WHEN starts_with(x, 'User: ') AND NOT starts_with(upper(x), 'USER: NT AUTHORITY') AND NOT contains(upper(x), 'APPPOOL') THEN 'User: ' || realm || chr(92) || name ELSE x END) AS ls FROM drawn),
 kept AS (SELECT ord, realm, name, regexp_replace(array_to_string(ls, chr(10)), '(?i)(c:\\\\+users\\\\+)(public|default|all users)([^a-z0-9_.-]|$)', '\\1<\\2>\\3', 'g') AS event FROM lines),
 named AS (SELECT ord, realm, array_to_string(list_transform(string_split_regex(event, '[Cc]:\\\\+[Uu]sers\\\\+'), lambda x, i: CASE WHEN i > 1 THEN regexp_replace(x, '^[A-Za-z0-9_.-]+', name) ELSE x END), chr(1)) AS event, regexp_extract_all(event, '[Cc]:\\\\+[Uu]sers\\\\+') AS heads FROM kept),
 back AS (SELECT ord, realm, array_to_string(list_transform(string_split(event, chr(1)), lambda x, i: CASE WHEN i > 1 THEN heads[i - 1] ELSE '' END || x), '') AS event FROM named)
 SELECT ord, replace(replace(replace(replace(regexp_replace(event, '(?i)<(public|default|all users)>', '\\1', 'g'), 'MSEDGEWIN10' || chr(92), realm || chr(92)), 'IEWIN7' || chr(92), realm || chr(92)), 'PC01' || chr(92), realm || chr(92)), 'insecurebank' || chr(92), realm || chr(92)) AS event FROM back""")
def identity_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    lab = spark.sql(f"SELECT ord, {_LAB} AS event FROM {{rows}}", rows=_signed(spark, sf))
    return lab.select("ord", rewriting.rewrite_identity(F.col("event"), F.col("ord"), "s7").alias("event"))


_MOVED = {"tool.exe": "C:\\Users\\Public\\svcupd.exe", "x.exe": "C:\\ProgramData\\run.exe"}
_NEW = "CASE " + " ".join(f"WHEN suffix(Image, '\\{k}') THEN '{v}'" for k, v in _MOVED.items()) + " END"


@query(f"""{o.SIGNED_EVENTS}, moved AS (SELECT ord, event, Image, {_NEW} AS new, regexp_extract(Image, '[^\\\\]*$') AS name FROM sig)
 SELECT ord, replace(CASE WHEN new IS NULL THEN event ELSE replace(replace(event, Image, new), name, regexp_extract(new, '[^\\\\]*$')) END, 'UACME.exe', 'a.exe') AS event FROM moved""")
def image_rename(spark: SparkSession, sf: str) -> DataFrame:
    renames = spark.createDataFrame(list(_MOVED.items()), "_old string, new string")
    rows = _signed(spark, sf).withColumn("_name", F.substring_index("Image", "\\", -1)).join(F.broadcast(renames), F.col("_name") == F.col("_old"), "left")
    return rows.select("ord", rewriting.rename_image(F.col("event"), F.col("new")).alias("event"))


_CAPTURE = "src || CASE ord % 4 WHEN 0 THEN ' T1059.001 and T1105' WHEN 1 THEN '_T1003' WHEN 2 THEN ' T99' ELSE '' END"


@query(f"{o.TELEMETRY}, named AS (SELECT DISTINCT {_CAPTURE} AS capture FROM telemetry) SELECT capture, coalesce(nullif(array_to_string(regexp_extract_all(capture, 'T[0-9]{{4}}(?:[.][0-9]{{3}})?'), ','), ''), '-') AS attck FROM named")
def techniques(spark: SparkSession, sf: str) -> DataFrame:
    captures = bridge.telemetry(spark, sf).select(F.expr(_CAPTURE).alias("capture")).distinct()
    return captures.select("capture", rewriting.techniques(F.col("capture")).alias("attck"))


# ---- smaller operators


@query(f"{o.TELEMETRY}, s AS (SELECT DISTINCT src FROM telemetry) SELECT src, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(regexp_replace({o._STEM}, '([a-z])([A-Z])', '\\1 \\2', 'g'), '[^A-Za-z0-9]+'), lambda t: lower(t)), lambda t: length(t) > 3 AND t NOT IN {o.in_list(rules.STOP_TOKENS)} AND NOT regexp_matches(t, '^[0-9]+$')))), ' ') AS tokens FROM s")
def source_tokens(spark: SparkSession, sf: str) -> DataFrame:
    src = bridge.telemetry(spark, sf).select("src").distinct()
    return src.select("src", F.array_join(F.array_sort(rules.source_tokens(F.col("src"))), " ").alias("tokens"))


_NOW = "SELECT id, CASE WHEN id % 9 = 0 THEN 'malicious' ELSE gold END AS gold, 'v' || (id % 2) AS subset FROM"


@query(f"{o.PREDICTIONS}, now AS ({_NOW} preds WHERE id % 4 <> 0) SELECT p.id, coalesce(n.gold, p.gold) AS gold, coalesce(n.subset, CAST(p.subset AS VARCHAR)) AS subset, pred FROM preds p LEFT JOIN now n ON p.id = n.id")
def refresh_gold(spark: SparkSession, sf: str) -> DataFrame:
    results = _predictions(spark, sf).select("id", "gold", F.col("subset").cast("string").alias("subset"), "pred")
    return metrics.refreshed(results, spark.sql(f"{_NOW} {{p}} WHERE id % 4 <> 0", p=results)).select("id", "gold", "subset", "pred")


@query(f"{o.PREDICTIONS} SELECT severity, pred, count(*) AS n FROM preds GROUP BY ALL")
def prediction_spread(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf).groupBy("severity", "pred").agg(F.count("*").alias("n"))


_OWN = "SELECT 'S' || user_id AS signature, CASE WHEN max(event_id) % 2 = 0 THEN 'high' END AS severity FROM {} WHERE event_type = 'click' GROUP BY user_id"
_DEFAULT = "SELECT 'S' || user_id AS signature, 'low' AS severity FROM {} WHERE event_type = 'error' GROUP BY user_id"


@query(f"WITH own AS ({_OWN.format('events')}), rest AS ({_DEFAULT.format('events')}) SELECT * FROM own UNION ALL SELECT * FROM rest WHERE signature NOT IN (SELECT signature FROM own)")
def default_labels(spark: SparkSession, sf: str) -> DataFrame:
    e = bridge.table(spark, sf, "events")
    return labels.with_defaults(spark.sql(_OWN.format("{e}"), e=e), spark.sql(_DEFAULT.format("{e}"), e=e))


@query("SELECT round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS loss FROM lineitem")
def weighted_loss(spark: SparkSession, sf: str) -> DataFrame:
    tokens = bridge.table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("ce"), F.col("l_quantity").alias("w"))
    return metrics.weighted_loss(tokens).select(F.round("loss", 4).alias("loss"))


@query("WITH first AS (SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1), second AS (SELECT event_type, count(*) AS n FROM events WHERE event_id % 3 = 0 AND event_type <> 'click' GROUP BY 1) SELECT * FROM second UNION ALL SELECT * FROM first WHERE event_type NOT IN (SELECT event_type FROM second)")
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    e = bridge.table(spark, sf, "events")
    count = lambda c: e.where(c).groupBy("event_type").agg(F.count("*").alias("n"))
    return upserted(count("event_id % 2 = 0"), count("event_id % 3 = 0 AND event_type <> 'click'"), "event_type")


_WRAPPED = "CASE ord % 3 WHEN 0 THEN event WHEN 1 THEN 'lost line' || chr(10) || event || chr(10) || '  and on' ELSE event || chr(10) || 'Image: second' END"


@query(f"""{o.SIGNED_EVENTS}, w AS (SELECT ord, {_WRAPPED} AS event FROM sig), ls AS (SELECT ord, unnest(string_split(event, chr(10))) AS line, unnest(range(1, len(string_split(event, chr(10))) + 1)) AS i FROM w),
 k AS (SELECT *, CASE WHEN regexp_matches(line, '^[A-Za-z][A-Za-z0-9_]*:') THEN i END AS pos FROM ls), f AS (SELECT *, max(pos) OVER (PARTITION BY ord ORDER BY i) AS field FROM k),
 v AS (SELECT ord, field, regexp_extract(min(line) FILTER (pos IS NOT NULL), '^[^:]*') AS key, regexp_replace(string_agg(line, chr(10) ORDER BY i), '^[^:]*: ?', '') AS value FROM f WHERE field IS NOT NULL GROUP BY 1, 2),
 last AS (SELECT ord, key, arg_max(value, field) AS value FROM v GROUP BY 1, 2)
 SELECT ord, max(value) FILTER (key = 'Image') AS image, max(value) FILTER (key = 'CommandLine') AS command, count(*)::INT AS fields, ord % 3 <> 1 AS strict FROM last GROUP BY ord""")
def wrapped_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql(f"SELECT ord, {_WRAPPED} AS event FROM {{rows}}", rows=_signed(spark, sf))
    m = contract.wrapped_fields(F.col("event"))
    return rows.select("ord", m["Image"].alias("image"), m["CommandLine"].alias("command"), F.size(m).alias("fields"), contract.strict_fields(F.col("event")).isNotNull().alias("strict"))


@query(f"""{o.SIGNED_EVENTS}, broken AS (SELECT ord, signature, Image, {o.GOLD_OF} AS gold, CASE WHEN ord % 10 = 3 THEN 'Extra: 1' || chr(10) || event ELSE event END AS event, ord % 10 = 3 AS bad FROM sig WHERE attack), held AS (SELECT DISTINCT signature FROM sig WHERE NOT attack AND ord % 9 = 0),
 tagged AS (SELECT *, signature IN (SELECT signature FROM held) AS h FROM broken), placed AS (SELECT *, row_number() OVER (PARTITION BY signature, gold <> 'drop' AND NOT h ORDER BY sha256('s8|' || signature || '|' || ord), ord) AS place FROM tagged),
 first AS (SELECT *, CASE WHEN gold = 'drop' THEN 'dropped' WHEN h THEN 'reserved' WHEN place > 3 THEN 'over cap' WHEN bad THEN 'contract: off-contract field: Extra' ELSE 'kept' END AS reason FROM placed),
 imaged AS (SELECT *, row_number() OVER (PARTITION BY gold, {o.basename('Image')}, reason ORDER BY sha256('s8|image|' || ord), ord) AS place2 FROM first)
 SELECT ord, CASE WHEN reason = 'kept' AND place2 > 4 THEN 'over image cap' ELSE reason END AS reason FROM imaged""")
def training_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    rows = _gold_events(spark, sf)
    event = F.when(F.col("ord") % 10 == 3, F.concat(F.lit("Extra: 1\n"), F.col("event"))).otherwise(F.col("event"))
    members = rows.where("attack").select("ord", "signature", "Image", "gold", event.alias("event"))
    return sampling.training_exclusions(members, rows.where("NOT attack AND ord % 9 = 0"), 3, 4, "s8").select("ord", "reason")


@query(f"""{o.SIGNED_EVENTS}, g AS (SELECT ord, {o.basename('Image')} AS image, {o.GOLD_OF} AS gold FROM sig WHERE attack) SELECT ord, image, gold FROM g QUALIFY row_number() OVER (PARTITION BY gold, image ORDER BY sha256('s9|' || ord), ord) <= 5""")
def event_image_cap(spark: SparkSession, sf: str) -> DataFrame:
    rows = _gold_events(spark, sf).where("attack").select("ord", signatures.basename(F.col("Image")).alias("image"), "gold")
    return sampling.capped(rows, ["gold", "image"], 5, [sampling.hash_order("s9", "ord"), F.col("ord")])


@query(f"""{o.SIGNED_EVENTS}, blind AS (SELECT signature, {o.SEVERITY_OF} AS severity FROM sig WHERE attack AND ord % 2 = 0 QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1),
 cand AS (SELECT ord, 'X' || ord AS id, signature, EventID, event, action FROM sig WHERE attack QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord DESC) = 1),
 made AS (SELECT c.*, b.severity, CASE b.severity {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.BUCKET.items())} END AS gold FROM blind b JOIN cand c USING (signature) WHERE b.severity IS NOT NULL),
 ruled AS (SELECT *, {o.WANT} AS want FROM made), news AS (SELECT id, signature, action, event, CASE WHEN want IN ('benign', 'malicious') AND want <> gold THEN want ELSE gold END AS gold, CASE WHEN want IN ('benign', 'malicious') AND want <> gold THEN CASE want WHEN 'benign' THEN 'none' ELSE 'high' END ELSE severity END AS severity FROM ruled),
 train AS (SELECT signature, action FROM sig WHERE NOT attack), base AS (SELECT 'E' || ord AS id, {o.GOLD_OF} AS gold, coalesce({o.SEVERITY_OF}, 'none') AS severity FROM sig WHERE NOT attack AND ord % 97 = 0)
 SELECT id, gold, severity, 'v2' AS subset, CAST(NULL AS VARCHAR) AS reason FROM base UNION ALL
 SELECT id, gold, severity, 'blind' AS subset, CASE WHEN signature IN (SELECT signature FROM train) THEN 'exact signature in training' WHEN action IN (SELECT action FROM train) THEN 'same action in training' END AS reason FROM news""")
def expanded_eval(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(_gold_events(spark, sf).select("ord", "signature", "action", "EventID", "event", "gold", "severity", "attack"), "events")
    blind = labels.first_by(rows.where("attack AND ord % 2 = 0").select("signature", "severity", "ord"), "signature")
    candidates = rows.where("attack").withColumn("id", F.concat(F.lit("X"), F.col("ord")))
    base = rows.where("NOT attack AND ord % 97 = 0").select(F.concat(F.lit("E"), F.col("ord")).alias("id"), "gold", F.coalesce("severity", F.lit("none")).alias("severity"), "event")
    return sampling.expanded_eval(base, blind, candidates, rows.where("NOT attack"), "v2", "blind").drop("event")


_SMALL = "CASE WHEN id % 17 = 0 THEN 'PARSE-FAIL' WHEN id % 5 = 0 THEN 'high' ELSE severity END"


@query(f"""{o.PREDICTIONS}, a AS (SELECT id, gold, CASE {_SMALL} WHEN 'none' THEN 'benign' WHEN 'low' THEN 'benign' WHEN 'medium' THEN 'suspicious' WHEN 'high' THEN 'malicious' END AS pred, CASE WHEN id % 3 <> 0 THEN pred END AS before FROM preds)
 SELECT id, gold, pred, before, CASE WHEN pred <> before THEN CASE WHEN pred = gold THEN 'better' WHEN before = gold THEN 'worse' ELSE 'same' END END AS mark FROM a""")
def quantised_answers(spark: SparkSession, sf: str) -> DataFrame:
    p = _predictions(spark, sf)
    return metrics.quantised(p.select("id", F.expr(_SMALL).alias("severity")), p, p.where("id % 3 <> 0"))


@query(f"""{o.PREDICTIONS}, a AS (SELECT id, gold, CASE {_SMALL} WHEN 'none' THEN 'benign' WHEN 'low' THEN 'benign' WHEN 'medium' THEN 'suspicious' WHEN 'high' THEN 'malicious' END AS p, CASE WHEN id % 3 <> 0 THEN pred END AS before FROM preds)
 SELECT count(p) AS n, count(*) - count(p) AS parse_fail, round(avg(CASE WHEN p IS NOT NULL THEN CASE WHEN p = gold THEN 1 ELSE 0 END END), 9) AS accuracy, round(avg(CASE WHEN p IS NOT NULL AND gold = 'malicious' THEN CASE WHEN p = 'benign' THEN 1 ELSE 0 END END), 9) AS dismissed,
 round(avg(CASE WHEN p IS NOT NULL AND gold = 'malicious' THEN CASE WHEN p = gold THEN 1 ELSE 0 END END), 9) AS malicious_recall, round(avg(CASE WHEN p IS NOT NULL THEN CASE WHEN {o.CLASS_RANK.format('p')} < {o.CLASS_RANK.format('gold')} THEN 1 ELSE 0 END END), 9) AS under_call, count(*) FILTER (p <> before) AS flips FROM a""")
def quantised_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.quantised_summary(quantised_answers(spark, sf)))


@query(f"""{o.KNOWN_BAD_RUN}, flagged AS (SELECT *, coalesce(lower(ParentImage) IN (SELECT path FROM bad), false) OR (EventID = '7' AND coalesce(lower(Image) IN (SELECT path FROM bad), false)) AS bad FROM labelled), ruled AS (SELECT *, {o.FLOOR} AS rule FROM flagged),
 hit AS (SELECT *, rule IS NOT NULL AND {o.RANK.format('severity')} < 3 AS changed FROM ruled) SELECT signature, CASE WHEN changed THEN 'high' ELSE severity END AS severity, changed FROM hit""")
def recalibrated(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(spark, sf)
    return labels.applied(rows, labels.recalibrations(rows, 0.3), "signature", severity="new_severity").select("signature", "severity", "changed")


@query("WITH runs AS (SELECT DISTINCT 'checkpoint-' || (user_id % 120) AS run FROM events UNION ALL SELECT 'final') SELECT row_number() OVER (ORDER BY run = 'final', TRY_CAST(regexp_extract(run, '-([0-9]+)$', 1) AS BIGINT)) AS place, run FROM runs")
def checkpoint_order(spark: SparkSession, sf: str) -> DataFrame:
    runs = bridge.table(spark, sf, "events").select(F.concat(F.lit("checkpoint-"), F.col("user_id") % 120).alias("run")).distinct().unionByName(spark.createDataFrame([("final",)], "run string"))
    return metrics.by_number(runs, "run", "final").coalesce(1).select((F.monotonically_increasing_id() + 1).alias("place"), "run")
