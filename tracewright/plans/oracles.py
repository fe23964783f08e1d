"""SQL for DuckDB that gives the same rows as the queries: shared expressions and views."""

from __future__ import annotations

from tracewright.functions import contract as c
from tracewright.functions import rules, signatures, targets
from tracewright.plans.bridge import CORPUS_SQL, SCORES_SQL, quoted, telemetry_sql


def in_list(values) -> str:
    return "(" + ", ".join(quoted(str(v)) for v in values) + ")"


def drawn(n: int, *seeds: str) -> str:
    """A number from 0 to n - 1, by a hash of the seeds."""
    return f"(CAST('0x' || substr(sha256(concat_ws('|', {', '.join(seeds)})), 1, 8) AS BIGINT) % {n})"


def drawn_of(pool, *seeds: str) -> str:
    return f"([{', '.join(map(quoted, pool))}])[1 + {drawn(len(pool), *seeds)}]"


def norm_cmd(x: str) -> str:
    p = f"replace({x}, '%%', '%')"
    return f"CASE WHEN length({p}) > {c.MAX_COMMAND} THEN substr({p}, 1, {c.MAX_COMMAND}) || '{c.TRUNCATED}' ELSE {p} END"


def normalise(x: str) -> str:
    out = f"replace(coalesce({x}, ''), '%%', '%')"
    for pattern, value in signatures.SUBSTITUTIONS:
        out = f"regexp_replace({out}, {quoted(pattern.replace('(?!\\.\\d)', ''))}, {quoted(value)}, 'g')"
    return f"trim(regexp_replace(lower({out}), '\\s+', ' ', 'g'))"


def slashed(x: str) -> str:
    return f"replace(coalesce({x}, ''), '/', '\\')"


def basename(x: str) -> str:
    return f"lower(regexp_extract({slashed(x)}, '[^\\\\]*$'))"


def dirname(x: str) -> str:
    return f"CASE WHEN contains({slashed(x)}, '\\') THEN {normalise(f"regexp_replace({slashed(x)}, '\\\\[^\\\\]*$', '')")} ELSE '' END"


def cmd_shape(command: str, image: str) -> str:
    n, b = normalise(command), basename(image)
    return f"substr(CASE WHEN {b} <> '' THEN regexp_replace({n}, '^\"?[^\"\\s]*\\Q' || {b} || '\\E\"?\\s*', '') ELSE {n} END, 1, 300)"


def port_bucket(x: str) -> str:
    n = f"TRY_CAST(trim({x}) AS BIGINT)"
    return f"""CASE WHEN {n} IS NULL THEN 'noport' WHEN {n} IN ({', '.join(map(str, signatures.SUSPECT_PORTS))}) THEN 'suspect:' || {n}
 WHEN {n} IN ({', '.join(map(str, signatures.WELL_KNOWN_PORTS))}) THEN 'wk:' || {n} WHEN {n} >= 49152 THEN 'ephemeral' WHEN {n} < 1024 THEN 'low' ELSE 'registered' END"""


DETAIL = f"""CASE WHEN EventID IN ('1', '4688') THEN {cmd_shape('CommandLine', 'Image')} WHEN EventID IN ('7', '11', '12', '13') THEN substr({normalise('TargetFilename')}, 1, 200)
 WHEN EventID = '3' THEN {port_bucket('DestinationPort')} || CASE WHEN coalesce(DestinationHostname, '') <> '' THEN '|dns' ELSE '|nodns' END
 WHEN EventID IN ('4624', '4625') THEN coalesce(LogonType, '') || '|' || coalesce(AuthPackage, '') END"""
SIGNATURE = f"concat_ws('|', EventID, {basename('Image')}, {dirname('Image')}, {basename('ParentImage')}, {DETAIL})"
COARSE = f"concat_ws('|', EventID, {basename('Image')}, {basename('ParentImage')})"
ACTION = f"concat_ws('|', EventID, {basename('Image')}, {dirname('Image')}, {DETAIL})"
BODY = "concat_ws(chr(10), " + ", ".join(f"CASE WHEN {f} IS NOT NULL THEN '{f}: ' || {f} END" for f in c.FIELDS) + ")"
VENDOR = "CASE regexp_extract(Image, '[^\\\\]*$') " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in c.VENDORS.items()) + " END"


def starts(x: str, prefixes) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {quoted(p)})" for p in prefixes) + ")"


_OPEN = f"({starts('lower(Image)', c.WRITABLE_WINDOWS_DIRS)} OR starts_with(lower(Image), 'c:\\users\\public'))"
_SYSTEM = f"({starts('lower(Image)', c.SYSTEM_DIRS)} OR starts_with(lower(Image), 'c:\\windows\\'))"
SIGNED = f"CASE WHEN coalesce(Image, '') = '' THEN NULL WHEN {VENDOR} IS NOT NULL THEN 'true' WHEN {_OPEN} THEN 'false' WHEN {_SYSTEM} THEN 'true' ELSE 'false' END"
SIGNER = f"CASE WHEN coalesce(Image, '') = '' THEN NULL WHEN {VENDOR} IS NOT NULL THEN {VENDOR} WHEN {_OPEN} THEN NULL WHEN {_SYSTEM} THEN '{c.MS_SIGNER}' END"
EVENT_TYPE = "CASE EventID " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in c.EVENT_TYPES.items()) + " END"

RANK = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.RANK.items()) + " ELSE -1 END"
CLASS_RANK = "CASE {0} WHEN 'benign' THEN 0 WHEN 'suspicious' THEN 1 WHEN 'malicious' THEN 2 END"

_REMOTE = "len(list_filter(regexp_extract_all(event, '(?i)https?://[^\\n]*'), lambda u: NOT regexp_matches(u, '(?i)\\.(icorp|corp|local|internal)'))) > 0"
_HEUR = [(_REMOTE if label == "remote fetch" else f"regexp_matches(event, {quoted(p)})", w, label) for p, w, label in rules.HEURISTICS]
_PAIR = f"({basename('ParentImage')} || '>' || {basename('Image')}) IN {in_list(f'{p}>{i}' for p, i in rules.BAD_LINEAGE)}"
_STEM = "regexp_replace(regexp_extract(src, '[^/]*$'), '\\.[^.]*$', '')"
_NAMED = f"""list_sort(list_distinct(list_filter(list_transform(string_split_regex(regexp_replace({_STEM}, '([a-z])([A-Z])', '\\1 \\2', 'g'), '[^A-Za-z0-9]+'), lambda t: lower(t)),
 lambda t: length(t) > 3 AND t NOT IN {in_list(rules.STOP_TOKENS)} AND NOT regexp_matches(t, '^[0-9]+$') AND contains(lower(event), t))))"""
_WRITABLE = quoted(rules.WRITABLE)
_AUTO = f"""CASE WHEN EventID = '7' AND coalesce(TargetFilename, '') <> '' AND NOT regexp_matches(TargetFilename, {_WRITABLE}) AND NOT regexp_matches(coalesce(Image, ''), {_WRITABLE}) THEN 'system module'
 WHEN amb >= 25 THEN 'ambient' END"""
_WHY = f"""list_filter([CASE WHEN amb >= 2 THEN 'ambient in real capture (x' || amb || ')' WHEN camb >= 20 THEN 'common image/parent pair on a real host (x' || camb || ')' END,
 CASE WHEN n_files >= 8 THEN 'appears in ' || n_files || ' unrelated captures' WHEN n_files >= 4 THEN 'appears in ' || n_files || ' captures' WHEN n_files = 1 THEN 'unique to this capture' END,
 CASE WHEN len(named) > 0 THEN 'matches sample name (' || array_to_string(named[1:3], ', ') || ')' END, {', '.join(f"CASE WHEN {p} THEN '{label}' END" for p, _, label in _HEUR)},
 CASE WHEN {_PAIR} THEN 'anomalous lineage ' || {basename('ParentImage')} || ' -> ' || {basename('Image')} END], lambda x: x IS NOT NULL)"""
_SCORE = f"""round(CASE WHEN amb >= 2 THEN -6.0 WHEN camb >= 20 THEN -2.5 ELSE 0.0 END + CASE WHEN n_files >= 8 THEN -4.0 WHEN n_files >= 4 THEN -1.5 WHEN n_files = 1 THEN 1.5 ELSE 0.0 END
 + CASE WHEN len(named) > 0 THEN 2.0 + 0.5 * len(named) ELSE 0.0 END + {' + '.join(f"CASE WHEN {p} THEN {w} ELSE 0.0 END" for p, w, _ in _HEUR)} + CASE WHEN {_PAIR} THEN 3.0 ELSE 0.0 END, 2)::DOUBLE"""


def has(needle: str) -> str:
    return f"len(list_filter(why, lambda x: contains(x, '{needle}'))) > 0"


def _proposal(of: str) -> str:
    pick = lambda severity, rule: (f"'{severity}'" if severity else "NULL") if of == "severity" else f"'{rule}'"
    out = f"CASE WHEN ({' OR '.join(map(has, rules.EXCULPATORY))}) AND score < 4.0 THEN {pick(None, 'ambient')} WHEN score < 1.0 THEN {pick(None, 'low-score')}"
    for name, needles, severity in rules.PROPOSALS:
        out += f" WHEN {' AND '.join(map(has, needles))} THEN {pick(severity, name)}"
    for name, severity in rules.TACTICS.items():
        out += f" WHEN split_part(src, '/', 1) = '{name}' THEN {pick(severity, f'tactic:{name}')}"
    return f"{out} ELSE {pick(None, 'unclassified')} END"


PROPOSED_SEVERITY, PROPOSED_RULE = _proposal("severity"), _proposal("rule")

_OBSERVE = f"""(regexp_matches(event, '(?i)\\b(?:whoami|systeminfo|nltest|hostname|ipconfig|tasklist|quser|qwinsta|arp)\\b|\\badfind\\b|\\bdsquery\\b|\\bnbtscan\\b|\\breg(?:\\.exe)?\\b[^\\n]*?\\bquery\\b')
 OR len(list_filter(string_split(event, chr(10)), lambda l: regexp_matches(l, '(?i)\\bnet1?(?:\\.exe)?\\b.*?\\b(?:user|localgroup|group|view|share|accounts)\\b') AND NOT regexp_matches(l, '(?i)/(?:add|delete)'))) > 0)"""


def _boundary(of: str) -> str:
    pick = lambda want, reason: quoted(want if of == "want" else reason)
    out = f"CASE WHEN id = 'B010' THEN {pick('benign', 'normal: ' + rules.NORMAL['B010'])}"
    for name, pattern in rules.CHANGES:
        out += f" WHEN regexp_matches(event, {quoted('(?i)' + pattern)}) THEN {pick('malicious', f'state change: {name}')}"
    out += f" WHEN EventID IN ('12', '13', '14') AND regexp_matches(event, {quoted(rules.AUTORUN_PATH)}) THEN {pick('malicious', 'state change: autorun_write (registry set)')}"
    return f"{out} WHEN {_OBSERVE} THEN {pick('observe', 'observation only')} END"


WANT, REASON = _boundary("want"), _boundary("reason")
FLOOR = f"""CASE WHEN bad THEN 'R1 known-bad binary (by execution)' WHEN regexp_matches(event, {quoted(rules.AUTORUN)}) AND NOT regexp_matches(event, {quoted(rules.REGISTRY_READ)}) THEN 'R2 autorun-location registry write or delete'
 WHEN regexp_matches(event, {quoted(rules.ANTIFORENSIC)}) THEN 'R3 anti-forensic / telemetry tampering' END"""

SEVERITY_OF = "CASE ord % 6 WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' WHEN 4 THEN 'critical' END"
GOLD_OF = "CASE ord % 6 WHEN 0 THEN 'benign' WHEN 1 THEN 'benign' WHEN 2 THEN 'suspicious' WHEN 3 THEN 'malicious' WHEN 4 THEN 'malicious' ELSE 'drop' END"

TELEMETRY = f"WITH telemetry AS ({telemetry_sql()})"
#: Normalised attack events with signatures and bodies.
SIGNED_EVENTS = f"""{TELEMETRY}, norm AS (SELECT * REPLACE ({norm_cmd('CommandLine')} AS CommandLine, {norm_cmd('ParentCommandLine')} AS ParentCommandLine) FROM telemetry),
 sig AS (SELECT *, {SIGNATURE} AS signature, {COARSE} AS coarse, {ACTION} AS action, {BODY} AS event FROM norm)"""
QUEUE = f"""{SIGNED_EVENTS}, benign AS (SELECT {SIGNATURE} AS signature, {COARSE} AS coarse FROM telemetry WHERE NOT attack), fine AS (SELECT signature, count(*) AS amb FROM benign GROUP BY 1),
 common AS (SELECT coarse, count(*) AS camb FROM benign GROUP BY 1), files AS (SELECT signature, count(DISTINCT src) AS n_files FROM sig WHERE attack GROUP BY 1),
 joined AS (SELECT s.*, coalesce(amb, 0) AS amb, coalesce(camb, 0) AS camb, n_files, {_NAMED} AS named FROM sig s LEFT JOIN fine USING (signature) JOIN files USING (signature) LEFT JOIN common USING (coarse) WHERE attack),
 queue0 AS (SELECT ord, src, EventID, signature, event, {_SCORE} AS score, {_WHY} AS why, {_AUTO} AS auto, amb FROM joined),
 queue AS (SELECT *, CASE WHEN auto IS NOT NULL THEN 'drop' WHEN score >= 4.0 THEN 'malicious' WHEN score >= 1.0 THEN 'review' ELSE 'drop' END AS prelabel FROM queue0)"""
GROUPS = f"""{QUEUE}, groups AS (SELECT signature, count(*) AS n, count(DISTINCT src) AS n_src, max(score) AS score, min(ord) AS first_ord FROM queue GROUP BY 1),
 best AS (SELECT signature, src, why FROM queue QUALIFY row_number() OVER (PARTITION BY signature ORDER BY score DESC, ord) = 1),
 opening AS (SELECT signature, prelabel, EventID FROM queue QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1),
 grouped AS (SELECT * FROM groups JOIN best USING (signature) JOIN opening USING (signature)),
 autos AS (SELECT signature, auto AS rule, amb FROM queue WHERE auto IS NOT NULL QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1)"""
LABELLED = f"""{SIGNED_EVENTS}, labelled AS (SELECT *, {SEVERITY_OF} AS severity, {GOLD_OF} AS gold FROM sig WHERE attack QUALIFY row_number() OVER (PARTITION BY signature ORDER BY ord) = 1)"""
_SHARES = f"SELECT * FROM (SELECT lower(Image) AS path, count(*) AS n, avg(CASE WHEN gold = 'malicious' THEN 1 ELSE 0 END) AS share FROM labelled WHERE coalesce(Image, '') <> ''{{0}} GROUP BY 1) WHERE share >= {{1}} AND NOT {starts('path', rules.PROGRAM_DIRS)}"
KNOWN_BAD = f"{LABELLED}, bad AS ({_SHARES.format('', 0.3)})"
KNOWN_BAD_RUN = f"{LABELLED}, bad AS ({_SHARES.format(" AND EventID IN ('1', '4688')", 0.3)})"
CORPUS = f"WITH corpus AS ({CORPUS_SQL})"
PREDICTIONS = f"""WITH scores AS ({SCORES_SQL}), top AS (SELECT *, greatest(ll_none, ll_low, ll_medium, ll_high) AS t FROM scores),
 e AS (SELECT *, exp(ll_none - t) AS e0, exp(ll_low - t) AS e1, exp(ll_medium - t) AS e2, exp(ll_high - t) AS e3 FROM top),
 p AS (SELECT *, e0 / (e0 + e1 + e2 + e3) AS p0, e1 / (e0 + e1 + e2 + e3) AS p1, e2 / (e0 + e1 + e2 + e3) AS p2, e3 / (e0 + e1 + e2 + e3) AS p3 FROM e),
 preds AS (SELECT id, subset, gold, CASE WHEN p0 >= p1 AND p0 >= p2 AND p0 >= p3 THEN 'none' WHEN p1 >= p2 AND p1 >= p3 THEN 'low' WHEN p2 >= p3 THEN 'medium' ELSE 'high' END AS severity,
 p0 + p1 AS benign, p2 AS suspicious, p3 AS malicious, CASE WHEN p0 + p1 >= p2 AND p0 + p1 >= p3 THEN 'benign' WHEN p2 >= p3 THEN 'suspicious' ELSE 'malicious' END AS pred,
 list_sort([p0 + p1, p2, p3], 'DESC')[1] - list_sort([p0 + p1, p2, p3], 'DESC')[2] AS margin FROM p)"""


def metrics_sql(keys: str, grouping: str) -> str:
    g, r = CLASS_RANK.format("gold"), CLASS_RANK.format("pred")
    avg = lambda cond, among="true": f"round(avg(CASE WHEN {among} THEN CASE WHEN {cond} THEN 1 ELSE 0 END END), 9)"
    return f"""SELECT {keys} count(*) AS n, {avg('pred = gold')} AS accuracy, {avg(f'{r} < {g}')} AS under_call, {avg(f'{r} > {g}')} AS over_call, {avg('pred = gold', "gold = 'malicious'")} AS malicious_recall,
 {avg('pred = gold', "gold = 'suspicious'")} AS suspicious_recall, {avg("pred = 'benign'", "gold = 'malicious'")} AS missed_threat, {avg('pred = gold', "pred = 'benign'")} AS benign_precision,
 round(avg(CASE WHEN pred = gold THEN margin END), 6) AS margin_correct, round(avg(CASE WHEN pred <> gold THEN margin END), 6) AS margin_wrong FROM preds {grouping}"""


class SqlOps:
    """The operations of the target rules in DuckDB's SQL."""

    def field(self, name):
        return f"coalesce({name}, '')"

    def text(self, value):
        return quoted(value)

    def matches(self, x, pattern):
        return f"regexp_matches({x}, {quoted(pattern)})"

    def one_of(self, x, values):
        return f"({x} IN ({', '.join(quoted(v) if isinstance(v, str) else str(v) for v in values)}))"

    def contains(self, x, part):
        return f"contains({x}, {quoted(part)})"

    def ends(self, x, part):
        return f"suffix({x}, {quoted(part)})"

    def lower(self, x):
        return f"lower({x})"

    def base(self, path):
        return basename(path)

    def folder(self, path):
        return f"(CASE WHEN contains({slashed(path)}, '\\') THEN lower(regexp_replace({slashed(path)}, '\\\\[^\\\\]*$', '')) ELSE '' END)"

    def clip(self, x, n=120):
        v = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
        return f"(CASE WHEN length({v}) <= {n} THEN {v} ELSE substr({v}, 1, {n - 1}) || '\u2026' END)"

    def join(self, *parts):
        return "(" + " || ".join(p if p.startswith(("coalesce", "lower")) else quoted(p) for p in parts) + ")"

    def number(self, x):
        return f"coalesce(TRY_CAST(trim({x}) AS BIGINT), -1)"

    def all(self, *c):
        return "(" + " AND ".join(c) + ")"

    def any(self, *c):
        return "(" + " OR ".join(c) + ")"

    def no(self, c):
        return f"(NOT {c})"

    def is_(self, x, value):
        return f"({x} = {quoted(value)})"

    def at_least(self, x, n):
        return f"({x} >= {n})"

    def pick(self, *pairs, otherwise):
        return "(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {otherwise} END)"


_D = SqlOps()
_SLOTS = f"list_filter([{', '.join(f'CASE WHEN {c} THEN {{key: {quoted(k)}, value: {_D.clip(v)}}} END' for k, c, v in targets.slots(_D))}], lambda x: x IS NOT NULL)"
_HAS_PARENT, _LINE, _PLACE = targets.fallback(_D)
_OTHERWISE = f"CASE WHEN {_HAS_PARENT} THEN {{key: 'expected_parent', value: {_D.clip(_LINE)}}} ELSE {{key: 'system32_path', value: {_D.clip(_PLACE)}}} END"


def _any(names) -> str:
    return f"list_has_any(keys, [{', '.join(map(quoted, names))}])"


_CMD = "concat_ws(' ', nullif(CommandLine, ''), nullif(TargetFilename, ''))"
THREAT = f"""CASE WHEN gold = 'benign' THEN NULL WHEN EventID = '4625' THEN 'credential_stuffing'
 WHEN {_any(['privilege_escalation'])} OR ({_any(['system_context_exec'])} AND {_any(['masquerading_name', 'temp_path_exec'])}) THEN 'privilege_escalation'
 WHEN {_any(targets.THREATS_BY_INDICATOR['lateral'])} THEN 'lateral_movement' WHEN regexp_matches({_CMD}, {quoted(targets.EXFILTRATION)}) THEN 'data_exfiltration' WHEN {_any(['discovery_command'])} THEN 'reconnaissance'
 WHEN {_any(targets.THREATS_BY_INDICATOR['malware'])} THEN 'malware' WHEN regexp_matches({_CMD}, {quoted(targets.MINING)}) THEN 'cryptomining' WHEN regexp_matches({_CMD}, {quoted(targets.ANTIFORENSIC)}) THEN 'ransomware'
 WHEN (EventID IN ('11', '12', '13', '14') AND regexp_matches({_CMD}, {quoted(targets.AUTORUN)})) OR {_any(targets.THREATS_BY_INDICATOR['weak'])} THEN 'malware' ELSE 'unknown' END"""


def case_of(x: str, values: dict, otherwise: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items()) + f" ELSE {otherwise} END"


_BENIGN = in_list(targets.BENIGN_KEYS)
_PHRASE = case_of("k", targets.PHRASES)
REASONING = f"""{case_of('EventID', targets.ACTIONS, "'Event'")} || ' by ' || coalesce(nullif({basename('Image')}, ''), nullif({basename('TargetFilename')}, ''), 'the subject') || ': '
 || array_to_string((CASE WHEN len(bad) > 0 THEN bad ELSE good END)[1:2], ' and ') || '. ' || {case_of('gold', targets.VERDICTS)} || CASE WHEN len(bad) > 0 AND len(good) > 0 AND gold <> 'benign' THEN ' The mitigating evidence (' || good[1] || ') does not outweigh it.'
 WHEN len(bad) > 0 AND len(good) > 0 AND gold = 'benign' THEN ' ' || upper(good[1][1]) || lower(substr(good[1], 2)) || ', which accounts for it.' WHEN len(bad) > 0 AND gold = 'benign' THEN ' The pattern is documented normal behaviour for this binary.' ELSE '' END"""
#: Rendered attack and benign events with gold classes, indicators and their names.
TARGETS = f"""{SIGNED_EVENTS}, pol AS (SELECT * REPLACE (CASE WHEN EventID IN ('1', '7', '4688') THEN {SIGNED} END AS Signed, CASE WHEN EventID IN ('1', '7', '4688') THEN {SIGNER} END AS Signer) FROM norm),
 classed AS (SELECT *, CASE ord % 3 WHEN 0 THEN 'benign' WHEN 1 THEN 'suspicious' ELSE 'malicious' END AS gold, {_SLOTS} AS found FROM pol),
 ind AS (SELECT *, CASE WHEN len(found) > 0 THEN found[1:4] ELSE [{_OTHERWISE}] END AS indicators FROM classed), keyed AS (SELECT *, list_transform(indicators, lambda x: x.key) AS keys FROM ind),
 argued AS (SELECT *, list_transform(list_filter(keys, lambda k: k NOT IN {_BENIGN}), lambda k: {_PHRASE}) AS bad, list_transform(list_filter(keys, lambda k: k IN {_BENIGN}), lambda k: {_PHRASE}) AS good FROM keyed)"""
