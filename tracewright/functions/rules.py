"""Rule tables compiled to CASE expressions: scores, proposals, boundaries and floors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.contract import any_prefix, lookup
from tracewright.functions.signatures import basename

# Patterns, weights and labels.
HEURISTICS = (
    (r"(?i)-enc(odedcommand)?\s|frombase64string|::frombase64", 3.0, "encoded command"),
    (r"(?i)\\(temp|appdata|programdata|users\\public|windows\\tasks)\\[^\\\s\"]*\.(exe|dll|scr|ps1|vbs|js|hta|bat|cmd|sct|cpl)", 2.5, "payload in writable path"),
    (r"(?i)\b(rundll32|regsvr32|mshta|certutil|bitsadmin|wmic|cscript|wscript|installutil|msbuild|odbcconf|hh|control)\.exe", 1.5, "LOLBin"),
    (r"(?i)https?://(?!.*\.(icorp|corp|local|internal))", 2.0, "remote fetch"),
    (r"(?i)-w\s+hidden|-windowstyle\s+hidden|-nop\b|-noni\b|executionpolicy\s+bypass", 2.0, "concealment / policy bypass"),
    (r"(?i)(minidump|lsass|sekurlsa|comsvcs\.dll,\s*minidump)", 3.5, "credential access"),
    (r"(?i)(vssadmin.*delete|wbadmin.*delete|bcdedit.*recoveryenabled)", 3.5, "destruction"),
    (r"(?i)DestinationPort.: ?(4444|1337|8080|8443|9001|1234|31337|6666)", 2.0, "uncommon C2 port"),
    (r"(?i)(whoami|net\s+(group|user|localgroup)|nltest|systeminfo|net\s+view)\b", 1.0, "discovery"),
)
BAD_LINEAGE = (
    ("winword.exe", "cmd.exe"), ("winword.exe", "powershell.exe"), ("excel.exe", "cmd.exe"), ("excel.exe", "powershell.exe"), ("outlook.exe", "cmd.exe"),
    ("w3wp.exe", "cmd.exe"), ("w3wp.exe", "powershell.exe"), ("services.exe", "cmd.exe"), ("services.exe", "powershell.exe"), ("hh.exe", "cmd.exe"),
    ("sqlservr.exe", "cmd.exe"), ("wmiprvse.exe", "rundll32.exe"), ("mshta.exe", "powershell.exe"), ("winlogon.exe", "cmd.exe"),
)
STOP_TOKENS = (
    "sysmon", "evtx", "windows", "microsoft", "attack", "sample", "test", "log", "logs", "event", "events", "and", "the", "via", "with", "from", "win",
    "win7", "win10", "x64", "x86", "exe", "dll", "proc", "process", "security", "operational", "detected", "detection", "poc", "demo",
)
WRITABLE = r"(?i)\\(temp|appdata|programdata|users\\public|windows\\tasks|downloads|perflogs)\\"
RANK = {"drop": -1, "none": 0, "low": 1, "medium": 2, "high": 3, "critical": 4}
BUCKET = {"none": "benign", "low": "benign", "medium": "suspicious", "high": "malicious", "critical": "malicious", "drop": "drop"}
CLASS_RANK = {"benign": 0, "suspicious": 1, "malicious": 2}
CLASS_SEVERITY = {"benign": "none", "suspicious": "medium", "malicious": "high"}
#: name, all of these labels, severity
PROPOSALS = (
    ("destruction", ("destruction",), "critical"),
    ("credential-access", ("credential access",), "critical"),
    ("encoded-and-hidden", ("encoded command", "concealment"), "critical"),
    ("encoded-command", ("encoded command",), "high"),
    ("drop-and-fetch", ("payload in writable path", "remote fetch"), "high"),
    ("payload-drop", ("payload in writable path",), "high"),
    ("anomalous-lineage", ("anomalous lineage",), "high"),
    ("remote-fetch", ("remote fetch",), "high"),
    ("concealment", ("concealment",), "high"),
    ("c2-port", ("uncommon C2 port",), "high"),
    ("lolbin", ("LOLBin",), "medium"),
    ("discovery", ("discovery",), "medium"),
)
TACTICS = {
    "Credential Access": "critical", "Command and Control": "critical", "Lateral Movement": "high", "Privilege Escalation": "high", "Persistence": "high",
    "Defense Evasion": "high", "Execution": "high", "Discovery": "medium",
}
#: Why a rule proposes what it does.
REASONS = {
    "ambient": "occurs on a real working machine or across unrelated captures", "low-score": "no attack signal found; expected to be dropped",
    "destruction": "shadow copy or backup deletion -- ransomware precursor, no benign reading", "credential-access": "LSASS or secret material access",
    "encoded-and-hidden": "encoded payload plus deliberate concealment -- intent is not ambiguous", "encoded-command": "base64 / -enc payload",
    "drop-and-fetch": "remote fetch writing an executable to a user-writable path", "payload-drop": "executable content staged in a writable path",
    "anomalous-lineage": "parent-child pair that does not occur in normal operation", "remote-fetch": "inline retrieval from an external host",
    "concealment": "hidden window or execution-policy bypass", "c2-port": "outbound to a port associated with implant defaults",
    "lolbin": "living-off-the-land binary with no other aggravating signal -- dual-use", "discovery": "enumeration; identical whether run by an admin or an intruder",
    "unclassified": "no rule matched; needs a human read",
} | {f"tactic:{t}": f"capture filed under {t.lower()} with no specific behavioural signal" for t in TACTICS}
EXCULPATORY = ("ambient in real capture", "unrelated captures", "common image/parent pair on a real host")
CHANGES = (
    ("account_create_or_grant", r"\bnet1?(?:\.exe)?\b[^\n]*?\b(?:user|localgroup|group)\b[^\n]*?/(?:add|delete)"),
    ("scheduled_task_create", r"\bschtasks(?:\.exe)?\b[^\n]*?/create|\bat(?:\.exe)?\s+\d{1,2}:\d{2}"),
    ("service_create", r"\bsc(?:\.exe)?\b[^\n]*?\b(?:create|config)\b[^\n]*?binpath|\bnew-service\b"),
    ("defender_exclusion", r"windows defender\\exclusions|add-mppreference[^\n]*?exclusion"),
    ("autorun_write", r"\breg(?:\.exe)?\b[^\n]*?\badd\b[^\n]*?(?:currentversion\\run|\\winlogon\\|image file execution)"),
)
AUTORUN_PATH = r"(?i)(currentversion\\run(?:once)?\b|\\winlogon\\(?:shell|userinit)|image file execution options\\|windows defender\\exclusions)"
OBSERVE = (
    r"(?i)(\bnet1?(?:\.exe)?\b[^\n]*?\b(?:user|localgroup|group|view|share|accounts)\b(?![^\n]*?/(?:add|delete))"
    r"|\b(?:whoami|systeminfo|nltest|hostname|ipconfig|tasklist|quser|qwinsta|arp)\b|\badfind\b|\bdsquery\b|\bnbtscan\b|\breg(?:\.exe)?\b[^\n]*?\bquery\b)"
)
NORMAL = {"B010": "IIS worker to SQL Server on 1433, by hostname, internal subnet"}
PROGRAM_DIRS = ("c:\\windows\\system32", "c:\\windows\\syswow64", "c:\\windows\\microsoft.net", "c:\\program files")
AUTORUN = (
    r"(?i)CurrentVersion\\+Run(Once)?(Ex)?\b|CurrentVersion\\+Policies\\+Explorer\\+Run|Winlogon\\+(Shell|Userinit|Notify)|Start ?Menu\\+Programs\\+Startup"
    r"|Image File Execution Options\\+[^\\\s]+\\+Debugger|Environment\\+UserInitMprLogonScript"
)
ANTIFORENSIC = (
    r"(?i)\bMRU\b|RecentDocs|wevtutil\s+(cl|clear-log)|netsh\s+trace\s+(start|stop)|fltmc(\.exe)?\s+unload|Clear-EventLog|/dontLog:true"
    r"|ScriptBlockLogging|EnableScriptBlockLogging"
)
REGISTRY_READ = r"(?i)\breg(\.exe)?\s+query\b|\bGet-ItemProperty\b|/s\s+/f\b"


def ranked_severity(c: Column) -> Column:
    """Ordinal of a severity; null counts as drop."""
    return F.coalesce(lookup(c, RANK), F.lit(-1))


def bucket(severity: Column) -> Column:
    return lookup(F.coalesce(severity, F.lit("drop")), BUCKET)


def class_rank(c: Column) -> Column:
    return lookup(c, CLASS_RANK)


def source_tokens(src: Column) -> Column:
    """Words of a capture's file name that may name its technique: split at case changes, over 3 letters, no stop words."""
    stem = F.regexp_replace(F.substring_index(src, "/", -1), r"(?<=[^.])\.[^.]*$", "")
    parts = F.split(F.regexp_replace(stem, r"(?<=[a-z])(?=[A-Z])", " "), r"[^A-Za-z0-9]+")
    return F.array_distinct(F.filter(F.transform(parts, F.lower), lambda t: (F.length(t) > 3) & ~t.isin(*STOP_TOKENS) & ~t.rlike(r"^\d+$")))


def heuristic_labels(event: Column) -> Column:
    return F.array_compact(F.array(*(F.when(event.rlike(p), F.lit(label)) for p, _, label in HEURISTICS)))


def heuristic_score(labels: Column) -> Column:
    """The sum of the weights of heuristic_labels()."""
    return F.aggregate(labels, F.lit(0.0), lambda total, x: total + lookup(x, {label: w for _, w, label in HEURISTICS}))


def bad_lineage(parent: Column, image: Column) -> Column:
    pair = F.concat(basename(parent), F.lit(">"), basename(image))
    return pair.isin(*(f"{p}>{i}" for p, i in BAD_LINEAGE))


#: Fixed value: a signature that is so frequent in benign captures is dropped without a reader.
AMBIENT_DROP = 25


def auto_drop(event_id: Column, target: Column, image: Column, ambient: Column) -> Column:
    """Why a rule may drop an event without a reader; null if none may."""
    plain = (F.coalesce(target, F.lit("")) != "") & ~F.coalesce(target, F.lit("")).rlike(WRITABLE) & ~F.coalesce(image, F.lit("")).rlike(WRITABLE)
    return F.when((event_id == "7") & plain, F.lit("system module")).when(ambient >= AMBIENT_DROP, F.lit("ambient"))


def drop_reason(rule: Column, ambient: Column) -> Column:
    """The reason of auto_drop() in full, with the count of an ambient signature."""
    return F.when(rule == "system module", F.lit("system module loaded by a system-path binary -- image loads carry signal only for sideloading")).when(
        rule == "ambient", F.concat(F.lit("signature occurs "), ambient.cast("string"), F.lit("x in the real benign capture"))
    )


def has(why: Column, needle: str) -> Column:
    return F.exists(why, lambda x: x.contains(needle))


def propose(why: Column, score: Column, src: Column) -> Column:
    """struct<severity, rule>: exculpation, low score, behaviour rules in order, the tactic of the capture, nothing."""
    pair = lambda s, r: F.struct(F.lit(s).cast("string").alias("severity"), (r if isinstance(r, Column) else F.lit(r)).alias("rule"))
    out = F.when(reduce(lambda a, b: a | b, (has(why, x) for x in EXCULPATORY)) & (score < 4.0), pair(None, "ambient"))
    out = out.when(score < 1.0, pair(None, "low-score"))
    for name, needles, severity in PROPOSALS:
        out = out.when(reduce(lambda a, b: a & b, (has(why, x) for x in needles)), pair(severity, name))
    tactic = F.substring_index(src, "/", 1)
    for name, severity in TACTICS.items():
        out = out.when(tactic == name, pair(severity, f"tactic:{name}"))
    return out.otherwise(pair(None, "unclassified"))


def strength(rule: Column) -> Column:
    """How far a proposal's rule may be trusted."""
    return F.when(rule.isNull() | rule.isin("unclassified"), F.lit("none")).when(rule.startswith("tactic:"), F.lit("weak")).otherwise(F.lit("strong"))


def boundary(row_id: Column, event_id: Column, event: Column) -> Column:
    """struct<want, reason>: named normal events, lasting changes, observation; null if no rule applies."""
    pair = lambda w, r: F.struct(F.lit(w).alias("want"), F.lit(r).alias("reason"))
    out = F.when(row_id == "B010", pair("benign", f"normal: {NORMAL['B010']}"))
    for name, pattern in CHANGES:
        out = out.when(event.rlike(f"(?i){pattern}"), pair("malicious", f"state change: {name}"))
    out = out.when(event_id.isin("12", "13", "14") & event.rlike(AUTORUN_PATH), pair("malicious", "state change: autorun_write (registry set)"))
    return out.when(event.rlike(OBSERVE), pair("observe", "observation only"))


def severity_floor(known_bad: Column, event: Column) -> Column:
    """Which rule raises an event to high at least; null if none."""
    return (
        F.when(known_bad, F.lit("R1 known-bad binary (by execution)"))
        .when(event.rlike(AUTORUN) & ~event.rlike(REGISTRY_READ), F.lit("R2 autorun-location registry write or delete"))
        .when(event.rlike(ANTIFORENSIC), F.lit("R3 anti-forensic / telemetry tampering"))
    )


def in_program_dir(path: Column) -> Column:
    return any_prefix(path, PROGRAM_DIRS)
