"""Views that give the star-schema tables the shape of telemetry, labelled corpora and predictions.

Every text column picks from a short fixed list by an integer expression that Spark SQL and DuckDB read alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.contract import FIELDS

IMAGES = [
    "C:\\Windows\\System32\\svchost.exe", "C:\\Windows\\System32\\cmd.exe", "C:\\Windows\\System32\\WindowsPowerShell\\v1.0\\powershell.exe",
    "C:\\Program Files\\Google\\Chrome\\Application\\chrome.exe", "C:\\Users\\Public\\tool.exe", "C:\\Users\\alice\\AppData\\Local\\Temp\\drop.exe",
    "C:\\Windows\\System32\\rundll32.exe", "C:\\Windows\\Temp\\x.exe", "C:\\Windows\\System32\\reg.exe", "C:\\Windows\\System32\\net.exe", "D:/apps/agent.exe", None,
]
PARENTS = ["C:\\Windows\\explorer.exe", "C:\\Windows\\System32\\services.exe", "C:\\Office\\WINWORD.EXE", "C:\\inetpub\\w3wp.exe", "C:\\Users\\Public\\tool.exe", None, "C:\\Windows\\System32\\mshta.exe"]
COMMANDS = [
    "svchost.exe -k netsvcs -p", "cmd.exe /c whoami", "powershell.exe -nop -w hidden -enc SQBFAFgAIAAoAE4AZQB3AC0ATwBiAGoAZQBjAHQAIABOAGUAdAA=",
    "chrome.exe --type=renderer --pid 4821", "tool.exe https://files.example.net/a.bin", "%%TEMP%%\\drop.exe 10.14.7.33 9f86d081884c7d659a2feaa0c55ad015",
    "rundll32.exe comsvcs.dll, MiniDump 624 C:\\Windows\\Temp\\l.dmp full", "vssadmin.exe delete shadows /all", "reg add HKCU\\Software\\Microsoft\\Windows\\CurrentVersion\\Run /v u",
    "reg query HKCU\\Software\\Microsoft\\Windows\\CurrentVersion\\Run", "net user backdoor P4ss /add", "net view \\\\server", None, "x" * 520,
    "schtasks /create /tn up /tr C:\\Users\\bob\\run.exe", "wevtutil cl Security", "tool.exe http://updates.corp/a",
]
TARGETS = [
    "C:\\Windows\\System32\\kernel32.dll", "C:\\Users\\alice\\Downloads\\a1b2c3d4.tmp", "HKLM\\Software\\Microsoft\\Windows\\CurrentVersion\\Run\\upd", "C:\\Windows\\Temp\\evil.dll",
    "C:\\Windows\\System32\\newsvc.exe", "HKLM\\System\\CurrentControlSet\\Services\\abc\\ImagePath", "\\Device\\NamedPipe\\pipe\\x1", None,
]
USERS = ["NT AUTHORITY\\SYSTEM", "CORP\\alice", "CORP\\Guest", "NT AUTHORITY\\NETWORK SERVICE", None]
ADDRESSES = ["10.0.0.5", "203.0.113.7", "198.51.100.20"]
PORTS = ["443", "445", "4444", "51515", "99", "8081", "x1", "3389"]
HOSTNAMES = ["files.example.net", None, "dc01.corp"]
SOURCES = ["Execution/sysmon_powershell_hidden.evtx", "Credential Access/LsassMiniDump.evtx", "Discovery/net_view.evtx", "Other/misc.evtx"]

# field -> (values, index expression over user_id and k)
CHOICES = {
    "Image": (IMAGES, "user_id + k"), "ParentImage": (PARENTS, "user_id * 3 + k"), "CommandLine": (COMMANDS, "user_id + k * 5"), "ParentCommandLine": ([None, "parent.exe %%1"], "k"),
    "User": (USERS, "user_id"), "TargetFilename": (TARGETS, "k + user_id * 2"), "DestinationIp": (ADDRESSES, "k"), "DestinationPort": (PORTS, "user_id + k"),
    "DestinationHostname": (HOSTNAMES, "k + user_id"), "LogonType": (["2", "3", "10", "0"], "k"), "AuthPackage": (["NTLM", "Kerberos", "Negotiate"], "user_id + k"),
}
#: Fields that a kind of event carries.
CARRIED = {
    "CommandLine": ("1",), "ParentCommandLine": ("1",), "ParentImage": ("1", "7"), "TargetFilename": ("7", "11", "13"), "DestinationIp": ("3",), "DestinationPort": ("3",),
    "DestinationHostname": ("3",), "LogonType": ("4624", "4625"), "AuthPackage": ("4624", "4625"), "User": ("1", "11", "13", "4624", "4625"),
}
EVENT_ID = """CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN CASE WHEN k % 3 = 0 THEN '7' ELSE '3' END WHEN 'purchase' THEN '11'
 WHEN 'error' THEN '13' ELSE CASE WHEN k % 4 = 0 THEN '4625' ELSE '4624' END END"""
GOLD = "CASE WHEN quality = 0 AND toxic = 1 THEN 'malicious' WHEN quality = 0 OR toxic = 1 THEN 'suspicious' ELSE 'benign' END"
CUT = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task works on at most, on average.
ROWS = 50_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a table (read so far, a row a key) dealt evenly to tasks of at most ROWS rows, and to all cores.

    How a file lies says nothing of the work: one row group, however large, is one task, and parts without a row group
    are empty ones. So the longest task, and what it sorts or holds, stays the same for tables of any size. Only the columns read are
    shuffled, before anything is made of them; the count is that of the footers. Spark moves filters below a shuffle, with all that they are
    made of, to the few tasks that read; below a generator of their columns it does not, so rows pass one that gives each as it is.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS))
    return df.repartition(tasks, key).select(F.inline(F.array(F.struct(*df.columns))))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract record for each event, with ord (unique), src (capture) and attack (not part of the benign profile)."""
    e = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "props"), "event_id")
    e = e.withColumn("k", F.get_json_object("props", "$.k").cast("long")).drop("props")
    e = e.select("*", F.expr(EVENT_ID).alias("EventID"))
    made = []
    for field in FIELDS[2:]:
        if field not in CHOICES:
            made.append(F.lit(None).cast("string").alias(field))
            continue
        values, index = CHOICES[field]
        picked = F.get(F.array(*(F.lit(v).cast("string") for v in values)), F.expr(f"CAST(({index}) % {len(values)} AS INT)"))
        made.append((F.when(F.col("EventID").isin(*CARRIED[field]), picked) if field in CARRIED else picked).alias(field))
    sources = F.get(F.array(*map(F.lit, SOURCES)), F.expr("CAST(user_id % 4 AS INT)"))
    src = F.regexp_replace(sources, r"\.evtx$", F.concat(F.lit("_"), F.expr("CAST(user_id % 12 AS STRING)"), F.lit(".evtx")))
    return e.select(F.col("event_id").alias("ord"), src.alias("src"), (F.col("ts") >= F.expr(f"TIMESTAMP_NTZ '{CUT} 00:00:00'")).alias("attack"), "EventID", F.lit(None).cast("string").alias("EventType"), *made)


def unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def telemetry_sql() -> str:
    """The same view for DuckDB."""
    made = []
    for field in FIELDS[2:]:
        if field not in CHOICES:
            made.append(f"CAST(NULL AS VARCHAR) AS {field}")
            continue
        values, index = CHOICES[field]
        picked = f"([{', '.join(map(quoted, values))}])[1 + ({index}) % {len(values)}]"
        made.append((f"CASE WHEN EventID IN ({', '.join(map(quoted, CARRIED[field]))}) THEN {picked} END" if field in CARRIED else picked) + f" AS {field}")
    return f"""SELECT event_id AS ord, replace(([{', '.join(map(quoted, SOURCES))}])[1 + user_id % 4], '.evtx', '_' || CAST(user_id % 12 AS VARCHAR) || '.evtx') AS src,
 ts >= TIMESTAMP '{CUT} 00:00:00' AS attack, EventID, CAST(NULL AS VARCHAR) AS EventType, {', '.join(made)}
 FROM (SELECT *, {EVENT_ID} AS EventID FROM (SELECT event_id, user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: ord, src, family (language), event (text), gold."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return d.select(F.col("doc_id").alias("ord"), F.col("source").alias("src"), F.col("lang").alias("family"), F.col("text").alias("event"), F.expr(GOLD).alias("gold"))


CORPUS_SQL = f"SELECT doc_id AS ord, source AS src, lang AS family, text AS event, {GOLD} AS gold FROM documents JOIN labels USING (doc_id)"

#: Scores of four severities and a gold class, by integer arithmetic on events.
PREDS = """SELECT event_id AS id, user_id % 3 AS subset, CASE (k + user_id) % 3 WHEN 0 THEN 'benign' WHEN 1 THEN 'suspicious' ELSE 'malicious' END AS gold,
 CAST(-((k * 7 + user_id) % 13) AS DOUBLE) AS ll_none, CAST(-((k * 5 + user_id) % 17) - 2 AS DOUBLE) AS ll_low, CAST(-((k * 3 + user_id) % 11) AS DOUBLE) AS ll_medium,
 CAST(-((k * 11 + user_id) % 19) AS DOUBLE) AS ll_high FROM keyed"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "props"), "event_id")
    e = e.select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return spark.sql(PREDS.replace("FROM keyed", "FROM {keyed}"), keyed=e)


SCORES_SQL = PREDS.replace("FROM keyed", "FROM (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
