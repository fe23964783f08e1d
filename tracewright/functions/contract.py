"""The event contract: field order, rendering, signature policy and validation, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the contract.
FIELDS = (
    "EventID", "EventType", "Image", "CommandLine", "ParentImage", "ParentCommandLine", "User", "Signed", "Signer", "DestinationIp",
    "DestinationPort", "DestinationHostname", "TargetFilename", "LogonType", "AuthPackage",
)
EVENT_TYPES = {
    1: "Process Create", 3: "Network Connection", 7: "Image Load", 8: "Remote Thread", 10: "Process Access", 11: "File Create",
    12: "Registry Create", 13: "Registry Set", 22: "DNS Query", 4624: "Logon", 4625: "Failed Logon", 4688: "Process Create", 4697: "Service Install",
}
MAX_COMMAND = 512
TRUNCATED = "<truncated>"
MS_SIGNER = "Microsoft Windows"
MS_CORP = "Microsoft Corporation"
VENDORS = {
    "chrome.exe": "Google LLC", "GoogleUpdate.exe": "Google LLC", "firefox.exe": "Mozilla Corporation", "Code.exe": MS_CORP, "OneDrive.exe": MS_CORP,
    "Teams.exe": MS_CORP, "OUTLOOK.EXE": MS_CORP, "EXCEL.EXE": MS_CORP, "WINWORD.EXE": MS_CORP, "Update.exe": "Slack Technologies, LLC",
    "slack.exe": "Slack Technologies, LLC", "NVIDIA Web Helper.exe": "NVIDIA Corporation", "Dropbox.exe": "Dropbox, Inc", "7zG.exe": "Igor Pavlov",
    "PsExec.exe": MS_CORP, "PsExec64.exe": MS_CORP, "PSEXESVC.exe": MS_CORP, "python.exe": "Python Software Foundation", "node.exe": "OpenJS Foundation",
    "AcroRd32.exe": "Adobe Inc.", "AnyDesk.exe": "AnyDesk Software GmbH", "TeamViewer.exe": "TeamViewer Germany GmbH", "putty.exe": "Simon Tatham",
    "plink.exe": "Simon Tatham", "7z.exe": "Igor Pavlov", "ProcessHacker.exe": "Winsider Seminars & Solutions Inc.",
}
SYSTEM_DIRS = ("c:\\windows\\system32", "c:\\windows\\syswow64", "c:\\windows\\winsxs", "c:\\program files", "c:\\program files (x86)")
WRITABLE_WINDOWS_DIRS = (
    "c:\\windows\\temp", "c:\\windows\\tasks", "c:\\windows\\debug", "c:\\windows\\tracing", "c:\\windows\\registration\\crmlog",
    "c:\\windows\\system32\\spool\\drivers\\color", "c:\\windows\\system32\\tasks",
)
SIGNED_EVENTS = ("1", "7", "4688")

CONTRACT = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])


def any_prefix(c: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def lookup(c: Column, values: dict) -> Column:
    """The value of a small fixed table; null for a key that it lacks. The key is evaluated once."""
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[c]


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalise_command(c: Column) -> Column:
    """Undo doubled percent signs, then cut after MAX_COMMAND characters with a marker."""
    plain = F.replace(c, F.lit("%%"), F.lit("%"))
    return F.when(F.length(plain) > MAX_COMMAND, F.concat(F.substring(plain, 1, MAX_COMMAND), F.lit(TRUNCATED))).otherwise(plain)


def event_type(event_id: Column) -> Column:
    """The usual EventType of an EventID; null for an unknown one."""
    return lookup(event_id, {str(k): v for k, v in EVENT_TYPES.items()})


def authenticode(image: Column) -> Column:
    """struct<signed, signer> from an image path; null without a path. Vendor names match by case, folders do not."""
    low, base = F.lower(image), F.substring_index(image, "\\", -1)
    vendor = lookup(base, VENDORS)
    public = any_prefix(low, WRITABLE_WINDOWS_DIRS) | low.startswith("c:\\users\\public")
    system = any_prefix(low, SYSTEM_DIRS) | low.startswith("c:\\windows\\")
    pair = lambda s, n: F.struct(F.lit(s).alias("signed"), n.cast("string").alias("signer"))
    return F.when(image.isNull() | (image == ""), F.lit(None)).when(vendor.isNotNull(), pair("true", vendor)).when(public, pair("false", F.lit(None))).when(system, pair("true", F.lit(MS_SIGNER))).otherwise(pair("false", F.lit(None)))


def with_signature_policy(events: DataFrame, mode: str) -> DataFrame:
    """strip: no Signed and Signer at all. backfill: on process and image-load events from the path, kept where given."""
    if mode == "strip":
        return events.withColumns({"Signed": F.lit(None).cast("string"), "Signer": F.lit(None).cast("string")})
    if mode != "backfill":
        raise ValueError(f"unknown signature mode {mode!r}")
    carries, given, made = F.col("EventID").isin(*SIGNED_EVENTS), F.col("Signed").isNotNull(), authenticode(F.col("Image"))
    return events.withColumns({
        "Signed": F.when(carries, F.coalesce("Signed", made["signed"])),
        "Signer": F.when(carries, F.when(given, F.col("Signer")).otherwise(F.coalesce(made["signer"], "Signer"))),
    })


def normalised(events: DataFrame) -> DataFrame:
    """The contract's command-line rule on both command lines."""
    return events.withColumns({c: normalise_command(F.col(c)) for c in ("CommandLine", "ParentCommandLine")})


def body(prefix: str = "") -> Column:
    """`Key: value` lines in contract order; absent (null) fields are left out."""
    return F.concat_ws("\n", *(F.when(F.col(prefix + f).isNotNull(), F.concat(F.lit(f"{f}: "), F.col(prefix + f))) for f in FIELDS))


def rendered(events: DataFrame, mode: str = "backfill", name: str = "event") -> DataFrame:
    """events with EventType filled in, commands normalised, the signature policy applied, and the rendered body."""
    filled = normalised(events.withColumn("EventType", F.coalesce("EventType", event_type(F.col("EventID")))))
    return with_signature_policy(filled, mode).withColumn(name, body())


def violations(event: Column) -> Column:
    """array<string>: what breaks the contract in a rendered body, line by line, then order and duplicates."""
    order = F.array(*map(F.lit, FIELDS))
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    lines = F.when(event == "", F.array().cast("array<string>")).otherwise(F.split(event, "\n"))
    keyed = F.filter(lines, lambda x: x.contains(":"))
    keys = F.transform(keyed, lambda x: strip(F.substring_index(x, ":", 1)))
    value = lambda x: strip(F.regexp_replace(x, r"^[^:]*:", ""))
    by_line = F.flatten(F.transform(lines, lambda x: F.when(~x.contains(":"), F.array(F.concat(F.lit("no colon: "), x))).otherwise(F.concat(
        F.when(~F.array_contains(order, strip(F.substring_index(x, ":", 1))), F.array(F.concat(F.lit("off-contract field: "), strip(F.substring_index(x, ":", 1))))).otherwise(F.array().cast("array<string>")),
        F.when(value(x) == "", F.array(F.concat(F.lit("empty value: "), strip(F.substring_index(x, ":", 1))))).otherwise(F.array().cast("array<string>")),
    ))))
    places = F.filter(F.transform(keys, lambda k: F.array_position(order, k)), lambda p: p > 0)
    return F.concat(
        by_line,
        F.when(places != F.array_sort(places), F.array(F.lit("field order violated"))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(F.array_distinct(keys)) != F.size(keys), F.array(F.lit("duplicate fields"))).otherwise(F.array().cast("array<string>")),
    )


def wrapped_fields(event: Column) -> Column:
    """map of the fields of a body whose values may go on over lines; what stands before the first field is left out.

    The last of equal keys wins.
    """
    pieces = F.filter(F.split(event, r"\n(?=[A-Za-z][A-Za-z0-9_]*:)"), lambda x: x.rlike(r"^[A-Za-z][A-Za-z0-9_]*:"))
    pairs = F.transform(pieces, lambda x: F.struct(F.substring_index(x, ":", 1).alias("k"), F.regexp_replace(x, r"^[^:]*: ?", "").alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def strict_fields(event: Column) -> Column:
    """fields_of() a body, null if it has a line without a colon."""
    return F.when(~F.exists(F.split(event, "\n"), lambda x: ~x.contains(":")), fields_of(event))


def fields_of(event: Column) -> Column:
    """struct of the contract fields of a rendered body; lines without a colon are skipped, the last of equal keys wins."""
    lines = F.transform(F.split(event, "\n"), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.regexp_replace(F.regexp_replace(x, r"^[^:]*:", ""), r"^\s+|\s+$", "").alias("v"), x.contains(":").alias("ok")))

    def last(name: str) -> Column:
        return F.try_element_at(F.filter(lines, lambda x: x["ok"] & (x["k"] == name)), F.lit(-1))["v"]

    return F.struct(*(last(f).alias(f) for f in FIELDS))
