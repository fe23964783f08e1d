"""Readers for event XML, rendered events, decision files, answers and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import contract
from tracewright.functions.contract import CONTRACT, EVENT_TYPES, FIELDS, event_type, fields_of, let, lookup
from tracewright.functions.rules import BUCKET

#: EventData name -> contract field; of several entries for a field the first with a value wins.
EVENT_DATA = {
    "Image": "Image", "CommandLine": "CommandLine", "ParentImage": "ParentImage", "ParentCommandLine": "ParentCommandLine", "User": "User", "TargetUserName": "User",
    "Signed": "Signed", "Signature": "Signer", "DestinationIp": "DestinationIp", "DestinationPort": "DestinationPort", "DestinationHostname": "DestinationHostname",
    "IpAddress": "DestinationIp", "TargetFilename": "TargetFilename", "TargetObject": "TargetFilename", "ImageLoaded": "TargetFilename", "LogonType": "LogonType",
    "AuthenticationPackageName": "AuthPackage", "LmPackageName": "AuthPackage",
}
MAX_EXTRACTED = 512
NOTHING = ("", "-", "N/A", "0x0")
XML_SCHEMA = "System struct<EventID: string>, EventData struct<Data: array<struct<_Name: string, _VALUE: string>>>"


def parse_events(df: DataFrame, xml: str) -> DataFrame:
    """Contract records of a column of event XML; other columns stay.

    Left out: text that is no event, unknown EventIDs, and events without any of Image, TargetFilename,
    DestinationIp and User. Of several entries that name a field the first with a value counts.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col(xml), r"\sxmlns(:\w+)?=(\"[^\"]*\"|'[^']*')", ""), r"<EventID [^>]*>", "<EventID>")
    # a generator between two steps: filters are not pushed below it, so the XML is parsed once
    once = lambda frame, c, name: frame.select("*", F.explode(F.array(c)).alias(name))
    parsed = once(df, F.from_xml(plain, XML_SCHEMA), "_e").withColumn("_id", F.trim(F.col("_e.System.EventID")))
    parsed = parsed.where(F.col("_id").isin(*(str(k) for k in EVENT_TYPES)))
    given = F.filter("_e.EventData.Data", lambda x: x["_VALUE"].isNotNull() & ~F.trim(x["_VALUE"]).isin(*NOTHING))
    names = {f: [k for k, v in EVENT_DATA.items() if v == f] or [f] for f in (*dict.fromkeys(EVENT_DATA.values()), "SignatureStatus")}
    first = lambda data, wanted: F.trim(F.get(F.filter(data, lambda x: x["_Name"].isin(*wanted)), F.lit(0))["_VALUE"])
    parsed = once(parsed, let(given, lambda data: F.struct(*(first(data, wanted).alias(f) for f, wanted in names.items()))), "_f")
    field = lambda name: F.col(f"_f.{name}")
    made = {f: field(f) for f in dict.fromkeys(EVENT_DATA.values())}
    status, cut = field("SignatureStatus"), made["CommandLine"]
    valid = F.when(F.lower(status) == "valid", F.lit("true")).otherwise(F.lit("false"))
    made["Signed"] = F.when(status.isNotNull(), valid).otherwise(F.coalesce(made["Signed"], F.when(made["Signer"].isNotNull(), F.lit("true"))))
    made["CommandLine"] = F.when(F.length(cut) > MAX_EXTRACTED, F.concat(F.substring(cut, 1, MAX_EXTRACTED), F.lit("..."))).otherwise(cut)
    out = parsed.withColumns({"EventID": F.col("_id"), "EventType": event_type(F.col("_id")), **made})
    out = out.withColumns({f: F.lit(None).cast("string") for f in FIELDS if f not in ("EventID", "EventType", *made)})
    kept = F.coalesce("Image", "TargetFilename", "DestinationIp", "User").isNotNull()
    return out.where(kept).select(*(c for c in df.columns if c != xml and c not in FIELDS), *FIELDS)


def event_xml(spark: SparkSession, path: str) -> DataFrame:
    """Contract records, with src, of a folder of XML exports; files that cannot be read are passed over."""
    rows = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("lineSep", "</Event>").text(path)
    events = rows.where(F.col("value").contains("<Event")).select(F.input_file_name().alias("src"), F.concat(F.regexp_extract("value", r"(?s)<Event[ >].*$", 0), F.lit("</Event>")).alias("xml"))
    return parse_events(events, "xml")


def rendered_files(spark: SparkSession, path: str) -> DataFrame:
    """id, event, and the contract fields of a folder with one rendered event a .txt file, or a folder id=... each."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True).withColumn("_file", F.input_file_name())
    files = files.where(~F.col("_file").rlike("/(labels.json|manifest.tsv)/[^/]*$"))
    named = files.select(F.regexp_extract("_file", r"(?:/id=([^/]+)/[^/]*$)", 1).alias("_folder"), F.regexp_extract("_file", r"([^/]+)\.txt$", 1).alias("_name"), F.regexp_replace("value", r"\s+$", "").alias("event"))
    named = named.select(F.when(F.col("_folder") != "", F.col("_folder")).otherwise(F.col("_name")).alias("id"), "event")
    return named.withColumn("_f", fields_of(F.col("event"))).select("id", "event", "_f.*")


def records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of contract records with _src; blank lines are passed over."""
    return spark.read.schema(CONTRACT.add("_src", "string")).json(path)


def decision_map(spark: SparkSession, path: str) -> DataFrame:
    """signature and its decision of JSON files that map signatures to decisions, whatever fields an entry lacks."""
    entry = "severity: string, gold: string, decided_by: string, n: long, srcs: array<string>, prefilter: string, score: double, rule: string, gid: string, why: string"
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", f"map<string, struct<{entry}>>")).alias("signature", "decision"))
    return pairs.select("signature", "decision.*")


def labels_file(spark: SparkSession, path: str) -> DataFrame:
    """id, name, gold, severity, rationale of a labels.json."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", "map<string, array<string>>")))
    return pairs.select(F.col("key").alias("id"), *(F.get("value", F.lit(i)).alias(c) for i, c in enumerate(("name", "gold", "severity", "rationale"))))


MANIFEST = ("file", "source", "event_id", "family", "severity", "attck", "rationale")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a tab-separated manifest; lines with fewer than seven columns, and the heading, are passed over."""
    cut = spark.read.text(path).select(F.split("value", "\t").alias("c")).where((F.size("c") >= len(MANIFEST)) & (F.get("c", F.lit(0)) != "file"))
    return cut.select(*(F.get("c", F.lit(i)).alias(name) for i, name in enumerate(MANIFEST)))


def class_directory(spark: SparkSession, path: str) -> DataFrame:
    """Rendered events of a folder with their label and family; defects: what breaks the contract in a body, and a
    severity that is not of the class. What the manifest lacks is '-'."""
    m = manifest(spark, f"{path}/manifest.tsv").select(F.regexp_replace("file", r"\.txt$", "").alias("id"), "family", "source", "attck")
    rows = labels_file(spark, f"{path}/labels.json").join(rendered_files(spark, path), "id").join(m, "id", "left")
    mismatch = F.when(~lookup(F.col("severity"), BUCKET).eqNullSafe(F.col("gold")), F.concat(F.lit("severity "), F.col("severity"), F.lit(" is not "), F.col("gold")))
    out = rows.withColumn("defects", F.array_compact(F.concat(contract.violations(F.col("event")), F.array(mismatch))))
    return out.fillna("-", ["family", "attck"])


def checked(rows: DataFrame) -> DataFrame:
    """rows of class_directory() without defects; ValueError that names a few of those that have some."""
    wrong = rows.where(F.size("defects") > 0).select("id", "defects").orderBy("id").limit(5).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['id']}: {', '.join(r['defects'])}" for r in wrong))
    return rows.drop("defects")


def answers(spark: SparkSession, path: str) -> DataFrame:
    """id, severity of a JSON object of answers, a byte-order mark or not; what is no severity is PARSE-FAIL."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"))
    pairs = whole.select(F.explode(F.from_json("value", "map<string, string>"))).select(F.col("key").alias("id"), F.lower("value").alias("severity"))
    return pairs.withColumn("severity", F.when(F.col("severity").isin("none", "low", "medium", "high", "critical"), F.col("severity")).otherwise("PARSE-FAIL"))


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction rows of a JSON array or of JSON lines."""
    schema = "id string, name string, gold string, pred string, severity string, sev_probs map<string, double>, class_probs map<string, double>, margin double"
    return spark.read.schema(schema).option("multiLine", "true").json(path)
