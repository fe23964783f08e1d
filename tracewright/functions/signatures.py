"""Behaviour signatures: what an event does, without who did it and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Substitutions in this order, and port lists.
SUBSTITUTIONS = (
    (r"[a-fA-F0-9]{8}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{12}", "<GUID>"),
    (r"S-1-5-21-[\d-]+", "<SID>"),
    (r"(?i)\b[a-z]:\\users\\[^\\\s\"]+", "<PROFILE>"),
    (r"(?i)\\(users|documents and settings)\\[^\\\s\"]+", r"\\<PROFILE>"),
    (r"\b\d+\.\d+\.\d+(\.\d+)?\b(?!\.\d)", "<VER>"),
    (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "<IP>"),
    (r"[A-Za-z0-9+/]{40,}={0,2}", "<B64>"),
    (r"\b[a-fA-F0-9]{16,}\b", "<HEX>"),
    (r"(?i)\b[a-z0-9]{8}\.(tmp|dat|log|bin)\b", "<RANDFILE>"),
    (r"(?i)\\pipe\\[^\s\"]+", r"\\pipe\\<PIPE>"),
    (r"\b\d{3,}\b", "<N>"),
    (r"(?i)\\(?:app-)?<VER>\\", r"\\<VERDIR>\\"),
)
WELL_KNOWN_PORTS = (80, 443, 53, 88, 123, 135, 139, 389, 445, 636, 3268, 3389, 1433, 5985, 5986, 25, 110, 143, 993, 995)
SUSPECT_PORTS = (4444, 1337, 8080, 8443, 9001, 1234, 31337, 6666, 6667, 8888)


def normalise(c: Column) -> Column:
    """Placeholders for names, versions, addresses and opaque text; lower case, white space collapsed; '' for null."""
    out = F.replace(F.coalesce(c, F.lit("")), F.lit("%%"), F.lit("%"))
    for pattern, value in SUBSTITUTIONS:
        out = F.regexp_replace(out, pattern, value)
    return F.trim(F.regexp_replace(F.lower(out), r"\s+", " "))


def basename(path: Column) -> Column:
    return F.lower(F.substring_index(F.replace(F.coalesce(path, F.lit("")), F.lit("/"), F.lit("\\")), "\\", -1))


def dirname(path: Column) -> Column:
    """The normalised folder; '' for a bare name or null."""
    slashed = F.replace(F.coalesce(path, F.lit("")), F.lit("/"), F.lit("\\"))
    return F.when(slashed.contains("\\"), normalise(F.regexp_replace(slashed, r"\\[^\\]*$", ""))).otherwise(F.lit(""))


def cmd_shape(command: Column, image: Column) -> Column:
    """The normalised command line without its leading image, at most 300 characters."""
    return shape_of(normalise(command), basename(image))


def port_bucket(port: Column) -> Column:
    n = F.trim(port.cast("string")).try_cast("long")
    return (
        F.when(n.isNull(), F.lit("noport"))
        .when(n.isin(*SUSPECT_PORTS), F.concat(F.lit("suspect:"), n.cast("string")))
        .when(n.isin(*WELL_KNOWN_PORTS), F.concat(F.lit("wk:"), n.cast("string")))
        .when(n >= 49152, F.lit("ephemeral"))
        .when(n < 1024, F.lit("low"))
        .otherwise(F.lit("registered"))
    )


def shape_of(normal: Column, base: Column) -> Column:
    """A normalised command line without its leading image (its name given), at most 300 characters."""
    lead = F.concat(F.lit(r'^"?[^"\s]*\Q'), base, F.lit(r'\E"?\s*'))
    return F.substring(F.when(base != "", F.regexp_replace(normal, lead, F.lit(""))).otherwise(normal), 1, 300)


def _described() -> Column:
    """The text that describes an event by its kind: command line or target; null for other kinds."""
    return F.when(F.col("EventID").isin("1", "4688"), F.col("CommandLine")).when(F.col("EventID").isin("7", "11", "12", "13"), F.col("TargetFilename"))


def _detail(eid: Column, text: Column, base: Column) -> Column:
    """What follows image and parent, by kind of event; null where nothing follows. text: _described(), normalised."""
    dns = F.when(F.coalesce(F.col("DestinationHostname"), F.lit("")) != "", F.lit("dns")).otherwise(F.lit("nodns"))
    return (
        F.when(eid.isin("1", "4688"), shape_of(text, base))
        .when(eid.isin("7", "11", "12", "13"), F.substring(text, 1, 200))
        .when(eid == "3", F.concat_ws("|", port_bucket(F.col("DestinationPort")), dns))
        .when(eid.isin("4624", "4625"), F.concat_ws("|", F.coalesce("LogonType", F.lit("")), F.coalesce("AuthPackage", F.lit(""))))
    )


def _parts() -> dict[str, Column]:
    """What the signatures are made of; each normalised text is made once an event."""
    return {"_eid": F.coalesce("EventID", F.lit("")), "_base": basename(F.col("Image")), "_dir": dirname(F.col("Image")), "_parent": basename(F.col("ParentImage")), "_text": normalise(_described())}


def with_behaviour(events: DataFrame) -> DataFrame:
    """events with signature, coarse and action columns.

    signature: event, image, folder, parent and detail, joined by bars, nulls as empty parts; coarse: event, image
    and parent; action: the signature without the parent. Parts are columns of their own before they are joined.
    """
    parts = _parts()
    out = events.withColumns(parts).withColumn("_detail", _detail(F.col("_eid"), F.col("_text"), F.col("_base")))
    joined = {"signature": ("_eid", "_base", "_dir", "_parent", "_detail"), "coarse": ("_eid", "_base", "_parent"), "action": ("_eid", "_base", "_dir", "_detail")}
    return out.withColumns({name: F.concat_ws("|", *of) for name, of in joined.items()}).drop(*parts, "_detail")
