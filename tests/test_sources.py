import json
import time

from pyspark.sql import functions as F

from tracewright.functions import prompts, rewriting
from tracewright.plans import stateful
from tracewright.sources import readers, writers
from tracewright.streaming import ingest


def event(event_id, **data):
    rows = "".join(f"<Data Name='{k}'>{v}</Data>" for k, v in data.items())
    return f'<Event xmlns="http://schemas.microsoft.com/win/2004/08/events/event"><System><EventID>{event_id}</EventID></System><EventData>{rows}</EventData></Event>'


EVENTS = [
    event(1, Image="C:\\a.exe", CommandLine="x" * 600, User="-", TargetUserName="bob", SignatureStatus="Valid"),
    event(7, Image="C:\\a.exe", ImageLoaded="C:\\b.dll", Signature="Vendor"),
    event(9999, Image="C:\\a.exe"),
    event(3, DestinationPort="80"),
    "no xml at all",
    event(3, DestinationIp="10.0.0.1", IpAddress="10.0.0.2"),
]


def test_events_of_xml(spark):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(EVENTS)], "n int, xml string")
    got = {r["n"]: r for r in readers.parse_events(df, "xml").collect()}
    assert set(got) == {0, 1, 5}
    assert got[0]["User"] == "bob" and got[0]["Signed"] == "true" and got[0]["CommandLine"] == "x" * 512 + "..." and got[0]["EventType"] == "Process Create"
    assert (got[1]["TargetFilename"], got[1]["Signer"], got[1]["Signed"]) == ("C:\\b.dll", "Vendor", "true")
    assert got[5]["DestinationIp"] == "10.0.0.1"


def test_xml_folder_and_stream_give_the_same_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text("\n".join(e for e in EVENTS if e.startswith("<")) + "\n")
    batch = readers.event_xml(spark, str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        ingest.append(ingest.xml_lines(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    stream = spark.read.parquet(str(tmp_path / "out"))
    assert batch.count() == stream.count() == 3
    assert sorted(r["EventID"] for r in batch.collect()) == sorted(r["EventID"] for r in stream.collect())


def test_running_profile(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"EventID":"1","Image":"C:\\\\x.exe"}\n\n{"EventID":"1","Image":"C:\\\\x.exe"}\n')
    profile = ingest.running_profile(ingest.json_records(spark, str(tmp_path)))
    ingest.kept_profile(profile, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]


def test_decisions_labels_answers_and_manifest(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"1|a": {"severity": None, "gold": "drop", "n": 2}, "1|b": {"severity": "high", "gold": "malicious", "srcs": ["x"]}}, indent=2))
    assert {r["signature"]: (r["severity"], r["n"], r["srcs"]) for r in readers.decision_map(spark, str(tmp_path / "d.json")).collect()} == {"1|a": (None, 2, None), "1|b": ("high", None, ["x"])}
    (tmp_path / "q.json").write_text("﻿" + json.dumps({"a": "High", "b": "???"}), encoding="utf-8")
    assert dict(map(tuple, readers.answers(spark, str(tmp_path / "q.json")).collect())) == {"a": "high", "b": "PARSE-FAIL"}
    d = tmp_path / "events"
    d.mkdir()
    (d / "B001.txt").write_text("EventID: 1\nImage: x\n")
    (d / "labels.json").write_text(json.dumps({"B001": ["n", "benign", "none", "why"]}))
    (d / "manifest.tsv").write_text("file\tsource\tevent_id\tfamily\tseverity\tattck\trationale\nB001.txt\tsynthetic\t1\tfam\tnone\t\twhy\n")
    got = readers.class_directory(spark, str(d)).first()
    assert (got["id"], got["event"], got["gold"], got["family"], got["Image"]) == ("B001", "EventID: 1\nImage: x", "benign", "fam", "x")


def test_upsert_and_checksums(spark, tmp_path):
    old, new = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]))
    assert sorted(map(tuple, writers.upserted(old, new, "k").collect())) == [("a", 1), ("b", 3), ("c", 4)]
    writers.json_lines(old, str(tmp_path / "x"), str(tmp_path / "y"))
    assert spark.read.json(str(tmp_path / "y")).count() == 2
    assert all(len(r["sha256"]) == 64 for r in writers.checksums(spark, str(tmp_path)).collect())


def test_tool_names_are_replaced_alike_within_an_event(spark):
    text = "Image: C:\\lab\\Akagi64.exe\nCommandLine: akagi64 AKAGI64.exe akagi645 xakagi64"
    df = spark.createDataFrame([(i, text) for i in range(40)], "id long, event string")
    got = [r[0] for r in df.select(rewriting.scrub_names(F.col("event"), F.col("id"))).collect()]
    names = {g.split("\\lab\\")[1].split(".exe")[0] for g in got}
    assert all(g.count(n) >= 3 for g in got for n in names if f"\\lab\\{n}.exe" in g) and len(names) > 10
    assert all(g.endswith(" akagi645 xakagi64") for g in got) and any(n[-1].isdigit() for n in names) and any(n in rewriting.NEUTRAL_NAMES for n in names)


def test_prompts(spark):
    assert prompts.system_prompt("5way").count('"critical"') == 1
    rows = spark.createDataFrame([(1, "s", "e", "high", "malicious", "{}"), (2, "t", "e", "odd", "benign", "{}")], "id int, signature string, event string, severity string, gold string, target string")
    got = prompts.training_pairs(rows, rows.select("signature").where("signature = 's'")).collect()
    assert [(r["id"], r["split"], r["prompt"][1]["content"]) for r in got] == [(1, "val", "Event:\ne\n\nClassify.")]


def test_checksums_of_a_file_larger_than_an_array(spark, tmp_path):
    """A sparse file of 3 GB, in pieces; the digest is that of so many zeros."""
    import hashlib

    size = 3 << 30
    with open(tmp_path / "big.bin", "wb") as f:
        f.truncate(size)
    (tmp_path / "small.txt").write_text("abc")
    zeros, piece = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        zeros.update(piece)
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["sha256"]) for r in writers.checksums(spark, str(tmp_path)).collect()}
    assert got == {"big.bin": (size, zeros.hexdigest()), "small.txt": (3, hashlib.sha256(b"abc").hexdigest())}


def test_tasks_list_the_files_not_the_driver(spark, tmp_path):
    """No file is in the plan, as it is where the driver lists them; all levels are found, hidden names are not."""
    import hashlib

    names = ["a.txt", "p/b.txt", "p/q/c d.txt", "p/k=1/e.txt", "p/_hidden.txt", ".git/f.txt", "_pending/g.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    found = writers.checksums(spark, str(tmp_path))
    assert not any(f.endswith(".txt") for f in found.inputFiles())
    assert [tuple(r) for r in found.collect()] == sorted((f"file:{tmp_path}/{n}", len(n), hashlib.sha256(n.encode()).hexdigest()) for n in names[:4])
    assert [r["length"] for r in writers.checksums(spark, f"file://{tmp_path}/a.txt").collect()] == [5]
    (tmp_path / "none").mkdir()
    assert writers.checksums(spark, str(tmp_path / "none")).count() == 0


def test_each_file_is_digested_once(spark, tmp_path, monkeypatch):
    """In order of path, and large files, dealt out by themselves, too."""
    import hashlib
    from types import SimpleNamespace

    log, root = str(tmp_path / "log"), tmp_path / "in"

    def sha256():
        with open(log, "a") as f:
            f.write("x")
        return hashlib.sha256()

    want = []
    for i in range(40):
        at = root / f"part-{i % 3}" / f"E{i}.txt"
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text("x" * i)
        want.append((f"file:{at}", i, hashlib.sha256(b"x" * i).hexdigest()))
    monkeypatch.setattr(writers, "hashlib", SimpleNamespace(sha256=sha256))
    monkeypatch.setattr(writers, "AHEAD", 7, raising=False)
    for runs, bound in ((1, 1 << 20), (2, 30)):
        monkeypatch.setattr(writers, "LARGE", bound, raising=False)
        assert [tuple(r) for r in writers.checksums(spark, str(root)).collect()] == sorted(want)
        assert len(open(log).read()) == 40 * runs


def test_ids_of_files_come_from_the_name_alone(spark, sf, monkeypatch):
    """A pattern over the whole path takes the square of its longest part, which here is a minute."""
    monkeypatch.setattr(stateful, "write_event_folder", lambda rows, path: None)
    given = [(f"file:/{'x' * 60_000}.txt/E{i}.txt", i, "s") for i in range(8)] + [("file:/x/.txt", 8, "s"), ("file:/x.txt/y", 9, "s")]
    monkeypatch.setattr(stateful, "checksums", lambda spark, path: spark.createDataFrame(given, "path string, length long, sha256 string"))
    began = time.perf_counter()
    got = stateful.folder_checksums(spark, sf).collect()
    assert [r["id"] for r in got] == [f"E{i}" for i in range(8)] + ["", ""]
    assert time.perf_counter() - began < 10


def test_only_parts_with_changed_keys_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("old").alias("v"))
    writers.keyed_table(rows, path, ["k"], 16)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    changes = spark.createDataFrame([(5, "new"), (None, "new"), (5_000, "new")], "k long, v string")
    n = writers.upsert_table(changes, path, ["k"], 16)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert 1 <= n <= 3 and len({p.parent for p in before if p not in after}) <= n and sum(p in after for p in before) >= len(before) - n
    got = {r["k"]: r["v"] for r in writers.read_keyed(spark, path).collect()}
    assert len(got) == 1_001 and {k for k, v in got.items() if v == "new"} == {5, None, 5_000}
    assert writers.upsert_table(changes.where("k < 0"), path, ["k"], 16) == 0


def test_json_lines_of_records(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"EventID": "1", "Image": "x", "_src": "a.evtx", "other": 1}\n\n{"EventID": "3"}\n')
    got = readers.records(spark, str(tmp_path / "a.jsonl")).orderBy("EventID").collect()
    assert [(r["EventID"], r["Image"], r["_src"]) for r in got] == [("1", "x", "a.evtx"), ("3", None, None)]


def test_home_folders(spark):
    df = spark.createDataFrame([("CORP\\ann",), ("bob",), ("NT AUTHORITY\\SYSTEM",)], "u string")
    assert [r[0] for r in df.select(rewriting.home_of(F.col("u"))).collect()] == ["C:\\Users\\ann", "C:\\Users\\bob", "C:\\Users\\SYSTEM"]
