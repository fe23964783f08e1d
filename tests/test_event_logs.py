"""Binary event logs: the encoder against the decoder, hand-made bytes, damage, and Spark's reading of it all."""

import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewright.sources import event_logs, evtx
from tracewright.sources.readers import parse_events

WHEN = datetime(2024, 1, 2, 3, 4, 5, 678901)


def events(n, start=1, text="C:\\a & <b>.exe"):
    return [evtx.Event(start + i, WHEN + timedelta(seconds=i), 1 + 2 * (i % 2), (("Image", f"{text}{i}"), ("User", None if i % 3 else 'x"y'), *((("Port", str(i)),) if i % 2 else ()))) for i in range(n)]


def chunks(data):
    return [data[i : i + evtx.CHUNK] for i in range(evtx.FILE_HEADER, len(data), evtx.CHUNK)]


def test_records_come_back_as_they_went(spark):
    data = evtx.encoded(events(2_000))
    assert len(chunks(data)) > 3 and len(data) == evtx.FILE_HEADER + evtx.CHUNK * len(chunks(data))
    found = [r for c in chunks(data) for r in evtx.Chunk(c).records()]
    assert [r.record_id for r in found] == list(range(1, 2_001)) and all(r.error is None for r in found)
    assert found[3].written == WHEN + timedelta(seconds=3)
    assert found[0].xml == (
        f'<Event xmlns="{evtx.NAMESPACE}"><System><Provider Name="Tracewright"/><EventID>1</EventID><EventRecordID>1</EventRecordID><TimeCreated SystemTime="2024-01-02T03:04:05.678901Z"/>'
        '<Computer>localhost</Computer></System><EventData><Data Name="Image">C:\\a &amp; &lt;b&gt;.exe0</Data><Data Name="User">x&quot;y</Data></EventData></Event>'
    )
    assert '<Data Name="User"></Data><Data Name="Port">1</Data>' in found[1].xml


def test_a_damaged_record_costs_itself_and_a_damaged_chunk_its_records():
    whole = chunks(evtx.encoded(events(2_000)))
    first = bytearray(whole[0])
    starts = [i for i in range(evtx.CHUNK_HEADER, evtx.CHUNK - 4) if first[i : i + 4] == evtx.RECORD_MAGIC]
    n = len(starts)
    at = starts[5] + evtx.RECORD_HEADER + 4
    first[at + 10 : at + 14] = struct.pack("<I", 1 << 30)  # more values than the record has room for
    got = list(evtx.Chunk(bytes(first)).records())
    assert [i for i, r in enumerate(got) if r.error] == [5] and len(got) == n
    assert got[5].record_id == 6 and got[5].xml is None
    first[starts[9] : starts[9] + 4] = b"junk"
    got = list(evtx.Chunk(bytes(first)).records())
    assert len(got) == 10 and got[9].error == f"no record at {starts[9]}"
    assert [r.error for r in evtx.Chunk(b"x" * evtx.CHUNK).records()] == ["no chunk"]
    assert list(evtx.Chunk(bytes(evtx.CHUNK)).records()) == []


@pytest.mark.parametrize("seed", range(40))
def test_no_bytes_break_the_decoder(seed):
    import random

    rng = random.Random(seed)
    data = bytearray(chunks(evtx.encoded(events(60)))[0])
    for _ in range(200):
        data[rng.randrange(evtx.CHUNK_HEADER, 9_000)] = rng.randrange(256)
    for r in evtx.Chunk(bytes(data)).records():
        assert (r.xml is None) != (r.error is None)


def fragment(*tokens):
    """A chunk with one record that holds these bytes."""
    body = b"".join(tokens)
    record = evtx.RECORD_MAGIC + struct.pack("<IQQ", len(body) + 28, 7, 0) + body + struct.pack("<I", len(body) + 28)
    data = bytearray(evtx.CHUNK)
    data[:8] = evtx.CHUNK_MAGIC
    struct.pack_into("<I", data, 48, evtx.CHUNK_HEADER + len(record))
    data[evtx.CHUNK_HEADER : evtx.CHUNK_HEADER + len(record)] = record
    return bytes(data)


def name(text, at):
    """A name that stands right at its use, at `at` of the chunk (the offset's place)."""
    return struct.pack("<IIHH", at + 4, 0, 0, len(text)) + text.encode("utf-16-le") + b"\0\0"


def test_values_of_every_type():
    start = evtx.CHUNK_HEADER + evtx.RECORD_HEADER
    body = bytes([evtx.FRAGMENT, 1, 1, 0, evtx.OPEN]) + struct.pack("<HI", 0xFFFF, 0)
    body += name("E", start + len(body)) + bytes([evtx.CLOSE_START])
    body += bytes([evtx.VALUE, evtx.STRING]) + struct.pack("<H", 2) + "a<".encode("utf-16-le")
    body += bytes([evtx.CHAR | evtx.MORE]) + struct.pack("<H", 0xE9)
    body += bytes([evtx.CDATA]) + struct.pack("<H", 2) + "&b".encode("utf-16-le")
    body += bytes([evtx.ENTITY])
    body += name("lt", start + len(body)) + bytes([evtx.CLOSE, evtx.END])
    (got,) = evtx.Chunk(fragment(body)).records()
    assert got.xml == "<E>a&lt;é&amp;b&lt;</E>"
    shown = evtx._shown
    assert shown(3, b"\xff") == "-1" and shown(4, b"\xff") == "255" and shown(9, struct.pack("<q", -5)) == "-5" and shown(12, struct.pack("<d", 1.5)) == "1.5"
    assert shown(evtx.BOOL, struct.pack("<I", 1)) == "true" and shown(evtx.BINARY, b"\x0a\xff") == "0AFF" and shown(evtx.HEX32, struct.pack("<I", 255)) == "0xff"
    assert shown(evtx.GUID, bytes(range(16))) == "{03020100-0504-0706-0809-0A0B0C0D0E0F}"
    assert shown(evtx.SID, bytes.fromhex("0101000000000005") + struct.pack("<I", 18)) == "S-1-5-18"
    assert shown(evtx.SYSTEMTIME, struct.pack("<8H", 2024, 2, 5, 9, 10, 11, 12, 13)) == "2024-02-09T10:11:12.013Z"
    assert shown(evtx.FILETIME, struct.pack("<Q", 0)) == "1601-01-01T00:00:00.000000Z"
    assert shown(evtx.STRING, "a\x00".encode("utf-16-le")) == "a" and shown(evtx.ANSI, b"a\x01b") == "ab"
    assert evtx._array(evtx.STRING, "a\0b\0".encode("utf-16-le")) == ["a", "b"] and evtx._array(6, b"\1\0\2\0") == ["1", "2"]


def rows(spark, some):
    return spark.createDataFrame([(e.record_id, e.written, e.event_id, [{"name": n, "value": v} for n, v in e.data]) for e in some], "record_id long, written timestamp, event_id int, data array<struct<name: string, value: string>>")


def test_spark_writes_and_reads_logs(spark, tmp_path):
    some = events(5_000)
    event_logs.write_event_logs(rows(spark, some).repartition(3), str(tmp_path / "a" / "logs"))
    files = sorted((tmp_path / "a" / "logs").iterdir())
    assert len(files) == 3 and all(f.suffix == ".evtx" for f in files)
    got = event_logs.event_log_records(spark, str(tmp_path / "a")).collect()
    assert sorted(r["record_id"] for r in got) == [e.record_id for e in some] and {r["src"] for r in got} == {f"logs/{f.name}" for f in files}
    assert event_logs.event_logs(spark, str(files[0])).select("src").distinct().collect() == [(files[0].name,)]
    # one chunk destroyed: its records are gone, all else is there
    broken = bytearray(files[1].read_bytes())
    lost = {r.record_id for r in evtx.Chunk(bytes(broken[evtx.FILE_HEADER :][: evtx.CHUNK])).records()}
    broken[evtx.FILE_HEADER : evtx.FILE_HEADER + 8] = b"XXXXXXXX"
    files[1].write_bytes(broken)
    read = event_logs.event_log_records(spark, str(tmp_path / "a"))
    assert {r["record_id"] for r in read.where("xml IS NOT NULL").collect()} == {e.record_id for e in some} - lost
    assert [r["error"] for r in read.where("error IS NOT NULL").collect()] == ["no chunk"]


def test_a_log_is_read_by_as_many_tasks_as_it_has_runs_of_chunks(tmp_path, monkeypatch):
    (tmp_path / "x.evtx").write_bytes(evtx.encoded(events(3_000)))
    (tmp_path / "y.EVTX").write_bytes(evtx.encoded(events(10)) + b"\0" * 100)
    (tmp_path / "z.evtx").write_bytes(b"")
    monkeypatch.setattr(event_logs, "TASK_CHUNKS", 2)
    reader = event_logs.EventLogReader(str(tmp_path))
    parts = reader.partitions()
    assert len(parts) > 3 and all(sum(n for *_, n in p.runs) <= 2 for p in parts)
    ids = [r[2] for p in parts for r in reader.read(p) if r[1] is not None and r[2] is not None]
    assert len(ids) == 3_010


def test_nothing_to_read(spark, tmp_path):
    assert event_logs.event_logs(spark, str(tmp_path / "none")).collect() == []


def test_log_records_are_the_events_of_their_xml(spark, tmp_path):
    event_logs.write_event_logs(rows(spark, events(50)), str(tmp_path))
    records = event_logs.event_log_records(spark, str(tmp_path))
    direct = parse_events(records.select("record_id", "xml"), "xml").drop("src")
    assert sorted(map(str, event_logs.event_logs(spark, str(tmp_path)).drop("src").collect())) == sorted(map(str, direct.collect()))
    assert direct.where(F.col("Image").contains("&")).count() == 50


def test_an_event_larger_than_a_chunk_is_an_error():
    with pytest.raises(ValueError):
        evtx.encoded([evtx.Event(1, WHEN, 1, (("Image", "x" * 40_000),))])
