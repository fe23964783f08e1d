"""Rows worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tracewright.functions import contract, rules, signatures
from tracewright.operators import audit, decisions, labels, metrics, queue, sampling


def values(spark, rows, expression, schema="x string"):
    df = spark.createDataFrame([(i, *r) if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_commands_are_cut_after_512_characters(spark):
    got = values(spark, ["a" * 511, "a" * 512, "a" * 513, "%%a%%", None], contract.normalise_command(F.col("x")))
    assert got == ["a" * 511, "a" * 512, "a" * 512 + "<truncated>", "%a%", None]


def test_port_buckets(spark):
    got = values(spark, ["x", None, "0", "1023", "1024", "49151", "49152", "443", "4444", " 22 "], signatures.port_bucket(F.col("x")))
    assert got == ["noport", "noport", "low", "low", "registered", "registered", "ephemeral", "wk:443", "suspect:4444", "low"]


def test_dotted_quads_count_as_versions(spark):
    assert values(spark, ["to 10.14.7.33", None, ""], signatures.normalise(F.col("x"))) == ["to <ver>", "", ""]


def test_paths(spark):
    rows = ["C:/Users/x/App.EXE", "plain.exe", None, "C:\\a\\"]
    assert values(spark, rows, signatures.basename(F.col("x"))) == ["app.exe", "plain.exe", "", ""]
    assert values(spark, rows, signatures.dirname(F.col("x"))) == ["<profile>", "", "", "c:\\a"]


def test_command_shape_drops_the_image_and_takes_its_name_literally(spark):
    got = values(spark, [('"C:\\x\\a+b.exe" -k', "C:\\x\\a+b.exe"), ("other", "a.exe"), (None, None)], signatures.cmd_shape(F.col("c"), F.col("i2")), "c string, i2 string")
    assert got == ["-k", "other", ""]


def test_violations(spark):
    rows = ["EventID: 1\nImage: x", "Image: x\nEventID: 1", "EventID: 1\nnope", "EventID: 1\nFoo: 2", "EventID: ", "EventID: 1\nEventID: 2", ""]
    got = values(spark, rows, contract.violations(F.col("x")))
    assert got == [[], ["field order violated"], ["no colon: nope"], ["off-contract field: Foo"], ["empty value: EventID"], ["duplicate fields"], []]


def test_fields_of_a_body_last_of_equal_keys_wins(spark):
    got = values(spark, ["EventID: 1\nUser: a\nUser: b : c\nstray"], contract.fields_of(F.col("x")))[0]
    assert (got["EventID"], got["User"], got["Image"]) == ("1", "b : c", None)


def test_vendor_names_match_by_case(spark):
    rows = ["C:\\x\\chrome.exe", "C:\\x\\CHROME.exe", "C:\\Windows\\Temp\\a.exe", "C:\\Windows\\a.exe", "D:\\a.exe", "", None]
    got = values(spark, rows, contract.authenticode(F.col("x")))
    assert [None if g is None else tuple(g) for g in got] == [("true", "Google LLC"), ("false", None), ("false", None), ("true", "Microsoft Windows"), ("false", None), None, None]


def test_rendering_rejects_an_unknown_policy(spark):
    with pytest.raises(ValueError):
        contract.with_signature_policy(spark.createDataFrame([], contract.CONTRACT), "other")


def test_source_tokens(spark):
    assert values(spark, ["Dir/sysmon_LsassMiniDump_2020.evtx"], F.array_sort(rules.source_tokens(F.col("x")))) == [["dump", "lsass", "mini"]]


def test_metrics_of_one_class_are_nan_where_undefined(spark):
    df = spark.createDataFrame([("benign", "benign", 0.5), ("other", "benign", 0.1)], "gold string, pred string, margin double")
    got = metrics.class_metrics(df).first()
    assert got["n"] == 1 and got["accuracy"] == 1.0 and math.isnan(got["malicious_recall"]) and math.isnan(got["margin_wrong"])


@pytest.mark.parametrize("counts, size", [({"benign": 9, "suspicious": 5, "malicious": 4}, 10), ({"benign": 3, "suspicious": 3, "malicious": 8}, 9), ({"benign": 1, "suspicious": 0, "malicious": 2}, 9), ({"a": 7, "b": 7, "c": 2, "malicious": 1}, 8)])
def test_trim_quotas_take_one_at_a_time_from_the_largest(counts, size):
    left = dict(counts)
    while sum(left.values()) > size and any(n for c, n in left.items() if c != "malicious"):
        left[max((c for c in left if c != "malicious"), key=lambda c: left[c])] -= 1
    assert {c: counts[c] - n for c, n in sampling.trim_quotas(counts, size).items()} == left


def test_majority_ties_go_to_the_class_seen_first(spark):
    rows = spark.createDataFrame([(1, "s", "b"), (2, "s", "a"), (3, "s", "a"), (4, "s", "b")], "ord int, signature string, gold string")
    assert sampling.majority(rows).first()["gold"] == "b"


def test_undone_decisions_do_not_count(spark):
    log = spark.createDataFrame([(1, "s", "label", "low", None), (2, "s", "label", "high", None), (3, "s", "undo", None, 2)], "seq int, signature string, action string, severity string, undoes int")
    assert [tuple(r) for r in labels.latest_decisions(log).collect()] == [("s", 1, "low")]


def test_defaults_do_not_replace_decisions(spark):
    own = spark.createDataFrame([("a", "low")], "signature string, severity string")
    rest = spark.createDataFrame([("a", "high"), ("b", None)], "signature string, severity string")
    assert sorted(map(tuple, labels.with_defaults(own, rest).collect())) == [("a", "low"), ("b", None)]


def test_empty_tables(spark):
    events = spark.createDataFrame([], "ord long, src string, attack boolean, " + ", ".join(f"{f} string" for f in contract.FIELDS))
    q = queue.scored(events, events)
    assert q.count() == 0 and queue.proposals(queue.groups(q)).count() == 0 and queue.top(q, 5).count() == 0
    assert audit.field_presence(events.withColumn("gold", F.lit("x"))).count() == 0


def test_blind_work_lists_and_completeness(spark):
    groups = spark.createDataFrame([("a", 2.0, "review", 1), ("b", 0.5, "drop", 2), ("c", 3.0, "review", 3)], "signature string, score double, prelabel string, n int")
    decided = spark.createDataFrame([("c",)], "signature string")
    assert sorted(map(tuple, decisions.worklist(groups, decided, blind=True).collect())) == [("a", 1), ("b", 2)]
    assert [r["signature"] for r in decisions.worklist(groups, decided, 1.0, "review").collect()] == ["a"]
    rows = spark.createDataFrame([("x",), ("y",)], "id string")
    assert decisions.complete(rows, rows) and not decisions.complete(rows, rows.limit(1))
