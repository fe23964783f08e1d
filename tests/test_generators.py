"""Generated events: quotas, distinct bodies, the contract, determinism; rewriting; files that are read back."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracewright.functions import contract, prompts, rewriting
from tracewright.operators import generate, metrics, sampling
from tracewright.sources import committed, readers, writers


@pytest.mark.parametrize("kind", ["benign", "suspicious"])
def test_quotas_bodies_and_contract(spark, kind):
    n = 300
    rows = generate.generated(spark, n, kind, seed="7").cache()
    got = rows.collect()
    wanted = {r["key"]: r["n"] for r in sampling.apportion(spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(generate.mix_of(kind))], "key int, share double, ord int"), n).collect()}
    assert Counter(int(r["EventID"]) for r in got) == {k: v for k, v in wanted.items() if v}
    assert len({r["event"] for r in got}) == len({r["id"] for r in got}) == n
    assert rows.where(F.size(contract.violations(F.col("event"))) > 0).count() == 0
    assert {r["gold"] for r in got} == {kind} and {r["severity"] for r in got} == ({"none", "low"} if kind == "benign" else {"medium"})
    assert len({r["name"] for r in got}) > 12 and all(r["User"] for r in got) and all(r["ParentImage"] for r in got if r["EventID"] == "1")
    again = generate.generated(spark.newSession(), n, kind, seed="7").collect()
    assert sorted(again) == sorted(got)
    assert {r["event"] for r in generate.generated(spark, n, kind, seed="8").collect()} != {r["event"] for r in got}


def rewritten(spark, *events):
    df = spark.createDataFrame(list(enumerate(events)), "id long, event string")
    return [r[0] for r in df.orderBy("id").select(rewriting.rewrite_identity(F.col("event"), F.col("id"), "s")).collect()]


def test_only_accounts_profiles_and_stale_hosts_change(spark):
    (got,) = rewritten(spark, "Image: C:\\Windows\\explorer.exe\nUser: PC01\\ex\nCommandLine: c:\\users\\ex\\run.exe C:\\Users\\Public\\x C:\\Users\\All Users\\y \\\\PC01\\share insecurebank\\a WKSTN-0143\\b PC01 C:\\Users\\other.name\\z")
    user, command = re.search(r"User: (.*)\nCommandLine: (.*)$", got).groups()
    realm, name = user.split("\\")
    assert got.startswith("Image: C:\\Windows\\explorer.exe\n") and name in rewriting.LOCAL_USERS and realm in (*rewriting.HOSTS, rewriting.DOMAIN)
    assert command == f"c:\\users\\{name}\\run.exe C:\\Users\\Public\\x C:\\Users\\All Users\\y \\\\{realm}\\share {realm}\\a WKSTN-0143\\b PC01 C:\\Users\\{name}\\z"


def test_accounts_of_the_system_stay(spark):
    for user in ("NT AUTHORITY\\SYSTEM", "IIS APPPOOL\\DefaultAppPool"):
        (got,) = rewritten(spark, f"User: {user}\nImage: C:\\Users\\den\\a.exe")
        assert got.startswith(f"User: {user}\n") and "den" not in got
    assert rewritten(spark, "Image: x", "") == ["Image: x", ""]


def test_images_and_parents_are_renamed(spark):
    event = "Image: C:\\lab\\UacTool.exe\nCommandLine: C:\\lab\\UacTool.exe -k UacTool.exe\nParentImage: C:\\lab\\UACME.exe"
    df = spark.createDataFrame([(event, "D:\\x\\upd.exe"), (event, None)], "e string, new string")
    assert [r[0] for r in df.select(rewriting.rename_image(F.col("e"), F.col("new"))).collect()] == [
        "Image: D:\\x\\upd.exe\nCommandLine: D:\\x\\upd.exe -k upd.exe\nParentImage: C:\\lab\\a.exe", event.replace("UACME", "a"),
    ]
    p = spark.createDataFrame([("C:\\Python27\\python.exe", "python x.py"), ("C:\\a.exe", "a"), (None, None)], "p string, c string").select(rewriting.plain_parents(F.col("p"), F.col("c")).alias("x")).select("x.*")
    assert [tuple(r) for r in p.collect()] == [("C:\\Windows\\System32\\cmd.exe", '"C:\\Windows\\System32\\cmd.exe"'), ("C:\\a.exe", "a"), (None, None)]


def test_bodies_with_wrapped_lines(spark):
    df = spark.createDataFrame([("x\nEventID: 1\nCommandLine: a\n b: c\nImage: i\nImage:j",), ("EventID: 1",), ("",)], "e string")
    got = [r[0] for r in df.select(contract.wrapped_fields(F.col("e"))).collect()]
    assert got == [{"EventID": "1", "CommandLine": "a\n b: c", "Image": "j"}, {"EventID": "1"}, {}]
    assert [r[0] is None for r in df.select(contract.strict_fields(F.col("e"))).collect()] == [True, False, True]


def test_a_class_folder_is_read_as_it_was_written(spark, tmp_path):
    rows = spark.createDataFrame([("B001", "EventID: 1\nImage: x", "n", "benign", "none", "why", "s", "fam", "-"), ("B002", "Image: x\nEventID: 1", "n", "benign", "high", "why", "s", "fam", "T1003")], "id string, event string, name string, gold string, severity string, rationale string, source string, family string, attck string")
    committed.write_event_folder(rows, str(tmp_path / "c"))
    got = {r["id"]: r for r in readers.class_directory(spark, str(tmp_path / "c")).collect()}
    assert got["B001"]["defects"] == [] and (got["B001"]["event"], got["B001"]["family"], got["B002"]["attck"]) == ("EventID: 1\nImage: x", "fam", "T1003")
    assert got["B002"]["defects"] == ["field order violated", "severity high is not benign"]
    with pytest.raises(ValueError, match="B002: field order violated"):
        readers.checked(readers.class_directory(spark, str(tmp_path / "c")))


def test_short_manifest_lines_are_passed_over(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("file\tsource\tevent_id\tfamily\tseverity\tattck\trationale\na.txt\ts\t1\tf\tlow\t-\twhy\nb.txt\ts\n")
    assert [r["file"] for r in readers.manifest(spark, str(tmp_path / "m.tsv")).collect()] == ["a.txt"]


def test_decisions_are_appended_and_rows_by_class_written(spark, tmp_path):
    for seq in (1, 2):
        writers.append_decisions(spark.createDataFrame([(seq, "s", "label", "high")], "seq long, signature string, action string, severity string"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    rows = spark.createDataFrame([("a", "e", "benign"), ("b", "e", "malicious")], "id string, event string, gold string")
    writers.rendered_events(rows, str(tmp_path / "t"))
    writers.rendered_events(rows.where("gold = 'benign'"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_model_file_and_checkpoints(spark):
    text = prompts.model_file("base-3b", "adapters/v1", "./model.gguf", 32768, "5way")
    assert "FROM ./model.gguf\n" in text and '"critical"' in text and "PARAMETER num_ctx 32768\n" in text
    runs = spark.createDataFrame([("checkpoint-100",), ("final",), ("checkpoint-20",), ("odd",)], "run string")
    assert [r[0] for r in metrics.by_number(runs, "run", "final").collect()] == ["checkpoint-20", "checkpoint-100", "odd", "final"]


@pytest.mark.parametrize("parts", [1, 5])
def test_places_within_large_groups(spark, parts):
    rows = [(i, ["a", "b", None][i % 3 if i % 5 else 0]) for i in range(200)]
    df = spark.createDataFrame(rows, "ord long, g string").repartition(parts)
    place: Counter = Counter()
    want = {}
    for i, g in rows:
        place[g] += 1
        want[i] = place[g]
    assert {r["ord"]: r["n"] for r in sampling.numbered(df, ["g"], [F.col("ord")], "n").collect()} == want
