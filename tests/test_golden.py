"""Published results and rows worked out by hand, independent of the engine's own rule tables."""

import pytest
from pyspark.sql import functions as F

from tracewright.functions import targets
from tracewright.functions.contract import FIELDS
from tracewright.operators import metrics
from tracewright.sources import readers

#: Margins of the events of two published runs of one model over 50 events, by (gold, predicted) class.
RUNS = {
    "first": {
        ("benign", "benign"): [0.546, 0.6153, 0.5687, 0.6003, 0.7788, 0.7034, 0.7332, 0.6463, 0.5747, 0.6611, 0.612, 0.744, 0.661, 0.626, 0.5633, 0.7737],
        ("suspicious", "benign"): [0.6187, 0.5456, 0.537, 0.5655, 0.6302, 0.58, 0.6791, 0.541, 0.4534, 0.2041, 0.4423],
        ("malicious", "benign"): [0.6285, 0.5277, 0.4493, 0.5503, 0.1727, 0.0871, 0.6743, 0.5373, 0.4095, 0.1703, 0.6973, 0.6046, 0.3022, 0.6095, 0.6562, 0.4748, 0.5197, 0.5468, 0.305, 0.3955, 0.5527, 0.6249],
        ("malicious", "malicious"): [0.0727],
    },
    "strict": {
        ("benign", "benign"): [0.4558, 0.3647, 0.375, 0.3179, 0.4935, 0.0326, 0.514, 0.3343, 0.0231, 0.1518, 0.4138, 0.5564, 0.5194, 0.3867],
        ("benign", "malicious"): [0.1407, 0.0882],
        ("suspicious", "benign"): [0.6208, 0.2393, 0.0055, 0.21, 0.2627, 0.3619, 0.2738, 0.0578, 0.0735],
        ("suspicious", "malicious"): [0.1049, 0.0296],
        ("malicious", "benign"): [0.3344, 0.2719, 0.3372, 0.043, 0.2626, 0.4869, 0.2753, 0.4078, 0.039, 0.2642],
        ("malicious", "malicious"): [0.0463, 0.6885, 0.1287, 0.2499, 0.235, 0.41, 0.0398, 0.0007, 0.4511, 0.3966, 0.2967, 0.2224, 0.3716],
    },
}
#: The published mean margins of right and of wrong predictions.
MARGINS = {"first": (0.617, 0.494), "strict": (0.314, 0.226)}
#: The figures published for them, in percent.
PUBLISHED = {
    "first": {"accuracy": 34.0, "under_call": 66.0, "over_call": 0.0, "malicious_recall": 4.3, "suspicious_recall": 0.0, "benign_precision": 32.7, "missed_threat": 95.7},
    "strict": {"accuracy": 54.0, "under_call": 38.0, "over_call": 8.0, "malicious_recall": 56.5, "suspicious_recall": 0.0, "benign_precision": 42.4, "missed_threat": 43.5},
}


@pytest.mark.parametrize("run", sorted(RUNS))
def test_metrics_are_those_published(spark, tmp_path, run):
    rows = [f'{{"id": "{g}-{p}-{i}", "gold": "{g}", "pred": "{p}", "margin": {m}, "sev_probs": {{"none": 1.0}}}}' for (g, p), margins in RUNS[run].items() for i, m in enumerate(margins)]
    (tmp_path / "run.json").write_text("[" + ",\n".join(rows) + "]")
    predictions = readers.predictions(spark, str(tmp_path / "run.json"))
    got = metrics.class_metrics(predictions).first()
    assert got["n"] == 50 and {k: round(100 * got[k], 1) for k in PUBLISHED[run]} == PUBLISHED[run]
    assert (got["margin_correct"], got["margin_wrong"]) == pytest.approx(MARGINS[run], abs=6e-4)
    spread = {r["pred"]: r["n"] for r in predictions.groupBy("pred").agg(F.count("*").alias("n")).collect()}
    assert spread == {"first": {"benign": 49, "malicious": 1}, "strict": {"benign": 33, "malicious": 17}}[run]
    met = {r["metric"]: r["met"] for r in metrics.gates(metrics.class_metrics(predictions)).collect()}
    assert met == {"accuracy": False, "under_call": False, "missed_threat": False, "over_call": True, "malicious_recall": False}


S32 = "C:\\Windows\\System32"
KNOWN = "This matches a known attack technique and should be treated as malicious."
REVIEW = "This is consistent with legitimate administration but also with an attack in progress, so it warrants review rather than a verdict."
NORMAL = "Nothing here departs from normal activity for this host."
#: fields, gold; indicators in order, threat type, reasoning
EVENTS = [
    (
        {"EventID": "1", "Image": f"{S32}\\cmd.exe", "ParentImage": "C:\\Office\\WINWORD.EXE", "CommandLine": "cmd.exe /c whoami", "User": "CORP\\alice", "Signed": "true", "Signer": "Microsoft Windows"}, "malicious",
        [("office_spawns_shell", "winword.exe -> cmd.exe"), ("discovery_command", "cmd.exe /c whoami"), ("signed_microsoft", "Microsoft Windows"), ("system32_path", "c:\\windows\\system32")], "reconnaissance",
        f"Process creation by cmd.exe: an Office application spawned a shell and it enumerates hosts, users or domains. {KNOWN} The mitigating evidence (the binary carries a valid Microsoft signature) does not outweigh it.",
    ),
    (
        {"EventID": "3", "Image": "C:\\Program Files\\Google\\Chrome\\Application\\chrome.exe", "DestinationIp": "203.0.113.7", "DestinationPort": "4444"}, "suspicious",
        [("outbound_uncommon_port", "203.0.113.7:4444"), ("raw_ip_no_dns", "203.0.113.7"), ("system32_path", "c:\\program files\\google\\chrome\\application")], "malware",
        f"Network connection by chrome.exe: the destination port is non-standard and it connects to a literal IP with no DNS resolution. {REVIEW} The mitigating evidence (it executes from a system path) does not outweigh it.",
    ),
    (
        {"EventID": "1", "Image": f"{S32}\\svchost.exe", "ParentImage": f"{S32}\\services.exe", "CommandLine": "svchost.exe -k netsvcs", "User": "NT AUTHORITY\\SYSTEM"}, "benign",
        [("system_context_exec", "NT AUTHORITY\\SYSTEM"), ("expected_parent", "services.exe -> svchost.exe"), ("system32_path", "c:\\windows\\system32")], None,
        f"Process creation by svchost.exe: it runs in SYSTEM context. {NORMAL} The parent-child relationship is normal, which accounts for it.",
    ),
    (
        {"EventID": "4625", "User": "CORP\\Guest", "LogonType": "3", "AuthPackage": "NTLM"}, "malicious",
        [("blank_or_guest_account", "CORP\\Guest"), ("legacy_auth_protocol", "NTLM")], "credential_stuffing",
        f"Failed logon by the subject: the account is guest or blank-password and authentication is downgraded. {KNOWN}",
    ),
    (
        {"EventID": "11", "Image": f"{S32}\\WindowsPowerShell\\v1.0\\powershell.exe", "TargetFilename": "C:\\Users\\Public\\drop.exe"}, "malicious",
        [("temp_path_exec", "C:\\Users\\Public\\drop.exe"), ("system32_path", "c:\\windows\\system32\\windowspowershell\\v1.0")], "malware",
        f"File creation by powershell.exe: the image runs from a user-writable path. {KNOWN} The mitigating evidence (it executes from a system path) does not outweigh it.",
    ),
    (
        {"EventID": "3", "DestinationIp": "10.0.0.5", "DestinationPort": "445", "DestinationHostname": "fs.corp", "Image": "D:\\a.exe"}, "malicious",
        [("smb_admin_share", "10.0.0.5:445")], "lateral_movement",
        f"Network connection by a.exe: it touches an SMB administrative share. {KNOWN}",
    ),
    (
        {"EventID": "1", "Image": "D:\\shells\\bash.exe", "ParentImage": "C:\\b\\chrome.exe", "CommandLine": "bash.exe -c ls"}, "malicious",
        [("browser_spawns_shell", "chrome.exe -> bash.exe")], "malware", f"Process creation by bash.exe: a browser spawned a shell. {KNOWN}",
    ),
    (
        {"EventID": "1", "Image": f"{S32}\\rundll32.exe", "ParentImage": f"{S32}\\svchost.exe", "CommandLine": "rundll32.exe a.dll,Go"}, "suspicious",
        [("service_host_spawns_proc", "svchost.exe -> rundll32.exe"), ("lolbin_exec", "rundll32.exe"), ("system32_path", "c:\\windows\\system32")], "malware",
        f"Process creation by rundll32.exe: a service host spawned an unexpected child and the image is a living-off-the-land binary. {REVIEW} The mitigating evidence (it executes from a system path) does not outweigh it.",
    ),
    (
        {"EventID": "1", "Image": "C:\\ProgramData\\svchost.exe", "CommandLine": "svchost.exe", "User": "NT AUTHORITY\\LOCAL SERVICE"}, "malicious",
        [("temp_path_exec", "C:\\ProgramData\\svchost.exe"), ("masquerading_name", "C:\\ProgramData\\svchost.exe"), ("restricted_service_acct", "NT AUTHORITY\\LOCAL SERVICE")], "malware",
        f"Process creation by svchost.exe: the image runs from a user-writable path and the filename mimics a system binary outside a system path. {KNOWN} The mitigating evidence (it runs under a restricted service account) does not outweigh it.",
    ),
    (
        {"EventID": "1", "Image": "D:\\ps\\powershell.exe", "CommandLine": "powershell -nop -w hidden -enc SQBFAFgAIAAoAE4AZQB3AC0A https://x.example/a"}, "malicious",
        [(k, "powershell -nop -w hidden -enc SQBFAFgAIAAoAE4AZQB3AC0A https://x.example/a") for k in ("encoded_command", "hidden_window", "download_cradle", "exec_policy_bypass")], "malware",
        f"Process creation by powershell.exe: the command line is encoded and the window is hidden. {KNOWN}",
    ),
    (
        {"EventID": "13", "Image": "D:\\x\\inst.exe", "TargetFilename": "HKLM\\System\\CurrentControlSet\\Services\\abc\\ImagePath"}, "suspicious",
        [("service_binary_created", "HKLM\\System\\CurrentControlSet\\Services\\abc\\ImagePath")], "malware", f"Registry value set by inst.exe: a service or system binary was written to disk. {REVIEW}",
    ),
    (
        {"EventID": "1", "Image": "D:\\x\\a.exe", "CommandLine": "a.exe enable SeDebugPrivilege"}, "malicious",
        [("privilege_escalation", "a.exe enable SeDebugPrivilege")], "privilege_escalation", f"Process creation by a.exe: privileges are being elevated. {KNOWN}",
    ),
    (
        {"EventID": "13", "Image": "D:\\x\\i.exe", "TargetFilename": "HKLM\\Software\\Microsoft\\Windows NT\\CurrentVersion\\Image File Execution Options\\sethc.exe\\Debugger"}, "malicious",
        [("privilege_escalation", "HKLM\\Software\\Microsoft\\Windows NT\\CurrentVersion\\Image File Execution Options\\sethc.exe\\Debugger")], "privilege_escalation", f"Registry value set by i.exe: privileges are being elevated. {KNOWN}",
    ),
    (
        {"EventID": "1", "Image": "C:\\Tools\\PsExec.exe", "CommandLine": "PsExec.exe \\\\srv1 cmd", "Signed": "true", "Signer": "Sysinternals"}, "suspicious",
        [("remote_service_install", "PsExec.exe \\\\srv1 cmd"), ("signed_known_vendor", "Sysinternals")], "lateral_movement",
        f"Process creation by psexec.exe: it acts against a remote host. {REVIEW} The mitigating evidence (the binary is signed by a known vendor) does not outweigh it.",
    ),
    (
        {"EventID": "3", "Image": "D:\\a.exe", "DestinationIp": "93.184.216.34", "DestinationPort": "443", "DestinationHostname": "www.example.com"}, "benign",
        [("outbound_known_good", "93.184.216.34:443")], None, f"Network connection by a.exe: the destination is a well-known service on its usual port. {NORMAL}",
    ),
    (
        {"EventID": "7", "Image": "D:\\h\\host.exe", "TargetFilename": "D:\\h\\plug.dll", "Signed": "false"}, "suspicious",
        [("unsigned_binary", "plug.dll")], "malware", f"Image load by host.exe: the binary is unsigned. {REVIEW}",
    ),
    (
        {"EventID": "1", "Image": "D:\\t\\certutil.exe", "CommandLine": "certutil -hashfile a"}, "benign",
        [("lolbin_exec", "certutil.exe")], None, f"Process creation by certutil.exe: the image is a living-off-the-land binary. {NORMAL} The pattern is documented normal behaviour for this binary.",
    ),
    (
        {"EventID": "1", "Image": "D:\\t\\rar.exe", "CommandLine": "rar a out.rar D:\\share"}, "malicious",
        [("system32_path", "d:\\t")], "data_exfiltration", f"Process creation by rar.exe: it executes from a system path. {KNOWN}",
    ),
    (
        {"EventID": "1", "Image": "D:\\t\\vssadmin.exe", "ParentImage": "D:\\t\\x.exe", "CommandLine": "vssadmin delete shadows /all"}, "malicious",
        [("expected_parent", "x.exe -> vssadmin.exe")], "ransomware", f"Process creation by vssadmin.exe: the parent-child relationship is normal. {KNOWN}",
    ),
    (
        {"EventID": "1", "Image": "D:\\t\\miner.exe", "CommandLine": "miner.exe -o stratum+tcp://pool:3333"}, "malicious",
        [("system32_path", "d:\\t")], "cryptomining", f"Process creation by miner.exe: it executes from a system path. {KNOWN}",
    ),
    (
        {"EventID": "4624", "User": "CORP\\ann", "LogonType": "2", "AuthPackage": "Negotiate"}, "suspicious",
        [("system32_path", "-")], "unknown", f"Successful logon by the subject: it executes from a system path. {REVIEW}",
    ),
]


def test_every_indicator_has_an_event():
    """signature_invalid has a phrase, but nothing makes it."""
    assert {k for _, _, found, *_ in EVENTS for k, _ in found} == set(targets.PHRASES) - {"signature_invalid"}


def test_targets_of_rows_worked_by_hand(spark):
    rows = [(i, gold, {"benign": "none", "suspicious": "medium", "malicious": "high"}[gold], *(f.get(x) for x in FIELDS)) for i, (f, gold, *_) in enumerate(EVENTS)]
    df = spark.createDataFrame(rows, "i int, gold string, severity string, " + ", ".join(f"{f} string" for f in FIELDS))
    got = targets.with_targets(df).orderBy("i").collect()
    for r, (_, _, indicators, threat, reasoning) in zip(got, EVENTS, strict=True):
        assert [(x["key"], x["value"]) for x in r["indicators"]] == indicators
        assert (r["threat_type"], r["reasoning"], r["is_threat"]) == (threat, reasoning, r["gold"] != "benign")
