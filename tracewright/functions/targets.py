"""Training targets of an event: ordered indicators, threat type and a sentence of reasoning.

The rules are written once, over a few operations; `SparkOps` compiles them to Columns, and plans.oracles to SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.contract import let, lookup

# Binaries, folders, parents and their usual children, patterns, vocabulary, phrases.
LOLBINS = (
    "rundll32.exe", "mshta.exe", "regsvr32.exe", "certutil.exe", "bitsadmin.exe", "wmic.exe", "cscript.exe", "wscript.exe", "msbuild.exe", "installutil.exe",
    "regasm.exe", "regsvcs.exe", "cmstp.exe", "forfiles.exe", "pcalua.exe", "odbcconf.exe", "xwizard.exe", "presentationhost.exe", "ieexec.exe",
    "msdt.exe", "hh.exe", "ftp.exe", "esentutl.exe", "extrac32.exe", "makecab.exe", "expand.exe", "replace.exe", "print.exe", "scriptrunner.exe",
    "mavinject.exe", "sc.exe", "schtasks.exe", "at.exe", "reg.exe",
)
SHELLS = ("cmd.exe", "powershell.exe", "pwsh.exe", "wscript.exe", "cscript.exe", "mshta.exe", "bash.exe", "wsl.exe")
OFFICE = ("winword.exe", "excel.exe", "powerpnt.exe", "outlook.exe", "msaccess.exe", "mspub.exe", "visio.exe", "onenote.exe")
BROWSERS = ("chrome.exe", "firefox.exe", "msedge.exe", "iexplore.exe", "brave.exe", "opera.exe", "vivaldi.exe")
SERVICE_HOSTS = ("services.exe", "svchost.exe")
SYSTEM_NAMES = (
    "svchost.exe", "lsass.exe", "services.exe", "csrss.exe", "winlogon.exe", "smss.exe", "spoolsv.exe", "taskhostw.exe", "dllhost.exe", "conhost.exe",
    "wininit.exe", "explorer.exe", "runtimebroker.exe", "sihost.exe", "ctfmon.exe",
)
SYSTEM_DIRS = ("c:\\windows\\system32", "c:\\windows\\syswow64", "c:\\program files", "c:\\program files (x86)", "c:\\windows\\winsxs", "c:\\windows\\microsoft.net")
TEMP_DIRS = (
    "\\appdata\\local\\temp", "\\appdata\\roaming", "\\appdata\\local", "c:\\windows\\temp", "c:\\programdata", "c:\\temp", "c:\\users\\public",
    "\\downloads", "c:\\perflogs", "c:\\windows\\tasks", "c:\\windows\\debug", "c:\\windows\\tracing",
)
EXPECTED = {
    "explorer.exe": ("cmd.exe", "powershell.exe", "notepad.exe", "chrome.exe", "msedge.exe", "firefox.exe", "code.exe", "winword.exe", "excel.exe", "outlook.exe",
                     "teams.exe", "slack.exe", "mmc.exe", "taskmgr.exe", "control.exe", "regedit.exe"),
    "services.exe": ("svchost.exe", "spoolsv.exe", "msmpeng.exe", "searchindexer.exe", "wmiprvse.exe", "vmtoolsd.exe", "sqlservr.exe", "w3wp.exe", "dllhost.exe",
                     "vgauthservice.exe", "securityhealthservice.exe"),
    "svchost.exe": ("taskhostw.exe", "runtimebroker.exe", "sihost.exe", "ctfmon.exe", "dllhost.exe", "wmiprvse.exe", "audiodg.exe", "consent.exe",
                    "backgroundtaskhost.exe", "wuauclt.exe", "usoclient.exe"),
    "wininit.exe": ("services.exe", "lsass.exe", "lsm.exe"),
    "userinit.exe": ("explorer.exe",),
    "winlogon.exe": ("userinit.exe", "dwm.exe", "logonui.exe", "fontdrvhost.exe"),
    "taskeng.exe": ("cmd.exe", "powershell.exe", "msiexec.exe"),
    "msiexec.exe": ("msiexec.exe", "rundll32.exe"),
    "code.exe": ("code.exe", "cmd.exe", "powershell.exe", "node.exe", "git.exe"),
}
HIDDEN = r"(?i)(-w(?:indow)?s?(?:tyle)?\s+h(?:idden)?\b|createnowindow|\bwindowstyle\s*=\s*hidden)"
ENCODED = r"(?i)(-e(?:nc|ncoded)?(?:command)?\s+[A-Za-z0-9+/=]{16,}|frombase64string|\[convert\]::|-enc\b|-encodedcommand\b)"
CRADLE = (
    r"(?i)(invoke-webrequest|invoke-restmethod|\biwr\b|\bcurl\b|\bwget\b|downloadstring|downloadfile|downloaddata|net\.webclient|start-bitstransfer"
    r"|bitsadmin[^|]*?/transfer|certutil[^|]*?-urlcache|\bhttps?://)"
)
BYPASS = r"(?i)(-ex(?:ec)?(?:utionpolicy)?\s+(bypass|unrestricted)|-nop\b|-noprofile\b)"
DISCOVERY = (
    r"(?i)\b(whoami|systeminfo|nltest|net\s+(user|group|localgroup|view|share|accounts)|net1\s+(user|group)|ipconfig|arp\s+-a|nbtstat|quser|qwinsta|dsquery"
    r"|tasklist|hostname|netstat|route\s+print|wmic\s+(computersystem|os|process|qfe|useraccount))\b"
)
ADMIN_SHARE = r"(?i)\\\\[^\\]+\\(admin\$|ipc\$|c\$)"
AUTORUN = (
    r"(?i)(\\currentversion\\run(once)?\b|\\winlogon\\(shell|userinit)|\\image file execution options\\|\\services\\[^\\]+\\imagepath"
    r"|\\currentversion\\explorer\\shell\s?folders|\\policies\\explorer\\run|\\userinitmprlogonscript)"
)
ANTIFORENSIC = (
    r"(?i)(vssadmin[^|]*?delete\s+shadows|wevtutil\s+cl|clear-eventlog|bcdedit[^|]*?(recoveryenabled|bootstatuspolicy)|wbadmin\s+delete|cipher\s+/w"
    r"|fsutil\s+usn\s+deletejournal)"
)
ELEVATION = r"(?i)(sedebugprivilege|setcbprivilege|token.*eleva)"
REMOTE = r"(?i)\b(psexec|sc\s+\\\\|wmic\s+/node|winrs|invoke-command\s+-computername)"
EXFILTRATION = r"(?i)(compress-archive|\brar\s+a\b|7z\s+a\b|invoke-webrequest[^|]*-method\s+post|\bftp\b|uploadfile)"
MINING = r"(?i)(xmrig|stratum\+tcp|minerd|nicehash)"
USUAL_PORTS, INTERNAL_PORTS = (80, 443, 53, 123, 88, 389, 636, 3268), (445, 139, 135, 3389, 5985, 5986)
BENIGN_KEYS = ("signed_microsoft", "signed_known_vendor", "system32_path", "expected_parent", "restricted_service_acct", "outbound_known_good")
PHRASES = {
    "office_spawns_shell": "an Office application spawned a shell", "browser_spawns_shell": "a browser spawned a shell",
    "service_host_spawns_proc": "a service host spawned an unexpected child", "system_context_exec": "it runs in SYSTEM context",
    "lolbin_exec": "the image is a living-off-the-land binary", "temp_path_exec": "the image runs from a user-writable path", "unsigned_binary": "the binary is unsigned",
    "signature_invalid": "the signature failed validation", "masquerading_name": "the filename mimics a system binary outside a system path",
    "service_binary_created": "a service or system binary was written to disk", "hidden_window": "the window is hidden", "encoded_command": "the command line is encoded",
    "download_cradle": "the command line fetches remote content", "exec_policy_bypass": "execution policy is bypassed", "discovery_command": "it enumerates hosts, users or domains",
    "outbound_uncommon_port": "the destination port is non-standard", "outbound_known_good": "the destination is a well-known service on its usual port",
    "raw_ip_no_dns": "it connects to a literal IP with no DNS resolution", "remote_service_install": "it acts against a remote host",
    "smb_admin_share": "it touches an SMB administrative share", "blank_or_guest_account": "the account is guest or blank-password",
    "legacy_auth_protocol": "authentication is downgraded", "privilege_escalation": "privileges are being elevated",
    "signed_microsoft": "the binary carries a valid Microsoft signature", "signed_known_vendor": "the binary is signed by a known vendor",
    "system32_path": "it executes from a system path", "expected_parent": "the parent-child relationship is normal",
    "restricted_service_acct": "it runs under a restricted service account",
}
VERDICTS = {
    "malicious": "This matches a known attack technique and should be treated as malicious.",
    "suspicious": "This is consistent with legitimate administration but also with an attack in progress, so it warrants review rather than a verdict.",
    "benign": "Nothing here departs from normal activity for this host.",
}
ACTIONS = {
    "1": "Process creation", "4688": "Process creation", "3": "Network connection", "7": "Image load", "11": "File creation", "12": "Registry key operation",
    "13": "Registry value set", "4624": "Successful logon", "4625": "Failed logon",
}
#: threat type, any of these indicators
THREATS_BY_INDICATOR = {
    "lateral": ("remote_service_install", "smb_admin_share"),
    "malware": ("download_cradle", "encoded_command", "temp_path_exec", "masquerading_name", "office_spawns_shell", "browser_spawns_shell"),
    "weak": ("lolbin_exec", "unsigned_binary", "service_binary_created", "service_host_spawns_proc", "raw_ip_no_dns", "outbound_uncommon_port"),
}


class SparkOps:
    """What the rules are made of."""

    def field(self, name):
        return F.coalesce(F.col(name), F.lit(""))

    def text(self, value):
        return F.lit(value)

    def matches(self, x, pattern):
        return x.rlike(pattern)

    def one_of(self, x, values):
        return x.isin(*values)

    def contains(self, x, part):
        return x.contains(part)

    def ends(self, x, part):
        return x.endswith(part)

    def lower(self, x):
        return F.lower(x)

    def base(self, path):
        return F.lower(F.substring_index(F.replace(path, F.lit("/"), F.lit("\\")), "\\", -1))

    def folder(self, path):
        p = F.replace(path, F.lit("/"), F.lit("\\"))
        return F.when(p.contains("\\"), F.lower(F.regexp_replace(p, r"\\[^\\]*$", ""))).otherwise(F.lit(""))

    def clip(self, x, n=120):
        v = F.trim(F.regexp_replace(x, r"\s+", " "))
        return let(v, lambda v: F.when(F.length(v) <= n, v).otherwise(F.concat(F.substring(v, 1, n - 1), F.lit("\u2026"))))

    def join(self, *parts):
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    def number(self, x):
        return F.coalesce(F.trim(x).try_cast("long"), F.lit(-1))

    def all(self, *c):
        return reduce(lambda a, b: a & b, c)

    def any(self, *c):
        return reduce(lambda a, b: a | b, c)

    def no(self, c):
        return ~c

    def is_(self, x, value):
        return x == value

    def at_least(self, x, n):
        return x >= n

    def pick(self, *pairs, otherwise):
        out = F.when(*pairs[0])
        for c, v in pairs[1:]:
            out = out.when(c, v)
        return out.otherwise(otherwise)


def slots(d):
    """(indicator, condition, evidence) in order, incriminating ones first. d compiles the operations."""
    eid, img, par, cmd, tgt, user = (d.field(f) for f in ("EventID", "Image", "ParentImage", "CommandLine", "TargetFilename", "User"))
    auth, logon, dip, port, dns, signer = (d.field(f) for f in ("AuthPackage", "LogonType", "DestinationIp", "DestinationPort", "DestinationHostname", "Signer"))
    ib, pb, folder, t, ul, pn = d.base(img), d.base(par), d.folder(img), d.lower(tgt), d.lower(user), d.number(port)
    inside = lambda x, dirs: d.any(*(d.contains(x, p) for p in dirs))
    usual = d.any(*(d.all(d.is_(pb, p), d.one_of(ib, c)) for p, c in EXPECTED.items()))
    office, browser = d.all(d.one_of(pb, OFFICE), d.one_of(ib, SHELLS)), d.all(d.one_of(pb, BROWSERS), d.one_of(ib, SHELLS))
    service = d.all(d.one_of(pb, SERVICE_HOSTS), d.no(d.is_(ib, "")), d.no(usual))
    line, run, file = d.join(pb, " -> ", ib), d.one_of(eid, ("1", "4688")), d.one_of(eid, ("11", "12", "13", "14"))
    auto, ifeo, services = d.all(file, d.matches(t, AUTORUN)), d.contains(t, "image file execution"), d.contains(t, "\\services\\")
    auto_ifeo = d.all(auto, d.no(services), ifeo)
    signed, net, share, to = d.lower(d.field("Signed")), d.is_(eid, "3"), d.matches(cmd, ADMIN_SHARE), d.join(dip, ":", port)
    vendor = d.all(d.is_(signed, "true"), d.no(d.is_(signer, "")))
    guest = d.any(d.matches(user, r"(?i)\\(guest|anonymous)$"), d.all(d.is_(d.lower(auth), "ntlm"), d.is_(logon, "3"), d.contains(ul, "guest")))
    elevated = d.any(d.is_(logon, "0"), d.matches(cmd, ELEVATION))
    system = d.all(d.contains(ul, "system"), d.no(d.contains(ul, "localsystem")))
    has_pb = d.no(d.is_(pb, ""))
    return [
        ("office_spawns_shell", office, line),
        ("browser_spawns_shell", d.all(d.no(office), browser), line),
        ("service_host_spawns_proc", d.all(d.no(office), d.no(browser), service), line),
        ("system_context_exec", system, user),
        ("blank_or_guest_account", guest, user),
        ("legacy_auth_protocol", d.all(d.one_of(d.lower(auth), ("ntlm", "ntlmv1", "msv1_0")), d.one_of(eid, ("4624", "4625"))), auth),
        ("privilege_escalation", elevated, d.pick((auto_ifeo, tgt), (d.is_(cmd, ""), logon), otherwise=d.clip(cmd))),
        ("temp_path_exec", d.all(run, inside(folder, TEMP_DIRS)), img),
        ("masquerading_name", d.all(run, d.one_of(ib, SYSTEM_NAMES), d.no(inside(folder, SYSTEM_DIRS))), img),
        ("lolbin_exec", d.all(run, d.one_of(ib, LOLBINS)), ib),
        ("unsigned_binary", d.is_(signed, "false"), d.pick((d.no(d.is_(tgt, "")), d.base(tgt)), (d.no(d.is_(ib, "")), ib), otherwise=d.text("-"))),
        ("encoded_command", d.matches(cmd, ENCODED), d.clip(cmd)),
        ("hidden_window", d.matches(cmd, HIDDEN), d.clip(cmd, 80)),
        ("download_cradle", d.matches(cmd, CRADLE), d.clip(cmd)),
        ("exec_policy_bypass", d.matches(cmd, BYPASS), d.clip(cmd, 80)),
        ("discovery_command", d.matches(cmd, DISCOVERY), d.clip(cmd, 80)),
        ("service_binary_created", d.any(d.all(auto, services), d.all(d.is_(eid, "11"), d.contains(t, "\\system32\\"), d.ends(t, ".exe"))), tgt),
        ("privilege_escalation", d.all(auto_ifeo, d.no(elevated)), tgt),
        ("masquerading_name", d.all(auto, d.no(services), d.no(ifeo)), tgt),
        ("temp_path_exec", d.all(d.is_(eid, "11"), d.any(d.ends(t, ".exe"), d.ends(t, ".dll")), inside(t, TEMP_DIRS)), tgt),
        ("smb_admin_share", d.all(net, d.any(share, d.one_of(pn, (445, 139)))), to),
        ("outbound_uncommon_port", d.all(net, d.at_least(pn, 0), d.no(d.one_of(pn, (*USUAL_PORTS, *INTERNAL_PORTS)))), to),
        ("raw_ip_no_dns", d.all(net, d.is_(dns, ""), d.matches(dip, r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$")), dip),
        ("remote_service_install", d.any(share, d.matches(cmd, REMOTE)), d.clip(cmd, 80)),
        ("expected_parent", d.all(d.no(office), d.no(browser), d.no(service), has_pb, usual), line),
        ("restricted_service_acct", d.all(d.no(system), d.any(d.contains(ul, "local service"), d.contains(ul, "network service"))), user),
        ("signed_microsoft", d.all(vendor, d.contains(d.lower(signer), "microsoft")), signer),
        ("signed_known_vendor", d.all(vendor, d.no(d.contains(d.lower(signer), "microsoft"))), signer),
        ("system32_path", inside(folder, SYSTEM_DIRS), folder),
        ("outbound_known_good", d.all(net, d.one_of(pn, USUAL_PORTS)), to),
    ]


def fallback(d):
    """(condition, evidence) of the indicator that stands where no rule applies: expected_parent, else system32_path."""
    img, par = d.field("Image"), d.field("ParentImage")
    folder = d.folder(img)
    return d.no(d.is_(d.base(par), "")), d.join(d.base(par), " -> ", d.base(img)), d.pick((d.no(d.is_(folder, "")), folder), (d.no(d.is_(img, "")), img), otherwise=d.text("-"))


def indicators() -> Column:
    """array<struct<key, value>> of the contract columns: at most four, incriminating first, never empty."""
    d = SparkOps()
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    every = F.array_compact(F.array(*(F.when(c, entry(k, v)) for k, c, v in slots(d))))
    has_parent, line, place = fallback(d)
    otherwise = F.when(has_parent, entry("expected_parent", line)).otherwise(entry("system32_path", place))
    found = let(every, lambda x: F.when(F.size(x) > 0, F.slice(x, 1, 4)).otherwise(F.array(otherwise)))
    return F.transform(found, lambda x: F.struct(x["key"].alias("key"), d.clip(x["value"]).alias("value")))


def threat_type(keys: Column, gold: Column) -> Column:
    """The first rule that fits; null for benign events. keys: the indicators' names."""
    any_of = lambda names: F.arrays_overlap(keys, F.array(*map(F.lit, names)))
    has = lambda name: F.array_contains(keys, name)
    eid, cmd = F.coalesce("EventID", F.lit("")), F.concat_ws(" ", *(F.when(F.col(c) != "", F.col(c)) for c in ("CommandLine", "TargetFilename")))
    return (
        F.when(gold == "benign", F.lit(None).cast("string"))
        .when(eid == "4625", "credential_stuffing")
        .when(has("privilege_escalation") | (has("system_context_exec") & any_of(("masquerading_name", "temp_path_exec"))), "privilege_escalation")
        .when(any_of(THREATS_BY_INDICATOR["lateral"]), "lateral_movement")
        .when(cmd.rlike(EXFILTRATION), "data_exfiltration")
        .when(has("discovery_command"), "reconnaissance")
        .when(any_of(THREATS_BY_INDICATOR["malware"]), "malware")
        .when(cmd.rlike(MINING), "cryptomining")
        .when(cmd.rlike(ANTIFORENSIC), "ransomware")
        .when((eid.isin("11", "12", "13", "14") & cmd.rlike(AUTORUN)) | any_of(THREATS_BY_INDICATOR["weak"]), "malware")
        .otherwise("unknown")
    )


def reasoning(keys: Column, gold: Column) -> Column:
    """One or two observations, the verdict of the class, and what speaks against it."""
    d = SparkOps()
    phrases = lambda x: F.transform(x, lambda k: lookup(k, PHRASES))
    bad, good = phrases(F.filter(keys, lambda k: ~k.isin(*BENIGN_KEYS))), phrases(F.filter(keys, lambda k: k.isin(*BENIGN_KEYS)))
    head = F.coalesce(lookup(F.col("EventID"), ACTIONS), F.lit("Event"))
    ib, tb = d.base(d.field("Image")), d.base(d.field("TargetFilename"))
    subject = F.when(ib != "", ib).when(tb != "", tb).otherwise(F.lit("the subject"))
    seen = F.array_join(F.slice(F.when(F.size(bad) > 0, bad).otherwise(good), 1, 2), " and ")
    first = F.get(good, F.lit(0))
    tail = (
        F.when((F.size(bad) > 0) & (F.size(good) > 0) & (gold != "benign"), F.concat(F.lit(" The mitigating evidence ("), first, F.lit(") does not outweigh it.")))
        .when((F.size(bad) > 0) & (gold == "benign") & (F.size(good) > 0), F.concat(F.lit(" "), F.upper(F.substring(first, 1, 1)), F.lower(F.substr(first, F.lit(2))), F.lit(", which accounts for it.")))
        .when((F.size(bad) > 0) & (gold == "benign"), F.lit(" The pattern is documented normal behaviour for this binary."))
        .otherwise(F.lit(""))
    )
    return F.concat(head, F.lit(" by "), subject, F.lit(": "), F.when(seen != "", seen).otherwise(F.lit("no notable properties")), F.lit(". "), lookup(gold, VERDICTS), tail)


def with_targets(events: DataFrame) -> DataFrame:
    """events (contract columns, gold, severity) with indicators, threat_type, is_threat, reasoning and the JSON target."""
    out = events.withColumn("indicators", indicators())
    keys = F.transform("indicators", lambda x: x["key"])
    out = out.withColumns({"threat_type": threat_type(keys, F.col("gold")), "is_threat": F.col("gold") != "benign", "reasoning": reasoning(keys, F.col("gold"))})
    target = F.to_json(F.struct(
        F.col("severity").alias("severity"), F.col("is_threat").alias("isThreat"), F.col("threat_type").alias("threatType"),
        F.map_from_entries("indicators").alias("indicators"), F.col("reasoning").alias("reasoning"),
    ), {"ignoreNullFields": "false"})
    return out.withColumn("target", target)


def indicator_frequency(events: DataFrame) -> DataFrame:
    """key, n of with_targets(), with 0 for indicators of the vocabulary that never occur."""
    # a plain explode would have Spark filter on the size of the array first, that is, make it once more for each condition; it is never empty
    n = events.select(F.explode_outer("indicators.key").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    names = events.sparkSession.createDataFrame([(k,) for k in PHRASES], "key string")
    return names.join(n, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n"))
