"""Synthetic benign and suspicious events: a table of templates, drawn by hashes of a seed and a running number.

Quotas follow an EventID mix and are met exactly. Families of an EventID take turns. Events are tried in rounds: each round
tries as many numbers of an EventID as its quota is short of, and some more, spread over all tasks; bodies that were
made before are passed over, of the rest those with the smallest numbers stay. The same seed gives the same events in
any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.contract import FIELDS, rendered
from tracewright.functions.rewriting import ACCOUNT_KINDS, HOSTS, account, drawn, home_of, pick
from tracewright.operators.sampling import apportion, numbered
from tracewright.sources.writers import staged

S32, PF = "C:\\Windows\\System32", "C:\\Program Files"
PS = f"{S32}\\WindowsPowerShell\\v1.0\\powershell.exe"
SYSTEM, LOCAL_SERVICE = "NT AUTHORITY\\SYSTEM", "NT AUTHORITY\\LOCAL SERVICE"
OFFICE = f"{PF}\\Microsoft Office\\root\\Office16"
#: Parents by how a process is started; a family without a parent of its own draws from those that keep its meaning, the
#: same in every class, so that the parent does not tell the class.
PARENT_GROUPS: dict[str, tuple[tuple[str, str], ...]] = {
    "interactive": (
        (f"{S32}\\cmd.exe", f'"{S32}\\cmd.exe"'), ("C:\\Windows\\explorer.exe", "C:\\Windows\\explorer.exe"), (PS, f'"{PS}" -NoLogo'),
        (f"{S32}\\mmc.exe", f'"{S32}\\mmc.exe" "{S32}\\services.msc"'), (f"{PF}\\Microsoft VS Code\\Code.exe", f'"{PF}\\Microsoft VS Code\\Code.exe" --type=ptyHost'),
    ),
    "scheduled": ((f"{S32}\\taskeng.exe", "taskeng.exe {7C0E5A11-2B44-4B7B-9F11-0A52C1D7E001} S-1-5-18:"), (f"{S32}\\svchost.exe", f"{S32}\\svchost.exe -k netsvcs -p -s Schedule"), (f"{S32}\\cmd.exe", f'"{S32}\\cmd.exe" /c {PF}\\HALVEN\\logon.cmd')),
    "service": ((f"{S32}\\services.exe", f"{S32}\\services.exe"), (f"{S32}\\svchost.exe", f"{S32}\\svchost.exe -k DcomLaunch -p"), (f"{S32}\\wbem\\WmiPrvSE.exe", f"{S32}\\wbem\\WmiPrvSE.exe -Embedding")),
}
DRAWN_FROM = ("interactive", "scheduled")
#: Share of each EventID.
MIX = ((1, 0.514), (13, 0.130), (11, 0.122), (3, 0.080), (4624, 0.068), (7, 0.050), (12, 0.032), (4625, 0.002))
#: Kinds of events that one class has no template for, and the EventID that takes their share.
FOLDED = {"suspicious": {7: 1}}
#: Families that take more turns than one.
TURNS = {"plain tool": 3}
#: Tries of a round for each event that is missing, tries that one task makes, and rounds without a new event before the
#: templates are found to be exhausted.
MORE, TASK, IDLE = 1.25, 50_000, 3

#: (class, family, EventID, severity, fields); <home>, <host>, <n> are drawn, and a parent and an account where none is given.
TEMPLATES: tuple[tuple[str, str, int, str, dict[str, str]], ...] = tuple(
    (kind, family, event_id, severity, dict(zip(names.split(), row, strict=True)))
    for kind, family, event_id, severity, names, rows in (
        ("benign", "desktop app", 1, "none", "Image CommandLine", [(f"{S32}\\notepad.exe", f'"{S32}\\notepad.exe" <home>\\Documents\\notes<n>.txt'), (f"{S32}\\mspaint.exe", f'"{S32}\\mspaint.exe" <home>\\Pictures\\p<n>.png'), ("C:\\Windows\\explorer.exe", "C:\\Windows\\explorer.exe /select,<home>\\Downloads\\scan<n>.pdf"), (f"{S32}\\SnippingTool.exe", f'"{S32}\\SnippingTool.exe" /clip<n>')]),
        ("benign", "service host", 1, "none", "Image CommandLine ParentImage User", [(f"{S32}\\svchost.exe", f"{S32}\\svchost.exe -k netsvcs -p -s svc<n>", f"{S32}\\services.exe", SYSTEM), (f"{S32}\\svchost.exe", f"{S32}\\svchost.exe -k LocalService -s svc<n>", f"{S32}\\services.exe", LOCAL_SERVICE), (f"{S32}\\spoolsv.exe", f"{S32}\\spoolsv.exe -q<n>", f"{S32}\\services.exe", SYSTEM)]),
        ("benign", "vendor updater", 1, "low", "Image CommandLine", [("<home>\\AppData\\Local\\Microsoft\\OneDrive\\OneDrive.exe", '"<home>\\AppData\\Local\\Microsoft\\OneDrive\\OneDrive.exe" /background /i<n>'), ("<home>\\AppData\\Local\\slack\\slack.exe", '"<home>\\AppData\\Local\\slack\\slack.exe" --process-start-args=<n>'), (f"{PF} (x86)\\Google\\Update\\GoogleUpdate.exe", "GoogleUpdate.exe /ua /installsource scheduler /c<n>")]),
        ("benign", "developer tools", 1, "low", "Image CommandLine", [(f"{PF}\\nodejs\\node.exe", f'"{PF}\\nodejs\\node.exe" <home>\\src\\app<n>\\build.js'), (f"{PF}\\Git\\cmd\\git.exe", "git.exe log -n <n>"), ("<home>\\src\\env\\Scripts\\python.exe", "python.exe -m pytest tests\\test_<n>.py"), (f"{PF}\\dotnet\\dotnet.exe", "dotnet.exe build <home>\\src\\web<n>\\web.csproj")]),
        ("benign", "office", 1, "none", "Image CommandLine", [(f"{OFFICE}\\EXCEL.EXE", '"EXCEL.EXE" "<home>\\Documents\\budget<n>.xlsx"'), (f"{OFFICE}\\WINWORD.EXE", '"WINWORD.EXE" /n "<home>\\Documents\\letter<n>.docx"'), (f"{OFFICE}\\OUTLOOK.EXE", '"OUTLOOK.EXE" /recycle <n>')]),
        ("benign", "system helper", 1, "low", "Image CommandLine ParentImage", [(f"{S32}\\rundll32.exe", f'"{S32}\\rundll32.exe" shell32.dll,Control_RunDLL "{S32}\\main.cpl",,<n>', f"{S32}\\control.exe"), (f"{S32}\\dllhost.exe", f"{S32}\\dllhost.exe /Processid:<n>", f"{S32}\\svchost.exe"), (f"{S32}\\msiexec.exe", f"{S32}\\msiexec.exe /i \\\\deploy\\pkg<n>.msi /qn", f"{S32}\\svchost.exe")]),
        ("benign", "local admin", 1, "none", "Image CommandLine", [(PS, 'powershell.exe -NoProfile -Command "Get-Service -Name svc<n>"'), (f"{S32}\\ipconfig.exe", f'"{S32}\\ipconfig.exe" /all /n<n>'), (f"{S32}\\gpupdate.exe", "gpupdate.exe /target:computer /wait:<n>"), (f"{S32}\\chkdsk.exe", "chkdsk.exe D: /scan /perf<n>")]),
        ("benign", "security product", 1, "low", "Image CommandLine ParentImage User", [(f"{S32}\\SecurityHealthService.exe", f'"{S32}\\SecurityHealthService.exe" -i <n>', f"{S32}\\services.exe", SYSTEM), (f"{PF}\\Windows Defender\\MpCmdRun.exe", f'"{PF}\\Windows Defender\\MpCmdRun.exe" -SignatureUpdate -r<n>', f"{S32}\\svchost.exe", SYSTEM)]),
        ("benign", "unsigned but known", 1, "low", "Image CommandLine Signed", [("C:\\ProgramData\\HALVEN\\tools\\assetcheck.exe", '"C:\\ProgramData\\HALVEN\\tools\\assetcheck.exe" --report <n>', "false"), ("D:\\plant\\labelprint.exe", "labelprint.exe /queue <n>", "false")]),
        ("benign", "plain tool", 1, "none", "Image CommandLine", [(f"{S32}\\calc.exe", f'"{S32}\\calc.exe" <n>'), (f"{S32}\\charmap.exe", f'"{S32}\\charmap.exe" <n>'), (f"{S32}\\hostname.exe", "hostname.exe /n<n>"), (f"{S32}\\tasklist.exe", "tasklist.exe /fo csv /n<n>")]),
        ("benign", "long command", 1, "low", "Image CommandLine", [(f"{PF}\\Java\\bin\\java.exe", "java.exe -cp " + "C:\\libs\\dependency.jar;" * 24 + " Main<n>"), (f"{PF}\\Git\\usr\\bin\\bash.exe", "bash.exe -c 'for f in <n> " + "src/module/file.c " * 30 + "; do cc -c $f; done'")]),
        ("benign", "web worker", 1, "low", "Image CommandLine ParentImage", [(f"{S32}\\inetsrv\\w3wp.exe", f'{S32}\\inetsrv\\w3wp.exe -ap "Pool<n>"', f"{S32}\\svchost.exe"), (f"{S32}\\inetsrv\\appcmd.exe", f'"{S32}\\inetsrv\\appcmd.exe" recycle apppool /apppool.name:"Pool<n>"', f"{S32}\\cmd.exe"), ("C:\\Windows\\Microsoft.NET\\Framework64\\v4.0.30319\\csc.exe", "csc.exe /noconfig /fullpaths @tmp<n>.cmdline", f"{S32}\\inetsrv\\w3wp.exe")]),
        ("benign", "web worker", 3, "low", "Image User DestinationIp DestinationPort DestinationHostname", [(f"{S32}\\inetsrv\\w3wp.exe", "IIS APPPOOL\\Pool<o>", "10.20.<p>.<o>", "1433", "sql<n>.halven.local"), (f"{S32}\\inetsrv\\w3wp.exe", "IIS APPPOOL\\Portal", "10.21.<p>.<o>", "443", "api<n>.halven.local")]),
        ("benign", "web worker", 11, "low", "Image User TargetFilename", [(f"{S32}\\inetsrv\\w3wp.exe", "IIS APPPOOL\\Pool<o>", "C:\\inetpub\\temp\\IIS Temporary Compressed Files\\Pool<o>\\page<n>.css.gz"), (f"{S32}\\inetsrv\\w3wp.exe", "IIS APPPOOL\\Portal", "C:\\inetpub\\logs\\LogFiles\\W3SVC<o>\\u_ex<n>.log")]),
        ("benign", "logon ui", 1, "none", "Image CommandLine ParentImage User", [(f"{S32}\\LogonUI.exe", f'"{S32}\\LogonUI.exe" /flags:0x<n>', f"{S32}\\winlogon.exe", SYSTEM), (f"{S32}\\userinit.exe", f"{S32}\\userinit.exe /s<n>", f"{S32}\\winlogon.exe", SYSTEM)]),
        ("benign", "web browsing", 3, "none", "Image DestinationIp DestinationPort DestinationHostname", [(f"{PF}\\Google\\Chrome\\Application\\chrome.exe", "93.184.<p>.<o>", "443", "www<n>.example.com"), (f"{PF}\\Mozilla Firefox\\firefox.exe", "198.18.<p>.<o>", "443", "cdn<n>.example.org"), (f"{OFFICE}\\OUTLOOK.EXE", "192.0.<p>.<o>", "443", "mail<n>.example.net")]),
        ("benign", "uncommon port", 3, "low", "Image DestinationIp DestinationPort DestinationHostname", [(f"{PF}\\HALVEN\\backup.exe", "10.0.<p>.<o>", "9100", "backup<n>.halven.local"), (f"{PF}\\HALVEN\\metrics.exe", "10.0.<p>.<o>", "8125", "stats<n>.halven.local")]),
        ("benign", "image load", 7, "none", "Image TargetFilename Signed Signer", [("C:\\Windows\\explorer.exe", f"{S32}\\lib<n>.dll", "true", "Microsoft Windows"), (f"{OFFICE}\\WINWORD.EXE", f"{OFFICE}\\addin<n>.dll", "true", "Microsoft Corporation")]),
        ("benign", "file create", 11, "none", "Image TargetFilename", [(f"{OFFICE}\\WINWORD.EXE", "<home>\\Documents\\report<n>.docx"), (f"{PF}\\Google\\Chrome\\Application\\chrome.exe", "<home>\\Downloads\\invoice<n>.pdf"), (f"{S32}\\svchost.exe", "C:\\Windows\\Prefetch\\APP<n>.pf")]),
        ("benign", "registry", 12, "none", "Image TargetFilename", [("C:\\Windows\\explorer.exe", "HKU\\S-1-5-21-1\\Software\\App<n>"), (f"{S32}\\svchost.exe", "HKLM\\Software\\Microsoft\\Cache\\k<n>")]),
        ("benign", "registry", 13, "none", "Image TargetFilename", [("C:\\Windows\\explorer.exe", "HKU\\S-1-5-21-1\\Software\\App<n>\\Window"), (f"{S32}\\lsass.exe", "HKLM\\System\\CurrentControlSet\\Control\\Lsa\\v<n>"), (f"{OFFICE}\\EXCEL.EXE", "HKU\\S-1-5-21-1\\Software\\Office\\Recent\\f<n>")]),
        ("benign", "logon", 4624, "none", "LogonType AuthPackage DestinationIp", [("2", "Negotiate", "127.0.<p>.<o>"), ("3", "Kerberos", "10.0.<p>.<o>"), ("7", "Negotiate", "127.0.<p>.<o>"), ("10", "Negotiate", "10.0.<p>.<o>")]),
        ("benign", "logon", 4625, "none", "LogonType AuthPackage DestinationIp", [("2", "Negotiate", "127.0.<p>.<o>"), ("3", "Kerberos", "10.0.<p>.<o>")]),
        ("suspicious", "discovery", 1, "medium", "Image CommandLine", [(f"{S32}\\whoami.exe", "whoami /all /n<n>"), (f"{S32}\\net.exe", "net view \\\\server<n>"), (f"{S32}\\nltest.exe", "nltest /dclist:dom<n>"), (f"{S32}\\systeminfo.exe", "systeminfo /s srv<n>"), (f"{S32}\\net.exe", "net group \"Domain Admins\" /domain /n<n>")]),
        ("suspicious", "remote admin", 1, "medium", "Image CommandLine", [(PS, "powershell.exe Enter-PSSession -ComputerName srv<n>"), (f"{S32}\\wbem\\WMIC.exe", "wmic /node:srv<n> os get caption"), (f"{S32}\\mstsc.exe", "mstsc.exe /v:srv<n> /admin")]),
        ("suspicious", "internal fetch", 1, "medium", "Image CommandLine", [(PS, "powershell.exe Invoke-WebRequest http://files.halven.local/pkg<n>.zip -OutFile p.zip"), (f"{S32}\\curl.exe", "curl.exe -o t<n>.ps1 http://files.halven.local/t.ps1"), (f"{S32}\\certutil.exe", "certutil.exe -urlcache -f http://pki.halven.local/ca<n>.crl ca.crl")]),
        ("suspicious", "grey persistence", 1, "medium", "Image CommandLine", [(f"{S32}\\schtasks.exe", "schtasks /query /tn job<n>"), (f"{S32}\\sc.exe", "sc.exe qc svc<n>"), (f"{S32}\\reg.exe", "reg query HKLM\\Software\\Microsoft\\Windows\\CurrentVersion\\Run /v app<n>")]),
        ("suspicious", "staging", 1, "medium", "Image CommandLine", [(f"{PF}\\7-Zip\\7z.exe", "7z a <home>\\Desktop\\share<n>.7z D:\\Shares\\Finance"), (f"{S32}\\robocopy.exe", "robocopy \\\\fs02\\hr <home>\\hr<n> /e"), (f"{S32}\\tar.exe", "tar.exe -cf <home>\\export<n>.tar D:\\Shares\\Legal")]),
        ("suspicious", "shadow recon", 1, "medium", "Image CommandLine", [(f"{S32}\\vssadmin.exe", "vssadmin list shadows /for=C: /n<n>"), (f"{S32}\\wbem\\WMIC.exe", "wmic shadowcopy list brief /n<n>")]),
        ("suspicious", "account admin", 1, "medium", "Image CommandLine", [(f"{S32}\\net.exe", "net user temp<n> /domain"), (f"{S32}\\net.exe", "net localgroup Administrators /n<n>"), (f"{S32}\\dsquery.exe", "dsquery user -name svc<n>*")]),
        ("suspicious", "dual-use tool", 1, "medium", "Image CommandLine", [("C:\\Tools\\PsExec.exe", "PsExec.exe \\\\srv<n> cmd /c hostname"), ("C:\\Tools\\plink.exe", "plink.exe -P <n> ops@10.0.8.4"), ("C:\\Tools\\ProcessHacker.exe", "ProcessHacker.exe -pid <n>")]),
        ("suspicious", "unsigned tool", 1, "medium", "Image CommandLine Signed", [("<home>\\Downloads\\scan<n>.exe", "scan<n>.exe 10.0.0.0/24", "false"), ("<home>\\Desktop\\portable\\viewer.exe", "viewer.exe /open d<n>", "false")]),
        ("suspicious", "network", 3, "medium", "Image DestinationIp DestinationPort", [("<home>\\Downloads\\agent.exe", "198.51.<p>.<o>", "8443"), (PS, "10.0.<p>.<o>", "5985"), (f"{S32}\\rundll32.exe", "203.0.<p>.<o>", "443")]),
        ("suspicious", "file", 11, "medium", "Image TargetFilename", [(PS, "C:\\ProgramData\\stage<n>.ps1"), (f"{S32}\\cmd.exe", "C:\\Windows\\Temp\\out<n>.txt"), ("<home>\\Downloads\\setup.exe", "<home>\\AppData\\Roaming\\helper<n>.exe")]),
        ("suspicious", "registry", 12, "medium", "Image TargetFilename", [(f"{S32}\\reg.exe", "HKCU\\Software\\Classes\\tool<n>"), (PS, "HKCU\\Software\\Scripts\\s<n>")]),
        ("suspicious", "registry", 13, "medium", "Image TargetFilename", [(f"{S32}\\reg.exe", "HKCU\\Software\\Vendor\\Policy<n>"), (PS, "HKLM\\System\\CurrentControlSet\\Services\\drv<n>\\Start")]),
        ("suspicious", "logon", 4624, "medium", "LogonType AuthPackage DestinationIp", [("10", "Negotiate", "203.0.<p>.<o>"), ("3", "NTLM", "10.0.<p>.<o>")]),
        ("suspicious", "failed logon", 4625, "medium", "LogonType AuthPackage DestinationIp", [("3", "NTLM", "10.0.<p>.<o>"), ("10", "Negotiate", "203.0.<p>.<o>")]),
        # further forms of the families above
        ("benign", "desktop app", 1, "none", "Image CommandLine", [(f"{S32}\\wordpad.exe", f'"{S32}\\wordpad.exe" <home>\\Documents\\memo<n>.rtf'), (f"{PF}\\VideoLAN\\VLC\\vlc.exe", f'"{PF}\\VideoLAN\\VLC\\vlc.exe" --started-from-file <home>\\Videos\\clip<n>.mp4'), (f"{PF}\\Adobe\\Acrobat DC\\Acrobat\\Acrobat.exe", '"Acrobat.exe" "<home>\\Downloads\\contract<n>.pdf"'), (f"{S32}\\Taskmgr.exe", f'"{S32}\\Taskmgr.exe" /<n>')]),
        ("benign", "service host", 1, "none", "Image CommandLine ParentImage User", [(f"{S32}\\svchost.exe", f"{S32}\\svchost.exe -k NetworkService -p -s net<n>", f"{S32}\\services.exe", "NT AUTHORITY\\NETWORK SERVICE"), (f"{S32}\\SearchIndexer.exe", f"{S32}\\SearchIndexer.exe /Embedding /i<n>", f"{S32}\\services.exe", SYSTEM), (f"{S32}\\WUDFHost.exe", f'"{S32}\\WUDFHost.exe" -HostGUID:<n> -IoEventPortName:p<o>', f"{S32}\\services.exe", LOCAL_SERVICE)]),
        ("benign", "vendor updater", 1, "low", "Image CommandLine", [("<home>\\AppData\\Local\\Programs\\signal-desktop\\Signal.exe", '"<home>\\AppData\\Local\\Programs\\signal-desktop\\Signal.exe" --update-check=<n>'), (f"{PF} (x86)\\Microsoft\\EdgeUpdate\\MicrosoftEdgeUpdate.exe", "MicrosoftEdgeUpdate.exe /ua /installsource core /r<n>"), ("<home>\\AppData\\Local\\Zoom\\bin\\Zoom.exe", '"<home>\\AppData\\Local\\Zoom\\bin\\Zoom.exe" --action=update --seq=<n>')]),
        ("benign", "developer tools", 1, "low", "Image CommandLine", [(f"{PF}\\Java\\jdk-21\\bin\\javac.exe", "javac.exe -d out src\\Main<n>.java"), (f"{PF}\\Docker\\Docker\\resources\\bin\\docker.exe", "docker.exe build -t app:<n> ."), ("<home>\\.cargo\\bin\\cargo.exe", "cargo.exe test --package crate<n>"), (f"{PF}\\PowerShell\\7\\pwsh.exe", "pwsh.exe -File <home>\\src\\tools\\lint<n>.ps1")]),
        ("benign", "office", 1, "none", "Image CommandLine", [(f"{OFFICE}\\POWERPNT.EXE", '"POWERPNT.EXE" "<home>\\Documents\\review<n>.pptx"'), (f"{OFFICE}\\ONENOTE.EXE", '"ONENOTE.EXE" /hyperlink onenote:page<n>'), (f"{OFFICE}\\MSACCESS.EXE", '"MSACCESS.EXE" "<home>\\Documents\\stock<n>.accdb"')]),
        ("benign", "system helper", 1, "low", "Image CommandLine ParentImage", [(f"{S32}\\regsvr32.exe", f'"{S32}\\regsvr32.exe" /s "{PF}\\HALVEN\\shell<n>.dll"', f"{S32}\\msiexec.exe"), (f"{S32}\\mshta.exe", f'"{S32}\\mshta.exe" "{PF}\\HALVEN\\help\\topic<n>.hta"', "C:\\Windows\\explorer.exe"), (f"{S32}\\cscript.exe", f'cscript.exe //nologo {S32}\\slmgr.vbs /dlv <n>', f"{S32}\\cmd.exe")]),
        ("benign", "local admin", 1, "none", "Image CommandLine", [(f"{S32}\\sc.exe", "sc.exe query svc<n>"), (f"{S32}\\netsh.exe", "netsh.exe interface show interface name=lan<n>"), (f"{S32}\\robocopy.exe", "robocopy.exe D:\\install\\set<n> E:\\install\\set<n> /mir"), (f"{S32}\\defrag.exe", "defrag.exe C: /A /n<n>")]),
        ("benign", "security product", 1, "low", "Image CommandLine ParentImage User", [(f"{PF}\\Windows Defender\\MsMpEng.exe", f'"{PF}\\Windows Defender\\MsMpEng.exe" -s<n>', f"{S32}\\services.exe", SYSTEM), (f"{PF}\\Sysinternals\\Sysmon64.exe", "Sysmon64.exe -c cfg<n>.xml", f"{S32}\\services.exe", SYSTEM), (f"{PF}\\HALVEN\\edr\\sensor.exe", "sensor.exe --scan quick --id <n>", f"{S32}\\services.exe", SYSTEM)]),
        ("benign", "unsigned but known", 1, "low", "Image CommandLine Signed", [(f"{PF}\\HALVEN\\legacy\\invoice.exe", "invoice.exe /month <n>", "false"), ("E:\\cnc\\postproc.exe", "postproc.exe job<n>.nc", "false"), ("<home>\\src\\out\\debug\\app.exe", "app.exe --case <n>", "false")]),
        ("benign", "web browsing", 3, "none", "Image DestinationIp DestinationPort DestinationHostname", [(f"{PF} (x86)\\Microsoft\\Edge\\Application\\msedge.exe", "198.18.<p>.<o>", "443", "news<n>.example.com"), (f"{PF}\\HALVEN\\edr\\sensor.exe", "192.0.<p>.<o>", "443", "telemetry<n>.example.net"), (f"{S32}\\svchost.exe", "198.18.<p>.<o>", "80", "update<n>.example.org")]),
        ("benign", "uncommon port", 3, "low", "Image DestinationIp DestinationPort DestinationHostname", [(f"{PF}\\HALVEN\\printmon.exe", "10.0.<p>.<o>", "9101", "printer<n>.halven.local"), (f"{PF}\\Git\\usr\\bin\\ssh.exe", "10.0.<p>.<o>", "2222", "git<n>.halven.local"), (f"{PF}\\MQTT\\client.exe", "10.0.<p>.<o>", "8883", "broker<n>.halven.local")]),
        ("benign", "image load", 7, "none", "Image TargetFilename Signed Signer", [(f"{S32}\\svchost.exe", f"{S32}\\mod<n>.dll", "true", "Microsoft Windows"), (f"{PF}\\Google\\Chrome\\Application\\chrome.exe", f"{PF}\\Google\\Chrome\\Application\\ext<n>.dll", "true", "Google LLC"), (f"{PF}\\Adobe\\Acrobat DC\\Acrobat\\Acrobat.exe", f"{PF}\\Adobe\\Acrobat DC\\Acrobat\\plug<n>.api", "true", "Adobe Inc.")]),
        ("benign", "file create", 11, "none", "Image TargetFilename", [(f"{OFFICE}\\EXCEL.EXE", "<home>\\AppData\\Local\\Temp\\~book<n>.tmp"), ("C:\\Windows\\explorer.exe", "<home>\\Desktop\\New folder<n>\\desktop.ini"), (f"{PF}\\Windows Defender\\MsMpEng.exe", "C:\\ProgramData\\Microsoft\\Windows Defender\\Scans\\h<n>.bin")]),
        ("benign", "registry", 12, "none", "Image TargetFilename", [(f"{S32}\\services.exe", "HKLM\\System\\CurrentControlSet\\Services\\upd<n>"), (f"{OFFICE}\\WINWORD.EXE", "HKU\\S-1-5-21-1\\Software\\Office\\Word\\Recent<n>")]),
        ("benign", "registry", 13, "none", "Image TargetFilename", [(f"{S32}\\svchost.exe", "HKLM\\Software\\Microsoft\\Cache\\v<n>\\Time"), (f"{PF}\\Google\\Chrome\\Application\\chrome.exe", "HKU\\S-1-5-21-1\\Software\\Google\\Chrome\\State\\s<n>")]),
        ("suspicious", "remote admin", 1, "medium", "Image CommandLine", [(f"{S32}\\winrs.exe", "winrs.exe -r:srv<n> ipconfig"), (f"{S32}\\query.exe", "query.exe session /server:srv<n>"), (f"{S32}\\schtasks.exe", "schtasks /query /s srv<n> /v")]),
        ("suspicious", "internal fetch", 1, "medium", "Image CommandLine", [(f"{S32}\\bitsadmin.exe", "bitsadmin /transfer j<n> http://files.halven.local/a.msi C:\\Temp\\a.msi"), (f"{S32}\\ftp.exe", "ftp.exe -s:get<n>.txt files.halven.local"), (PS, "powershell.exe (New-Object Net.WebClient).DownloadString('http://files.halven.local/v<n>.txt')")]),
        ("suspicious", "grey persistence", 1, "medium", "Image CommandLine", [(f"{S32}\\schtasks.exe", "schtasks /create /tn backup<n> /tr D:\\jobs\\backup.cmd /sc daily"), (f"{S32}\\sc.exe", "sc.exe config svc<n> start= demand"), (f"{S32}\\reg.exe", "reg export HKCU\\Software\\Microsoft\\Windows\\CurrentVersion\\Run run<n>.reg")]),
        ("suspicious", "staging", 1, "medium", "Image CommandLine", [(f"{PF}\\WinRAR\\Rar.exe", "Rar.exe a -r <home>\\Desktop\\bundle<n>.rar D:\\Shares\\Plans"), (f"{S32}\\xcopy.exe", "xcopy.exe \\\\fs03\\board E:\\usb<n> /s"), (PS, "powershell.exe Compress-Archive D:\\Shares\\Sales <home>\\sales<n>.zip")]),
        ("suspicious", "shadow recon", 1, "medium", "Image CommandLine", [(f"{S32}\\diskshadow.exe", "diskshadow.exe /s list<n>.txt"), (PS, "powershell.exe Get-CimInstance Win32_ShadowCopy -First <n>")]),
        ("suspicious", "account admin", 1, "medium", "Image CommandLine", [(PS, "powershell.exe Get-ADUser temp<n> -Properties *"), (f"{S32}\\net.exe", "net accounts /domain /n<n>"), (f"{S32}\\whoami.exe", "whoami /groups /fo csv /n<n>")]),
        ("suspicious", "dual-use tool", 1, "medium", "Image CommandLine", [("C:\\Tools\\nmap\\nmap.exe", "nmap.exe -sn 10.0.<p>.0/24"), ("C:\\Tools\\procdump.exe", "procdump.exe -ma app<n>.exe app.dmp"), ("C:\\Tools\\AdExplorer.exe", "AdExplorer.exe -snapshot dc01 snap<n>.dat")]),
        ("suspicious", "network", 3, "medium", "Image DestinationIp DestinationPort", [(f"{S32}\\cmd.exe", "203.0.<p>.<o>", "8080"), ("C:\\Tools\\plink.exe", "10.0.<p>.<o>", "22"), (f"{S32}\\mstsc.exe", "198.51.<p>.<o>", "3389")]),
        ("suspicious", "file", 11, "medium", "Image TargetFilename", [("C:\\Windows\\explorer.exe", "<home>\\Downloads\\tool<n>.exe"), (f"{S32}\\cscript.exe", "C:\\Users\\Public\\log<n>.vbs"), (f"{OFFICE}\\WINWORD.EXE", "<home>\\AppData\\Roaming\\Microsoft\\Templates\\m<n>.dotm")]),
        ("suspicious", "registry", 12, "medium", "Image TargetFilename", [("<home>\\Downloads\\setup.exe", "HKCU\\Software\\Setup\\k<n>"), (f"{S32}\\mmc.exe", "HKLM\\Software\\Policies\\Extra\\p<n>")]),
        ("suspicious", "registry", 13, "medium", "Image TargetFilename", [(f"{S32}\\regedit.exe", "HKLM\\Software\\Policies\\Vendor\\v<n>"), ("<home>\\Downloads\\setup.exe", "HKCU\\Software\\Setup\\Version\\v<n>")]),
        ("suspicious", "logon", 4624, "medium", "LogonType AuthPackage DestinationIp", [("9", "Negotiate", "10.0.<p>.<o>"), ("8", "Negotiate", "10.0.<p>.<o>")]),
    )
    for row in rows
)


def mix_of(kind: str) -> list[tuple[int, float]]:
    """Shares of each EventID, with those of kinds that a class has no template for where they go."""
    shares = dict(MIX)
    for event_id, to in FOLDED.get(kind, {}).items():
        shares[to] += shares.pop(event_id)
    return list(shares.items())


def tried(spark: SparkSession, kind: str, ranges: dict[int, tuple[int, int]], numbers: int, mode: str, seed: str) -> DataFrame:
    """The events (eid, at, name, severity, event, contract fields) of the numbers from..to of each EventID.

    Which template, account, parent and numbers (below `numbers`) an event has follows from hashes of the seed, the
    class, its EventID and its own number.
    """
    families: dict[int, list[str]] = {}
    variants: dict[tuple[int, str], int] = {}
    rows = []
    for _, family, event_id, severity, fields in (t for t in TEMPLATES if t[0] == kind):
        turn = families.setdefault(event_id, [])
        if family not in turn:
            turn.append(family)
        v = variants[event_id, family] = variants.get((event_id, family), 0) + 1
        rows.append((event_id, family, v - 1, severity, *(fields.get(f) for f in FIELDS[2:])))
    table = spark.createDataFrame(rows, "eid int, name string, variant int, severity string, " + ", ".join(f"{f} string" for f in FIELDS[2:]))
    order = {e: [x for x in f for _ in range(TURNS.get(x, 1))] for e, f in families.items()}
    turns = spark.createDataFrame([(e, i, len(f), x, variants[e, x]) for e, f in order.items() for i, x in enumerate(f)], "eid int, turn int, turns int, name string, variants int")

    total, eid, at = 0, F.lit(None).cast("int"), F.lit(None).cast("long")
    for event_id, (lo, hi) in ranges.items():
        own = (F.col("id") >= total) & (F.col("id") < total + hi - lo)
        eid, at = F.when(own, F.lit(event_id)).otherwise(eid), F.when(own, F.col("id") - total + lo).otherwise(at)
        total += hi - lo
    tries = spark.range(0, total, 1, max(1, -(-total // TASK))).select(eid.alias("eid"), at.alias("at"))
    key = [F.lit(seed), F.lit(kind), F.col("eid"), F.col("at")]
    number = lambda n, what: F.conv(F.substring(F.sha2(F.concat_ws("|", *key, F.lit(what)), 256), 1, 8), 16, 10).cast("long") % n
    tries = tries.join(F.broadcast(turns), (tries["eid"] == turns["eid"]) & (F.pmod(tries["at"], turns["turns"].cast("long")) == turns["turn"])).drop(turns["eid"])
    made = tries.withColumn("variant", number(F.col("variants"), "variant").cast("int")).join(F.broadcast(table), ["eid", "name", "variant"])
    at_home = account(("local", "local", "local", "domain", "domain"), *key)
    personal = F.coalesce("Image", F.lit("")).contains("<home>") | F.coalesce("CommandLine", F.lit("")).contains("<home>") | F.coalesce("TargetFilename", F.lit("")).contains("<home>")
    user = F.coalesce("User", F.when(personal, at_home).otherwise(account(ACCOUNT_KINDS, *key)))
    drawn_text = {"<home>": home_of(at_home), "<host>": pick(HOSTS, *key, F.lit("on")), "<n>": number(numbers, "n").cast("string"), "<o>": number(250, "o").cast("string"), "<p>": number(250, "p").cast("string")}
    made = made.withColumns({"User": user} | {f"_{k[1:-1]}": v for k, v in drawn_text.items()})

    def fill(c: str) -> Column:
        out = F.col(c)
        for k in drawn_text:
            out = F.replace(out, F.lit(k), F.col(f"_{k[1:-1]}"))
        return out

    made = made.withColumns({f: fill(f) for f in FIELDS[2:]})
    pool = [p for group in DRAWN_FROM for p in PARENT_GROUPS[group]]
    parent = F.get(F.array(*(F.struct(F.lit(i).alias("image"), F.lit(c).alias("command")) for i, c in pool)), drawn(len(pool), *key, F.lit("parent")))
    made = made.withColumn("_parent", F.when((F.col("eid") == 1) & F.col("ParentImage").isNull(), parent))
    made = made.withColumns({
        "ParentImage": F.coalesce("ParentImage", "_parent.image"), "ParentCommandLine": F.coalesce("ParentCommandLine", "_parent.command"),
        "EventID": F.col("eid").cast("string"), "EventType": F.lit(None).cast("string"),
    })
    return rendered(made, mode).select("eid", "at", "name", "severity", "event", *FIELDS)


def generated(spark: SparkSession, n: int, kind: str, mode: str = "backfill", seed: str = "1", prefix: str = "B") -> DataFrame:
    """n distinct events of a class, as many of each EventID as its share asks for: id, name, gold, severity, event, the
    contract fields. ValueError where the templates do not give so many distinct bodies."""
    mix = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(mix_of(kind))], "key int, share double, ord int")
    quota = {r["key"]: r["n"] for r in apportion(mix, n).collect() if r["n"]}  # a row an EventID
    numbers = max(250, 4 * n)
    kept: DataFrame | None = None
    short, start, idle = dict(quota), dict.fromkeys(quota, 0), 0
    while any(short.values()):
        ranges = {e: (start[e], start[e] + int(s * MORE) + 16) for e, s in short.items() if s}
        start |= {e: hi for e, (_, hi) in ranges.items()}
        rows = staged(tried(spark, kind, ranges, numbers, mode, seed), "tried")
        first = rows.groupBy("event").agg(F.min(F.struct("eid", "at")).alias("k")).select("event", "k.eid", "k.at")
        if kept is not None:
            first = first.join(kept.select("event"), "event", "left_anti")
        wanted = F.element_at(F.create_map(*(F.lit(x) for e, s in short.items() for x in (e, s))), F.col("eid"))
        places = numbered(first.select("eid", "at"), ["eid"], [F.col("at")], "place").where(F.col("place") <= wanted)
        new = staged(rows.join(places.select("eid", "at"), ["eid", "at"], "left_semi"), "made")
        kept = new if kept is None else kept.unionByName(new)
        found = {r["eid"]: r["count"] for r in new.groupBy("eid").count().collect()}
        short = {e: s - found.get(e, 0) for e, s in short.items()}
        idle = 0 if found else idle + 1
        if idle >= IDLE:
            raise ValueError(f"templates do not give {n} distinct events; missing by EventID: {short}")
    if kept is None:
        kept = tried(spark, kind, dict.fromkeys(quota, (0, 0)), numbers, mode, seed)
    places = numbered(kept.select("eid", "at"), [], [F.col("eid"), F.col("at")], "_place")
    return kept.join(places, ["eid", "at"]).withColumn("id", F.format_string(f"{prefix}%03d", F.col("_place"))).select("id", "name", F.lit(kind).alias("gold"), "severity", "event", *FIELDS)
