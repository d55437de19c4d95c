"""Rule detectors over sanitised evidence.

Keyword rules are data: each names the lists it reads and the words it looks for.  A rule looks at a whole list joined by
single spaces, so a phrase may run across two entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from triagelake.functions.lists import numbered
from triagelake.functions.sql import case, lit, lits, struct

# Binaries of the operating system that attackers like to run.
SYSTEM_BINARIES = (
    "powershell.exe", "cmd.exe", "wscript.exe", "cscript.exe", "mshta.exe", "regsvr32.exe", "rundll32.exe", "wmic.exe",
    "certutil.exe", "bitsadmin.exe",
)

# Calls that write into or run code in another process.
INJECTION_APIS = ("writeprocessmemory", "createremotethread", "ntunmapviewofsection", "queueuserapc")

# Fixed value: more files than this count as bulk file activity.
BULK_FILES = 200

# Title, severity, reason and evidence reference of each finding, and the words that trigger keyword rules.
KEYWORD_RULES = {
    "persistence": {
        "words": {"keys": ("run\\", "runonce", "startup"), "executed_commands": ("schtasks", "sc create")},
        "finding": ("Persistence behavior observed", "high", "Autostart registry or task/service creation activity found",
                    "behavior_summary"),
    },
    "discovery": {
        "words": {"executed_commands": ("whoami", "ipconfig", "net user", "systeminfo", "nltest")},
        "finding": ("Discovery commands detected", "medium", "Reconnaissance-like commands observed",
                    "behavior_summary.executed_commands"),
    },
    "credential_access": {
        "words": {"executed_commands": ("lsass", "sekurlsa", "sam", "security\\account")},
        "finding": ("Credential access hints", "high", "Commands suggest credential dumping intent",
                    "behavior_summary.executed_commands"),
    },
    "ransomware": {
        "words": {"executed_commands": ("vssadmin delete shadows", "wbadmin delete catalog")},
        "finding": ("Ransomware-like activity", "critical", "Shadow copy deletion or unusual bulk file operations observed",
                    "behavior_summary"),
    },
    "defense_evasion": {
        "words": {"executed_commands": ("set-mppreference", "wevtutil cl", "bcdedit /set")},
        "finding": ("Defense evasion behavior", "high", "Security disabling or log tampering commands found",
                    "behavior_summary.executed_commands"),
    },
}
INJECTION_FINDING = ("Process injection-like activity", "critical", "Injection-related APIs observed")
SYSTEM_BINARY_FINDING = ("LOLBins execution", "medium", "Potentially abused built-in binary executed")


def _finding(title: str, severity: str, reason: str, evidence_ref: str) -> str:
    return struct(title=lit(title), severity=lit(severity), reason=lit(reason), evidence_ref=evidence_ref)


def joined_text(values: str) -> str:
    return f"lower(array_join({values}, ' '))"


def mentions_any(text: str, words: tuple[str, ...]) -> str:
    """True if the lower-case text of a list holds any of the words."""
    return " OR ".join(f"contains({text}, {lit(word)})" for word in words)


def keyword_findings(rule: str) -> str:
    """Zero or one finding of a keyword rule; reads the columns ``text_<list>`` made by ``risk_indicators``."""
    spec = KEYWORD_RULES[rule]
    hit = " OR ".join(mentions_any(f"text_{name}", words) for name, words in spec["words"].items())
    if rule == "ransomware":
        hit += f" OR size(behavior_summary.files) > {BULK_FILES}"
    title, severity, reason, ref = spec["finding"]
    return case((hit, f"array({_finding(title, severity, reason, lit(ref))})"), otherwise="array()")


def injection_findings() -> str:
    """One finding for the first process that calls an injection API, matched as a whole name in any case."""
    called = f"exists(p.suspicious_api_calls, a -> lower(a) IN ({lits(*INJECTION_APIS)}))"
    first = f"slice(filter(process_highlights, p -> {called}), 1, 1)"
    return f"transform({first}, p -> {_finding(*INJECTION_FINDING, 'substring(p.id, 1, 60)')})"


def system_binary_findings() -> str:
    """One finding per process whose name is a known system binary."""
    hits = f"filter(process_highlights, p -> lower(p.process_name) IN ({lits(*SYSTEM_BINARIES)}))"
    return f"transform({hits}, p -> {_finding(*SYSTEM_BINARY_FINDING, 'substring(p.id, 1, 60)')})"


def rule_findings(rule: str) -> str:
    """Findings of one rule: of a keyword rule, ``injection`` or ``system_binaries``."""
    if rule == "injection":
        return injection_findings()
    return system_binary_findings() if rule == "system_binaries" else keyword_findings(rule)


def _with_texts(evidence: DataFrame) -> DataFrame:
    return evidence.selectExpr(
        "*", *(f"{joined_text(f'behavior_summary.{name}')} AS text_{name}" for name in ("keys", "executed_commands"))
    )


def findings_of(evidence: DataFrame, rule: str) -> DataFrame:
    """``task_id`` and the findings of one rule on evidence; only the lists that the rule looks at are read."""
    return _with_texts(evidence).selectExpr("task_id", f"inline({rule_findings(rule)})")


def detect_risks(evidence: DataFrame) -> DataFrame:
    """Evidence, stored or not, with its findings made anew."""
    return risk_indicators(evidence.drop("risk_indicators"))


def risk_indicators(evidence: DataFrame) -> DataFrame:
    """Add the numbered findings of all rules, in rule order."""
    texts = _with_texts(evidence)
    findings = ", ".join([*map(keyword_findings, KEYWORD_RULES), injection_findings(), system_binary_findings()])
    fields = ("title", "severity", "reason", "evidence_ref")
    row = struct(**{name: f"r.{name}" for name in fields}, id=numbered("risk_", "i"))
    numbered_findings = f"transform(concat({findings}), (r, i) -> {row})"
    return texts.selectExpr("*", f"{numbered_findings} AS risk_indicators").drop("text_keys", "text_executed_commands")
