"""Findings, their reduction to a verdict, and renderers. A report is a handful of rows and lives on the driver."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from typing import Any

#: Exit code of each verdict; 4 stands for usage, profile and I/O errors.
EXIT = {"PASS": 0, "FIX_REQUIRED": 2, "WILL_LOSE_DATA": 3}
USAGE = 4
GROUPS = ["HARD-REJECT", "SILENT-LOSS", "BAD-MODEL", "INTAKE", "INFO"]


@dataclass(frozen=True)
class Finding:
    group: str
    severity: str
    code: str
    message: str
    rule_ref: str = ""
    data: dict[str, Any] = field(default_factory=dict, hash=False)

    def key(self) -> tuple:
        return (self.code, *(str(self.data.get(k)) for k in ("column", "label", "session", "file")))


def hard(code: str, message: str, group: str = "HARD-REJECT", **data: Any) -> Finding:
    return Finding(group, "hard-reject", code, message, f"docs/rules.md#{code}", data)


def fix(code: str, message: str, group: str = "BAD-MODEL", **data: Any) -> Finding:
    return Finding(group, "fix-required", code, message, f"docs/rules.md#{code}", data)


def loss(code: str, message: str, **data: Any) -> Finding:
    return Finding("SILENT-LOSS", "will-lose-data", code, message, f"docs/rules.md#{code}", data)


def advise(code: str, message: str, **data: Any) -> Finding:
    return Finding("BAD-MODEL", "advisory", code, message, f"docs/rules.md#{code}", data)


def info(code: str, message: str, group: str = "INFO", **data: Any) -> Finding:
    return Finding(group, "info", code, message, f"docs/rules.md#{code}", data)


def deduped(findings: Iterable[Finding]) -> list[Finding]:
    """The first of each (code, column, label, session, file)."""
    seen: dict[tuple, Finding] = {}
    for f in findings:
        seen.setdefault(f.key(), f)
    return list(seen.values())


@dataclass
class Report:
    findings: list[Finding]

    @property
    def verdict(self) -> str:
        kinds = {f.severity for f in self.findings}
        if kinds & {"hard-reject", "fix-required"}:
            return "FIX_REQUIRED"
        return "WILL_LOSE_DATA" if "will-lose-data" in kinds else "PASS"

    @property
    def exit_code(self) -> int:
        return EXIT[self.verdict]

    def codes(self) -> set[str]:
        return {f.code for f in self.findings}

    def to_json(self) -> str:
        return json.dumps({"verdict": self.verdict, "findings": [asdict(f) for f in self.findings]}, indent=2, default=str)

    def to_text(self) -> str:
        lines, number = [f"Verdict: {self.verdict}"], 0
        for group in GROUPS:
            mine = [f for f in self.findings if f.group == group]
            if mine:
                lines += ["", f"{group}:"]
            for f in mine:
                number += 1
                lines.append(f"  {number}. [{f.severity}] {f.code}: {f.message}" + (f" [rule: {f.rule_ref}]" if f.rule_ref else ""))
        return "\n".join(lines)
