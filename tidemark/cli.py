"""Command line: validate, prep, quality-report. Exit 0 pass, 2 fix required, 3 will lose data, 4 usage."""

from __future__ import annotations

import argparse
import json
import sys

from tidemark.plans.findings import USAGE, Report, advise
from tidemark.plans.prepare import prep
from tidemark.plans.profile import Profile, ProfileError
from tidemark.plans.quality import quality_report
from tidemark.plans.validate import validate
from tidemark.session import local_session


class UsageError(Exception):
    """A call that can't be carried out."""


class Parser(argparse.ArgumentParser):
    def error(self, message: str):
        raise UsageError(message)


def parser() -> Parser:
    p = Parser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True, parser_class=Parser)
    v = sub.add_parser("validate")
    v.add_argument("csv")
    v.add_argument("--holdout")
    q = sub.add_parser("quality-report")
    q.add_argument("inputs", nargs="+")
    r = sub.add_parser("prep")
    r.add_argument("inputs", nargs="+")
    r.add_argument("--out", required=True)
    r.add_argument("--no-center", action="store_true")
    r.add_argument("--resample", type=float)
    r.add_argument("--time-unit", choices=["s", "ms", "us"], default="s")
    r.add_argument("--write-anyway", action="store_true")
    for x in (v, q, r):
        x.add_argument("--profile", required=True)
        x.add_argument("--window", type=int)
        x.add_argument("--json", action="store_true")
    return p


def mode(profile: Profile, window: int | None, command: str) -> tuple[bool | None, int | None]:
    """Signal-processing mode and window of a call."""
    if profile.signal_processing is False:
        return False, None
    if command == "validate":
        window = window or None
    elif window is not None and window < 1:
        raise UsageError("the window must be positive")
    window = window if window is not None else next(iter(profile.window_candidates), None)
    if not isinstance(window, int) or isinstance(window, bool):
        raise UsageError("no window is given, and the profile has none")
    return profile.signal_processing, window


def noted(report: Report, args: argparse.Namespace, sp: bool | None) -> Report:
    if sp is False and args.window is not None:
        report.findings.append(advise("sp_off_window_ignored", "Signal processing is off; the window is ignored."))
    return report


def emit(report: Report, as_json: bool, extra: dict | None = None) -> int:
    if as_json:
        print(json.dumps(json.loads(report.to_json()) | (extra or {}), indent=2, default=str))
    else:
        print(report.to_text())
        for k, v in (extra or {}).items():
            print(f"{k}: {v}")
    return report.exit_code


def main(argv: list[str] | None = None) -> int:
    try:
        args = parser().parse_args(argv)
        profile = Profile.load(args.profile)
        sp, window = mode(profile, args.window, args.command)
        spark = local_session("tidemark-cli")
        if args.command == "validate":
            return emit(noted(validate(spark, args.csv, profile, window, sp, args.holdout), args, sp), args.json)
        if args.command == "quality-report":
            report, extra = quality_report(spark, args.inputs, profile, window)
            return emit(noted(report, args, sp), args.json, extra)
        made = prep(spark, args.inputs, profile, args.out, window, False if args.no_center else None, args.resample, args.write_anyway, args.time_unit, sp)
        return emit(noted(made.report, args, sp), args.json, {"written": made.written, "dictionary": made.dictionary})
    except (UsageError, ProfileError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return USAGE


if __name__ == "__main__":
    sys.exit(main())
