"""The validate pipeline: intake, cells, target, windows, rate and storage rules of one recording."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parsing
from tidemark.operators import compare
from tidemark.operators import sequence as seq
from tidemark.plans.findings import Finding, Report, advise, deduped, fix, hard, info, loss
from tidemark.plans.profile import FLOAT_ONLY, Profile
from tidemark.sources import intake, recordings

_NAME = re.compile(parsing.COLUMN_NAME)
MIN_SAMPLES = 20


def with_session(df: DataFrame, profile: Profile) -> DataFrame:
    """Add session, pos and n; one constant session where the profile names none."""
    name = profile.session_column
    session = F.col(f"`{name}`").cast("string") if name and name in df.columns else F.lit("")
    return seq.ordinal(df, session, ["_row"])


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("_row", "_file")]


def cells(df: DataFrame, columns: list[str], comma: bool) -> DataFrame:
    """Add __v_<c> (number) and __r_<c> (reason) for every column."""
    for c in columns:
        value, reason = parsing.parse_number(F.col(f"`{c}`").cast("string"), comma)
        df = df.withColumn(f"__p_{c}", F.struct(value.alias("v"), reason.alias("r")))
    for c in columns:
        df = df.withColumn(f"__v_{c}", F.col(f"__p_{c}.v")).withColumn(f"__r_{c}", F.col(f"__p_{c}.r"))
    return df.drop(*[f"__p_{c}" for c in columns])


def check_names(names: list[str]) -> list[Finding]:
    found = [hard("bad_column_name", f"Column '{c}' has characters outside A-Z, a-z, 0-9, _ and -.", column=c) for c in names if not _NAME.match(c)]
    return found + ([hard("duplicate_columns", "Two columns share a name.")] if len(set(names)) < len(names) else [])


def check_cells(df: DataFrame, columns: list[str], time: str | None) -> list[Finding]:
    """One aggregate over parsed cells (see ``cells``)."""
    count = lambda c, r: F.sum((F.col(f"__r_{c}") == r).cast("long"))
    aggs = [a for c in columns for a in (count(c, "empty_or_na").alias(f"e_{c}"), count(c, "unrepairable").alias(f"u_{c}"))]
    if not aggs:
        return []
    got = df.agg(*aggs).first()
    found = []
    for c in columns:
        empty, bad = got[f"e_{c}"] or 0, got[f"u_{c}"] or 0
        if c == time:
            found += [hard("calendar_timestamp", f"'{c}' holds {bad} times that aren't numbers.", column=c, count=bad)] if bad else []
            continue
        found += [hard("empty_or_na_value", f"'{c}' has {empty} empty cells.", column=c, count=empty)] if empty else []
        found += [hard("non_numeric_value", f"'{c}' has {bad} cells that aren't numbers.", column=c, count=bad)] if bad else []
    return found


def check_index(df: DataFrame, columns: list[str]) -> tuple[list[str], list[Finding]]:
    """Columns outside the profile that repeat the row number, and the findings."""
    if not columns:
        return [], []
    made = cells(df, columns, False).select("_row", *[F.col(f"__v_{c}").alias(c) for c in columns])
    rows = seq.index_columns(seq.ordinal(made, F.lit(0), ["_row"]), columns).collect()
    index = [r.name for r in rows if r.is_index]
    found = [hard("index_column_present", f"'{c}' is a row number; drop it.", column=c) for c in index]
    found += [Finding("BAD-MODEL", "info", "possible_index_column", f"'{r.name}' counts up by one.", "docs/rules.md#possible_index_column", {"column": r.name}) for r in rows if r.is_counter and not r.is_index]
    return index, found


def check_target(df: DataFrame, label: str) -> tuple[DataFrame | None, list[Finding]]:
    """Class rules over the parsed label, and the frame with an integer label if it has one throughout."""
    v, r = F.col(f"__v_{label}"), F.col(f"__r_{label}")
    bad = df.filter(r.isNotNull() | (v != F.floor(v))).limit(1).count()
    if bad:
        return None, [info("labels_not_numeric", "Labels aren't all whole numbers; class rules wait until they are.")]
    df = df.withColumn("label", v.cast("long"))
    counts = {x.label: x["n"] for x in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    uniq, found = sorted(counts), []
    if uniq != list(range(len(uniq))):
        found.append(hard("noncontiguous_target", f"Labels {uniq} don't run from 0 without gaps.", labels=uniq))
    if len(uniq) < 2:
        found.append(hard("too_few_classes", f"{len(uniq)} class; two are needed.", n_classes=len(uniq)))
    small = {k: n for k, n in counts.items() if n < MIN_SAMPLES}
    if small:
        found.append(hard("class_below_min_samples", f"Classes {sorted(small)} have fewer than {MIN_SAMPLES} rows.", counts=small))
    if counts and max(counts.values()) / min(counts.values()) >= 3:
        found.append(advise("class_imbalance", "The largest class has three times the rows of the smallest or more.", counts=counts))
    return df, found


def check_window(profile: Profile, window: int, freq: bool) -> list[Finding]:
    found = []
    if freq and not (window & (window - 1) == 0 and 128 <= window <= 2048):
        found.append(hard("window_out_of_range_fft", f"With frequency features a window is a power of two from 128 to 2048, not {window}.", window=window))
    elif not freq and not 10 <= window <= 1000:
        found.append(hard("window_out_of_range", f"A window has 10 to 1000 samples, not {window}.", window=window))
    shift = profile.shift
    if shift is None:
        return [*found, Finding("BAD-MODEL", "info", "shift_unspecified", f"Train with a shift of {window}.", "docs/rules.md#shift_unspecified", {"window": window})]
    if shift > window:
        found.append(hard("shift_exceeds_window", f"The shift {shift} is larger than the window {window}.", shift=shift, window=window))
    elif shift != window:
        found.append(advise("training_shift_not_window", f"Train with a shift of {window}, not {shift}.", shift=shift, window=window))
    return found


def check_survival(df: DataFrame, window: int) -> list[Finding]:
    """Runs and windows of classes; ``df`` has session, pos, n and an integer label."""
    found = [loss("class_run_below_window", f"Class {r.label}: the longest run is {r.max_run}, under the window {window}.", label=r.label, max_run=r.max_run) for r in seq.class_run_below(df, window).orderBy("label").collect()]
    rows = seq.window_yield(df, window).orderBy("label").collect()
    made = {r.label: r.windows for r in rows}
    found.append(info("window_class_yield", f"Whole windows by class: {made}.", counts=made))
    if rows and rows[0].imbalanced:
        found.append(advise("window_class_imbalance", "Classes differ threefold or more in whole windows.", counts=made))
    return found


def check_rate(df: DataFrame, profile: Profile, sp: bool) -> list[Finding]:
    """Rates by session; ``df`` has session, pos and a numeric t where the profile names a time column."""
    found = []
    if profile.time_column and "t" in df.columns:
        r = seq.mixed_rate(seq.sampling_rate(df.filter("t is not null"))).first()
        if sp and r.mixed:
            found.append(advise("mixed_sampling_rate", f"Sessions run at {r.min_hz:.4g} to {r.max_hz:.4g} samples a unit.", min=r.min_hz, max=r.max_hz))
    elif not profile.sampling_rate_hz and not profile.time_column:
        text = "Neither a sampling rate nor a time column is known."
        found.append(fix("rate_unknown", text) if sp else advise("rate_unknown", text))
    return found


def check_frame(df: DataFrame, profile: Profile, window: int | None, sp: bool | None, file_name: str | None = None, holdout: list[str] | None = None) -> list[Finding]:
    """All rules on one frame of text or numbers with _row."""
    on = sp is not False
    label, names, found = profile.label_column, data_columns(df), []
    if profile.task_type != "anomaly_detection" and label not in names:
        found.append(hard("label_column_missing", f"The target column '{label}' isn't in the data.", label_column=label, columns=names))
    found += check_names(names)
    comma = profile.separator != "comma"
    values = [c for c in [*profile.sensor_columns, label, *([profile.time_column] if profile.time_column else [])] if c in names]
    ready = with_session(cells(df, values, comma), profile)
    if profile.time_column in names:
        ready = ready.withColumn("t", F.col(f"__v_{profile.time_column}"))
    found += check_cells(ready, values, profile.time_column)
    known = {label, *profile.sensor_columns, profile.session_column, profile.time_column}
    found += check_index(df, [c for c in names if c not in known and _NAME.match(c)])[1]
    labelled = None
    if profile.is_classification and label in names:
        labelled, said = check_target(ready, label)
        found += said
    if on and window is not None:
        found += check_window(profile, window, profile.frequency_domain)
        if labelled is not None:
            found += check_survival(labelled, window)
        if profile.session_column in names:
            short = seq.session_below(ready, window).orderBy("session").collect()
        else:
            short = seq.session_below(ready, window).collect()
        found += [loss("session_below_window", f"Session '{r.session}' has {r.rows} rows, under the window {window}.", session=r.session, rows=r.rows) for r in short]
    found += check_rate(ready, profile, on)
    if profile.target_technology == FLOAT_ONLY:
        kind = "FLOAT32"
    else:
        sensors = [f"__v_{c}" for c in profile.sensor_columns if c in names]
        kind = compare.storage_type(ready, sensors).first().dtype if sensors else "FLOAT32"
    found.append(advise("recommended_dtype", f"Store as {kind}.", dtype=kind))
    if on and profile.is_classification and len(profile.gesture_classes) >= 2:
        found.append(advise("enable_lr_features", "Two or more gesture classes need the regression features.", gesture_classes=list(profile.gesture_classes)))
    if holdout is not None and holdout != names:
        found.append(hard("holdout_column_order", "The holdout's columns differ in name or order.", train=names, holdout=holdout))
    if file_name and intake.bad_name(os.path.basename(file_name)):
        found.append(hard("bad_file_name", f"'{os.path.basename(file_name)}' has characters that an upload can't have."))
    if sp is False:
        found.append(advise("sp_off_unverified", "Signal processing is off, so window rules were skipped; that the data is tabular isn't verified."))
        if profile.gesture_classes:
            found.append(fix("sp_off_contradicts_profile", "Signal processing is off, yet there are gesture classes.", gesture_classes=list(profile.gesture_classes)))
    return deduped(found)


def time_findings(df: DataFrame, profile: Profile) -> list[Finding]:
    if not profile.time_column or profile.time_column not in df.columns:
        return []
    made = with_session(cells(df, [profile.time_column], False), profile).withColumn("t", F.col(f"__v_{profile.time_column}"))
    bad = seq.time_order(made).filter("bad_steps > 0").orderBy("session").collect()
    return [fix("timestamps_out_of_order", f"Session '{r.session}' runs back {r.bad_steps} times.", "BAD-MODEL", session=r.session, count=r.bad_steps) for r in bad]


def read_checked(spark: SparkSession, path: str, profile: Profile) -> tuple[DataFrame | None, list[Finding]]:
    """The frame and the intake findings; no frame where it can't be read."""
    scan = next(iter(intake.findings_of(intake.sniff(spark, [path])).values()))
    found = list(scan.findings)
    if scan.delimiter and scan.delimiter != profile.sep:
        found.append(Finding("INTAKE", "info", "delimiter_mismatch", f"The file is cut by {scan.delimiter!r}, the profile says {profile.sep!r}.", "docs/rules.md#delimiter_mismatch", {}))
    if scan.encoding == "unknown":
        return None, found
    try:
        df = recordings.read_strings(spark, path, profile.sep, scan.encoding).persist()
        df.count()
    except Exception as e:  # the reader's own error, and those of malformed rows
        return None, [*found, hard("parse_error", f"{os.path.basename(path)} can't be read as a table ({str(e)[:120]}).", "INTAKE")]
    return df, found


def validate(spark: SparkSession, path: str, profile: Profile, window: int | None, sp: bool | None = None, holdout: str | None = None) -> Report:
    df, found = read_checked(spark, path, profile)
    other = None
    if holdout:
        other, said = read_checked(spark, holdout, profile)
        found += [Finding(f.group, f.severity, f.code, f.message, f.rule_ref, f.data | {"file": os.path.basename(holdout)}) for f in said]
    if df is None:
        return Report(deduped(found))
    if sp is not False:
        found += time_findings(df, profile)
    found += check_frame(df, profile, window, sp, path, data_columns(other) if other is not None else None)
    return Report(deduped(found))
