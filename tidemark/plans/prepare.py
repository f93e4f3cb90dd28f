"""The prep pipeline: recordings to one upload-ready CSV. Nothing is written that would lose or corrupt data, unless asked."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parsing
from tidemark.operators import compare, events, labels, resample
from tidemark.operators import sequence as seq
from tidemark.plans.findings import Finding, Report, fix, hard, info, loss
from tidemark.plans.profile import Profile
from tidemark.plans.validate import cells, check_frame, check_index, data_columns, read_checked, time_findings, with_session
from tidemark.sources import sinks

#: Intake findings that the output repairs.
REPAIRED = {"mixed_line_endings", "cr_only_line_endings", "zip_inner_file_name"}


@dataclass
class Prepared:
    report: Report
    written: bool
    out_path: str
    dictionary: dict[str, int] | None = None
    dictionary_path: str | None = None


def combined(spark: SparkSession, paths: list[str], profile: Profile, sp_off: bool) -> tuple[DataFrame | None, list[Finding]]:
    """All recordings in order with one _row; index columns go, columns must agree."""
    parts, found = [], []
    known = {profile.label_column, *profile.sensor_columns, profile.session_column, profile.time_column}
    for p in paths:
        df, said = read_checked(spark, p, profile)
        found += [f for f in said if f.code not in REPAIRED]
        if df is None:
            return None, [*found, hard("combine_failed", f"{os.path.basename(p)} can't be read.")]
        index, _ = check_index(df, [c for c in data_columns(df) if c not in known])
        df = df.drop(*index)
        if not sp_off:
            found += time_findings(df, profile)
        parts.append(df)
    if any(data_columns(p) != data_columns(parts[0]) for p in parts):
        return None, [*found, hard("combine_failed", "The recordings differ in their columns.")]
    names = data_columns(parts[0])
    sized, before = [], 0
    for p in parts:
        sized.append(p.select(*names, (F.col("_row") + before).alias("_row")))
        before += p.count()
    return reduce(DataFrame.union, sized), found


def normalised(df: DataFrame, columns: list[str], comma: bool) -> tuple[DataFrame, list[Finding]]:
    """Columns as numbers; empty and unrepairable cells are reported and become null."""
    made = cells(df, columns, comma)
    got = made.agg(*[F.sum((F.col(f"__r_{c}") == r).cast("long")).alias(f"{r}_{c}") for c in columns for r in ("empty_or_na", "unrepairable")]).first()
    found = []
    for c in columns:
        for r, code in (("empty_or_na", "empty_or_na_value"), ("unrepairable", "unrepairable_value")):
            if got[f"{r}_{c}"]:
                found.append(hard(code, f"'{c}' has {got[f'{r}_{c}']} cells that can't be repaired.", column=c, count=got[f"{r}_{c}"]))
    return made.select(*[F.col(f"__v_{c}").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]), found


def encoded(df: DataFrame, profile: Profile) -> tuple[DataFrame, dict[str, int], list[Finding]]:
    label = profile.label_column
    df = df.withColumn(label, parsing.label_token(F.col(f"`{label}`")))
    present = [r[0] for r in df.select(label).distinct().collect()]  # a row a class
    mapping, said = labels.resolve(present, profile.class_map or None)
    kinds = {"label_not_in_map": lambda m: fix("label_not_in_map", m, "HARD-REJECT"), "label_keyspace_mixed": lambda m: fix("label_keyspace_mixed", m, "HARD-REJECT"),
             "noncontiguous_labels": lambda m: fix("noncontiguous_labels", m, "HARD-REJECT"), "mapped_class_absent": lambda m: info("mapped_class_absent", m, "BAD-MODEL"),
             "string_labels_encoded": lambda m: info("string_labels_encoded", m, "BAD-MODEL")}
    known = labels.dictionary(df.sparkSession, mapping)
    out = labels.encode(df, label, F.broadcast(known)).withColumn(label, F.col("idx")).drop("idx")
    names = profile.class_map if profile.class_map and not any(c == "label_not_in_map" for c, _ in said) else mapping
    return out, names, [kinds[c](f"Label {s}.") for c, s in said]


def resampled(df: DataFrame, profile: Profile, target: float, unit_name: str) -> tuple[DataFrame, list[Finding]]:
    """Each run at the target rate: linear upward, anti-aliased downward; runs that can't be stay as they are."""
    time, label, unit = profile.time_column, profile.label_column, resample.UNIT_PER_SECOND[unit_name]
    if not time or time not in df.columns:
        return df, [fix("no_time_column_for_resample", "Resampling needs a time column.")]
    session = profile.session_column if profile.session_column in df.columns else None
    sensors, found = [c for c in profile.sensor_columns if c in df.columns], []
    keep = {label, time, session, "_row", *sensors}
    dropped = [c for c in df.columns if c not in keep]
    if dropped:
        found.append(info("columns_dropped_on_resample", f"Other columns are dropped: {', '.join(dropped)}.", "BAD-MODEL", columns=dropped))
    df = with_session(df, profile).withColumn("label", F.col(label) if label in df.columns else F.lit(0)).withColumn("t", F.col(time))
    rates = {r.session: r.hz for r in seq.sampling_rate(df, unit=unit, in_row_order=True).collect()}  # a row a session
    steps = seq.run_steps(df).withColumnsRenamed({"session": "s", "run_id": "r", "label": "l"})
    base = seq.runs(df).join(steps.select("s", "r", "rows", "gap", "monotonic"), (F.col("session") == F.col("s")) & (F.col("run_id") == F.col("r")))
    whole = {r["name"] for r in compare.content_type(df, sensors).filter("integral").collect()}
    made = []
    for name in sorted({r.session for r in df.select("session").distinct().collect()}):
        hz = rates.get(name)
        way = resample.direction(hz, target)
        runs = base.filter(F.col("session") == name)
        ok, refused = runs.filter("monotonic"), runs.filter("not monotonic")
        if refused.limit(1).count():
            found.append(fix("nonmonotonic_timestamps", f"Session '{name}' has runs whose time doesn't run forward; they keep their rate.", "HARD-REJECT", session=name))
        gaps = ok.filter("gap").limit(1).count()
        if gaps:
            f = Finding("BAD-MODEL", "fix-required" if way == "down" else "advisory", "large_gap_in_resampled_run", f"Session '{name}' has gaps.", "docs/rules.md#large_gap_in_resampled_run", {"session": name})
            found.append(f)
        keys = ["session", "run_id", "label"]
        up = down = 0
        if way == "down":
            up, down = resample.ratio(hz, target)
            if up >= down:
                way = "up_or_noop"
        if way == "down":
            need = resample.least_samples(up, down) if up >= 1 and max(up, down) <= resample.CAP else None
            short = ok if need is None else ok.filter(F.col("rows") < need)
            if short.limit(1).count():
                found.append(fix("downsample_run_too_short", f"Session '{name}' has runs too short for {target} Hz.", session=name, needs=need))
            refused = refused.union(short)
            out = None if need is None else resample.downsample(ok.filter(F.col("rows") >= need), keys, "t", sensors, hz, target, unit)
        else:
            out = resample.regrid(ok.select(*keys, "t", *sensors), keys, unit / target, sensors)
        if out is not None:
            made.append(out.select(*keys, "step", "t", *sensors))
        made.append(refused.select(*keys, (F.col("pos") - F.col("run_start")).alias("step"), "t", *sensors))
        found.append(info("resample_provenance", f"Session '{name}': {way} to {target} Hz.", session=name, measured_hz=hz, target_hz=target, direction=way, up=up, down=down))
    first = base.groupBy("session").agg(F.min("_row").alias("first"))
    out = reduce(DataFrame.unionByName, made).join(first.withColumnRenamed("session", "fs"), F.col("session") == F.col("fs"))
    for c in whole:
        out = out.withColumn(c, resample.requantize(F.col(c)))
    if whole:
        found.append(info("resample_integer_preserved", f"Whole-number columns stay whole: {', '.join(sorted(whole))}.", columns=sorted(whole)))
    out = seq.ordinal(out.withColumn("__s", F.col("session")), F.lit(0), ["first", "__s", "run_id", "step"]).withColumnsRenamed({"pos": "_row"})
    cols = [F.col(c) for c in sensors] + [F.col("t").alias(time)] + ([F.col("label").alias(label)] if label in df.columns else []) + ([F.col("__s").alias(session)] if session else [])
    return out.select("_row", *cols), found


def centred(df: DataFrame, profile: Profile, window: int) -> tuple[DataFrame, list[Finding]]:
    """Gesture classes as centred windows, continuous ones cut to whole windows, in class blocks."""
    label = profile.label_column
    sensors = [c for c in profile.sensor_columns if c in df.columns]
    keep = [c for c in df.columns if c in (*sensors, label)]
    dropped = [c for c in data_columns(df) if c not in keep]
    found = [info("centering_dropped_columns", f"Dropped: {', '.join(dropped)}.", columns=dropped)] if dropped else []
    rows = seq.class_position(seq.ordinal(df.select("_row", *keep), F.lit(0), ["_row"]).withColumn("label", F.col(label)))
    classes = sorted(r.label for r in rows.select("label").distinct().collect())
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("double").alias("x")) for a in sensors])).alias("a")
    signal = rows.filter(F.col("label").isin(list(profile.gesture_classes))).select("label", F.col("class_pos").alias("pos"), F.col("class_n").alias("n"), each).select("label", "pos", "n", "a.*")
    best = events.best_axis(signal, "label", "axis", sensors, window).collect() if profile.gesture_classes else []
    axis = {r.label: r for r in best}
    made, ledger = [], {}
    for c in classes:
        mine = rows.filter(F.col("label") == c)
        n = mine.count()
        if c in profile.gesture_classes:
            _, _, windows = events.detect(signal.filter((F.col("label") == c) & (F.col("axis") == axis[c].axis)), ["label"], window)
            cut = windows.select("left", "center")
            out = mine.join(F.broadcast(cut), (F.col("class_pos") >= F.col("left")) & (F.col("class_pos") < F.col("left") + window))
            out = out.select(*keep, F.lit(c).alias("__c"), F.col("center").alias("__w"), "class_pos")
            kept, detected = axis[c].kept * window, axis[c].detected
            if not kept:
                found.append(loss("no_centered_windows", f"Class {c} has no centred window.", label=c))
        elif c in profile.continuous_classes:
            kept, detected = n // window * window, None
            out = mine.filter(F.col("class_pos") < kept).select(*keep, F.lit(c).alias("__c"), F.lit(0).cast("long").alias("__w"), "class_pos")
            if not kept:
                found.append(loss("class_too_short_to_trim", f"Class {c} has {n} rows, under a window.", label=c))
        else:
            kept, detected = n, None
            out = mine.select(*keep, F.lit(c).alias("__c"), F.lit(0).cast("long").alias("__w"), "class_pos")
            found.append(fix("class_not_partitioned", f"Class {c} is neither gesture nor continuous.", label=c))
        ledger[c] = {"rows_in": n, "rows_out": kept, "events": detected}
        made.append(out)
    lost = sum(v["rows_in"] - v["rows_out"] for v in ledger.values())
    if lost:
        found.append(info("centering_rows_discarded", f"Centering leaves out {lost} rows.", ledger=ledger))
    out = seq.ordinal(reduce(DataFrame.unionByName, made), F.lit(0), ["__c", "__w", "class_pos"])
    return out.select(F.col("pos").alias("_row"), *keep), found


def prep(
    spark: SparkSession, inputs: list[str], profile: Profile, out_path: str, window: int | None, center: bool | None = None, target_rate: float | None = None,
    write_anyway: bool = False, time_unit: str = "s", sp: bool | None = None,
) -> Prepared:
    off = sp is False
    if guard := sinks.output_guard(inputs, out_path):
        return Prepared(Report([guard]), False, out_path)
    df, found = combined(spark, inputs, profile, off)
    if df is None:
        return Prepared(Report(found), False, out_path)
    if not df.limit(1).count():
        return Prepared(Report([*found, hard("empty_input", "The input has no rows.")]), False, out_path)
    label = profile.label_column
    if profile.task_type != "anomaly_detection" and label not in df.columns:
        return Prepared(Report([*found, hard("label_column_missing", f"The target column '{label}' isn't in the data.", label_column=label, columns=data_columns(df))]), False, out_path)
    numeric = [c for c in [*profile.sensor_columns, profile.time_column, label if profile.task_type == "regression" else None] if c and c in df.columns]
    df, said = normalised(df, numeric, profile.separator != "comma")
    found += said
    mapping = None
    if profile.task_type != "regression" and label in df.columns:
        df, mapping, said = encoded(df, profile)
        found += said
    df = df.persist()
    if target_rate and off:
        found.append(fix("sp_off_resample_refused", "Signal processing is off; tabular rows can't be resampled."))
    elif target_rate:
        df, said = resampled(df, profile, target_rate, time_unit)
        found += said
    if not off and (center if center is not None else profile.is_classification and bool(profile.gesture_classes)):
        df, said = centred(df, profile, window)
        found += said
    df = df.persist()
    found += check_frame(df, profile, window, sp, out_path)
    flags = [f"-t {label}"] + ([f"-sn {profile.session_column}"] if profile.session_column in df.columns else []) + ([f"-d {profile.separator}"] if profile.separator != "comma" else [])
    found.append(info("runner_flags", f"Call the local runner with {' '.join(flags)}.", flags=flags))
    # Known before anything is written, so a report can't turn after the file is on disk.
    stale = sinks.stale_dictionary(out_path, remove=False) if mapping is None else []
    report = Report([*found, *stale])
    if report.verdict != "PASS" and not write_anyway:
        return Prepared(report, False, out_path, mapping)
    sinks.write_csv(df, out_path, ["_row"], data_columns(df))
    if mapping is None:
        return Prepared(Report([*found, *sinks.stale_dictionary(out_path)]), True, out_path)
    return Prepared(report, True, out_path, mapping, sinks.write_dictionary(out_path, mapping))
