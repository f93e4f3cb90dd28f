"""The quality report: how the sources of a data set differ, and how well features separate its classes."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import features as bank
from tidemark.operators import compare
from tidemark.operators import sequence as seq
from tidemark.plans.findings import Finding, Report, advise, hard
from tidemark.plans.profile import Profile
from tidemark.plans.validate import cells, read_checked, with_session


def load_sources(spark: SparkSession, paths: list[str], profile: Profile) -> tuple[DataFrame | None, list[Finding]]:
    """Files joined in order and tagged: by file name if there are several, else by session."""
    parts, found = [], []
    for p in paths:
        df, said = read_checked(spark, p, profile)
        found += said
        if df is not None:
            parts.append(df.withColumn("source", F.lit(os.path.basename(p))))
    if not parts:
        return None, found
    if any(p.columns != parts[0].columns for p in parts):
        return None, [*found, hard("combine_failed", "The files differ in their columns.")]
    before, sized = 0, []
    for p in parts:
        sized.append(p.withColumn("_row", F.col("_row") + before))
        before += p.count()
    df = reduce(DataFrame.union, sized)
    if len(paths) == 1:
        name = profile.session_column
        df = df.withColumn("source", F.col(f"`{name}`") if name and name in df.columns else F.lit("all"))
    return df, found


def quality_report(spark: SparkSession, paths: list[str], profile: Profile, window: int | None) -> tuple[Report, dict]:
    """Findings, and counts by source and class with the sources that could not be compared."""
    df, found = load_sources(spark, paths, profile)
    if df is None:
        return Report(found), {}
    label = profile.label_column
    if profile.task_type != "anomaly_detection" and label not in df.columns:
        return Report([*found, hard("label_column_missing", f"The target column '{label}' isn't in the data.", label_column=label)]), {}
    sensors = [c for c in profile.sensor_columns if c in df.columns]
    df = with_session(cells(df, sensors, profile.separator != "comma"), profile)
    df = df.select("source", "session", "pos", "n", "_row", F.col(f"`{label}`").alias("label") if label in df.columns else F.lit("").alias("label"), *[F.col(f"__v_{c}").alias(c) for c in sensors])
    profile_rows = df.groupBy("source", "label").agg(F.count("*").alias("rows")).collect()  # a row a source and class
    sources: dict = {}
    for r in profile_rows:
        sources.setdefault(r.source, {})[r.label] = r.rows
    extra = {"sources": sources, "insufficient": 0}
    if label and len(sources) >= 2 and window:
        rows = compare.source_outliers(df.na.drop(subset=sensors), sensors, window).collect()
        extra["insufficient"] = len({(r.label, r.source) for r in profile_rows}) - len(rows)
        for r in sorted(rows, key=lambda r: (str(r.label), str(r.source))):
            if r.outlier:
                found.append(advise("source_outlier", f"Class {r.label}: source {r.source} differs from the rest (mean d {r.mean_d:.2f}).", label=r.label, source=r.source, mean_d=round(r.mean_d, 4)))
    return Report(found), extra


#: The feature groups of a recommendation, by full name.
ENERGY = ["Standard Deviation", "Root Mean Square", "Range", "Mean Absolute Deviation", "Absolute Mean"]
LEVEL = ["Mean", "Min", "Max", "Linear Regression Slope", "Linear Regression Intercept", "Percentage of Signal over Zero", "Percentage of Signal over Mean"]
ON_DEMAND = {
    "Impulse/shape": ["Crest Factor", "Hjorth Mobility", "Hjorth Complexity"],
    "Crossing": ["Zero-crossing Rate", "Mean-crossing Rate"],
    "Variation": ["Root Difference Square", "Average Magnitude Difference"],
    "Autocorrelation": ["Autocorrelation"],
}


def recommendation(dtype: str, impulse: bool, families: set[str]) -> dict:
    """Feature groups to enable, from storage type and what tells classes apart."""
    enable = {"Energy": ENERGY, "Signed level + direction": LEVEL}
    if impulse:
        enable["Impulse/shape"] = ON_DEMAND["Impulse/shape"]
    enable |= {k: ON_DEMAND[k] for k in ("Crossing", "Variation", "Autocorrelation") if k in families}
    whole = dtype.startswith("int")
    if not whole:
        enable["Distribution shape"] = ["Skewness", "Kurtosis"]
    return {"enable": enable, "hold_back": ["Skewness", "Kurtosis"] if whole else []}


def separability(df: DataFrame, axes: list[str], window: int, label: str = "label", top: int = 15, blind: float = 1.0) -> dict:
    """How well the features of bank S tell classes apart. ``df`` has session, pos, an integer label and the axes."""
    df = df.na.drop(subset=axes)
    cut = seq.nonoverlapping(seq.class_position(df, label), window)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("axis"), F.col(a).cast("double").alias("x")) for i, a in enumerate(axes)])).alias("a")
    rows = cut.select(label, "win", "k", each).select(label, "win", "k", "a.*")
    keys = [label, "win", "axis"]
    long = bank.long_form(bank.bank_s(rows, keys), keys, bank.S)
    # One index over all axes, axis after axis.
    long = long.withColumn("idx", F.col("axis") * len(bank.S) + F.col("idx")).drop("axis").persist()
    counts = {r[label]: r["n"] for r in long.filter("idx = 0").groupBy(label).agg(F.count("*").alias("n")).collect()}
    dtype = [r["dtype"] for r in compare.content_type(df, axes).collect()]
    dtype = "float32" if "float32" in dtype else max(dtype, key=lambda d: int(d[3:]), default="float32")
    if sum(n >= 3 for n in counts.values()) < 2:
        return {"ok": False, "reason": "fewer than two classes have enough windows", "dtype": dtype}
    named = lambda r: f"{r.feature}@{axes[r.idx // len(bank.S)]}"
    scores = compare.anova(long, label).persist()
    best = compare.one_vs_rest(long, label).collect()
    pairs = compare.class_pairs(compare.moments(compare.enough(long, label), [label]), label)
    blind_pairs = compare.magnitude_blind(pairs, blind).orderBy("class_a", "class_b").collect()
    families = {bank.FAMILY[r.feature] for r in best}
    return {
        "ok": True, "dtype": dtype, "window": window, "windows": counts,
        "top_features": [{"feature": named(r), "family": bank.FAMILY[r.feature], "anova_f": round(r.f, 4)} for r in compare.top_features(scores, top).collect()],
        "families": sorted(({"family": r.family, "mean_f": round(r.mean_f, 4), "max_f": round(r.max_f, 4)} for r in compare.family_ranking(scores, bank.FAMILY).collect()), key=lambda x: (-x["mean_f"], x["family"])),
        "per_class": [{"class": r[label], "feature": named(r), "cohens_d": round(r.d, 4)} for r in sorted(best, key=lambda r: r[label])],
        "magnitude_blind_pairs": [r.asDict() for r in blind_pairs],
        "recommendation": recommendation(dtype, any(r.feature in bank.IMPULSE for r in best), families),
    }
