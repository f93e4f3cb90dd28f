"""Per-window feature banks Q (17) and S (22) on rows (window keys, k, x).

Two passes over one partitioning: mean and deviation as window functions, then one grouped aggregate, so each bank shuffles once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Q = ["min", "max", "range", "mean", "std", "rms", "absmean", "mad", "mcr", "zcr", "pzero", "pmean", "psigma", "pscr", "crest", "rds", "amdif"]
S = [
    "min", "max", "range", "mean", "absmean", "std", "mad", "rms", "kurtosis", "skewness", "lr_slope", "lr_intercept", "zcr", "mcr", "crest", "rds",
    "amdif", "psom", "psoz", "mobility", "complexity", "autocorr",
]
#: The family of each feature of bank S.
FAMILY = {
    "min": "Level", "max": "Level", "range": "Energy", "mean": "Level", "absmean": "Energy", "std": "Energy", "mad": "Energy", "rms": "Energy",
    "kurtosis": "Shape", "skewness": "Shape", "lr_slope": "Direction", "lr_intercept": "Level", "zcr": "Crossing", "mcr": "Crossing",
    "crest": "Impulse/Shape", "rds": "Variation", "amdif": "Variation", "psom": "Variation/Signed", "psoz": "Variation/Signed",
    "mobility": "Impulse/Shape", "complexity": "Impulse/Shape", "autocorr": "Autocorrelation",
}
#: Features that only tell magnitude, those that tell direction, and those that tell impulses.
MAGNITUDE = ["std", "rms", "range", "mad", "absmean"]
SIGNED = ["mean", "min", "max", "lr_slope", "lr_intercept", "psoz", "psom"]
IMPULSE = ["crest", "mobility", "complexity"]


def _prepared(df: DataFrame, keys: list[str]) -> DataFrame:
    whole, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("k")
    # Rounded, so that samples equal to the mean stay equal to it whatever the order of summation.
    df = df.withColumn("m", F.round(F.avg("x").over(whole), 12)).withColumn("s", F.stddev_pop("x").over(whole))
    df = df.withColumn("ms", F.round(F.col("m") + F.col("s"), 12))
    df = df.withColumn("p", F.lag("x").over(order))
    df = df.withColumn("d", F.col("x") - F.col("p"))
    return df.withColumn("dd", F.col("d") - F.lag("d").over(order))


def _share(cond) -> F.Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def _crossings(a, b, n) -> F.Column:
    return F.sum(F.when(F.signum(a) != F.signum(b), 1.0).otherwise(0.0)) / n


def _q(x, m, ms, p, d) -> dict[str, F.Column]:
    """Aggregates of bank Q over a window's samples x with their mean, mean plus deviation, sample before, and step."""
    n = F.count(x)
    rms = F.sqrt(F.avg(x * x))
    return {
        "min": F.min(x), "max": F.max(x), "range": F.max(x) - F.min(x), "mean": F.avg(x), "std": F.stddev_pop(x), "rms": rms, "absmean": F.avg(F.abs(x)),
        "mad": F.avg(F.abs(x - m)), "mcr": _crossings(x - m, p - m, n), "zcr": _crossings(x, p, n), "pzero": _share(x > 0), "pmean": _share(x > m), "psigma": _share(x > ms),
        "pscr": F.sum(F.when((x > ms) & (p <= ms), 1.0).otherwise(0.0)) / n, "crest": F.max(F.abs(x)) / F.greatest(rms, F.lit(1.0)),
        "rds": F.coalesce(F.sqrt(F.avg(d * d)), F.lit(0.0)), "amdif": F.coalesce(F.avg(F.abs(d)), F.lit(0.0)),
    }


def bank_q(df: DataFrame, keys: list[str]) -> DataFrame:
    made = _q(*[F.col(c) for c in ("x", "m", "ms", "p", "d")])
    return _prepared(df, keys).groupBy(*keys).agg(*[made[c].alias(c) for c in Q])


def long_q(df: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """(keys, axis, idx, feature, value) of bank Q over rows with one column an axis: rows are dealt and sorted once for all axes."""
    whole, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("k")
    df = df.select(*keys, "k", *[F.col(a).cast("double").alias(f"x{i}") for i, a in enumerate(axes)])
    n = range(len(axes))
    df = df.select("*", *[F.round(F.avg(f"x{i}").over(whole), 12).alias(f"m{i}") for i in n], *[F.stddev_pop(f"x{i}").over(whole).alias(f"s{i}") for i in n], *[F.lag(f"x{i}").over(order).alias(f"p{i}") for i in n])
    made = [_q(F.col(f"x{i}"), F.col(f"m{i}"), F.round(F.col(f"m{i}") + F.col(f"s{i}"), 12), F.col(f"p{i}"), F.col(f"x{i}") - F.col(f"p{i}")) for i in n]
    df = df.groupBy(*keys).agg(*[made[i][c].cast("double").alias(f"{c}_{i}") for i in n for c in Q])
    each = [F.struct(F.lit(i).alias("axis"), F.lit(j).alias("idx"), F.lit(c).alias("feature"), F.col(f"{c}_{i}").alias("value")) for i in n for j, c in enumerate(Q)]
    return df.select(*keys, F.explode(F.array(*each)).alias("f")).select(*keys, "f.*")


def bank_s(df: DataFrame, keys: list[str]) -> DataFrame:
    x, m, s, p, d, k = F.col("x"), F.col("m"), F.col("s"), F.col("p"), F.col("d"), F.col("k").cast("double")
    n, eps = F.count("x"), 1e-9
    made = _prepared(df, keys).withColumn("z", (x - m) / F.when(s > eps, s).otherwise(F.lit(1.0)))
    rms = F.sqrt(F.avg(x * x))
    slope = (F.avg(k * x) - F.avg(k) * F.avg(x)) / F.nullif(F.avg(k * k) - F.avg(k) * F.avg(k), F.lit(0.0))
    slope = F.coalesce(slope, F.lit(0.0))
    vx, vd, vdd = F.var_pop("x"), F.var_pop("d"), F.var_pop("dd")
    mob = F.when(vx > eps, F.sqrt(vd / F.when(vx > eps, vx))).otherwise(0.0)
    mob_d = F.when(vd > eps, F.sqrt(vdd / F.when(vd > eps, vd))).otherwise(0.0)
    # Correlation of the window without its last sample and without its first.
    pairs = F.count("p")
    cov = F.sum(x * p) / pairs - F.avg(F.when(p.isNotNull(), x)) * F.avg(p)
    dev = F.stddev_pop(F.when(p.isNotNull(), x)) * F.stddev_pop(p)
    auto = F.when((F.max(s) > eps) & (n > 2), F.coalesce(cov / F.nullif(dev, F.lit(0.0)), F.lit(0.0))).otherwise(0.0)
    return made.groupBy(*keys).agg(
        F.avg(x).alias("mean"), F.max(s).alias("std"), rms.alias("rms"), F.min(x).alias("min"), F.max(x).alias("max"), (F.max(x) - F.min(x)).alias("range"),
        F.avg(F.abs(x)).alias("absmean"), F.avg(F.abs(x - m)).alias("mad"), (F.avg(F.pow("z", F.lit(4.0))) - 3).alias("kurtosis"),
        F.avg(F.pow("z", F.lit(3.0))).alias("skewness"), slope.alias("lr_slope"), (F.avg(x) - slope * F.avg(k)).alias("lr_intercept"),
        _crossings(x, p, n).alias("zcr"), _crossings(x - m, p - m, n).alias("mcr"),
        F.when(rms > eps, F.max(F.abs(x)) / F.when(rms > eps, rms)).otherwise(0.0).alias("crest"), F.coalesce(F.sqrt(F.avg(d * d)), F.lit(0.0)).alias("rds"),
        F.coalesce(F.avg(F.abs(d)), F.lit(0.0)).alias("amdif"), _share(x > m).alias("psom"), _share(x > 0).alias("psoz"), mob.alias("mobility"),
        F.when(mob > eps, mob_d / F.when(mob > eps, mob)).otherwise(0.0).alias("complexity"), auto.alias("autocorr"),
    )


def long_form(features: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(keys, idx, feature, value): one row a feature."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for i, c in enumerate(names)]))
    return features.select(*keys, each.alias("f")).select(*keys, "f.*")
