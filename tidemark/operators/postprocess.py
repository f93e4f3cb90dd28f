"""Smoothing of prediction streams. Rows are (stream, pos, p): one probability array a frame.

A stream is one recording, so windows over it are bounded by its length; streams spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def argmax(p: Column) -> Column:
    """First place of the largest value."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def threshold(p: Column, least: float) -> Column:
    return F.when(F.array_max(p) >= least, argmax(p)).otherwise(-1)


def without(p: Column, unknown: int) -> Column:
    """The array with the unknown class at minus infinity."""
    return F.transform(p, lambda x, i: F.when(i == unknown, F.lit(float("-inf"))).otherwise(x))


def exclude_unknown(p: Column, least: float = 0.5, unknown: int = 1) -> Column:
    rest = without(p, unknown)
    return F.when(F.array_max(rest) >= least, argmax(rest)).otherwise(-1)


def _ordered() -> Window:
    return Window.partitionBy("stream").orderBy("pos")


def streaks(df: DataFrame, pred: str = "pred") -> DataFrame:
    """Add run (number of the stretch of equal predictions) and streak (place in it, from 1)."""
    order = _ordered()
    change = F.when(F.lag(pred).over(order).eqNullSafe(F.col(pred)), 0).otherwise(1)
    df = df.withColumn("run", F.sum(change).over(order))
    return df.withColumn("streak", F.row_number().over(Window.partitionBy("stream", "run").orderBy("pos")))


def consecutive(df: DataFrame, n: int, pred: str = "pred", strict: bool = False) -> DataFrame:
    """Add out: the last class seen n times running. Unless ``strict``, the first run counts one extra."""
    made = streaks(df, pred)
    length = F.col("streak") if strict else F.col("streak") + F.when(F.col("run") == 1, 1).otherwise(0)
    sure = F.last(F.when(length >= n, F.col(pred)), ignorenulls=True).over(_ordered())
    return made.withColumn("out", F.coalesce(sure, F.lit(-1))).drop("run", "streak")


def majority(df: DataFrame, k: int, classes: int, pred: str = "pred") -> DataFrame:
    """Add out: the class most seen in the last k frames, ignoring -1; the smallest of ties; -1 if there is none."""
    frame = _ordered().rowsBetween(-(k - 1), 0)
    votes = F.array(*[F.struct(F.sum(F.when(F.col(pred) == c, 1).otherwise(0)).over(frame).alias("n"), F.lit(-c).alias("c")) for c in range(classes)])
    best = F.array_max(votes)
    return df.withColumn("__b", best).withColumn("out", F.when(F.col("__b.n") > 0, -F.col("__b.c")).otherwise(-1)).drop("__b")


def ema(df: DataFrame, alpha: float = 0.3, seed: str = "first") -> DataFrame:
    """Add e: exponential moving average of p, from the first frame or from zero. One stream a task: the recurrence is sequential."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        now, out = None, []
        for p in part["p"]:
            p = np.asarray(p, np.float64)
            now = p if now is None and seed == "first" else alpha * p + (1 - alpha) * (np.zeros_like(p) if now is None else now)
            out.append(now)
        return part.assign(e=out)

    df = df.select("stream", "pos", "p")
    return df.groupBy("stream").applyInPandas(run, "stream long, pos long, p array<double>, e array<double>")


def production(df: DataFrame, alpha: float = 0.3, least: float = 0.6, n: int = 2, margin: float = 0.2, unknown: int = 1) -> DataFrame:
    """Average, drop narrow wins of the unknown class, threshold, and confirm by n frames; -1 breaks a streak, the output stays."""
    made = ema(df, alpha)
    rest = without(F.col("e"), unknown)
    swap = (argmax(F.col("e")) == unknown) & (F.array_max("e") - F.array_max(rest) < margin)
    made = made.withColumn("c", F.when(swap, argmax(rest)).otherwise(argmax(F.col("e")))).withColumn("top", F.when(swap, F.array_max(rest)).otherwise(F.array_max("e")))
    made = streaks(made.withColumn("pred", F.when(F.col("top") >= least, F.col("c")).otherwise(-1)))
    sure = F.last(F.when((F.col("streak") >= n) & (F.col("pred") != -1), F.col("pred")), ignorenulls=True).over(_ordered())
    return made.select("stream", "pos", "pred", F.coalesce(sure, F.lit(-1)).alias("out"))


def episodes(df: DataFrame, pred: str = "pred") -> DataFrame:
    """(stream, class, start, end, len) of stretches of one class, without -1."""
    made = streaks(df, pred).groupBy("stream", "run", F.col(pred).alias("class")).agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.count("*").alias("len"))
    return made.filter(F.col("class") >= 0).drop("run")


def ceiling(df: DataFrame, classes: int) -> DataFrame:
    """By class: largest and mean probability, times ranked first, second, third and never in the top three, and whether it is dead."""
    each = df.select("stream", "pos", F.posexplode("p").alias("class", "v"))
    each = each.withColumn("rank", F.row_number().over(Window.partitionBy("stream", "pos").orderBy(F.desc("v"), "class")))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    made = each.groupBy("class").agg(
        F.max("v").alias("max_p"), F.avg("v").alias("mean_p"), count(F.col("rank") == 1).alias("top1"), count(F.col("rank") == 2).alias("top2"),
        count(F.col("rank") == 3).alias("top3"), count(F.col("rank") > 3).alias("never_top3"),
    )
    return made.withColumn("dead", F.col("max_p") < 0.1)


def frame_report(df: DataFrame, name: str, pred: str = "out") -> DataFrame:
    """(pipeline, class, frames, episodes) with class -1 for dropped frames."""
    made = streaks(df, pred)
    return made.groupBy(F.lit(name).alias("pipeline"), F.col(pred).cast("int").alias("class")).agg(
        F.count("*").alias("frames"), F.sum(F.when(F.col("streak") == 1, 1).otherwise(0)).cast("long").alias("episodes")
    )


def comparison(df: DataFrame, classes: int, unknown: int = 1) -> DataFrame:
    """All pipelines side by side. The parameter grids."""
    base = df.withColumn("pred", argmax(F.col("p")))
    made = [frame_report(base, "argmax", "pred")]
    made += [frame_report(df.withColumn("out", threshold(F.col("p"), t)), f"threshold={t}") for t in (0.50, 0.80, 0.95, 0.99)]
    made += [frame_report(consecutive(base, n), f"consecutive={n}") for n in (2, 3, 5)]
    made += [frame_report(majority(base, k, classes), f"majority={k}") for k in (3, 5, 7)]
    made += [frame_report(df.withColumn("out", exclude_unknown(F.col("p"), t, unknown)), f"no-unknown={t}") for t in (0.10, 0.30, 0.50)]
    made += [frame_report(ema(df, a).withColumn("out", argmax(F.col("e"))), f"ema={a}") for a in (0.1, 0.3, 0.5)]
    made += [frame_report(production(df, unknown=unknown), "production")]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out


def median3(df: DataFrame, x: str = "x") -> DataFrame:
    """Add y: the first two samples pass, then the median of the last three."""
    a, b, c = F.col(x), F.lag(x, 1).over(_ordered()), F.lag(x, 2).over(_ordered())
    return df.withColumn("y", F.when(c.isNull(), a).otherwise(F.element_at(F.sort_array(F.array(a, b, c)), 2)))
