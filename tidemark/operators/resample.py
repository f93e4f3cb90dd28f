"""Combining recordings and changing their rate."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT_PER_SECOND = {"s": 1.0, "ms": 1e3, "us": 1e6}
SAME = 0.02
CAP = 256
HALF_TAPS = 10
GUARD = 3
GAP = 4.0


class ColumnMismatch(ValueError):
    """Recordings differ in their columns or in their order."""


def combine(parts: list[DataFrame], order: str) -> DataFrame:
    """One recording after the other, with part and pos over all. Offsets come from counts, one number a recording."""
    if any(p.columns != parts[0].columns for p in parts):
        raise ColumnMismatch([p.columns for p in parts])
    tagged = reduce(DataFrame.union, [p.select(F.lit(i).cast("long").alias("part"), *p.columns) for i, p in enumerate(parts)])
    counts = tagged.groupBy(F.col("part").alias("__p")).agg(F.count("*").alias("c"))
    counts = counts.withColumn("__b", F.coalesce(F.sum("c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("part").orderBy(order)
    made = tagged.withColumn("__i", F.row_number().over(inside) - 1).join(F.broadcast(counts), F.col("part") == F.col("__p"))
    return made.select((F.col("__b") + F.col("__i")).alias("pos"), "part", *parts[0].columns)


def direction(source_hz: float | None, target_hz: float) -> str:
    """``down`` only if the target is more than 2 % under a measured rate."""
    if not source_hz or not np.isfinite(source_hz) or source_hz <= 0 or abs(target_hz - source_hz) / source_hz <= SAME:
        return "up_or_noop"
    return "down" if target_hz < source_hz else "up_or_noop"


def ratio(source_hz: float, target_hz: float) -> tuple[int, int]:
    f = Fraction(target_hz / source_hz).limit_denominator(CAP)
    return f.numerator, f.denominator


def regrid(df: DataFrame, keys: list[str], step: float, sensors: list[str], time: str = "t") -> DataFrame:
    """(keys, step, t, sensors) on a uniform grid from each run's first time, by linear interpolation.

    Each sample makes the grid points up to the next sample, so no join is needed.
    """
    order = Window.partitionBy(*keys).orderBy(time)
    df = df.withColumn("__t0", F.min(time).over(Window.partitionBy(*keys))).withColumn("__next", F.lead(time).over(order))
    for c in sensors:
        df = df.withColumn(f"__n_{c}", F.lead(c).over(order))
    low = F.ceil((F.col(time) - F.col("__t0")) / step)
    high = F.when(F.col("__next").isNull(), F.floor((F.col(time) - F.col("__t0")) / step)).otherwise(F.ceil((F.col("__next") - F.col("__t0")) / step) - 1)
    df = df.withColumn("__lo", low).withColumn("__hi", high).filter("__lo <= __hi")
    df = df.withColumn("step", F.explode(F.sequence("__lo", "__hi")))
    at = F.col("__t0") + F.lit(step) * F.col("step")
    share = (at - F.col(time)) / (F.col("__next") - F.col(time))
    made = [F.when(F.col("__next").isNull(), F.col(c)).otherwise(F.col(c) + (F.col(f"__n_{c}") - F.col(c)) * share).alias(c) for c in sensors]
    return df.select(*keys, "step", at.alias(time), *made)


def taps(up: int, down: int) -> np.ndarray:
    """Low-pass by a windowed sinc (Kaiser, beta 5) at the lower Nyquist rate, with unit gain times ``up``."""
    most = max(up, down)
    half = HALF_TAPS * most
    h = np.sinc(np.arange(-half, half + 1) / most) * np.kaiser(2 * half + 1, 5.0)
    return h / h.sum() * up


def resample_poly(y: np.ndarray, up: int, down: int) -> np.ndarray:
    """Up by zeros, filter, down; the line from first to last sample is taken out before and put back after."""
    n = len(y)
    line = y[0] + (y[-1] - y[0]) * np.arange(n) / max(n - 1, 1)
    h = taps(up, down)
    wide = np.zeros(n * up)
    wide[::up] = y - line
    out = np.convolve(wide, h)[len(h) // 2 :][: n * up : down]
    count = ceil(n * up / down)
    at = np.arange(count) * down / up
    return out[:count] + y[0] + (y[-1] - y[0]) * at / max(n - 1, 1)


def least_samples(up: int, down: int) -> int:
    """Samples a run needs to be filtered without distortion."""
    return ceil(GUARD * (2 * HALF_TAPS * max(up, down) + 1) / up)


def downsample(df: DataFrame, keys: list[str], time: str, sensors: list[str], source_hz: float, target_hz: float, unit: float = 1.0, guard: bool = True) -> DataFrame:
    """(keys, step, time, sensors) of every run at the lower rate, anti-aliased; runs that are too short are left out under ``guard``.

    A run is one task's work: the filter needs its neighbours, and a run is bounded by its recording.
    """
    up, down = ratio(source_hz, target_hz)
    if up < 1 or max(up, down) > CAP:
        raise ValueError("rate ratio out of the supported range")
    need = least_samples(up, down) if guard else 2
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema), "step long", f"{time} double", *(f"{c} double" for c in sensors)])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(time)
        t = part[time].to_numpy(np.float64)
        if len(t) < need:
            return pd.DataFrame({c: [] for c in [*keys, "step", time, *sensors]})
        even = t[0] + unit / source_hz * np.arange(int(np.floor((t[-1] - t[0]) * source_hz / unit + 1e-9)) + 1)
        made = {c: resample_poly(np.interp(even, t, part[c].to_numpy(np.float64)), up, down) for c in sensors}
        n = len(made[sensors[0]])
        at = t[0] + unit / (source_hz * up / down) * np.arange(n)
        return pd.DataFrame({**{k: part[k].iloc[0] for k in keys}, "step": np.arange(n), time: at, **made})

    return df.select(*keys, time, *sensors).groupBy(*keys).applyInPandas(run, schema)


def requantize(value: Column) -> Column:
    """Whole numbers again after interpolation, halves to even."""
    return F.rint(value)
