"""Operators on ordered recordings: runs, grid windows, rates, gaps, order checks, trims.

Frames carry an explicit ordinal: ``session``, ``pos`` (0-based in the session) and ``n`` (rows of the session). All of them partition by
session, so a plan that chains several shuffles once. Positions along a class, which may be one long class, are built from counts
by session (``class_position``) instead of one window over the whole class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordinal(df: DataFrame, session: Column, order: list[str]) -> DataFrame:
    """Add session, pos and n."""
    df = df.withColumn("session", session)
    by = Window.partitionBy("session")
    return df.withColumn("pos", F.row_number().over(by.orderBy(*order)) - 1).withColumn("n", F.count("*").over(by))


def runs(df: DataFrame, label: str = "label") -> DataFrame:
    """Add run_id, run_start, run_end (exclusive) of maximal same-label stretches inside a session."""
    order = Window.partitionBy("session").orderBy("pos")
    change = F.when(F.lag(label).over(order).eqNullSafe(F.col(label)) & (F.col("pos") > 0), 0).otherwise(1)
    df = df.withColumn("run_id", F.sum(change).over(order))
    run = Window.partitionBy("session", "run_id")
    return df.withColumn("run_start", F.min("pos").over(run)).withColumn("run_end", F.max("pos").over(run) + 1)


def run_table(df: DataFrame, label: str = "label") -> DataFrame:
    """One row a run: session, run_id, label, len."""
    return runs(df, label).groupBy("session", "run_id", F.col(label).alias("label")).agg(F.count("*").alias("len"))


def run_lengths(df: DataFrame, label: str = "label") -> DataFrame:
    """By label: longest run, rows, number of runs."""
    return run_table(df, label).groupBy("label").agg(F.max("len").alias("max_run"), F.sum("len").alias("total"), F.count("*").alias("n_runs"))


def run_stats(df: DataFrame, label: str = "label") -> DataFrame:
    """By session and label: rows, runs, longest run and its truncated 95th percentile."""
    return run_table(df, label).groupBy("session", "label").agg(
        F.sum("len").alias("rows"), F.count("*").alias("n_runs"), F.max("len").alias("max_run"), F.floor(F.percentile("len", 0.95)).cast("long").alias("p95_run")
    )


def valid_label(label: Column) -> Column:
    """Present, not NaN and finite."""
    return label.isNotNull() & ~F.lower(label.cast("string")).isin("nan", "infinity", "-infinity", "inf", "-inf", "")


def grid_windows(df: DataFrame, window: int, shift: int, label: str = "label") -> DataFrame:
    """One row a window start on the grid: session, pos, label, pure. A window is pure if its run reaches its end."""
    made = runs(df, label).filter((F.col("pos") % shift == 0) & (F.col("pos") + window <= F.col("n")))
    pure = (F.col("run_end") - F.col("pos") >= window) & valid_label(F.col(label))
    return made.select("session", "pos", F.col(label).alias("label"), pure.alias("pure"))


def pure_windows(df: DataFrame, window: int, shift: int, label: str = "label") -> DataFrame:
    """By label: pure windows, with the total and mixed counts of all windows; labels without a pure window are included."""
    made = grid_windows(df, window, shift, label)
    total = made.agg(F.count("*").alias("total_windows"), F.coalesce(F.sum((~F.col("pure")).cast("long")), F.lit(0)).alias("mixed_windows"))
    labels = df.select(F.col(label).alias("label")).filter(valid_label(F.col("label"))).distinct()
    pure = made.filter("pure").groupBy("label").agg(F.count("*").alias("pure_windows"))
    return labels.join(pure, "label", "left").select("label", F.coalesce("pure_windows", F.lit(0)).alias("pure_windows")).crossJoin(F.broadcast(total))


def pure_windows_multi(df: DataFrame, configs: list[tuple[int, int]], label: str = "label") -> DataFrame:
    """``pure_windows`` for several (window, shift) pairs in one pass over the runs."""
    made = runs(df, label)
    want = F.explode(F.array(*[F.struct(F.lit(w).alias("window"), F.lit(s).alias("shift")) for w, s in configs])).alias("c")
    made = made.select("*", want).select("*", "c.window", "c.shift")
    made = made.filter((F.col("pos") % F.col("shift") == 0) & (F.col("pos") + F.col("window") <= F.col("n")))
    pure = ((F.col("run_end") - F.col("pos") >= F.col("window")) & valid_label(F.col(label))).cast("long")
    return made.groupBy("window", "shift").agg(F.count("*").alias("total_windows"), F.sum(pure).alias("pure_windows"), F.sum(1 - pure).alias("mixed_windows"))


def window_yield(df: DataFrame, window: int, label: str = "label", ratio: float = 3.0) -> DataFrame:
    """By label: pure windows at shift = window, and whether the classes that survive are imbalanced."""
    made = pure_windows(df, window, window, label).select("label", F.col("pure_windows").alias("windows"))
    alive = made.filter("windows > 0").agg((F.max("windows") / F.min("windows")).alias("ratio"))
    return made.crossJoin(F.broadcast(alive)).select("label", "windows", F.round("ratio", 6).alias("ratio"), (F.col("ratio") >= ratio).alias("imbalanced"))


def class_run_below(df: DataFrame, window: int, label: str = "label") -> DataFrame:
    return run_lengths(df, label).filter(F.col("max_run") < window).select("label", "max_run")


def session_below(df: DataFrame, window: int) -> DataFrame:
    return df.groupBy("session").agg(F.count("*").alias("rows")).filter(F.col("rows") < window)


def time_order(df: DataFrame, time: str = "t", factor: float = 1.0) -> DataFrame:
    """By session: steps that run back by more than the median forward step (or at all, where nothing runs forward)."""
    order = Window.partitionBy("session").orderBy("pos")
    step = df.filter(F.col(time).isNotNull()).withColumn("d", F.col(time) - F.lag(time).over(order))
    typical = F.median(F.when(F.col("d") > 0, F.col("d"))).over(Window.partitionBy("session"))
    step = step.withColumn("typical", typical)
    bad = F.when(F.col("typical").isNull(), F.col("d") < 0).otherwise(F.col("d") < -factor * F.col("typical"))
    return step.groupBy("session").agg(F.sum(F.coalesce(bad, F.lit(False)).cast("long")).alias("bad_steps"))


def sampling_rate(df: DataFrame, time: str = "t", unit: float = 1.0, in_row_order: bool = False) -> DataFrame:
    """By session: units a second over the median step; steps of sorted times (more than two rows) or forward steps in row order."""
    order = Window.partitionBy("session").orderBy("pos" if in_row_order else time)
    step = df.withColumn("d", F.col(time) - F.lag(time).over(order))
    if in_row_order:
        step = step.withColumn("d", F.when(F.col("d") > 0, F.col("d")))
    made = step.groupBy("session").agg(F.median("d").alias("m"), F.count("*").alias("rows"))
    made = made.filter("m > 0") if in_row_order else made.filter("rows > 2 and m > 0")
    return made.select("session", (F.lit(unit) / F.col("m")).alias("hz"))


def mixed_rate(rates: DataFrame, tolerance: float = 0.05) -> DataFrame:
    made = rates.agg(F.count("*").alias("sessions"), F.min("hz").alias("min_hz"), F.max("hz").alias("max_hz"))
    return made.withColumn("mixed", (F.col("sessions") >= 2) & ((F.col("max_hz") - F.col("min_hz")) / F.col("min_hz") > tolerance))


def run_steps(df: DataFrame, time: str = "t", label: str = "label", gap: float = 4.0) -> DataFrame:
    """By run: rows, median and largest step, whether there is a gap, and whether time runs forward throughout."""
    made = runs(df, label)
    order = Window.partitionBy("session", "run_id").orderBy("pos")
    made = made.withColumn("d", F.lead(time).over(order) - F.col(time))
    made = made.groupBy("session", "run_id", label).agg(
        F.count("*").alias("rows"), F.median("d").alias("median_step"), F.max("d").alias("max_step"), F.coalesce(F.bool_or(F.col("d") <= 0), F.lit(False)).alias("back")
    )
    has_gap = F.coalesce(F.col("max_step") > gap * F.col("median_step"), F.lit(False))
    return made.withColumn("gap", has_gap).withColumn("monotonic", (F.col("rows") >= 2) & ~F.col("back")).drop("back")


def index_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """By column: equal to the row number throughout (index), or more than two rows that each step by one (counter)."""
    order = Window.partitionBy("session").orderBy("pos")
    steps = df.select("pos", "session", *columns, *[(F.col(c) - F.lag(c).over(order)).alias(f"__{c}") for c in columns])
    made = steps.groupBy("session").agg(
        F.count("*").alias("rows"),
        *[F.coalesce(F.bool_and(F.col(c).isNotNull() & (F.col(c) == F.col("pos"))), F.lit(False)).alias(f"i_{c}") for c in columns],
        *[F.coalesce(F.bool_and(F.when(F.col("pos") > 0, F.coalesce(F.col(f"__{c}") == 1, F.lit(False)))), F.lit(False)).alias(f"c_{c}") for c in columns],
    )
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"i_{c}").alias("is_index"), ((F.col("rows") > 2) & F.col(f"c_{c}")).alias("is_counter")) for c in columns]))
    return made.select("session", each.alias("x")).select("session", "x.*")


def edge_trim(df: DataFrame, head: int, tail: int) -> DataFrame:
    """Drop the first and last rows of each session; sessions that would not survive stay whole."""
    return df.filter((F.col("n") <= head + tail) | ((F.col("pos") >= head) & (F.col("pos") < F.col("n") - tail)))


def class_position(df: DataFrame, label: str = "label") -> DataFrame:
    """Add class_pos and class_n: the place of a row among all rows of its class, by session then pos.

    Offsets come from counts by (class, session), so no task holds a whole class.
    """
    counts = df.groupBy(F.col(label).alias("__l"), F.col("session").alias("__s")).agg(F.count("*").alias("__c"))
    before = Window.partitionBy("__l").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).withColumn("class_n", F.sum("__c").over(Window.partitionBy("__l")))
    inside = Window.partitionBy("session", label).orderBy("pos")
    df = df.withColumn("__i", F.row_number().over(inside) - 1)
    df = df.join(counts, F.col(label).eqNullSafe(F.col("__l")) & F.col("session").eqNullSafe(F.col("__s")))
    return df.withColumn("class_pos", F.col("__before") + F.col("__i")).drop("__l", "__s", "__c", "__before", "__i")


def trim_to_multiple(df: DataFrame, window: int, label: str = "label") -> DataFrame:
    """Keep the first whole number of windows of each class."""
    return class_position(df, label).filter(F.col("class_pos") < F.floor(F.col("class_n") / window) * window)


def nonoverlapping(df: DataFrame, window: int, position: str = "class_pos", total: str = "class_n") -> DataFrame:
    """Add win and k: complete windows that follow each other along a position."""
    made = df.withColumn("win", F.floor(F.col(position) / window)).withColumn("k", F.col(position) % window)
    return made.filter((F.col("win") + 1) * window <= F.col(total))


def sliding(df: DataFrame, window: int, shift: int, position: str = "class_pos", total: str = "class_n") -> DataFrame:
    """Add win (start over shift) and k: every complete window on the grid that holds the row."""
    low = F.greatest(F.lit(0), F.ceil((F.col(position) - window + 1) / shift))
    high = F.least(F.floor(F.col(position) / shift), F.floor((F.col(total) - window) / shift))
    made = df.filter(F.col(total) >= window).withColumn("__lo", low).withColumn("__hi", high).filter("__lo <= __hi")
    made = made.withColumn("win", F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")
    return made.withColumn("k", F.col(position) - F.col("win") * shift)


def session_length_stats(df: DataFrame) -> DataFrame:
    made = df.groupBy("session").agg(F.count("*").alias("c"))
    q = lambda p: F.floor(F.percentile("c", p)).cast("long")
    return made.agg(F.min("c").alias("min"), q(0.25).alias("p25"), q(0.5).alias("median"), q(0.75).alias("p75"), F.max("c").alias("max"), F.sum("c").alias("total"))


def crosstab(df: DataFrame, values: list[str], label: str = "label") -> DataFrame:
    return df.groupBy("session").agg(*[F.sum(F.when(F.col(label) == v, 1).otherwise(0)).cast("long").alias(f"n_{v}") for v in values])
