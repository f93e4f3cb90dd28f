"""Event detection: envelope, threshold segments, local peaks, suppression of close peaks, centred windows.

Rows are (group, pos, n, x): ``group`` lists the columns that name one signal (class and axis), ``pos`` its 0-based position, without gaps.
A signal may be very long, so no rows of a whole one meet in a task: moving windows work on blocks of positions that overlap, means and
places in an order come from sums and counts by block, and rows meet segments a few positions at a time. Groups aren't null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORK_RATIO = 0.95
THRESHOLD = 0.5
TOLERANCE = 10
#: Positions of a block, at least; more where windows are long.
BLOCK = 4096
#: Positions of a block in which rows meet segments.
MEET = 64


def blocks(df: DataFrame, ahead: int, behind: int) -> tuple[DataFrame, Column]:
    """Rows by block of pos, each block with the first rows of the next and the last of the one before; and which rows are its own."""
    size = max(BLOCK, 8 * max(ahead, behind))
    own, place = F.floor(F.col("pos") / size), F.col("pos") % size
    into = F.array_compact(F.array(own, F.when((place < ahead) & (own > 0), own - 1), F.when(place >= size - behind, own + 1)))
    return df.withColumn("block", F.explode(into)), F.col("block") == own


def averages(df: DataFrame, group: list[str], name: str) -> DataFrame:
    """(group, block, mean): the mean of a group beside each of its blocks; sums of a block are added up over the blocks."""
    sums = df.groupBy(*group, "block").agg(F.sum(name).alias("s"), F.count(name).alias("c"))
    whole = Window.partitionBy(*group)
    return sums.select(*group, "block", (F.sum("s").over(whole) / F.sum("c").over(whole)).alias("mean"))


def numbered(df: DataFrame, group: list[str]) -> DataFrame:
    """Add k: the place of a row in its group by pos, from counts by block."""
    counts = df.groupBy(*group, "block").agg(F.count("*").alias("c"))
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*group, "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*group, "block").orderBy("pos"))
    return df.withColumn("k", inside).join(counts, [*group, "block"]).withColumn("k", F.col("k") + F.col("before")).drop("before")


def work_window(window: int) -> int:
    return max(1, int(window * WORK_RATIO))


def envelope(df: DataFrame, group: list[str], window: int, script_length: bool = False) -> DataFrame:
    """Root of squared rolling minimum plus maximum of the mean-free signal, for full frames.

    Adds block, c (mean-free), frames, env, and env of the position before and after. Rows are dealt by (group, block) once.
    """
    w = work_window(window)
    df, own = blocks(df, ahead=w, behind=1)
    # Twice, as one pass over a long run leaves a mean off by 1e-9.
    for name in ("x", "c"):
        df = df.join(averages(df.filter(own), group, name), [*group, "block"]).withColumn("c", F.col(name) - F.col("mean")).drop("mean")
    order = Window.partitionBy(*group, "block").orderBy("pos")
    frame = order.rowsBetween(0, w - 1)
    env = F.sqrt(F.pow(F.min("c").over(frame), F.lit(2.0)) + F.pow(F.max("c").over(frame), F.lit(2.0)))
    frames = F.col("n") - w + (0 if script_length else 1)
    df = df.withColumn("frames", frames).withColumn("env", F.when((F.col("pos") < F.col("frames")) & (F.col("n") > w), env))
    return df.withColumn("env_before", F.lag("env").over(order)).withColumn("env_after", F.lead("env").over(order)).filter(own)


def segments(env: DataFrame, group: list[str], window: int) -> DataFrame:
    """(group, start, end): stretches above half the mean envelope. Bounds are one-based in the envelope, shifted by half a frame."""
    half = work_window(window) // 2
    env = env.filter(F.col("env").isNotNull())
    env = env.join(averages(env, group, "env"), [*group, "block"])
    on = lambda c: F.coalesce(F.col(c) > THRESHOLD * F.col("mean"), F.lit(False))
    env = env.filter(on("env")).select(*group, "block", "pos", "frames", (~on("env_before")).alias("opens"), (~on("env_after")).alias("closes"))
    first = numbered(env.filter("opens").select(*group, "block", "pos"), group).select(*group, "k", F.col("pos").alias("a"))
    last = numbered(env.filter("closes").select(*group, "block", "pos", "frames"), group).select(*group, "k", F.col("pos").alias("b"), "frames")
    made = last.join(first, [*group, "k"])
    # A closed stretch ends at the (one-based) place of the first value back under; an open one at the last value.
    end = F.when(F.col("b") + 1 < F.col("frames"), F.col("b") + 2).otherwise(F.col("frames"))
    return made.select(*group, (F.col("a") + 1 + half).alias("start"), (end + half).alias("end"))


def within(signal: DataFrame, spans: DataFrame, group: list[str]) -> DataFrame:
    """Rows (group, pos, c) beside the spans [start, end) that hold them; they meet by ``MEET`` positions."""
    spots = F.explode(F.sequence(F.floor(F.col("start") / MEET), F.floor((F.col("end") - 1) / MEET))).alias("spot")
    rows = signal.select(*group, "pos", "c", F.floor(F.col("pos") / MEET).alias("spot"))
    met = rows.join(spans.filter("end > start").select("*", spots), [*group, "spot"])
    return met.filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("end")))


def peaks(signal: DataFrame, segs: DataFrame, group: list[str]) -> DataFrame:
    """(group, peak, score): largest deviation of each segment of two samples or more, first of ties."""
    best = F.max(F.struct(F.abs("c").alias("score"), (-F.col("pos")).alias("at"))).alias("best")
    made = within(signal, segs, group).groupBy(*group, "start").agg(best, F.count("*").alias("len")).filter("len > 1")
    return made.select(*group, (-F.col("best.at")).alias("peak"), F.col("best.score").alias("score"))


def suppress(found: DataFrame, group: list[str], window: int) -> DataFrame:
    """(group, center): strongest peaks first, dropping any closer than a window to one kept.

    Peaks on either side of a gap of a window or more don't touch each other, so each stretch between such gaps is judged by itself.
    Peaks are one a segment, few beside the rows, so their gaps are found in one order a group.
    """
    order = Window.partitionBy(*group).orderBy("peak")
    opens = F.when(F.col("peak") - F.lag("peak").over(order) < window, 0).otherwise(1)
    found = found.withColumn("opens", opens).withColumn("piece", F.sum("opens").over(order))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("peak").alias("p"))))
    keep = lambda acc, c: F.when(F.forall(acc, lambda k: F.abs(k - c["p"]) >= window), F.array_append(acc, c["p"])).otherwise(acc)
    made = found.groupBy(*group, "piece").agg(ranked.alias("r"))
    kept = F.aggregate("r", F.array().cast("array<long>"), keep)
    return made.select(*group, F.explode(kept).alias("center"))


def centered(signal: DataFrame, centers: DataFrame, group: list[str], window: int, tolerance: int = TOLERANCE) -> DataFrame:
    """(group, center, left): windows inside the signal whose largest deviation sits near the middle."""
    half = window // 2
    left = F.col("center") - half
    rows = within(signal, centers.select(*group, "center", left.alias("start"), (left + window).alias("end")), group)
    best = F.max(F.struct(F.abs("c").alias("v"), (-F.col("pos")).alias("at")))
    out = rows.groupBy(*group, "center", F.col("start").alias("left")).agg(F.count("*").alias("len"), best.alias("best"))
    ok = (F.col("len") == window) & (F.col("left") >= 0)
    if tolerance >= 0:
        ok &= F.abs(-F.col("best.at") - F.col("left") - half) <= tolerance
    return out.filter(ok).select(*group, "center", "left")


def detect(df: DataFrame, group: list[str], window: int, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mean-free signal, centers and centred windows of every group."""
    env = envelope(df, group, window, **options)
    # Read four times below. Rounded, so equal samples stay equal whatever the order of summation.
    signal = env.select(*group, "block", "pos", "frames", "env", "env_before", "env_after", F.round("c", 9).alias("c")).persist()
    centers = suppress(peaks(signal, segments(signal, group, window), group), group, window)
    return signal, centers, centered(signal, centers, group, window)


def best_axis(df: DataFrame, klass: str, axis: str, axes: list[str], window: int) -> DataFrame:
    """(class, axis, kept, detected): the axis that keeps most windows, first declared of ties."""
    _, centers, windows = detect(df, [klass, axis], window)
    rank = F.array_position(F.array(*[F.lit(a) for a in axes]), F.col(axis))
    made = df.select(klass, axis).distinct()
    made = made.join(centers.groupBy(klass, axis).agg(F.count("*").alias("detected")), [klass, axis], "left")
    made = made.join(windows.groupBy(klass, axis).agg(F.count("*").alias("kept")), [klass, axis], "left").na.fill(0)
    best = F.max(F.struct("kept", (-rank).alias("r"), F.col(axis).alias("axis"), "detected")).alias("b")
    return made.groupBy(klass).agg(best).select(klass, F.col("b.axis").alias("axis"), F.col("b.kept").alias("kept"), F.col("b.detected").alias("detected"))


def active_axis(df: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """(keys, axis, std): by window the axis of largest deviation, first declared of ties. Rows are wide: one column an axis."""
    made = df.groupBy(*keys).agg(*[F.stddev_pop(a).alias(f"s_{a}") for a in axes])
    best = F.greatest(*[F.struct(F.col(f"s_{a}").alias("s"), F.lit(-i).alias("o"), F.lit(a).alias("axis")) for i, a in enumerate(axes)]) if len(axes) > 1 else F.struct(F.col(f"s_{axes[0]}").alias("s"), F.lit(0).alias("o"), F.lit(axes[0]).alias("axis"))
    return made.withColumn("b", best).select(*keys, F.col("b.axis").alias("axis"), F.col("b.s").alias("std"))


def peak_position(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, peak): place of the largest deviation from the window's mean, first of ties. Rows are (keys, k, x)."""
    made = df.withColumn("a", F.abs(F.col("x") - F.avg("x").over(Window.partitionBy(*keys))))
    best = F.max(F.struct(F.round("a", 12).alias("a"), (-F.col("k")).alias("o"))).alias("b")
    return made.groupBy(*keys).agg(best).select(*keys, (-F.col("b.o")).alias("peak"))


def centered_verdict(found: DataFrame, klass: str, window: int) -> DataFrame:
    """By class: place statistics of the peaks, and CENTERED, LOOSE or RAW."""
    q = lambda p: F.floor(F.percentile("peak", p)).cast("long")
    made = found.groupBy(klass).agg(F.count("*").alias("n"), q(0.5).alias("median"), q(0.25).alias("p25"), q(0.75).alias("p75"), F.round(F.stddev_pop("peak"), 6).alias("std"))
    near = F.abs(F.col("median") - window // 2) <= 10
    # Random places in a window of 100 have a deviation of about 29.
    verdict = F.when(F.col("std") >= 25, "RAW").when(near & (F.col("std") < 15), "CENTERED").when(near, "LOOSE").otherwise("RAW")
    return made.withColumn("verdict", verdict)
