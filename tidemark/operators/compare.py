"""Statistical comparison of windows by class and source, on features in long form (keys, idx, feature, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import features as bank
from tidemark.operators.sequence import sliding

EPS = 1e-9


def moments(long: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean, population variance and deviation of each feature."""
    v = F.col("value")
    return long.groupBy(*by, "idx", "feature").agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"), F.stddev_pop(v).alias("std")
    )


def effect(m1: Column, m2: Column, v1: Column, v2: Column) -> Column:
    """Signed Cohen's d with a floor under the pooled deviation."""
    return (m1 - m2) / F.sqrt((v1 + v2) / 2 + EPS)


def class_pairs(mom: DataFrame, klass: str) -> DataFrame:
    """(class_a, class_b, idx, feature, d) for every pair a < b. Moments are one row a class and feature."""
    b = mom.select(F.col(klass).alias("class_b"), F.col("idx").alias("i"), F.col("mean").alias("mb"), F.col("var").alias("vb"))
    made = mom.join(b, (F.col("idx") == F.col("i")) & (F.col(klass) < F.col("class_b")))
    return made.select(F.col(klass).alias("class_a"), "class_b", "idx", "feature", effect(F.col("mean"), F.col("mb"), F.col("var"), F.col("vb")).alias("d"))


def enough(long: DataFrame, klass: str, least: int = 3) -> DataFrame:
    """Only classes with ``least`` windows or more."""
    return long.withColumn("__n", F.count("*").over(Window.partitionBy(klass, "idx"))).filter(F.col("__n") >= least).drop("__n")


def anova(long: DataFrame, klass: str) -> DataFrame:
    """(idx, feature, f): variance ratio of classes with three windows or more; the error is floored by the feature's own variance."""
    mom = moments(enough(long, klass), [klass])
    made = mom.groupBy("idx", "feature").agg(
        F.count("*").alias("k"), F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("gm"),
        F.sum(F.col("n") * F.col("var")).alias("ssw"),
    )
    between = mom.join(made.select(F.col("idx").alias("i"), "gm"), F.col("idx") == F.col("i"))
    between = between.groupBy(F.col("idx").alias("i")).agg(F.sum(F.col("n") * F.pow(F.col("mean") - F.col("gm"), F.lit(2.0))).alias("ssb"))
    made = made.join(between, F.col("idx") == F.col("i"))
    error = F.greatest(F.col("ssw") / F.greatest(F.col("total") - F.col("k"), F.lit(1)), 1e-6 * (F.col("ssw") + F.col("ssb")) / F.col("total")) + EPS
    return made.select("idx", "feature", (F.col("ssb") / F.greatest(F.col("k") - 1, F.lit(1)) / error).alias("f"))


def top_features(scores: DataFrame, n: int = 15) -> DataFrame:
    return scores.orderBy(F.desc(F.round("f", 9)), "idx").limit(n)


def family_ranking(scores: DataFrame, family: dict[str, str]) -> DataFrame:
    of = F.create_map(*[F.lit(x) for kv in family.items() for x in kv])
    return scores.withColumn("family", of[F.col("feature")]).groupBy("family").agg(F.avg("f").alias("mean_f"), F.max("f").alias("max_f"))


def one_vs_rest(long: DataFrame, klass: str) -> DataFrame:
    """(class, idx, feature, d): the feature that tells each class best from all others, first of ties. Moments add up over classes."""
    v = F.col("value")
    sums = enough(long, klass).groupBy(klass, "idx", "feature").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"))
    whole = Window.partitionBy("idx")
    n, m, w = F.col("n"), F.col("mean"), F.col("var")
    rest_n = F.sum("n").over(whole) - n
    rest_m = (F.sum(n * m).over(whole) - n * m) / F.nullif(rest_n, F.lit(0))
    rest_2 = (F.sum(n * (w + m * m)).over(whole) - n * (w + m * m)) / F.nullif(rest_n, F.lit(0))
    made = sums.withColumn("rm", rest_m).withColumn("rv", F.greatest(rest_2 - rest_m * rest_m, F.lit(0.0)))
    d = F.coalesce(effect(m, F.col("rm"), w, F.col("rv")), F.lit(0.0))
    best = F.max(F.struct(F.round(F.abs(d), 9).alias("a"), (-F.col("idx")).alias("o"), "feature", d.alias("d"))).alias("b")
    return made.groupBy(klass).agg(best).select(klass, (-F.col("b.o")).alias("idx"), F.col("b.feature").alias("feature"), F.col("b.d").alias("d"))


def magnitude_blind(pairs: DataFrame, limit: float = 1.0) -> DataFrame:
    """Class pairs that no magnitude feature tells apart, with the best signed feature, first of ties."""
    size = F.abs("d")
    signed = F.when(F.col("feature").isin(bank.SIGNED), F.struct(F.round(size, 9).alias("a"), (-F.col("idx")).alias("o"), F.col("feature").alias("feature")))
    made = pairs.groupBy("class_a", "class_b").agg(F.max(F.when(F.col("feature").isin(bank.MAGNITUDE), size)).alias("best_magnitude_d"), F.max(signed).alias("s"))
    made = made.filter(F.col("best_magnitude_d") < limit)
    return made.select("class_a", "class_b", "best_magnitude_d", F.col("s.feature").alias("best_signed_feature"), F.col("s.a").alias("best_signed_d"))


def window_rows(df: DataFrame, keys: list[str], axes: list[str], window: int, shift: int) -> DataFrame:
    """(keys, win, k, axes): sliding windows over rows with class_pos and class_n."""
    return sliding(df.select(*keys, "class_pos", "class_n", *axes), window, shift).select(*keys, "win", "k", *axes)


def source_outliers(df: DataFrame, axes: list[str], window: int, label: str = "label", source: str = "source", least: int = 3, limit: float = 1.5) -> DataFrame:
    """(label, source, n_own, n_rest, mean_d, verdict): windows of each source against those cut on all other sources together.

    Windows of the rest are cut on the concatenation without the source, and their places differ by source, so a row is in one sequence
    a source. Its place there is its place among all rows of the class less the rows of that source before it; both come from counts by
    session, so the rows are ordered once, and are only multiplied as they are dealt to windows. The cost grows with sources times rows
    and suits some tens of sources. Rows need ``session`` and ``pos`` for their order.
    """
    shift = max(1, window // 2)
    keys = [F.col(label).alias("l"), F.col("session"), F.col(source).alias("src")]
    counts = df.groupBy(*keys).agg(F.count("*").alias("c"))
    names = counts.select("l", F.col("src").alias("of")).distinct()
    # One row a class, session, source in it and source left out: how many rows of the sequence come before.
    pairs = counts.join(names, "l")
    pairs = pairs.select("l", "session", "src", "of", (F.col("src") == F.col("of")).alias("own"), "c")
    sequence = Window.partitionBy("l", "of", "own")
    pairs = pairs.withColumn("class_n", F.sum("c").over(sequence))
    per_session = pairs.groupBy("l", "of", "own", "session").agg(F.sum("c").alias("c"))
    so_far = sequence.orderBy("session").rowsBetween(Window.unboundedPreceding, -1)
    per_session = per_session.select("l", "of", "own", "session", F.coalesce(F.sum("c").over(so_far), F.lit(0)).alias("before"))
    places = pairs.join(per_session, ["l", "of", "own", "session"]).groupBy("l", "session", "src").agg(F.collect_list(F.struct("of", "own", "before", "class_n")).alias("seqs"))
    # Inside a session: the place among rows of the class, and among those of the row's own source.
    inside = Window.partitionBy("session", "l").orderBy("pos")
    rows = df.select(*keys, "pos", *axes).withColumn("all_i", F.row_number().over(inside) - 1)
    mine = Window.partitionBy("session", "l", "src").orderBy("pos")
    several = counts.groupBy("l", "session").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    rows = rows.withColumn("own_i", F.row_number().over(mine) - 1)
    rows = rows.join(places, ["l", "session", "src"]).select("l", "session", "pos", "src", "all_i", "own_i", *axes, F.explode("seqs").alias("q"))
    if several and several > 1:
        # A session of several sources: rows of the one left out that come before, by position.
        left_out = F.sum(F.when(F.col("src") == F.col("q.of"), 1).otherwise(0)).over(Window.partitionBy("session", "l", "q.of").orderBy("pos"))
        rows = rows.withColumn("i", F.when(F.col("q.own"), F.col("own_i")).otherwise(F.col("all_i") - left_out))
    else:
        rows = rows.withColumn("i", F.col("own_i"))
    rows = rows.select(F.struct("l", "q.of", "q.own").alias("part"), (F.col("q.before") + F.col("i")).alias("class_pos"), F.col("q.class_n").alias("class_n"), *axes)
    feats = bank.long_q(window_rows(rows, ["part"], axes, window, shift), ["part", "win"], axes)
    mom = feats.groupBy("part", "axis", "idx").agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    side = lambda own, p: mom.filter(F.col("part.own") == own).select(
        F.col("part.l").alias("label"), F.col("part.of").alias("source"), "axis", "idx", F.col("n").alias(f"{p}n"), F.col("m").alias(f"{p}m"), F.col("v").alias(f"{p}v")
    )
    both = side(True, "a").join(side(False, "b"), ["label", "source", "axis", "idx"])
    both = both.filter((F.col("an") >= least) & (F.col("bn") >= least)).withColumn("d", F.abs(effect(F.col("am"), F.col("bm"), F.col("av"), F.col("bv"))))
    made = both.groupBy("label", "source").agg(F.max("an").alias("n_own"), F.max("bn").alias("n_rest"), F.avg("d").alias("mean_d"))
    return made.withColumn("outlier", F.col("mean_d") >= limit)


def closest_class(test: DataFrame, train: DataFrame, klass: str) -> DataFrame:
    """(class, mean_d, median_d, max_d, closest): the whole test set against each class; the least mean is closest, first of ties."""
    v = lambda p: [F.avg("value").alias(f"{p}m"), F.var_pop("value").alias(f"{p}v")]
    a = test.groupBy("axis", "idx").agg(*v("a"))
    b = train.groupBy(klass, "axis", "idx").agg(*v("b"))
    made = b.join(a, ["axis", "idx"]).withColumn("d", F.abs(effect(F.col("am"), F.col("bm"), F.col("av"), F.col("bv"))))
    made = made.groupBy(klass).agg(F.avg("d").alias("mean_d"), F.median("d").alias("median_d"), F.max("d").alias("max_d"))
    least = made.agg(F.min(F.struct(F.round("mean_d", 9).alias("d"), klass)).alias("b")).select(F.col(f"b.{klass}").alias("best"))
    return made.crossJoin(F.broadcast(least)).withColumn("closest", F.col(klass) == F.col("best")).drop("best")


def std_envelope(rows: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """Median and 95th percentile of window deviations by (keys, axis)."""
    made = rows.groupBy(*keys, "win").agg(*[F.stddev_pop(F.col(a).cast("double")).alias(f"s{i}") for i, a in enumerate(axes)])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("axis"), F.col(f"s{i}").alias("s")) for i in range(len(axes))])).alias("x")
    made = made.select(*keys, each).select(*keys, "x.*")
    return made.groupBy(*keys, "axis").agg(F.percentile("s", 0.5).alias("median_std"), F.percentile("s", 0.95).alias("p95_std"))


def storage_type(df: DataFrame, columns: list[str]) -> DataFrame:
    """Platform rule over all columns: INT8, INT16 or FLOAT32, and the first fractional column."""
    both = [F.col(c) for c in columns] + [F.col(columns[0])]
    whole = [F.coalesce(F.bool_and(F.col(c) == F.floor(c)), F.lit(True)).alias(f"w_{c}") for c in columns]
    made = df.agg(F.min(F.least(*both)).alias("low"), F.max(F.greatest(*both)).alias("high"), *whole)
    first = F.coalesce(*[F.when(~F.col(f"w_{c}"), F.lit(c)) for c in columns])
    kind = F.when(F.col("low").isNull() | first.isNotNull(), "FLOAT32").when((F.col("low") >= -128) & (F.col("high") <= 127), "INT8")
    kind = kind.when((F.col("low") >= -32768) & (F.col("high") <= 32767), "INT16").otherwise("FLOAT32")
    return made.select("low", "high", first.alias("first_fractional"), kind.alias("dtype"))


def content_type(df: DataFrame, columns: list[str]) -> DataFrame:
    """By column: int8, int16, int32 or float32 by largest magnitude of finite values."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")
    made = df.select(each).select("x.*").filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    made = made.groupBy("name").agg(F.max(F.abs("v")).alias("high"), F.bool_and(F.col("v") == F.floor("v")).alias("integral"))
    kind = F.when(~F.col("integral"), "float32").when(F.col("high") <= 127, "int8").when(F.col("high") <= 32767, "int16").otherwise("int32")
    return made.select("name", "integral", kind.alias("dtype"))
