"""Mixing sources to target weights by capped water-filling.

Every source gets weight times a common level, clamped at ``max_epochs`` times its size; what a clamped source can't take is shared
again by weight until no source is above its clamp. A source's documents are then taken ``floor(target / size)`` whole times, and
the fraction left is the documents of lowest seeded hash rank, the last of them in part so that the total meets the target.

The rank cut is found in two steps that spread over the cluster: sizes summed by (source, hash bucket), then exact order inside
the one bucket a source is cut in. Nothing is gathered but one row a source.

Defined cases: a null text has size 0; null is a source of its own, last in order; documents without words are taken 0 words;
repeated rows count each; ties in rank are broken by doc_id and text hash, and fully equal rows are interchangeable; an empty
table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, materialise

BUCKETS = 4096


def water_fill(sizes: list[tuple[str | None, int]], weights: list[float], total: float, max_epochs: float) -> dict:
    """Target by source. Weights repeat along the sources in code-point order, null last."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: float(weights[i % len(weights)]) for i, (s, _) in enumerate(order)}
    cap = {s: max_epochs * n for s, n in order}
    target = dict.fromkeys(weight, 0.0)
    left, free = float(total), [s for s, _ in order]
    while free and left > 0:
        share = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / share >= cap[s]]
        if not full:
            target |= {s: left * weight[s] / share for s in free}
            break
        target |= {s: float(cap[s]) for s in full}
        left -= sum(cap[s] for s in full)
        free = [s for s in free if s not in set(full)]
    return target


def mix(
    docs: DataFrame,
    weights: list[float] = (3, 1, 2),
    total_share: float = 1.5,
    max_epochs: float = 2,
    seed: int = 8,
    partial: bool = True,
    keep: list[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, epochs, source, *keep).

    ``partial`` lets a cut document give part of its words; without it that document is taken when half of it or more is wanted.
    ``epochs`` is how often the document is taken whole.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("tie"),
        *keep,
    ).withColumn("rank", F.xxhash64("doc_id", "tie", F.lit(seed)))
    sized = sized.withColumn("bucket", F.pmod("rank", F.lit(BUCKETS)))
    narrow = materialise(sized.drop(*keep), "mix-sizes")
    sums = narrow.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    # One row a source; the buckets stay where they are.
    totals = [(r.source, r.n) for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()]
    target = water_fill(totals, list(weights), total_share * sum(n for _, n in totals), max_epochs)
    plan = []
    for s, n in totals:
        goal = round(target[s])
        whole = min(int(goal // n), int(max_epochs)) if n else 0
        plan.append((s, n, float(target[s]), whole, goal - whole * n))
    plan = spark.createDataFrame(plan, "p_source string, source_size long, target double, whole long, part long")

    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = sums.withColumn("before", F.coalesce(F.sum("n").over(by_bucket), F.lit(0)))
    edge = edge.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source")))
    edge = edge.filter((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("n")))
    edge = edge.select("p_source", F.col("bucket").alias("p_bucket"), "before", "part")
    same = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("bucket") == F.col("p_bucket"))
    # Equal rows count as one group here, so that they are cut alike.
    group = ["source", "bucket", "rank", "doc_id", "tie"]
    inside = narrow.join(F.broadcast(edge), same).groupBy(*group, "before", "part").agg(F.sum("size").alias("n"), F.count("*").alias("copies"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("prior", F.col("before") + F.coalesce(F.sum("n").over(order), F.lit(0)))
    inside = inside.filter((F.col("prior") <= F.col("part")) & (F.col("part") < F.col("prior") + F.col("n")))
    given = F.floor((F.col("part") - F.col("prior")) / F.col("copies")).alias("given")
    cut = inside.select(F.col("source").alias("c_source"), F.struct("bucket", "rank", "doc_id", "tie").alias("cut"), given)

    out = sized if keep else narrow
    out = out.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source")), "left")
    out = out.join(F.broadcast(cut), F.col("source").eqNullSafe(F.col("c_source")), "left")
    here = F.struct("bucket", "rank", "doc_id", "tie")
    last = F.col("given") if partial else F.when(2 * F.col("given") >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    more = (
        F.when(F.col("cut").isNull(), F.when(F.col("part") > 0, F.col("size")).otherwise(F.lit(0)))
        .when(here < F.col("cut"), F.col("size"))
        .when(here == F.col("cut"), last)
        .otherwise(F.lit(0))
    )
    taken = (F.col("whole") * F.col("size") + more).cast("long").alias("taken")
    epochs = (F.col("whole") + (more > 0).cast("long")).alias("epochs")
    return out.select("doc_id", "size", "source_size", "target", taken, epochs, "source", *keep)
