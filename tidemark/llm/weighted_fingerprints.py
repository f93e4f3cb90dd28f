"""Document fingerprints by consistent weighted sampling; DataFrame and SQL functions only.

For slot k and term t of weight w (its count in the document) the draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) come from hashes of
(t, k). With q = floor(ln w / r + b) the score is ln a = ln c - r (q - b + 1); the slot keeps the (t, q) of the least score. Two
documents agree in a slot with a probability equal to their generalised Jaccard similarity, sum of min over sum of max of the counts.
The score is a function of (t, q, k), so keeping the least score keeps the sample, in a plain MIN that combines within each task.

Documents are dealt by ranges of doc_id whose bounds are quantiles and whose number follows the size of all texts, so ``next in descending order`` is a LEAD inside a range; the first
row of each range is also sent to the range before it. A range is called by a number that Spark's hash deals to a task of its own.

Defined cases: a null text is an empty one; a text without words has the all-zero fingerprint (likeness 1 to another such, else 0); a
null doc_id counts as the least id; rows that repeat an id follow each other in the order of a text hash; a lone document is its
own next; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 32
#: Bytes of text of one range of documents, about.
RANGE_BYTES = 64 << 20
LOWEST = -(1 << 63)


def score(h: Column, w: Column, slot: int) -> Column:
    unit = lambda x: (x + F.lit(0.5)) / F.lit(float(1 << 32))
    low = lambda x: unit(x.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = lambda x: unit(F.shiftrightunsigned(x, 32))
    one, two, three = (F.xxhash64(h, F.lit(3 * slot + i)) for i in range(3))
    r = -F.ln(low(one) * high(one))
    c = -F.ln(low(two) * high(two))
    b = low(three)
    q = F.when(w == 1, F.lit(0.0)).otherwise(F.floor(F.ln(w) / r + b).cast("double"))
    return F.ln(c) - r * (q - b + 1)


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the key, in about 2 sqrt(n) steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(x) for x in bounds[step - 1 :: step]])
    every = F.array(*[F.lit(x) for x in bounds])
    first = F.size(F.filter(coarse, lambda x: x <= key)) * step
    rest = F.slice(every, first + 1, F.lit(step))
    return (first + F.size(F.filter(rest, lambda x: x <= key))).cast("int")


def dealt_names(spark: SparkSession, parts: int) -> list[int]:
    """A number for each of ``parts`` partitions, such that ``repartition(parts, number)`` sends it there."""
    names: dict[int, int] = {}
    start, step = 0, 16 * parts
    while len(names) < parts:
        goes = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("to")
        for i, r in enumerate(spark.range(start, start + step, 1, 1).select(goes).collect(), start):
            names.setdefault(r.to, i)
        start += step
    return [names[i] for i in range(parts)]


def ordered_ranges(docs: DataFrame, parts: int) -> DataFrame:
    """(part, extra, key, tie, doc_id, text): rows by range of doc_id, with the first row of the next range as an extra."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LOWEST)).alias("key"), F.xxhash64(text).alias("tie"), text.alias("text"))
    got = rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 20 * parts).alias("b")).collect()[0].b
    bounds = sorted(set(got or [])) if parts > 1 else []
    rows = rows.withColumn("part", range_of(F.col("key"), bounds))
    # One row a range: the head in descending order, and the range it is also sent to.
    heads = sorted((r.part, r.m.key, r.m.tie) for r in rows.groupBy("part").agg(F.max(F.struct("key", "tie")).alias("m")).collect())
    to = [(k, t, heads[(i + 1) % len(heads)][0]) for i, (_, k, t) in enumerate(heads)]
    heads = spark.createDataFrame(to, "h_key long, h_tie long, to int")
    rows = rows.join(F.broadcast(heads), (F.col("key") == F.col("h_key")) & (F.col("tie") == F.col("h_tie")), "left")
    where = F.when(F.col("to").isNull(), F.array("part")).otherwise(F.array("part", "to"))
    rows = rows.select("doc_id", "key", "tie", "text", F.posexplode(where).alias("extra", "range"))
    names = F.array(*[F.lit(x) for x in dealt_names(spark, parts)])
    return rows.withColumn("part", F.get(names, F.col("range"))).drop("range")


def fingerprint(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n")).collect()[0].n or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES)
    rows = ordered_ranges(docs, parts).repartition(parts, F.col("part"))
    down = Window.partitionBy("part").orderBy(F.col("extra"), F.col("key").desc(), F.col("tie").desc())
    rows = rows.withColumn("next", F.coalesce(F.lead("text").over(down), F.lit(""))).withColumn("row", F.row_number().over(down))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half))
    rows = rows.select("part", "row", "extra", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    key = ["part", "row", "extra", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    both = F.concat(*[weighted(F.col(c), i) for i, c in enumerate(("text", "edited"))])
    rows = rows.select(*key, F.explode_outer(both).alias("t")).select(*key, F.col("t.v").alias("v"), F.col("t.h").alias("h"), F.col("t.w").alias("w"))
    sig = rows.groupBy(*key, "v").agg(*[F.min(score(F.col("h"), F.col("w"), k)).alias(f"s{k}") for k in range(slots)])
    code = [F.lower(F.lpad(F.hex(F.coalesce(F.xxhash64(f"s{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0))), 8, "0")) for k in range(slots)]
    code = [F.when(F.col(f"s{k}").isNull(), F.lit("0" * 8)).otherwise(c) for k, c in enumerate(code)]
    sig = sig.select(*key, "v", F.concat(*code).alias("code"))
    pick = lambda v: F.coalesce(F.max(F.when(F.col("v") == v, F.col("code"))), F.lit("0" * 8 * slots))
    out = sig.groupBy(*key).agg(pick(0).alias("fingerprint"), pick(1).alias("edited_fingerprint"))
    out = out.withColumn("next", F.lead("fingerprint").over(Window.partitionBy("part").orderBy("row"))).filter("extra = 0")
    near = lambda a, b: sum((F.substring(a, 8 * k + 1, 8) == F.substring(b, 8 * k + 1, 8)).cast("int") for k in range(slots)) / F.lit(float(slots))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("fingerprint", "edited_fingerprint").alias("near_edited"), near("fingerprint", "next").alias("near_next"),
    )


def weighted(text: Column, variant: int) -> Column:
    """array<struct<v, h, w>>: distinct word hashes of a text with their counts."""
    hashes = F.sort_array(F.transform(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), lambda x: F.xxhash64(x)))
    # Last place of each distinct hash in the sorted array; the distance between such places is the count.
    packed = F.transform(F.array(hashes), lambda s: last_places(s, variant))
    return F.element_at(packed, 1)


def last_places(s: Column, variant: int) -> Column:
    n = F.size(s)
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(s, i - 1) != F.get(s, i)))
    made = F.transform(
        F.array(ends),
        lambda e: F.transform(
            e,
            lambda i, j: F.struct(
                F.lit(variant).alias("v"), F.get(s, i - 1).alias("h"), (i - F.when(j > 0, F.get(e, j - 1)).otherwise(F.lit(0))).alias("w")
            ),
        ),
    )
    none = F.array().cast("array<struct<v:int,h:bigint,w:int>>")
    return F.when(n > 0, F.element_at(made, 1)).otherwise(none)
