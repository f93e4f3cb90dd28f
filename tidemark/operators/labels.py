"""Label counts, dictionaries and encoding; feature-mask decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Feature of each mask bit, least significant first.
MASK_BITS = [
    "MIN", "MAX", "RANGE", "MEAN", "MAD", "SKEW", "KUR", "STD", "RMS", "MCR", "ZCR", "TCR", "P2P_LF", "P2P_HF", "ABSMEAN", "AMDF", "PSCR", "NSCR", "PSOZ", "PSOM",
    "PSOS", "CREST", "RMDS", "AUTOCORR", "HJ_MOBILITY", "HJ_COMPLEXITY", "LR_SLOPE", "LR_INTERCEPT",
]


def counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))


def imbalance(df: DataFrame, label: str, ratio: float = 3.0) -> DataFrame:
    made = counts(df, label).agg(F.min("n").alias("min_n"), F.max("n").alias("max_n")).withColumn("ratio", F.col("max_n") / F.col("min_n"))
    return made.withColumn("imbalanced", F.col("ratio") >= ratio)


def small(df: DataFrame, label: str, least: int = 20) -> DataFrame:
    return counts(df, label).filter(F.col("n") < least)


def contiguity(df: DataFrame, label: str, name: str) -> DataFrame:
    made = df.select(F.col(label).alias("l")).distinct().agg(F.min("l").alias("a"), F.max("l").alias("b"), F.count("*").alias("classes"))
    return made.select(F.lit(name).alias("name"), ((F.col("a") == 0) & (F.col("b") == F.col("classes") - 1)).alias("contiguous"), "classes")


def dictionary(spark: SparkSession, mapping: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), "token string, idx long")


def sorted_dictionary(df: DataFrame, token: str) -> DataFrame:
    """Distinct tokens numbered in string order. One row a class."""
    made = df.select(F.col(token).alias("token")).filter("token is not null").distinct()
    return made.withColumn("idx", (F.row_number().over(Window.orderBy("token")) - 1).cast("long"))


def encode(df: DataFrame, token: str, known: DataFrame) -> DataFrame:
    """Add idx from a dictionary of one row a class; unknown tokens get null."""
    return df.join(known.select(F.col("token").alias("__t"), "idx"), F.col(token) == F.col("__t"), "left").drop("__t")


def mismatch(df: DataFrame, token: str, known: DataFrame) -> DataFrame:
    """Tokens that the dictionary lacks, and entries that the data lacks."""
    present = df.select(F.col(token).alias("token")).distinct()
    unknown = present.join(known, "token", "left_anti").withColumn("code", F.lit("label_not_in_map"))
    return unknown.union(known.select("token").join(present, "token", "left_anti").withColumn("code", F.lit("mapped_class_absent")))


def resolve(present: list[str], mapping: dict[str, int] | None) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """Encoding of the distinct tokens under the label rules: (token to index, [(code, subject)]). Classes are few."""
    present, found = sorted(present), []
    if mapping:
        by_index = {str(v): v for v in mapping.values()}
        if all(t in mapping for t in present):
            out = {t: mapping[t] for t in present}
        elif all(t in by_index for t in present):
            out = {t: by_index[t] for t in present}
        else:
            unknown = [t for t in present if t not in mapping and t not in by_index]
            fresh = max(mapping.values()) + 1
            out = {t: mapping.get(t, by_index.get(t)) for t in present if t not in unknown}
            out |= {t: fresh + i for i, t in enumerate(unknown)}
            found += [("label_not_in_map", t) for t in unknown] or [("label_keyspace_mixed", ",".join(present))]
        found += [("mapped_class_absent", n) for n, v in mapping.items() if v not in out.values()]
        return out, found
    whole = all(t.lstrip("-").isdigit() for t in present)
    if whole:
        order = sorted(present, key=int)
        if [int(t) for t in order] != list(range(len(order))):
            found.append(("noncontiguous_labels", ",".join(order)))
        return {t: i for i, t in enumerate(order)}, found
    return {t: i for i, t in enumerate(present)}, [("string_labels_encoded", ",".join(present))]


def decode_masks(sources: DataFrame) -> DataFrame:
    """(axis, bit, feature, enabled) of the masks in C sources; time-domain bits are the upper half of a 64-bit word."""
    body = F.regexp_extract("source", r"FEATURES_EXTRACTION_MASK\[\]\s*=\s*\{([^}]+)\}", 1)
    masks = sources.select(F.posexplode(F.regexp_extract_all(body, F.lit("0x([0-9a-fA-F]+)"), 1)).alias("axis", "hex"))
    word = F.conv(F.substring(F.lpad("hex", 16, "0"), 1, 8), 16, 10).cast("long")
    names = F.posexplode(F.array(*[F.lit(n) for n in MASK_BITS])).alias("bit", "feature")
    made = masks.select("axis", word.alias("word"), names)
    return made.select("axis", "bit", "feature", (F.getbit("word", F.col("bit")) == 1).alias("enabled"))
