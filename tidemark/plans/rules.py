"""Rules as findings: (group, severity, code, message, subject) and their reduction to one verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compare, labels
from tidemark.operators import sequence as seq

#: Severities by rank; 3 and 4 block, 2 loses data.
SEVERITY = {"info": 0, "advisory": 1, "will-lose-data": 2, "fix-required": 3, "hard-reject": 4}
GROUPS = ["HARD-REJECT", "SILENT-LOSS", "BAD-MODEL", "INTAKE", "INFO"]


def finding(df: DataFrame, group: str, severity: str, code: str, message: Column, subject: Column) -> DataFrame:
    """One finding a row of ``df``."""
    return df.select(F.lit(group).alias("group"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), message.alias("message"), subject.cast("string").alias("subject"))


def verdict(findings: DataFrame) -> DataFrame:
    rank = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])[F.col("severity")]
    made = findings.agg(F.max(rank).alias("r"), F.count("*").alias("findings"))
    word = F.when(F.col("r") >= 3, "FIX_REQUIRED").when(F.col("r") == 2, "WILL_LOSE_DATA").otherwise("PASS")
    return made.select(word.alias("verdict"), "findings")


def demo_findings(events: DataFrame, quality: DataFrame) -> DataFrame:
    """Rules of class, session and data-set grain over recordings and labels; each grain is one aggregate."""
    say = lambda *x: F.concat_ws(" ", *[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    made = [
        finding(labels.imbalance(quality, "quality").filter("imbalanced"), "BAD-MODEL", "advisory", "class_imbalance", say("largest over smallest class:", F.col("ratio")), F.lit("quality")),
        finding(labels.small(quality, "toxic", 20), "HARD-REJECT", "hard-reject", "class_below_min_samples", say("rows:", F.col("n")), F.col("label")),
        finding(seq.class_run_below(events, 6), "SILENT-LOSS", "will-lose-data", "class_run_below_window", say("longest run:", F.col("max_run")), F.col("label")),
        finding(seq.session_below(events, 60), "SILENT-LOSS", "will-lose-data", "session_below_window", say("rows:", F.col("rows")), F.col("session")),
        finding(compare.storage_type(events, ["value"]), "BAD-MODEL", "advisory", "recommended_dtype", F.lit("storage"), F.col("dtype")),
    ]
    return reduce(DataFrame.union, made)
