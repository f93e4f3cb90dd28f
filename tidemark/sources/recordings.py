"""Recordings as all-string frames with _file and _row, and predictions."""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.intake import zip_member


class ParseError(ValueError):
    """A row has more cells than the header."""


def header(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names; repeats are numbered as .1, .2."""
    rows = spark.read.format("binaryFile").load(path).select("path", F.expr("substring(content, 1, 1048576)").alias("content") if not path.lower().endswith(".zip") else "content")
    data = bytes(rows.first().content)
    if path.lower().endswith(".zip"):
        data = zip_member(data, path)[0] or b""
    names = next(csv.reader(io.StringIO(data.decode(encoding, "replace"), newline=""), delimiter=sep), [])
    out: list[str] = []
    for n in names:
        k = sum(o == n or (o.startswith(f"{n}.") and o[len(n) + 1 :].isdigit()) for o in out)
        out.append(f"{n}.{k}" if n in out else n)
    return out


def read_strings(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """Cells as text ('' stays ''), with _file and the 0-based _row. Rows longer than the header are an error, short ones are filled."""
    names = header(spark, path, sep, encoding)
    base = os.path.basename(path)
    if path.lower().endswith(".zip"):
        schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("_row", T.LongType())])

        def unpack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for p, c in zip(part["path"], part["content"], strict=True):
                    body = zip_member(bytes(c), p)[0] or b""
                    rows = [r for r in csv.reader(io.StringIO(body.decode(encoding, "replace"), newline=""), delimiter=sep) if r][1:]
                    if any(len(r) > len(names) for r in rows):
                        raise ParseError(p)
                    yield pd.DataFrame([[*r, *[""] * (len(names) - len(r)), i] for i, r in enumerate(rows)], columns=[*names, "_row"])

        return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(unpack, schema).withColumn("_file", F.lit(base))
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("_bad", T.StringType())])
    df = spark.read.csv(
        path, schema=schema, header=True, sep=sep, encoding=encoding, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, quote='"', escape='"',
    )
    df = df.withColumn("_id", F.monotonically_increasing_id())
    # With multiLine a file is one split, so its ids have no gaps.
    df = df.withColumn("_row", F.col("_id") - F.min("_id").over(Window.partitionBy(F.lit(0))))
    extra = F.size(F.split(F.col("_bad"), sep if sep not in "|^" else "\\" + sep)) > len(names)
    checked = F.when(F.col("_bad").isNotNull() & extra & ~F.contains("_bad", F.lit('"')), F.raise_error(F.lit("parse_error"))).otherwise(F.col("_row")).cast("long")
    return df.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names], checked.alias("_row"), F.lit(base).alias("_file"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(stream, pos, p) from a table with columns 'Probability of N'."""
    df = read_strings(spark, path)
    cols = [c for c in df.columns if c.startswith("Probability of ")]
    if not cols:
        raise ValueError("no 'Probability of N' columns")
    return df.select(F.lit(0).cast("long").alias("stream"), F.col("_row").alias("pos"), F.array(*[F.col(f"`{c}`").try_cast("double") for c in cols]).alias("p"))
