"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir

#: A word: a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
MASK64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Hand texts to Python some MB at a time, whatever their length; the session keeps a smaller limit of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or int(now) > limit or int(now) <= 0:
        spark.conf.set(key, str(limit))


def release() -> None:
    """Give freed memory back to the system at the end of a task, where the C library can: a worker is kept for later tasks."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by a table in the shared folder; it outlives a lost executor."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], total: int, n: str = "n") -> DataFrame:
    """``big`` joined to ``small``, which has one row a key with the number ``n`` of its rows in ``big``; keys with many are salted.

    A key is hot from a thousandth of the ``total`` rows of ``big`` on, so there are under 1,000 hot keys whatever the input; only those
    are broadcast, to tell both sides how many salts a key has.
    """
    limit = max(64, total // 1000)
    salts = F.ceil(F.col(n) / limit).cast("int")
    hot = F.broadcast(small.filter(F.col(n) > limit).select(*keys, salts.alias("__salts")))
    left = big.join(hot, keys, "left").withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.coalesce("__salts", F.lit(1))).cast("int")).drop("__salts")
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.when(F.col(n) > limit, salts).otherwise(1) - 1)))
    return left.join(right, [*keys, "__salt"]).drop("__salt")


def packed(df: DataFrame) -> Column:
    """All columns of a row in one struct, whatever their names."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def unpacked(df: DataFrame, row: str = "row") -> DataFrame:
    """The columns of a packed row again."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in df.schema[row].dataType.names])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def map_texts(df: DataFrame, row: Callable, schema: str, names: list[str], types: list[pa.DataType]) -> DataFrame:
    """Apply ``row(text) -> tuple`` to (doc_id, text) in Arrow batches; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in types]
            for text in batch.column("text").to_pylist():
                for col, value in zip(out, row(text or ""), strict=True):
                    col.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], ["doc_id", *names]
            )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, {schema}"
    )


def fmix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, in place on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class RollingHash:
    """Polynomial hashes of windows over a uint64 sequence, modulo 2**64, by one cumulative sum.

    Symbols must be well mixed (a random table for bytes, ``fmix64`` for words). ``base`` is odd, so it can be inverted.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.zeros(0, np.uint64)

    def __reduce__(self):
        return RollingHash, (self.base,)

    def _tables(self, n: int) -> None:
        if len(self._up) < n:
            size = (n + (1 << 18)) >> 18 << 18
            self._up, self._down = powers(self.base, size), powers(self.inverse, size)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        self._tables(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * self._up[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of the spans [start, end)."""
        self._tables(len(prefix))
        return fmix64((prefix[end] - prefix[start]) * self._down[start])


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words in a uint8 buffer."""
    space = np.ones(len(raw) + 2, np.int8)
    np.logical_or(raw == 32, (raw >= 9) & (raw <= 13), out=space[1:-1], casting="unsafe")
    edge = np.diff(space)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column in one uint8 buffer, and the n+1 offsets; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Join small Arrow batches and cut large ones, so that each holds about ``limit`` bytes, or one row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        total = batch.nbytes
        if total <= limit:
            pieces = [(batch, total)]
        else:
            weight = np.diff(text_buffer(batch.column("text"))[1]) + 64
            part = np.cumsum(weight) // limit
            cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            pieces = [(batch.slice(a, b - a), int(weight[a:b].sum())) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for piece, n in pieces:
            if held and size + n > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(piece)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def parts(batches: Iterator[pa.RecordBatch], limit: int, cut: Callable[[np.ndarray, int], Iterator[tuple[int, int, int]]]) -> Iterator[tuple]:
    """(raw, offsets, row, base, batch) of batches of about ``limit`` bytes, with longer texts in overlapping parts.

    ``cut(raw, limit)`` gives (start, end, base) of the parts of one text; base is the place of the part's first symbol in it.
    """
    for batch in gathered(batches, limit):
        raw, at = text_buffer(batch.column("text"))
        size = np.diff(at)
        long = np.flatnonzero(size > limit)
        if not len(long):
            yield raw, at, np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), batch
            continue
        for i in long.tolist():
            mine = raw[at[i] : at[i + 1]]
            for start, end, base in cut(mine, limit):
                yield mine[start:end], np.array([0, end - start]), np.array([i]), np.array([base]), batch
        rest = np.flatnonzero(size <= limit)
        if len(rest):
            kept = batch.column("text").take(pa.array(rest))
            yield *text_buffer(kept), rest, np.zeros(len(rest), np.int64), batch
