"""Repeated windows over a corpus: anchors, a merged count-min sketch of them, and packed exchange.

A window of ``window`` symbols is anchored at the gram of ``gram`` symbols in it that has the least hash (leftmost of ties). Equal
windows have equal anchors at equal offsets, so a window can only repeat if its anchor does. About ``2 / (window - gram + 2)`` of all
positions are anchors. The sketch counts anchors: every task emits the cells it touched (sparse, delta-coded), the owners of cell
ranges merge them, and the result is two bitmaps "counted twice or more". It may overestimate, never underestimate, so no repeated
window is lost; its size is set from the corpus and bounded by ``MAX_CELLS``. Beyond that bound only its selectivity falls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fmix64, parts, release, small_batches, text_buffer, word_bounds

#: Cells of one sketch row, at most; a row's bitmap then has 128 MiB.
MAX_CELLS = 1 << 30
MIN_CELLS = 1 << 18
NULL_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_key, tie, text): rows that repeat both keys are equal rows and share their fate."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_key")
    small_batches(docs.sparkSession)
    return docs.select(key, F.xxhash64(text).alias("tie"), text.alias("text"))


def sliding_anchor(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the least gram in every run of ``width`` grams, leftmost of ties."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:n], low[width - span : width - span + n])
    return (low[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def byte_parts(window: int) -> Callable:
    """Parts of a long text that share window - 1 bytes, so every string lies in exactly one."""

    def cut(raw: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
        for start in range(0, max(len(raw) - window + 1, 1), limit):
            yield start, min(len(raw), start + limit + window - 1), start

    return cut


def word_parts(window: int) -> Callable:
    """Parts of a long text that share window - 1 words."""

    def cut(raw: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
        start = base = 0
        while True:
            size = limit
            while True:
                end = min(len(raw), start + size)
                begin, stop = word_bounds(raw[start:end])
                # The last word may go on after the part.
                whole = len(begin) - (1 if end < len(raw) and len(stop) and stop[-1] == end - start else 0)
                if end == len(raw) or whole > window:
                    break
                size *= 2
            if end == len(raw):
                yield start, end, base
                return
            yield start, start + int(stop[whole - 1]), base
            base += whole - window + 1
            start += int(begin[whole - window + 1])

    return cut


def whole_windows(bounds: np.ndarray, total: int, window: int) -> np.ndarray:
    """Starts of the windows that lie in one document, for documents cut at ``bounds`` (n+1 offsets)."""
    ok = np.zeros(max(total - window + 1, 0) + 1, np.int32)
    lo, hi = bounds[:-1], bounds[1:] - window + 1
    has = hi > lo
    np.add.at(ok, lo[has], 1)
    np.add.at(ok, hi[has], -1)
    return np.flatnonzero(np.cumsum(ok)[:-1])


def cells(anchor: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each anchor in either row of the sketch."""
    mask = np.uint64(width - 1)
    return (anchor & mask).astype(np.uint32), (fmix64(anchor + np.uint64(0x9E3779B97F4A7C15)) & mask).astype(np.uint32)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint32 values as compressed differences, byte planes apart."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def sketch_width(symbols: int, density: float) -> int:
    want = max(MIN_CELLS, int(4 * symbols * density))
    return min(MAX_CELLS, 1 << (want - 1).bit_length())


class Sketch:
    """Two bitmaps of the cells counted at least twice."""

    def __init__(self, width: int, rows: list[np.ndarray]):
        self.width, self.rows = width, rows

    def repeated(self, anchor: np.ndarray) -> np.ndarray:
        out = np.ones(len(anchor), bool)
        for row, cell in zip(self.rows, cells(anchor, self.width), strict=True):
            out &= (row[cell >> np.uint32(3)] >> (cell & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1
        return out


def build_sketch(docs: DataFrame, anchors: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int, batch_bytes: int, cut: Callable) -> Sketch:
    """Count the anchors of all texts; ``anchors(raw, offsets)`` gives the hashes of a batch's anchor occurrences."""
    chunk = min(width, 1 << 22)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            made: list[list] = [[], [], []]
            found = np.concatenate(held)
            for row, cell in enumerate(cells(found, width)):
                cell = np.sort(cell)
                first = np.concatenate(([True], cell[1:] != cell[:-1]))
                at = np.flatnonzero(first)
                many = np.diff(np.concatenate((at, [len(cell)]))) > 1
                once, more = cell[at[~many]], cell[at[many]]
                edges = np.arange(0, width + 1, chunk, dtype=np.int64)
                for kind, values in enumerate((once, more)):
                    cut = np.searchsorted(values, edges)
                    for c in np.flatnonzero(np.diff(cut)):
                        made[0].append(row * (width // chunk) + int(c))
                        made[1].append(kind + 1)
                        made[2].append(pack_sorted(values[cut[c] : cut[c + 1]] - np.uint32(c * chunk)))
            yield pa.RecordBatch.from_arrays([pa.array(made[0], pa.int32()), pa.array(made[1], pa.int32()), pa.array(made[2], pa.binary())], ["part", "kind", "cells"])

        for raw, at, *_ in parts(batches, batch_bytes, cut):
            got = anchors(raw, at)
            if len(got):
                held.append(got)
                size += len(got)
            if size > 1_000_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from touched(batches)
        release()  # here, where the arrays of the last batch are gone

    def merged(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(chunk, np.uint8)
        for batch in group:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                at = unpack_sorted(data)
                count[at] = np.minimum(count[at] + np.uint8(kind), 2)
        bits = zstandard.compress(np.packbits(count >= 2, bitorder="little").tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits], pa.binary())], ["part", "bits"])

    def merge(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from merged(key, group)
        release()

    made = docs.select("text").mapInArrow(emit, "part int, kind int, cells binary").groupBy("part").applyInArrow(merge, "part int, bits binary")
    rows = [np.zeros(width // 8, np.uint8) for _ in range(2)]
    per, each = width // chunk, chunk // 8
    for r in made.toLocalIterator():
        rows[r.part // per][r.part % per * each : (r.part % per + 1) * each] = np.frombuffer(zstandard.decompress(bytes(r.bits)), np.uint8)
    return Sketch(width, rows)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of consecutive numbers in an ascending array, as indexes."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(np.diff(values) != 1) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(values)]))


def spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def equal_groups(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal (first, second) side by side, and the starts of the groups in it."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    same = a[1:] == a[:-1]
    if np.any(same & (b[1:] != b[:-1])):
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        same = a[1:] == a[:-1]
    new = np.concatenate(([True], ~(same & (b[1:] == b[:-1])))) if len(a) else np.zeros(0, bool)
    return order, np.flatnonzero(new)


def marks_batch(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Ranges packed by document: (doc_key, tie, spans), spans being pairs of int32."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]))) if len(doc) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    pairs = np.stack((start, end), 1).astype("<i4")
    bounds = np.concatenate((at, [len(doc)])) * 8
    data = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(pairs.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(doc[at], pa.int64()), pa.array(tie[at], pa.int64()), data.cast(pa.binary())], ["doc_key", "tie", "spans"])


MARKS = "doc_key long, tie long, spans binary"


def covered(spans: list[bytes] | None, n: int) -> np.ndarray:
    """Mask of the n positions that the packed ranges cover."""
    edge = np.zeros(n + 1, np.int32)
    for data in spans or ():
        pairs = np.frombuffer(data, "<i4").reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, pairs[:, 1], -1)
    return np.cumsum(edge, dtype=np.int32)[:n] > 0


def apply_marks(docs: DataFrame, marks: DataFrame, cut: Callable, schema: str, names: list[str], types: list[pa.DataType]) -> DataFrame:
    """Bring the marks to their documents and call ``cut(raw bytes, spans) -> row`` for each."""
    spans = marks.groupBy("doc_key", "tie").agg(F.collect_list("spans").alias("spans"))
    both = keyed(docs).join(spans, ["doc_key", "tie"], "left").select("doc_key", "text", "spans")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_buffer(batch.column("text"))
            rows = [cut(raw[a:b], s) for a, b, s in zip(at[:-1], at[1:], batch.column("spans").to_pylist(), strict=True)]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[] for _ in types], types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_key"), *cols], ["doc_key", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kept(batches)
        release()

    out = both.mapInArrow(run, f"doc_key long, {schema}")
    return out.select(F.when(F.col("doc_key") != NULL_ID, F.col("doc_key")).alias("doc_id"), *names)
