"""Substring dedup over windows of words, by a count-min prefilter and exact grouping.

Pass 1 sketches the anchors of all windows (see ``anchors``). Pass 2 hashes the windows whose anchor is estimated repeated, joins equal
ones within a batch, and deals the rest by anchor to buckets, where equal windows meet exactly (a 64-bit hash of the anchor and one
of the window, independent of each other). Windows that occur again are marked and the words they cover removed. A window that a
batch holds more than once is proven repeated there and sent on once, so a passage in a third of all documents costs its bucket one
entry a batch.

Defined cases: null and empty texts have no words; texts shorter than a window lose nothing; equal rows (same id and text) are each
other's repeats; words are compared unchanged; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import MARKS, apply_marks, build_sketch, covered, equal_groups, keyed, marks_batch, runs, sketch_width, sliding_anchor, spread, whole_windows, word_parts
from tidemark.llm.common import RollingHash, fmix64, parts, word_bounds

BATCH = 1 << 20
_TABLE = fmix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTES = RollingHash(0x5851F42D4C957F2D)
_GRAMS = RollingHash(0xD1342543DE82EF95)
_WINDOWS = RollingHash(0x2545F4914F6CDD1D)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and the n+1 word offsets of the documents. No word spans two documents."""
    # A space between documents keeps their words apart.
    gaps = np.insert(raw, offsets[1:-1], 32) if len(offsets) > 2 else raw
    at = offsets + np.concatenate(([0], np.arange(len(offsets) - 2), [max(len(offsets) - 2, 0)]))[: len(offsets)]
    start, end = word_bounds(gaps)
    hashes = np.empty(len(start), np.uint64)
    # A slice of words at a time: the tables of a prefix take 24 bytes a byte.
    cut = [*np.unique(np.searchsorted(start, np.arange(0, len(gaps) + BATCH, BATCH))).tolist()]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        lo, hi = start[a], end[b - 1]
        hashes[a:b] = _BYTES.spans(_BYTES.prefix(_TABLE[gaps[lo:hi]]), start[a:b] - lo, end[a:b] - lo)
    return fmix64(hashes + (end - start).astype(np.uint64)), np.searchsorted(start, at)


class Windows:
    """The windows of one batch, with the anchor of each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.words, self.bounds = word_hashes(raw, offsets)
        n = len(self.words)
        self.starts = whole_windows(self.bounds, n, window)
        if not len(self.starts):
            self.anchors = self.hashes = np.zeros(0, np.uint64)
            self.at = self.starts
            return
        at = np.arange(n - gram + 1)
        self.grams = _GRAMS.spans(_GRAMS.prefix(self.words), at, at + gram)
        self.at = sliding_anchor(self.grams, window - gram + 1)[self.starts]

    def occurrences(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        # An anchor at one place is one occurrence, however many windows it serves.
        new = np.concatenate(([True], (np.diff(self.at) != 0)))
        return self.grams[self.at[new]]


def repeated_windows(docs: DataFrame, window: int = 35, gram: int = 18, bucket_chars: int = 4 << 20) -> DataFrame:
    """Marks (doc_key, tie, spans of words) of all windows that occur more than once."""
    docs = keyed(docs)
    chars = docs.agg(F.sum(F.length("text")).alias("n")).collect()[0].n or 0
    sketch = build_sketch(
        docs, lambda raw, at: Windows(raw, at, window, gram).occurrences(), sketch_width(chars // 5, 2 / (window - gram + 2)), BATCH, word_parts(window)
    )
    held = docs.sparkSession.sparkContext.broadcast(sketch)  # bounded by anchors.MAX_CELLS
    buckets = max(64, chars // bucket_chars)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw, at, row, base, batch in parts(batches, BATCH, word_parts(window)):
            w = Windows(raw, at, window, gram)
            if not len(w.starts):
                continue
            anchor = w.grams[w.at]
            keep = held.value.repeated(anchor)
            starts, anchor = w.starts[keep], anchor[keep]
            if not len(starts):
                continue
            doc_of = np.searchsorted(w.bounds, starts, "right") - 1
            doc = batch.column("doc_key").to_numpy()[row[doc_of]]
            tie = batch.column("tie").to_numpy()[row[doc_of]]
            pos = starts - w.bounds[doc_of] + base[doc_of]
            hashes = _WINDOWS.spans(_WINDOWS.prefix(w.words), starts, starts + window)
            order, groups = equal_groups(hashes, anchor)
            size = np.diff(np.concatenate((groups, [len(order)])))
            lead = order[groups]
            many = np.zeros(len(starts), bool)
            many[order] = np.repeat(size > 1, size)
            again = np.flatnonzero(many)
            lo, hi = runs(starts[again] + doc_of[again])  # a step of 1 only within a document
            if len(lo):
                yield as_rows(-1, marks_batch(doc[again[lo]], tie[again[lo]], pos[again[lo]], pos[again[hi - 1]] + window))
            lead = np.sort(lead)
            bucket = (anchor[lead] % np.uint64(buckets)).astype(np.int64)
            lead = lead[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket) != 0, [True])))
            names, made = [], []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                names.append(int(bucket[a]))
                made.append(pack(anchor, hashes, doc, tie, pos, many, lead[a:b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), *[pa.nulls(len(made), pa.int64())] * 2, pa.array(made, pa.binary())], ["bucket", "doc_key", "tie", "data"]
            )

    def meet(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ = []
        for batch in group:
            passed = pa.compute.is_valid(batch.column("doc_key"))
            done = batch.filter(passed)
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([done.column("doc_key"), done.column("tie"), done.column("data")], ["doc_key", "tie", "spans"])
            held_ += [unpack(x) for x in batch.filter(pa.compute.invert(passed)).column("data").to_pylist()]
        if held_:
            anchor, hashes, doc, tie, pos, many = (np.concatenate(x) for x in zip(*held_, strict=True))
            order, groups = equal_groups(hashes, anchor)
            size = np.diff(np.concatenate((groups, [len(order)])))
            hit = np.zeros(len(order), bool)
            hit[order] = np.repeat(size > 1, size)
            hit &= ~many
            yield marks_batch(doc[hit], tie[hit], pos[hit], pos[hit] + window)

    # Proven marks ride along, dealt by document.
    rows = docs.mapInArrow(emit, "bucket int, doc_key long, tie long, data binary")
    rows = rows.withColumn("bucket", F.when(F.col("doc_key").isNull(), F.col("bucket")).otherwise(F.pmod(F.xxhash64("doc_key", "tie"), F.lit(buckets)).cast("int")))
    return rows.groupBy("bucket").applyInArrow(meet, MARKS)


def as_rows(bucket: int, marks: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket] * marks.num_rows, pa.int32()), *marks.columns], ["bucket", "doc_key", "tie", "data"])


def pack(anchor, hashes, doc, tie, pos, many, pick) -> bytes:
    """Windows that follow each other under one anchor share a head; each then costs the 8 bytes of its hash."""
    a, d, t, p, m = anchor[pick], doc[pick], tie[pick], pos[pick], many[pick]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (np.diff(p) != 1) | (m[1:] != m[:-1])))
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate((at, [len(pick)]))).astype("<u4")
    head = [x.tobytes() for x in (a[at].astype("<u8"), d[at].astype("<i8"), t[at].astype("<i8"), p[at].astype("<u4"), count, m[at].astype(np.uint8))]
    return np.array([len(at), len(pick)], "<u4").tobytes() + b"".join(head) + hashes[pick].astype("<u8").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    n, total = np.frombuffer(data, "<u4", 2)
    at, out = 8, []
    for kind in ("<u8", "<i8", "<i8", "<u4", "<u4", "u1"):
        out.append(np.frombuffer(data, kind, n, at))
        at += int(n) * np.dtype(kind).itemsize
    a, d, t, p, count, m = out
    r = lambda x: np.repeat(x, count)
    return r(a), np.frombuffer(data, "<u8", total, at), r(d), r(t), r(p).astype(np.int64) + spread(count.astype(np.int64)), r(m).astype(bool)


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 18, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every document; ``kept`` is the words that stay, null if not wanted."""

    def cut(raw: np.ndarray, spans: list[bytes] | None) -> tuple:
        start, end = word_bounds(raw)
        gone = covered(spans, len(start))
        data = raw.tobytes()
        kept = b" ".join([data[s:e] for s, e, g in zip(start.tolist(), end.tolist(), gone.tolist(), strict=True) if not g])
        return len(start), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None

    marks = repeated_windows(docs, window, gram)
    i, s = pa.int64(), pa.string()
    return apply_marks(docs, marks, cut, "n_words long, n_removed long, kept_sha256 string, kept string", ["n_words", "n_removed", "kept_sha256", "kept"], [i, i, s, s])
