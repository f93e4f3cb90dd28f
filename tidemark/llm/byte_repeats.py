"""Exact substring dedup over bytes: remove what a document shares with one of a smaller id.

The plan is the distributed part of a suffix index: strings of ``window`` bytes are dealt by content, so that all occurrences of one
meet in one place, sorted there, and the smallest document of each class of equal strings is found. Sampling makes it affordable:
only strings whose anchor gram repeats (``anchors``) are sent, as the raw bytes around that anchor, and each bucket hashes them again.
A batch resolves its own repeats first and sends a string only from its smallest document, so a string in a third of all documents
costs its bucket one entry a batch.

See the README on why the run-length index itself (``run_length_index``) is not on this path.

Defined cases: null and empty texts have no bytes; texts shorter than a window lose nothing; a null doc_id is the smallest; equal rows
(same id and text) are one document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import MARKS, apply_marks, build_sketch, byte_parts, covered, equal_groups, keyed, marks_batch, runs, sketch_width, sliding_anchor, spread, whole_windows
from tidemark.llm.common import RollingHash, fmix64, parts, release

BATCH = 3 << 18
FLUSH = 16 << 20
_TABLE = fmix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_OTHER = fmix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_FIRST = RollingHash(0x5851F42D4C957F2D)
_SECOND = RollingHash(0xD1342543DE82EF95)


class Strings:
    """The strings of ``window`` bytes in one batch, with the anchor of each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.raw, self.bounds, self.window = raw, offsets, window
        self.starts = whole_windows(offsets, len(raw), window)
        self.prefix = _FIRST.prefix(_TABLE[raw])
        if not len(self.starts):
            self.at, self.grams = self.starts, np.zeros(0, np.uint64)
            return
        at = np.arange(len(raw) - gram + 1)
        self.grams = _FIRST.spans(self.prefix, at, at + gram)
        self.at = sliding_anchor(self.grams, window - gram + 1)[self.starts]

    def occurrences(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        return self.grams[self.at[np.concatenate(([True], np.diff(self.at) != 0))]]


def hash_pairs(raw: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the strings at ``starts``."""
    return _FIRST.spans(_FIRST.prefix(_TABLE[raw]), starts, starts + window), _SECOND.spans(_SECOND.prefix(_OTHER[raw]), starts, starts + window)


def smallest(order: np.ndarray, groups: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each string the smallest document that holds it."""
    size = np.diff(np.concatenate((groups, [len(order)])))
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], groups), size) if len(groups) else out
    return out


def cut_out(raw: np.ndarray, begin: np.ndarray, length: np.ndarray, at_once: int = 4096) -> np.ndarray:
    """The bytes of all stretches one after the other, some stretches at a time: their indexes take 40 times the bytes themselves."""
    made = [np.zeros(0, np.uint8)]
    for a in range(0, len(begin), at_once):
        lo, n = begin[a : a + at_once], length[a : a + at_once]
        made.append(raw[np.repeat(lo, n) + spread(n)])
    return np.concatenate(made)


class Stretches:
    """Strings that follow each other under one anchor, as stretches of bytes, gathered over batches and dealt to buckets."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets, self.held, self.size = window, buckets, [], 0

    def add(self, raw, doc, tie, pos, starts, anchor_at, anchor) -> None:
        at = np.flatnonzero(np.concatenate(([True], (np.diff(starts) != 1) | (np.diff(anchor_at) != 0))))
        count = np.diff(np.concatenate((at, [len(starts)])))
        length = count + self.window - 1
        body = cut_out(raw, starts[at], length)
        bucket = (fmix64(anchor[at]) % np.uint64(self.buckets)).astype(np.int32)
        self.held.append((bucket, doc[at], tie[at], pos[at].astype(np.uint32), count.astype(np.uint32), body))
        self.size += len(body) + 28 * len(at)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        bucket, doc, tie, pos, count, body = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        length = count.astype(np.int64) + self.window - 1
        begin = np.cumsum(length) - length
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0, [True])))
        made = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            p = order[a:b]
            head = [x[p].tobytes() for x in (doc, tie, pos, count)]
            mine = cut_out(body, begin[p], length[p]).tobytes()
            made.append(np.array([len(p)], "<u4").tobytes() + zstandard.compress(b"".join(head) + mine, 3))
        names = bucket[order[cut[:-1]]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), *[pa.nulls(len(made), pa.int64())] * 2, pa.array(made, pa.binary())], ["bucket", "doc_key", "tie", "data"]
        )


def unpack(data: bytes, window: int) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    body, at, out = zstandard.decompress(data[4:]), 0, []
    for kind in ("<i8", "<i8", "<u4", "<u4"):
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return *out, np.frombuffer(body, np.uint8, -1, at)


def repeated_strings(docs: DataFrame, window: int = 50, gram: int = 20, bucket_chars: int = 2 << 20) -> DataFrame:
    """Marks (doc_key, tie, spans of bytes) of all strings that also start in a document of smaller id."""
    docs = keyed(docs)
    chars = docs.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0].n or 0
    density = 2 / (window - gram + 2)
    sketch = build_sketch(docs, lambda raw, at: Strings(raw, at, window, gram).occurrences(), sketch_width(chars, density), BATCH, byte_parts(window))
    held = docs.sparkSession.sparkContext.broadcast(sketch)  # bounded by anchors.MAX_CELLS
    buckets = max(64, chars // bucket_chars)

    def send(out: Stretches, raw: np.ndarray, at: np.ndarray, row: np.ndarray, base: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch | None:
        """Adds what other batches must see to ``out``; what the batch itself settles is returned. Its arrays go before the next batch."""
        s = Strings(raw, at, window, gram)
        if not len(s.starts):
            return None
        new = np.concatenate(([True], np.diff(s.at) != 0))
        hit = held.value.repeated(s.grams[s.at[new]])
        keep = np.repeat(hit, np.diff(np.concatenate((np.flatnonzero(new), [len(s.at)]))))
        starts, anchor_at = s.starts[keep], s.at[keep]
        if not len(starts):
            return None
        ids, ties = batch.column("doc_key").to_numpy(), batch.column("tie").to_numpy()
        doc_of = np.searchsorted(s.bounds, starts, "right") - 1
        doc, tie, pos = ids[row[doc_of]], ties[row[doc_of]], starts - s.bounds[doc_of] + base[doc_of]
        first = _FIRST.spans(s.prefix, starts, starts + window)
        second = _SECOND.spans(_SECOND.prefix(_OTHER[s.raw]), starts, starts + window)
        gone = doc > smallest(*equal_groups(first, second), doc)
        del first, second
        pick = np.flatnonzero(~gone)
        if len(pick):
            out.add(s.raw, doc[pick], tie[pick], pos[pick], starts[pick], anchor_at[pick], s.grams[anchor_at[pick]])
        again = np.flatnonzero(gone)
        lo, hi = runs(starts[again] + doc_of[again])
        if not len(lo):
            return None
        done = marks_batch(doc[again[lo]], tie[again[lo]], pos[again[lo]], pos[again[hi - 1]] + window)
        return pa.RecordBatch.from_arrays([pa.array([-1] * done.num_rows, pa.int32()), *done.columns], ["bucket", "doc_key", "tie", "data"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Stretches(window, buckets)
        for part in parts(batches, BATCH, byte_parts(window)):
            done = send(out, *part)
            if done is not None:
                yield done
            if out.size > FLUSH:
                yield from out.flush()
        yield from out.flush()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sent(batches)
        release()

    def met(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ = []
        for batch in group:
            passed = pa.compute.is_valid(batch.column("doc_key"))
            done = batch.filter(passed)
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([done.column("doc_key"), done.column("tie"), done.column("data")], ["doc_key", "tie", "spans"])
            held_ += [unpack(x, window) for x in batch.filter(pa.compute.invert(passed)).column("data").to_pylist()]
        if held_:
            doc, tie, pos, count, raw = (np.concatenate(x) for x in zip(*held_, strict=True))
            held_.clear()
            count = count.astype(np.int64)
            length = count + window - 1
            begin = np.cumsum(length) - length
            owner, step = np.repeat(np.arange(len(doc)), count), spread(count)
            starts = begin[owner] + step
            # Hashed a slice at a time: a prefix table takes 16 bytes a byte.
            cut = [*np.searchsorted(begin, np.arange(0, len(raw), 1 << 20)), len(begin)]
            made = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b > a:
                    lo, hi = begin[a], begin[b - 1] + length[b - 1]
                    made.append(hash_pairs(raw[lo:hi], starts[np.searchsorted(owner, a) : np.searchsorted(owner, b)] - lo, window))
            order, groups = equal_groups(*(np.concatenate(x) for x in zip(*made, strict=True)))
            of = doc[owner]
            hit = np.flatnonzero(of > smallest(order, groups, of))
            if len(hit):
                lo, hi = runs(hit + owner[hit])  # a step of 1 only within a stretch
                o, p = owner[hit[lo]], pos[owner[hit]].astype(np.int64) + step[hit]
                yield marks_batch(doc[o], tie[o], p[lo], p[hi - 1] + window)

    def meet(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from met(group)
        release()

    rows = docs.mapInArrow(emit, "bucket int, doc_key long, tie long, data binary")
    rows = rows.withColumn("bucket", F.when(F.col("doc_key").isNull(), F.col("bucket")).otherwise(F.pmod(F.xxhash64("doc_key", "tie"), F.lit(buckets)).cast("int")))
    return rows.groupBy("bucket").applyInArrow(meet, MARKS)


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = 20, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document; ``kept`` is the bytes that stay, null if not wanted."""

    def cut(raw: np.ndarray, spans: list[bytes] | None) -> tuple:
        gone = covered(spans, len(raw))
        kept = raw[~gone].tobytes()
        n_spans = int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=0) == 1))
        return len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None

    marks = repeated_strings(docs, window, gram)
    i = pa.int64()
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return apply_marks(docs, marks, cut, schema, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], [i, i, i, pa.string(), pa.binary()])
