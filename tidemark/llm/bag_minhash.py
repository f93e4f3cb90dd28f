"""Near-duplicates of word shingles under weighted Jaccard similarity, by BagMinHash signatures.

A document is the multiset of its shingles of five words (a text of fewer words is one shingle). Every distinct shingle runs one
Poisson process on each dyadic block of weights (0,1], (1,2], (2,4], ... that its count reaches. A point has a time, a register
and a position in the block and counts if the position is within the weight, so documents share points exactly as far as their
weights overlap, and the earliest point of a register is equal with a probability equal to the weighted Jaccard similarity. Only
points before a limit are made; the limit is raised for a document until all its registers are filled, which leaves the result exact.

Banding: ``bands`` of ``rows`` registers; at 0.8 a link is missed by all 25 bands of 5 with probability 5e-5. Candidates of a bucket
are first checked against its best connected member only (a star, no pairs within the group), verified by the exact multiset overlap;
what components then still meet in a bucket is checked across components, in tiles. So no candidate link between different components
is left out, and copies are never expanded into pairs. Joins on a bucket, a leader, a text or a class salt the keys that hold a
thousandth of the rows or more (``spread_join``).

Defined cases: a null text counts as the empty text; equal texts are always one class, also those without words; texts without words
are otherwise near nothing; a null doc_id is the least id; equal rows share their class; texts are read whole; other columns are
ignored, and ``drop_near_duplicates`` keeps them whatever their names (of rows equal in id and text the one of least hash stays).
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import NULL_ID, keyed, whole_windows
from tidemark.llm.common import RollingHash, fmix64, gathered, materialise, packed, release, spread_join, text_buffer, unpacked
from tidemark.llm.components import components
from tidemark.llm.word_windows import word_hashes

REGISTERS = 128
BATCH = 1 << 19
#: Shingles that run their processes at a time.
PART = 1 << 17
#: Members of one side of a tile, and the bytes of their texts.
TILE, TILE_BYTES = 256, 4 << 20
#: Pairs that one copy of a leader's text is held against.
STAR = 64
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SHINGLES = RollingHash(0xD1342543DE82EF95)


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of every shingle in a batch."""
    words, bounds = word_hashes(raw, offsets)
    prefix = _SHINGLES.prefix(words)
    starts = whole_windows(bounds, len(words), size)
    doc = np.searchsorted(bounds, starts, "right") - 1
    hashes = _SHINGLES.spans(prefix, starts, starts + size)
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < size))
    few = _SHINGLES.spans(prefix, bounds[short], bounds[short + 1]) ^ fmix64(np.diff(bounds)[short].astype(np.uint64))
    return np.concatenate((doc, short)), np.concatenate((hashes, few))


def bags(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle) with its count."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])))) if len(doc) else np.zeros(0, np.int64)
    return doc[new], hashes[new], np.diff(np.concatenate((new, [len(doc)])))


def unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Earliest point of each register, n x m; infinite for documents without shingles. Some shingles at a time, as points only compete by time."""
    out = np.full(n * m, np.inf)
    total = np.bincount(doc, weight, n)
    limit = (np.log(m) + 3) / np.maximum(total, 1)
    rows = np.arange(len(doc))
    while True:
        for a in range(0, len(rows), PART):
            part = rows[a : a + PART]
            points(doc[part], shingle[part], weight[part], limit, out, m)
        empty = np.isinf(out.reshape(n, m)).any(1) & (total > 0)
        if not empty.any():
            return out.reshape(n, m)
        limit[empty] *= 2
        rows = np.flatnonzero(empty[doc])


def points(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, limit: np.ndarray, out: np.ndarray, m: int) -> None:
    """Lower the registers ``out`` to the points of these shingles before the limits of their documents."""
    # Blocks (lo, hi] of weights: one process each.
    top = np.ceil(np.log2(weight)).astype(np.int64) if len(weight) else np.zeros(0, np.int64)
    blocks = top + 1
    owner = np.repeat(np.arange(len(doc)), blocks)
    block = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    hi = np.ldexp(1.0, block)
    lo = np.where(block > 0, hi / 2, 0.0)
    of, bound = doc[owner], weight[owner]
    rate = (hi - lo) * m
    state = fmix64(shingle[owner] + _GOLDEN * (block + 1).astype(np.uint64))
    step = np.zeros(len(owner), np.uint64)
    draw = fmix64(state)
    when = -np.log(unit(draw)) / rate
    live = np.flatnonzero(when <= limit[of])
    while len(live):
        point = fmix64(draw[live] ^ _GOLDEN)
        register = (point & np.uint64(m - 1)).astype(np.int64)
        at = lo[live] + unit(point) * (hi[live] - lo[live])
        ok = at <= bound[live]
        np.minimum.at(out, of[live[ok]] * m + register[ok], when[live[ok]])
        step[live] += np.uint64(1)
        draw[live] = fmix64(state[live] + step[live] * _GOLDEN)
        when[live] -= np.log(unit(draw[live])) / rate[live]
        live = live[when[live] <= limit[of[live]]]


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = sig.view(np.uint64)[:, : bands * rows].reshape(len(sig), bands, rows)
    out = np.zeros((len(sig), bands), np.uint64)
    for i in range(rows):
        out = fmix64(out * np.uint64(0x5851F42D4C957F2D) + bits[:, :, i])
    return out.astype(np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted (hash, count) bags."""
    total = a[1].sum() + b[1].sum()
    if not total:
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (total - both))


def bag_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    _, h, w = bags(*shingles(raw, np.array([0, len(raw)])))
    return h, w


def sign(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_key, tie, node, bands, sketch, bytes) of every document; node is the digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BATCH):
            raw, at = text_buffer(batch.column("text"))
            sig = signatures(*bags(*shingles(raw, at)), batch.num_rows)
            has = np.isfinite(sig[:, 0])
            made = band_hashes(sig, bands, rows)
            small = (fmix64(sig.view(np.uint64).ravel()) >> np.uint64(48)).astype("<u2").reshape(sig.shape)
            body = raw.tobytes()
            node = [hashlib.md5(body[a:b]).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_key"), batch.column("tie"), pa.array(node, pa.binary()),
                    pa.array([list(x) if h else [] for x, h in zip(made, has, strict=True)], pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in small], pa.binary()), pa.array(np.diff(at), pa.int64()),
                ],
                ["doc_key", "tie", "node", "bands", "sketch", "bytes"],
            )
        release()

    return docs.mapInArrow(run, "doc_key long, tie long, node binary, bands array<long>, sketch binary, bytes long")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float, margin: float = 0.12) -> DataFrame:
    """Pairs (a, b) whose sketches agree in ``threshold - margin`` of the registers and whose texts have that multiset overlap.

    ``pairs`` has n, about the number of pairs of b. As b may be in very many, its pairs are dealt out in lots of some ``STAR`` by (b, salt),
    and its text is sent to each lot once.
    """
    salt = F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / STAR)).cast("int").alias("salt")
    pairs = materialise(pairs.select("a", "b", salt), "star-pairs")
    far = pairs.select("b", "salt").distinct().join(texts.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("text").alias("tb")), "b")
    near = pairs.join(texts.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("text").alias("ta")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bag = functools.lru_cache(64)(bag_of)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            alike = np.flatnonzero((x == y).mean(1) >= threshold - margin)
            some = batch.take(pa.array(alike))
            ok = [likeness(bag_of(x), bag(y)) >= threshold for x, y in zip(some.column("ta").to_pylist(), some.column("tb").to_pylist(), strict=True)]
            yield some.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = near.join(far, ["b", "salt"]).select("a", "b", "sa", "sb", "ta", "tb")
    return materialise(both.mapInArrow(run, "a binary, b binary"), "star-links")


def first_labels(links: DataFrame) -> DataFrame:
    """(node, label): each linked node's leader, followed twice. Equal labels are connected; connected nodes may still differ."""
    up = materialise(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "leaders")
    now = up
    for _ in range(2):
        step = up.select(F.col("node").alias("label"), F.col("label").alias("next"))
        now = now.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return now


def across(met: DataFrame, label: DataFrame, texts: DataFrame, total: int, threshold: float, margin: float = 0.12) -> DataFrame:
    """Links (a, b) between nodes of different labels that share a bucket.

    Members of the smaller labels of a bucket are held against all others of it in square tiles, so no task has more than two
    blocks of some ``TILE`` documents and ``TILE_BYTES`` of text, and only links leave it. A pair is looked at in the first band that it shares, if its sketches agree
    in ``threshold - margin`` of the registers (3.4 deviations), and verified exactly unless the tile already joined its components.
    """
    known = met.join(label, "node", "left").select("band", "hash", "node", "bytes", F.coalesce("label", "node").alias("label"))
    known = materialise(known, "labelled")
    by_label = known.groupBy("band", "hash", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    mixed = by_label.groupBy("band", "hash").agg(F.max(F.struct("n", "label", "bytes")).alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("labels"))
    blocks = lambda n, size: F.greatest(F.ceil(n / TILE), F.ceil(size / TILE_BYTES)).cast("int")
    nb, mb = blocks(F.col("n"), F.col("bytes")).alias("nb"), blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("mb")
    mixed = materialise(mixed.filter("labels > 1").select("band", "hash", F.col("main.label").alias("main"), "n", nb, mb), "mixed-sizes")
    known = materialise(spread_join(known.drop("bytes"), mixed, ["band", "hash"], total).drop("n"), "mixed")
    at = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))
    small = known.filter(F.col("label") != F.col("main")).select("band", "hash", "node", "label", at(F.col("mb")).alias("i"), each(F.col("nb")).alias("j"), F.lit(True).alias("minor"), "main")
    whole = known.select("band", "hash", "node", "label", each(F.col("mb")).alias("i"), at(F.col("nb")).alias("j"), F.lit(False).alias("minor"), "main")
    rows = small.unionByName(whole).join(texts, "node")

    def tile(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        left, right = [r for r in rows if r["minor"]], [r for r in rows if not r["minor"]]
        out: tuple[list, list] = ([], [])
        if left and right:
            band, main = key[0].as_py(), right[0]["main"]
            sketch = np.frombuffer(b"".join(r["sketch"] for r in right), "<u2").reshape(len(right), -1)
            bands = np.array([r["bands"] for r in right])
            up: dict[bytes, bytes] = {}

            def root(x: bytes) -> bytes:
                while x in up:
                    x = up[x]
                return x

            bag = functools.lru_cache(2 * TILE)(bag_of)
            for a in left:
                alike = (sketch == np.frombuffer(a["sketch"], "<u2")).mean(1)
                shared = bands == np.array(a["bands"])
                first = shared[:, band] & ~shared[:, :band].any(1)
                order = np.argsort(-alike, kind="stable")
                for k in order[(alike >= threshold - margin)[order] & first[order]].tolist():
                    b = right[k]
                    if root(a["label"]) == root(b["label"]) or (b["label"] != main and b["node"] > a["node"]):
                        continue
                    if likeness(bag(a["text"]), bag(b["text"])) >= threshold:
                        up[root(a["label"])] = root(b["label"])
                        out[0].append(a["node"])
                        out[1].append(b["node"])
        return pa.table({"a": pa.array(out[0], pa.binary()), "b": pa.array(out[1], pa.binary())})

    return materialise(rows.groupBy("band", "hash", "i", "j").applyInArrow(tile, "a binary, b binary"), "across-links")


def near_classes(docs: DataFrame, threshold: float = 0.8, bands: int = 25, rows: int = 5) -> DataFrame:
    """(doc_key, tie, class_key, class_tie) of every document: the least document of its class."""
    docs = keyed(docs)
    signed = materialise(sign(docs, bands, rows), "signatures")
    first = F.min_by(F.struct("doc_key", "tie", "bands", "sketch", "bytes"), F.struct("doc_key", "tie")).alias("r")
    nodes = materialise(signed.groupBy("node").agg(first, F.count("*").alias("copies")).select("node", "copies", "r.*"), "nodes")
    counted = nodes.agg(F.count("*").alias("n"), F.sum("copies").alias("rows")).collect()[0]
    # Buckets of a thousandth of all texts are salted: under 1,000 a band.
    total = counted.n
    places = nodes.select("node", "bytes", F.posexplode("bands").alias("band", "hash"))
    size = materialise(places.groupBy("band", "hash").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes")
    met = materialise(spread_join(places, size, ["band", "hash"], total), "met")
    degree = met.groupBy("node").agg(F.sum("n").alias("degree"))
    # Texts of the nodes that share a bucket; the rest is done with.
    texts = docs.join(nodes.join(degree, "node"), ["doc_key", "tie"]).select("node", "degree", "bands", "sketch", "text").dropDuplicates(["node"])
    texts = materialise(texts, "met-texts")
    leader = met.join(texts.select("node", "degree"), "node").groupBy("band", "hash").agg(F.max(F.struct("degree", "node")).getField("node").alias("b"), F.max("n").alias("n"))
    star = spread_join(met.select("node", "band", "hash"), materialise(leader, "leaders"), ["band", "hash"], total)
    star = star.filter(F.col("node") != F.col("b")).groupBy(F.col("node").alias("a"), "b").agg(F.max("n").alias("n"))
    texts = texts.drop("degree")
    links = verify(star, texts, threshold)
    links = links.union(across(met, first_labels(links), texts, total, threshold))
    label = materialise(components(links), "labels")
    of = materialise(nodes.join(label, "node", "left").select("node", "copies", F.coalesce("label", "node").alias("label"), F.struct("doc_key", "tie").alias("r")), "labelled-nodes")
    least = materialise(of.groupBy("label").agg(F.min("r").alias("least"), F.count("*").alias("n")), "classes")
    of = spread_join(of, least, ["label"], total).select("node", F.col("copies").alias("n"), F.col("least.doc_key").alias("class_key"), F.col("least.tie").alias("class_tie"))
    return spread_join(signed.select("doc_key", "tie", "node"), of, ["node"], counted.rows or 0).select("doc_key", "tie", "class_key", "class_tie")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, kept) of every document; one document of each class is kept."""
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    kept = (F.col("doc_key") == F.col("class_key")) & (F.col("tie") == F.col("class_tie"))
    return near_classes(docs, **options).select(known("doc_key").alias("doc_id"), known("class_key").alias("class_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class."""
    classes = near_classes(docs, **options)
    first = classes.filter((F.col("doc_key") == F.col("class_key")) & (F.col("tie") == F.col("class_tie")))
    first = materialise(first.groupBy("doc_key", "tie").agg(F.count("*").alias("copies")), "near-classes")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_key")
    tie = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("tie")
    rows = docs.select(key, tie, packed(docs).alias("row")).join(first, ["doc_key", "tie"])
    # Equal rows all pass; only then is one of them picked.
    alone = rows.filter("copies = 1").select("row")
    if first.filter("copies > 1").limit(1).count():
        order = F.xxhash64(F.to_json("row"))
        alone = alone.union(rows.filter("copies > 1").groupBy("doc_key", "tie").agg(F.min_by("row", order).alias("row")).select("row"))
    return unpacked(alone)
