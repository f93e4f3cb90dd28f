"""Token-ID / binary output with a shared zstandard dictionary.

Layout of a store, all written by Spark's own committer, so a lost executor only costs a retried task:

* ``dictionary``: one row ``(sha256, id_bytes, end_id, dictionary)``. The dictionary is trained on the serialised id arrays of a
  bounded sample (``sample_docs`` documents by lowest hash rank, ``sample_ids`` ids of each); it only affects the size of frames.
* ``blocks``: rows in ascending document order. Each holds one blob of zstandard frames, one frame a document, and the offset
  index beside it: ``doc_ids, offsets, n_tokens`` with ``dict_sha256`` and the block's first token within its shard.
* ``shards``: one row a shard, with the number of tokens in all shards before it.

Short-document access (``fetch``) prunes blocks by ``first_doc_id``/``last_doc_id`` and unpacks only the wanted frames.

Defined cases: a null text is an empty text, an empty text is the end id alone; a null doc_id sorts first; rows that repeat a
doc_id are all kept, ordered by a hash of the text; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import array
import functools
import hashlib
import json
import os
import re
import sys
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import release

#: Characters for which the standard library's classes and those of the byte-level splitter agree.
_PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_NOT_PLAIN = re.compile(rf"[^\x00-\x1b\x20-\x7f{_PLAIN_LETTERS}€‘’“”–—…¿¡«»§°]")
_SPLIT = re.compile(
    rf" ?[{_PLAIN_LETTERS}]+| ?[0-9]+|'(?:[sdmt]|ll|ve|re)| ?[^\s{_PLAIN_LETTERS}0-9]+|\s+(?!\S)|\s+"
)
_CACHE_ENTRIES = 500_000
#: Longer texts are cut at a space between plain letters, which always parts two pieces, so that few pieces are held at a time.
_STRETCH = 1 << 18
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")

BLOCKS = (
    "shard int, block int, first_doc_id long, last_doc_id long, dict_sha256 string, shard_start long, tokens long, "
    "doc_ids array<long>, offsets array<long>, n_tokens array<long>, blob binary"
)


class Pieces(dict):
    """Serialised ids by piece; a missing one is asked of the tokenizer's model."""

    def __init__(self, model, code: str):
        self.model, self.code = model, code
        # The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = sorted(set(range(256)) - set(shown))
        self.alphabet = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}

    def __missing__(self, piece: str) -> bytes:
        word = piece.encode().decode("latin-1").translate(self.alphabet)
        made = self[piece] = array.array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()
        return made


class Encoder:
    """Encodes texts with the tokenizers library to little-endian id bytes.

    A byte-level BPE tokenizer without a normaliser treats each piece of its splitter alone, so the library's model gets each piece
    once a worker and is not asked again. Texts with other characters, and other kinds of tokenizer, go through the library whole.
    """

    def __init__(self, path: str):
        # The tasks already use every core; the library's own threads would only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.id_bytes = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.id_bytes}")
        spec = json.loads(Path(path).read_text())
        split = spec.get("pre_tokenizer") or {}
        self.by_piece = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        self.by_piece = self.by_piece and not split.get("add_prefix_space") and spec["model"].get("type", "BPE") == "BPE"
        self.by_piece = self.by_piece and sys.byteorder == "little"
        added = [x["content"] for x in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.pieces = Pieces(self.library.model, "H" if self.id_bytes == 2 else "I")

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_piece or _NOT_PLAIN.search(text) or (self.added and self.added.search(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        if len(self.pieces) > _CACHE_ENTRIES:
            self.pieces.clear()
        if len(text) <= _STRETCH:
            return b"".join(map(self.pieces.__getitem__, _SPLIT.findall(text)))
        made, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + _STRETCH)
            end = cut.start() if cut else len(text)
            made.append(b"".join(map(self.pieces.__getitem__, _SPLIT.findall(text, start, end))))
            start = end
        return b"".join(made)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, tokenizer: str, sample_docs: int, sample_ids: int, size: int) -> bytes:
    """A zstandard dictionary from the serialised ids of a bounded sample; raw content where there is too little to train on."""
    total = docs.count()
    rank = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40))
    share = min(1.0, 1.5 * sample_docs / max(total, 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            made = [enc.encode(x or "")[: sample_ids * enc.id_bytes] for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rank"), pa.array(made, pa.binary())], ["rank", "ids"])

    picked = docs.select(rank.alias("rank"), "text").filter(F.col("rank") <= F.lit(int(share * (1 << 40))))
    rows = picked.mapInArrow(encode, "rank long, ids binary").orderBy("rank", "ids").limit(sample_docs).collect()
    samples = [bytes(r.ids) for r in rows if len(r.ids) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    block_bytes: int = 1 << 20,
    dictionary_bytes: int = 64 << 10,
    sample_docs: int = 1000,
    sample_ids: int = 4096,
    level: int = 3,
) -> None:
    """Write (doc_id, text) of ``docs`` to a store at ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    raw = train_dictionary(docs, tokenizer, sample_docs, sample_ids, dictionary_bytes)
    sha = hashlib.sha256(raw).hexdigest()
    id_bytes = encoder(tokenizer).id_bytes
    spark.createDataFrame(
        [(sha, id_bytes, end_id, bytearray(raw))], "sha256 string, id_bytes int, end_id long, dictionary binary"
    ).coalesce(1).write.parquet(f"{path}/dictionary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(raw), write_content_size=True)
        end = np.array([end_id], enc.dtype).tobytes()
        ids: list = []
        offsets: list[int] = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = start = block = 0

        def flush() -> pa.RecordBatch:
            tokens = sum(counts)
            known = [i for i in ids if i is not None]
            row = [shard, block, min(known, default=None), max(known, default=None), sha, start, tokens, ids, offsets, counts, b"".join(frames)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            names = [x.split()[0] for x in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = enc.encode(text or "") + end
                frame = packer.compress(data)
                if frames and size + len(frame) > block_bytes:
                    yield flush()
                    start, block = start + sum(counts), block + 1
                    ids, offsets, counts, frames, size = [], [], [], [], 0
                ids.append(doc_id)
                offsets.append(size)
                counts.append(len(data) // enc.id_bytes)
                frames.append(frame)
                size += len(frame)
        if frames:
            yield flush()
        # A task's pieces cost little to ask for again, and a worker that is kept would hold those of all its tasks.
        enc.pieces.clear()
        release()

    tie = F.xxhash64("text")
    ordered = docs.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ordered.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")
    # One number a shard, so the driver holds a few bytes for each 100 MB or so of input.
    shards = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("tokens").alias("tokens")).collect()
    before, rows = 0, []
    for r in sorted(shards):
        rows.append((r.shard, before))
        before += r.tokens
    spark.createDataFrame(rows, "shard int, before long").coalesce(1).write.parquet(f"{path}/shards")


def _open(spark: SparkSession, path: str) -> tuple[str, int, bytes]:
    head = spark.read.parquet(f"{path}/dictionary").collect()[0]
    raw = bytes(head.dictionary)
    if hashlib.sha256(raw).hexdigest() != head.sha256:
        raise ValueError("the dictionary doesn't match its hash")
    return head.sha256, head.id_bytes, raw


def read_store(spark: SparkSession, path: str, wanted: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) from a store; ``wanted`` limits it to some documents' frames."""
    sha, id_bytes, raw = _open(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    blocks = blocks.join(spark.read.parquet(f"{path}/shards"), "shard")
    keep = None if wanted is None else frozenset(wanted)
    if keep is not None:
        near = F.lit(False)
        for i in sorted(keep):
            near |= F.lit(i).between(F.col("first_doc_id"), F.col("last_doc_id"))
        blocks = blocks.filter(near)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for b in batch.to_pylist():
                if b["dict_sha256"] != sha:
                    raise ValueError("a block was written with another dictionary")
                out: list[list] = [[], [], [], [], []]
                ends = [*b["offsets"][1:], len(b["blob"])]
                start = b["before"] + b["shard_start"]
                for doc_id, lo, hi, n in zip(b["doc_ids"], b["offsets"], ends, b["n_tokens"], strict=True):
                    if keep is None or doc_id in keep:
                        ids = np.frombuffer(opener.decompress(b["blob"][lo:hi]), f"<u{id_bytes}").astype("<u4")
                        row = [doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.astype(np.int64) if with_ids else None]
                        for col, v in zip(out, row, strict=True):
                            col.append(v)
                    start += n
                cols = [pa.array(c, pa.int64()) for c in out[:4]] + ([pa.array(out[4], pa.list_(pa.int64()))] if with_ids else [])
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    needed = ["dict_sha256", "doc_ids", "offsets", "n_tokens", "blob", "before", "shard_start"]
    return blocks.select(*needed).mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    )


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of some short documents, by the offset index."""
    return read_store(spark, path, wanted=doc_ids, with_ids=True)
