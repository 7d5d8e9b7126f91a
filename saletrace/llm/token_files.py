"""Token-id files: independent zstandard frames with a trailing seek table.

A data set is a folder of shards, each a range of document ids in ascending
order.  A shard is

* data frames: ``FRAME_IDS`` ids each (the last fewer) as little-endian
  unsigned 32-bit integers, whatever documents they belong to, so a frame's
  number follows from a position and memory is bounded by a frame;
* a skippable frame with the document index: id, whether it is null, and
  number of ids of each document, in order (compressed);
* a skippable frame with the seek table of the zstandard seekable format:
  compressed size, decompressed size and checksum (low half of XXH64) of each
  data frame, and the footer.

``zstd -d`` of a shard gives its id stream.  A reader takes the footer, the
table and the index, and then decompresses only the frames that hold the
documents it wants; every frame read is checked against its checksum.

Writing: documents are range-partitioned and sorted by id in Spark, and each
task streams its shard to a file of its own name; only files named by the
manifest (itself written as a table) count, so a repeated or failed attempt
leaves nothing that is read.  Files go through ``pyarrow.fs``, so the folder
may be on any store it knows.

Defined results.  Null text: empty, only the end id.  Null ids come first.
Equal ids: each row is a document of its own, ordered by a hash of its text.
No documents: no shard.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import word_bpe
from .common import id_and_text, materialize, new_folder

FRAME_IDS = 1 << 16
LEVEL = 1
END_ID = 2
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80
_INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4")])
MANIFEST = "part int, file string, docs bigint, ids bigint, first bigint, last bigint"


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard to a binary file object."""

    def __init__(self, file):
        self.file, self.buffer = file, bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.file.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, ident: int | None, ids: bytes) -> None:
        self.index.append((ident or 0, ident is None, len(ids) // 4))
        self.buffer += ids
        size = 4 * FRAME_IDS
        if len(self.buffer) >= size:
            whole = len(self.buffer) // size * size
            view = bytes(memoryview(self.buffer)[:whole])
            for at in range(0, whole, size):
                self._frame(view[at:at + size])
            del self.buffer[:whole]

    def close(self) -> None:
        if self.buffer:
            self._frame(bytes(self.buffer))
        index = self.compressor.compress(np.array(self.index, _INDEX).tobytes())
        self.file.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), _CHECKSUMS, FOOTER_MAGIC)
        self.file.write(struct.pack("<II", TABLE_MAGIC, len(table) + len(footer)) + table + footer)


class ShardReader:
    """Random access to one shard; reads the table and the index first."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, 2)
        file.seek(end - 9)
        count, kind, magic = struct.unpack("<IBI", file.read(9))
        if magic != FOOTER_MAGIC or not kind & _CHECKSUMS:
            raise ValueError("not a shard with a checksummed seek table")
        file.seek(end - 9 - 12 * count)
        entries = np.frombuffer(file.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.lengths, self.sums = entries.T
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        file.seek(int(self.offsets[-1]))
        magic, size = struct.unpack("<II", file.read(8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index")
        raw = zstandard.ZstdDecompressor().decompress(file.read(size))
        self.index = np.frombuffer(raw, _INDEX)
        self.starts = np.concatenate([[0], np.cumsum(self.index["n"].astype(np.int64))])

    def frame(self, k: int) -> bytes:
        self.file.seek(int(self.offsets[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(int(self.sizes[k])))
        if len(raw) != self.lengths[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def document(self, row: int) -> bytes:
        """The ids of one document: only the frames that hold it are read."""
        a, b = int(self.starts[row]), int(self.starts[row + 1])
        if a == b:
            return b""
        first = a // FRAME_IDS
        raw = b"".join(self.frame(k) for k in range(first, (b - 1) // FRAME_IDS + 1))
        return raw[4 * (a - first * FRAME_IDS):4 * (b - first * FRAME_IDS)]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """All documents in order, each frame read once: ``(id, start, ids)``."""
        held, at, k = b"", 0, 0  # held: bytes from id position ``at`` on
        for row, (a, b) in enumerate(zip(self.starts[:-1].tolist(), self.starts[1:].tolist())):
            parts = [held]
            size = at + len(held) // 4
            while size < b:
                parts.append(self.frame(k))
                size += len(parts[-1]) // 4
                k += 1
            held = b"".join(parts) if len(parts) > 1 else held
            entry = self.index[row]
            yield (None if entry["null"] else int(entry["id"]), a, held[4 * (a - at):4 * (b - at)])
            if 4 * (b - at) >= len(held) // 2:
                held, at = held[4 * (b - at):], b


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the shards of ``docs`` under ``folder``; returns the manifest,
    one row per shard in id order (``first`` and ``last``: ids not null)."""
    rows = id_and_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        bpe, part = word_bpe.codec(tokenizer), TaskContext.get().partitionId()
        writer = out = None
        first = last = None
        count = total = 0
        name = f"shard-{part:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for ident, text in zip(piece["id"].to_pylist(), piece["text"].to_pylist()):
                    if writer is None:
                        system, base = _filesystem(folder)
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                        writer = ShardWriter(out)
                    ids = bpe.encode(text) + end
                    writer.add(ident, ids)
                    if ident is not None:
                        first, last = ident if first is None else first, ident
                    count, total = count + 1, total + len(ids) // 4
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"],
                "docs": [count], "ids": [total], "first": pa.array([first], pa.int64()),
                "last": pa.array([last], pa.int64())})

    return materialize(dealt.select("id", "text").mapInArrow(write, MANIFEST), "manifest")


def read_tokens(manifest: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``id, start, ids`` of every document of the manifest's shards: ``start``
    counts all ids before it, ``ids`` are little-endian unsigned 32-bit
    integers.  ``only`` (column ``id``): just those documents are
    decompressed."""
    # one row per shard
    placed = manifest.withColumn("before", F.coalesce(F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    schema = "id bigint, start bigint, ids binary"
    if only is None:
        # a task for each shard: a number of partitions that AQE leaves alone
        shards = max(1, manifest.count())
        return placed.repartitionByRange(shards, "part").mapInArrow(_read_all, schema)
    wanted = placed.join(only.select(F.col("id").alias("want")).distinct(),
                         F.col("want").between(F.col("first"), F.col("last")))
    asked = wanted.groupBy("file", "before").agg(F.collect_set("want").alias("want"))
    return asked.mapInArrow(_read_some, schema)


def _batches(rows, size: int = 256):
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield _batch(block)
            block = []
    if block:
        yield _batch(block)


def _batch(block):
    ids, starts, raw = zip(*block)
    return pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()),
                                       "start": pa.array(starts, pa.int64()),
                                       "ids": pa.array(raw, pa.binary())})


def _open(uri: str):
    system, path = _filesystem(uri)
    return system.open_input_file(path)


def _read_all(batches):
    for batch in batches:
        for uri, before in zip(batch["file"].to_pylist(), batch["before"].to_pylist()):
            with _open(uri) as f:
                yield from _batches((i, before + a, raw) for i, a, raw in ShardReader(f).documents())


def _read_some(batches):
    for batch in batches:
        for uri, before, want in zip(*(batch[c].to_pylist() for c in ("file", "before", "want"))):
            with _open(uri) as f:
                r = ShardReader(f)
                rows = np.flatnonzero(np.isin(r.index["id"], want) & (r.index["null"] == 0))
                yield from _batches((int(r.index["id"][k]), before + int(r.starts[k]),
                                     r.document(k)) for k in rows.tolist())


def tokenized(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a new folder and read all of it back."""
    return read_tokens(write_tokens(docs, tokenizer, new_folder(spark, "tokens")))
