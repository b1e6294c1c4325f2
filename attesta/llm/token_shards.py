"""Token ids in binary shards of plane-shuffled, compressed blocks.

Shard file: MAGIC, the blocks, a footer (zstandard), the footer's offset as an
unsigned 64-bit integer, MAGIC, a line end. A block holds up to BLOCK ids, which are
transposed into byte planes (or bit planes), each compressed with zstandard by
itself: the planes of the high bytes are nearly constant and take next to
nothing. Block header: ids (u32), kind (u8, 1 or 8 bits a plane), planes (u8),
then each plane's length (u32). The footer has the number of the task that wrote
the shard, the shard's number there and the ids of the task before it, the chunk
index (offset and first id of each block) and the document index (id, whether it
is null, ids). All integers are little-endian.

A task writes many shards, one after another. Each is handed over in ROWS rows
while it is made, so no task holds one whole; Spark's text writer puts so many
rows into a file of its own, each with a line end, which no offset leads to.
Spark's binary reader reads the file back: so shards go to any store, and what a
failed attempt wrote is never seen.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm._hash import token_parts
from attesta.llm.token_counts import loaded
from attesta.session import Stage, of_longs, small_batches

MAGIC = b"ATBPS1\r\n"
#: Ids of a block; a block is what a reader has to decode to get at one id.
BLOCK = 1 << 16
#: Bytes of text of a shard and of a task, about, with DOC_BYTES for each document's entry; there are as many tasks as cores at least.
SHARD_BYTES, TASK_BYTES, DOC_BYTES = 32 << 20, 1 << 30, 32
END = b"\n"
#: Rows that make a shard: whole blocks, after them empty rows, and in the last one what is left and the footer.
ROWS = 64
_DOCS, _CHUNKS = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")]), np.dtype([("offset", "<u8"), ("first", "<u8"), ("n", "<u4")])


def pack_block(ids: np.ndarray, bits: int = 8, level: int = 3) -> bytes:
    """One block: the ids' planes of ``bits`` bits (8 or 1), each compressed."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        planes = list(np.ascontiguousarray(octets.T))
    else:
        planes = list(np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1))
    squeeze = zstandard.ZstdCompressor(level=level).compress
    parts = [squeeze(p.tobytes()) for p in planes]
    return struct.pack("<IBB", len(ids), bits, len(parts)) + struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def unpack_block(data: bytes) -> np.ndarray:
    n, bits, count = struct.unpack_from("<IBB", data)
    sizes = struct.unpack_from(f"<{count}I", data, 6)
    at, expand, planes = 6 + 4 * count, zstandard.ZstdDecompressor().decompress, []
    for size in sizes:
        planes.append(np.frombuffer(expand(data[at : at + size]), np.uint8))
        at += size
    if bits == 8:
        return np.ascontiguousarray(np.stack(planes).T).view("<u4").reshape(-1)[:n]
    flat = np.ascontiguousarray(np.unpackbits(np.stack(planes), axis=1, count=n).T)
    return np.packbits(flat, axis=1, bitorder="little").view("<u4").reshape(-1)


class ShardWriter:
    """One shard; ``task``, ``number`` and ``first`` say who writes it, which of the task's it is, and how many ids the task wrote before."""

    def __init__(self, out, block: int = BLOCK, bits: int = 8, task: int = 0, number: int = 0, first: int = 0):
        self.out, self.block, self.bits, self.place = out, block, bits, (task, number, first)
        self.held, self.held_n, self.docs, self.chunks, self.total = [], 0, [], [], 0
        out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, ids: np.ndarray, docs: np.ndarray) -> None:
        """Ids of some documents, or a part of one's, and the entries of those that end with them."""
        if len(docs):
            self.docs.append(docs)
        self.held.append(ids)
        self.held_n += len(ids)
        if self.held_n >= self.block:
            ids = np.concatenate(self.held)
            full = len(ids) // self.block * self.block
            for i in range(0, full, self.block):
                self._write(ids[i : i + self.block])
            self.held, self.held_n = [ids[full:]], len(ids) - full

    def _write(self, ids: np.ndarray) -> None:
        data = pack_block(ids, self.bits)
        self.chunks.append((self.at, self.total, len(ids)))
        self.out.write(data)
        self.at += len(data)
        self.total += len(ids)

    def close(self) -> None:
        if self.held_n:
            self._write(np.concatenate(self.held))
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, _DOCS)
        chunks = np.array(self.chunks, _CHUNKS)
        self.out.write(zstandard.compress(struct.pack("<QQQQQ", *self.place, len(chunks), len(docs)) + chunks.tobytes() + docs.tobytes()))
        self.out.write(struct.pack("<Q", self.at) + MAGIC)


class ShardReader:
    """Random access by the chunk index, or documents one after another."""

    def __init__(self, source):
        """``source``: a file that can seek."""
        self.source, size = source, source.seek(0, io.SEEK_END) - len(END)
        source.seek(max(0, size - 16))
        offset, magic, end = struct.unpack("<Q8s1s", source.read(16 + len(END)).rjust(16 + len(END)))
        if magic != MAGIC or end != END:
            raise ValueError("not a token shard")
        source.seek(offset)
        footer = zstandard.decompress(source.read(size - 16 - offset))
        self.task, self.number, self.first, n_chunks, n_docs = struct.unpack_from("<QQQQQ", footer)
        self.chunks = np.frombuffer(footer, _CHUNKS, n_chunks, 40)
        self.docs = np.frombuffer(footer, _DOCS, n_docs, 40 + n_chunks * _CHUNKS.itemsize)
        self.end = offset

    def chunk(self, i: int) -> np.ndarray:
        start = int(self.chunks["offset"][i])
        end = int(self.chunks["offset"][i + 1]) if i + 1 < len(self.chunks) else self.end
        self.source.seek(start)
        return unpack_block(self.source.read(end - start))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop`` of this shard, decoding only the blocks that hold them."""
        first = int(np.searchsorted(self.chunks["first"], start, "right")) - 1
        parts = []
        for i in range(max(first, 0), len(self.chunks)):
            at = int(self.chunks["first"][i])
            if at >= stop:
                break
            parts.append(self.chunk(i)[max(0, start - at) : stop - at])
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")

    def parts(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document's number, a run of its ids, whether it ends here), block by block."""
        doc, left = 0, int(self.docs["n"][0]) if len(self.docs) else 0
        for i in range(len(self.chunks)):
            ids, at = self.chunk(i), 0
            while at < len(ids):
                while left == 0:
                    yield doc, ids[:0], True
                    doc += 1
                    left = int(self.docs["n"][doc])
                take = min(left, len(ids) - at)
                left -= take
                yield doc, ids[at : at + take], left == 0
                at += take
                if left == 0 and doc + 1 < len(self.docs):
                    doc += 1
                    left = int(self.docs["n"][doc])
                elif left == 0:
                    return
        while doc < len(self.docs) and left == 0 and not len(self.chunks):
            yield doc, np.zeros(0, "<u4"), True
            doc += 1


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, block: int, bits: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """ROWS rows for each shard of a task, of about equal texts; what a text that is longer than a shard has beyond that is in the last one."""
    task, number, first = TaskContext.get().partitionId(), 0, 0
    model, begun, size, row = loaded(path, True), 0, 0, 0
    out = io.BytesIO()
    writer = ShardWriter(out, block, bits, task)

    def handed(rows: list[bytes]) -> pa.RecordBatch:
        out.seek(0)
        out.truncate()
        writer.at += len(END) * len(rows)
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    def rest() -> Iterator[pa.RecordBatch]:
        if row < ROWS - 1:
            yield handed([out.getvalue(), *[b""] * (ROWS - 2 - row)])
        writer.close()
        yield handed([out.getvalue()])

    for batch in batches:
        for at, raw, offsets, whole in token_parts(batch.column(1), model.cuts):
            ids, n = model.run(raw, offsets)
            size += len(raw) + DOC_BYTES * len(n)
            if not whole:
                begun += len(ids)
                writer.add(ids, np.zeros(0, _DOCS))
                if row < ROWS - 1 and size * ROWS >= (row + 1) * shard_bytes:
                    yield handed([out.getvalue()])
                    row += 1
                continue
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(n), end_id)
                n = n + 1
            docs = np.zeros(len(n), _DOCS)
            key = batch.column(0).slice(at, len(n))
            docs["id"], docs["null"], docs["n"] = key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), n
            docs["n"][0] += begun
            begun = 0
            writer.add(ids, docs)
            if size >= shard_bytes:
                yield from rest()
                number, first, size, row = number + 1, first + writer.total, 0, 0
                writer = ShardWriter(out, block, bits, task, number, first)
            elif row < ROWS - 1 and size * ROWS >= (row + 1) * shard_bytes:
                yield handed([out.getvalue()])
                row += 1
    if writer.docs:
        yield from rest()


def write_shards(docs: DataFrame, uri: str, path: str, end_id: int | None = 2, block: int = BLOCK, bits: int = 8, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, task_bytes: int = TASK_BYTES) -> None:
    """Encode every whole text and write shards in ascending order of ``id_col`` into the folder ``uri``.

    Rows are dealt by range to tasks of about ``task_bytes`` of text, each of which
    writes shards of about ``shard_bytes``. A null id comes first, rows of equal
    ids are ordered by a hash of their text, a null text is empty, repeated rows
    are written each; other columns are ignored. A very long text is encoded in
    parts and makes its shard longer. An empty table gives no shard.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + DOC_BYTES).alias("n")).first()["n"] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))
    rows = rows.repartitionByRange(tasks, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    shards = small_batches(rows).mapInArrow(partial(_write, path=path, end_id=end_id, block=block, bits=bits, shard_bytes=shard_bytes), "value binary")
    shards.select(F.col("value").cast("string").alias("value")).write.mode("overwrite").option("lineSep", END.decode()).option("maxRecordsPerFile", ROWS).text(uri)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            reader = ShardReader(pa.BufferReader(content.as_buffer()))
            crc, out = 0, np.zeros(len(reader.docs), np.int64)
            for doc, ids, ends in reader.parts():
                crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
                if ends:
                    out[doc], crc = crc, 0
            n = reader.docs["n"].astype(np.int64)
            key = pa.array(reader.docs["id"].astype(np.int64), mask=reader.docs["null"].astype(bool))
            whole = pa.RecordBatch.from_arrays([pa.array(np.full(len(n), reader.task, np.int64)), key, pa.array(reader.first + np.cumsum(n) - n), pa.array(n), pa.array(out)], ["task", "doc_id", "at", "n_tokens", "ids_crc32"])
            for i in range(0, len(whole), 10_000):
                yield whole.slice(i, 10_000)


def read_shards(spark: SparkSession, uri: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files under ``uri``.

    What is decoded is written as a narrow table; the ids of each task, a row for
    each, come to the driver to add up where tasks start.
    """
    stage = Stage(spark, "index")
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(uri).where("length > 0").select("content")
    docs = stage.put(small_batches(files).mapInArrow(_read, "task long, doc_id long, at long, n_tokens long, ids_crc32 long"), "docs")
    before, starts = 0, []
    for r in sorted(docs.groupBy("task").agg(F.max(F.col("at") + F.col("n_tokens")).alias("n")).collect()):
        starts.append((r["task"], before))
        before += r["n"]
    starts = F.broadcast(of_longs(spark, starts, "task", "first"))
    return docs.join(starts, "task").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, path: str, end_id: int | None = 2, block: int = BLOCK, bits: int = 8, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write shards into the shared folder and read them back."""
    spark = docs.sparkSession
    uri = Stage(spark, "shards").path("ids")
    write_shards(docs, uri, path, end_id, block, bits, shard_bytes=shard_bytes)
    return read_shards(spark, uri)


__all__ = ["BLOCK", "ShardReader", "ShardWriter", "pack_block", "read_shards", "token_shards", "unpack_block", "write_shards"]
