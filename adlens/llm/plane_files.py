"""Token-id files of shuffled planes (operator 8).

File: magic; chunk data; then a footer of two zstandard frames (document table, chunk
index) and a trailer with their sizes. Ids are cut into chunks of ``block`` ids; a chunk
is transposed into byte planes (all lowest bytes, then the next, ...) or bit planes (all
lowest bits, ...), as many as its largest id needs, and each plane is one zstandard
frame. The chunk index holds (offset, ids, kind, planes, sizes of the planes), so a
reader fetches any range of ids by reading only the chunks it touches.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import open_file, partitions, staged, write_file
from adlens.llm.tokens import encoder
from adlens.session import scratch_path

MAGIC = b"IDPLANE1"
_TRAILER = struct.Struct("<qqqq8s")  # documents, ids, bytes of document table, bytes of chunk index, magic
_NO_ID = -(1 << 63)  # doc_id of a null in the document table


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of uint32 ids, lowest first; only as many as the largest id needs."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, k].tobytes() for k in range(-(-top // 8))]
    planes = []
    for k in range(top):
        planes.append(np.packbits((raw[:, k >> 3] >> (k & 7)) & 1, bitorder="little").tobytes())
    return planes


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """Inverse of :func:`to_planes`."""
    raw = np.zeros((n, 4), np.uint8)
    for k, p in enumerate(planes):
        if bits:
            raw[:, k >> 3] |= np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") << (k & 7)
        else:
            raw[:, k] = np.frombuffer(p, np.uint8)
    return raw.reshape(-1).view("<u4")


class Writer:
    """Yields a file's bytes for documents given in order; keeps one chunk in memory."""

    def __init__(self, block: int = 1 << 16, bits: bool = False, level: int = 3):
        self.block, self.bits, self.zstd = block, bits, zstandard.ZstdCompressor(level=level)
        self.docs: list[tuple[int, int]] = []
        self.index: list[bytes] = []
        self.at = len(MAGIC)
        self.ids = 0

    def _chunk(self, ids: np.ndarray) -> bytes:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.bits)]
        self.index.append(struct.pack(f"<qiBB{len(planes)}i", self.at, len(ids), self.bits, len(planes), *map(len, planes)))
        body = b"".join(planes)
        self.at += len(body)
        self.ids += len(ids)
        return body

    def write(self, docs: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[bytes]:
        yield MAGIC
        held: list[np.ndarray] = []
        n = 0
        for doc, ids in docs:
            self.docs.append((_NO_ID if doc is None else doc, len(ids)))
            held.append(ids)
            n += len(ids)
            if n >= self.block:
                whole = np.concatenate(held)
                cut = n - n % self.block
                for at in range(0, cut, self.block):
                    yield self._chunk(whole[at:at + self.block])
                held, n = [whole[cut:].copy()], n - cut
        if n:
            yield self._chunk(np.concatenate(held))
        table = self.zstd.compress(np.array(self.docs, "<i8").reshape(-1, 2).T.tobytes())
        index = self.zstd.compress(b"".join(self.index))
        yield table + index + _TRAILER.pack(len(self.docs), self.ids, len(table), len(index), MAGIC)


class Reader:
    """Documents or id ranges of one file."""

    def __init__(self, file):
        self.f = file
        size = file.size()
        self.f.seek(size - _TRAILER.size)
        n_docs, self.n_ids, t, x, magic = _TRAILER.unpack(self.f.read(_TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not an id-plane file, or cut off")
        self.f.seek(size - _TRAILER.size - x - t)
        unzip = zstandard.ZstdDecompressor().decompress
        table, index = unzip(self.f.read(t)), unzip(self.f.read(x))
        self.doc_ids, self.lengths = np.frombuffer(table, "<i8").reshape(2, n_docs)
        self.chunks = []
        at = first = 0
        while at < len(index):
            offset, n, bits, k = struct.unpack_from("<qiBB", index, at)
            sizes = struct.unpack_from(f"<{k}i", index, at + 14)
            self.chunks.append((first, n, offset, bool(bits), sizes))
            at += 14 + 4 * k
            first += n

    def chunk(self, i: int) -> np.ndarray:
        _, n, offset, bits, sizes = self.chunks[i]
        self.f.seek(offset)
        unzip = zstandard.ZstdDecompressor().decompress
        return from_planes([unzip(self.f.read(s)) for s in sizes], n, bits)

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop-1, reading only the chunks they lie in."""
        parts = [np.zeros(0, "<u4")]
        for i, (first, n, *_) in enumerate(self.chunks):
            if first < stop and first + n > start:
                parts.append(self.chunk(i)[max(0, start - first):stop - first])
        return np.concatenate(parts)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start in this file, ids, crc32 of the ids), one chunk in memory at a time."""
        i, held, first = -1, np.zeros(0, "<u4"), 0
        start = 0
        for doc, n in zip(self.doc_ids.tolist(), self.lengths.tolist()):
            at, crc = start, 0
            while at < start + n:
                while at >= first + len(held):
                    i += 1
                    first, held = self.chunks[i][0], self.chunk(i)
                stop = min(start + n, first + len(held))
                crc = zlib.crc32(held[at - first:stop - first].tobytes(), crc)
                at = stop
            yield (None if doc == _NO_ID else doc), start, n, crc
            start += n


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, block: int = 1 << 16,
              bits: bool = False, files: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into files under ``folder``.

    Returns the manifest (part, path, n_docs, n_ids, n_bytes), a written table: it names
    exactly one file per part, whatever tasks were run twice. Null doc_ids come first;
    rows that share a doc_id follow each other in the order of their texts' hashes.
    """
    files = files or partitions(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .repartitionByRange(files, *order).sortWithinPartitions(*order)
              .select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.spark_partition_id().alias("part")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        end = end_id.to_bytes(2, "little")
        writer, part = Writer(block, bits), []

        def ids():
            for b in batches:
                if not part and len(b):
                    part.append(int(b["part"].iloc[0]))
                for doc, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
                    yield None if doc is None else int(doc), np.frombuffer(enc.ids(text) + end, "<u2").astype("<u4")

        path, size = write_file(folder, "ids", writer.write(ids()))
        if part:
            yield pd.DataFrame({"part": part, "path": [path], "n_docs": [len(writer.docs)], "n_ids": [writer.ids], "n_bytes": [size]})

    return staged(ranged.mapInPandas(run, "part int, path string, n_docs long, n_ids long, n_bytes long"), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    One row per file goes through the window that carries the starts forward; a task
    reads one file at a time, chunk by chunk.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = staged(manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
                   .repartition(partitions(manifest.sparkSession), "part"), "files")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, base in zip(b["path"], b["base"]):
                with open_file(path) as f:
                    rows = [(None if d is None else str(d), base + s, n, c) for d, s, n, c in Reader(f).documents()]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    back = files.select("path", "base").mapInPandas(run, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return back.withColumn("doc_id", F.col("doc_id").cast("long"))  # text until here: pandas makes ids with nulls floats


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, bits: bool = False) -> DataFrame:
    """Write the ids of ``docs`` and read every document back from the files."""
    folder = scratch_path(docs.sparkSession, "llm-ids")
    return read_ids(write_ids(docs, tokenizer, folder, end_id, bits=bits))
