"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds a range of keys in ascending order: one frame for each document, a skippable frame with the documents' keys and
token counts, and the seek table of the zstandard seekable format (sizes and a checksum for every frame). A reader takes the
table from the file's end and decompresses the documents it wants; any zstandard tool can read the file as a whole.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import chunks, text_of, written
from eventlake.llm.tokens import CHUNK, encoder

END, LEVEL, SLICE = 0, 3, 1024
#: Documents of a file, which bound what a writer and a reader hold; ids that a reading task is meant to get, and most of these tasks.
FILE_DOCS, READ_IDS, READ_TASKS = 1 << 16, 1 << 23, 20_000
#: Words that the encoder remembers: with 300,000 an executor passed 3,000 MB on large groups of copies.
REMEMBERED_WORDS = 240_000
# Fixed values of the zstandard seekable format: skippable frames' magic numbers, the table's, its flag for checksums.
SKIPPABLE, SEEK_TABLE, SEEKABLE, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class Writer:
    """One file. Frames go to the store as they come; only sizes, checksums, keys and counts are held."""

    def __init__(self, path: str):
        store, place = _store(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out, self.entries, self.keys, self.counts = store.open_output_stream(place, compression=None), [], [], []
        self.codec = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        raw = ids.astype("<u2").tobytes()
        frame = self.codec.compress(raw)
        self.out.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.keys.append(key)
        self.counts.append(len(ids))

    def close(self) -> None:
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        index = self.codec.compress(known.tobytes() + keys.tobytes() + np.array(self.counts, "<i8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.entries.append((len(index) + 8, 0, 0))
        table = b"".join(_ENTRY.pack(*e) for e in self.entries) + _FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Random access to the documents of a file."""

    def __init__(self, path: str):
        store, place = _store(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        entries, flags, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        table = self.file.read_at(_ENTRY.size * entries, size - _FOOTER.size - _ENTRY.size * entries)
        self.entries = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.cumsum(self.entries[:, 0]) - self.entries[:, 0]
        index = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.entries[-1, 0]) - 8, int(self.starts[-1]) + 8))
        n = len(self.entries) - 1
        known, self.counts = np.frombuffer(index[:n], np.uint8), np.frombuffer(index[9 * n :], "<i8")
        self.keys = [k if there else None for k, there in zip(np.frombuffer(index[n : 9 * n], "<i8").tolist(), known, strict=True)]

    def ids(self, place: int) -> np.ndarray:
        """The ids of one document; its frame alone is read, and held against its checksum."""
        size, length, checksum = (int(x) for x in self.entries[place])
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(size, int(self.starts[place])), max_output_size=max(1, length))
        if len(raw) != length or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"document {place} differs from its checksum")
        return np.frombuffer(raw, "<u2")


def write(docs: DataFrame, folder: str, tokenizer: str, *, key: str = "doc_id", text: str = "text", end: int = END, file_docs: int = FILE_DOCS) -> DataFrame:
    """Write all rows in ascending order of the key, NULL keys first, ties by text. Returns the files in order: part, file, docs, tokens.

    The table of files is written after the files and names those of the attempts that succeeded: what a lost executor
    leaves behind is never read.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path, number = None, None, 0

        def closed() -> pa.RecordBatch:
            writer.close()
            part = (TaskContext.get().partitionId() << 24) + number
            return pa.RecordBatch.from_pydict({"part": [part], "file": [path], "docs": [len(writer.counts)], "tokens": [sum(writer.counts)]})

        for part in (c for batch in batches for c in chunks(batch, "text", CHUNK)):
            for row, raw in zip(part.column("key").to_pylist(), encoder(tokenizer, REMEMBERED_WORDS).tokenized(part.column("text")), strict=True):
                if writer is None:
                    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zst"
                    writer = Writer(path)
                writer.add(row, np.append(np.frombuffer(raw, np.uint16), np.uint16(end)))
                if len(writer.counts) == file_docs:
                    yield closed()
                    writer, number = None, number + 1
        if writer:
            yield closed()

    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text")).repartitionByRange(F.asc_nulls_first("key"))
    ordered = rows.sortWithinPartitions(F.asc_nulls_first("key"), "text")
    return written(ordered.mapInArrow(put, "part long, file string, docs long, tokens long"), "files")


def read(files: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, part, place."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                reader = Reader(job["file"])
                places = range(job["first"], min(job["first"] + SLICE, len(reader.counts)))
                before = np.cumsum(reader.counts) - reader.counts + job["before"]
                ids = [reader.ids(p) for p in places]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([reader.keys[p] for p in places], pa.int64()),
                    "start": pa.array(before[list(places)], pa.int64()),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    "part": pa.array([job["part"]] * len(ids), pa.int64()),
                    "place": pa.array(list(places), pa.int64()),
                })

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    jobs = files.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    slices = jobs.select("part", "file", "before", F.explode(F.expr(f"sequence(0L, docs - 1, {SLICE}L)")).alias("first"))
    facts = files.agg(F.sum("tokens").alias("tokens")).first()["tokens"] or 0
    tasks = min(READ_TASKS, -(-facts // READ_IDS) or 1)
    return slices.repartition(tasks, "file", "first").mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long, part long, place long")


def round_trip(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write the files, read every document back. A NULL text is empty: its frame holds the end id alone. An empty table gives no rows."""
    return read(write(docs, folder, tokenizer))
