"""Files of token ids in independent zstandard frames.

A file is a row of zstandard frames, one per document, then two skippable frames:
the documents' ids, and the seek table of the public seekable format (sizes and the
low half of XXH64 of each frame's content). Any zstandard reader gives all ids of a
file; with the tables, a reader decompresses only the documents it wants.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandwatch.llm.stage import id_and_text, staged
from bandwatch.llm.tokenizing import BYTE_BPE, encoder, vocabulary
from bandwatch.llm.tokenizing import ROWS as TEXTS
from bandwatch.session import work_dir

SKIPPABLE = 0x184D2A50  # fixed values of the zstandard frame and seekable formats
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
INDEX_TAIL = 8  # length of the index frame's content, kept at its end so that it is found from the seek table
MANIFEST = "part int, path string, n_docs long, n_tokens long"
ROWS = 500


class TokenFileWriter:
    def __init__(self, out, width: int, level: int = 3):
        self.out, self.width, self.pack = out, width, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.ids: list[int | None] = []
        self.table = bytearray()
        self.n_tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.pack.compress(raw)
        self.out.write(frame)
        self.table += struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
        self.ids.append(doc_id)
        self.n_tokens += len(ids)

    def finish(self) -> None:
        known = np.array([x is not None for x in self.ids], "u1").tobytes()
        body = self.pack.compress(np.array([x or 0 for x in self.ids], "<i8").tobytes() + known)
        content = struct.pack("<I", self.width) + body + struct.pack("<Q", len(body) + 4 + INDEX_TAIL)
        self.out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        tail = bytes(self.table) + struct.pack("<IBI", len(self.ids), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(tail)) + tail)


class TokenFileReader:
    """``file`` is seekable; nothing but the tables is read before a document is asked for."""

    def __init__(self, file, size: int):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a token file")
        table_at = size - 9 - 12 * n
        self.table = np.frombuffer(self._at(table_at, 12 * n), "<u4").reshape(n, 3)
        index_end = table_at - 8
        (length,) = struct.unpack("<Q", self._at(index_end - INDEX_TAIL, INDEX_TAIL))
        content = self._at(index_end - length, length)
        (self.width,) = struct.unpack_from("<I", content)
        raw = self.unpack.decompress(content[4:-INDEX_TAIL])
        ids, known = np.frombuffer(raw[: 8 * n], "<i8").tolist(), raw[8 * n:]
        self.doc_ids = [x if k else None for x, k in zip(ids, known)]
        self.places = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype="i8")])
        self.lengths = self.table[:, 1].astype("i8") // self.width

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def tokens(self, i: int) -> np.ndarray:
        """Ids of the ``i``-th document; raises if its frame is damaged."""
        raw = self.unpack.decompress(self._at(int(self.places[i]), int(self.table[i, 0])), max_output_size=int(self.table[i, 1]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(self.table[i, 2]):
            raise ValueError(f"checksum of document {self.doc_ids[i]} differs")
        return np.frombuffer(raw, f"<u{self.width}")


def write_token_files(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode whole texts, write them in ascending doc_id order, and return the manifest of the files written.

    ``path`` is a folder that all executors and readers reach (default: a new one in the shared folder). A task
    writes a file of its own name and only files of finished tasks are in the manifest, so a repeated task does no
    harm. Files in order of ``part`` hold the documents in order. Null text counts as empty; an empty text has the
    end id only; a null doc_id comes first; rows with one doc_id come in the order of their texts; an empty table
    writes no file.
    """
    tokenizer = tokenizer or vocabulary(BYTE_BPE)
    path = path or work_dir(docs.sparkSession, "tokens")
    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        code = encoder(tokenizer)
        width = 2 if max(code.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        last = struct.pack("<I", end_id)
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                for doc_id, ids in zip(part.column(0).to_pylist(), code.encode_all(part.column(1))):
                    if writer is None:
                        store, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                        store.create_dir(folder, recursive=True)
                        number = TaskContext.get().partitionId()
                        name = f"part-{number:06d}-{uuid.uuid4().hex}.zst"
                        out = store.open_output_stream(f"{folder}/{name}", compression=None)
                        writer = TokenFileWriter(out, width)
                    writer.add(doc_id, np.frombuffer(ids + last, "<u4"))
        code.settle()
        if writer is not None:
            writer.finish()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([number], pa.int32()), "path": [f"{path}/{name}"],
                "n_docs": pa.array([len(writer.ids)], pa.int64()), "n_tokens": pa.array([writer.n_tokens], pa.int64())})

    return staged(ordered.mapInArrow(write, MANIFEST), "token-files")


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None, digest: bool = False) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all documents before it), n_tokens, ids.

    Only frames of ``doc_ids`` are decompressed when given. ``digest`` gives ids_crc32 in place of the ids.
    The running start over files is a window over the manifest, one row per file.
    """
    wanted = None if doc_ids is None else set(doc_ids)
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("path", before.cast("long").alias("start"))
    kind = pa.int64() if digest else pa.list_(pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                with store.open_input_file(name) as file:
                    reader = TokenFileReader(file, file.size())
                    starts = start + np.concatenate([[0], np.cumsum(reader.lengths)])
                    which = [i for i, d in enumerate(reader.doc_ids) if wanted is None or d in wanted]
                    for k in range(0, len(which), ROWS):
                        some = which[k:k + ROWS]
                        ids = [reader.tokens(i) for i in some]
                        out = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids] if digest else ids
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([reader.doc_ids[i] for i in some], pa.int64()), pa.array(starts[some], pa.int64()),
                             pa.array(reader.lengths[some], pa.int64()), pa.array(out, kind)],
                            ["doc_id", "start", "n_tokens", "ids"])

    spread = files.repartition(max(1, manifest.count()))  # a row per file, dealt out evenly
    last = "long" if digest else "array<long>"
    read_back = spread.mapInArrow(read, f"doc_id long, start long, n_tokens long, ids {last}")
    return read_back.withColumnRenamed("ids", "ids_crc32" if digest else "ids")


def open_token_files(spark: SparkSession, manifest_path: str) -> DataFrame:
    """A stored manifest."""
    return spark.read.schema(MANIFEST).parquet(manifest_path)
