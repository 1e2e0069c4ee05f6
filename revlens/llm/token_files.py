"""Token ids in binary files that give single documents without reading the rest.

A file is a row of independent zstandard frames and a trailing seek table, in the
public seekable layout: any zstandard tool decompresses it, and a reader that wants
some documents reads the table, the index and the frames that hold them.

    frame 0 .. n-1   ids of the documents, one after the other, little-endian uint32,
                     at most ``frame_bytes`` of them each (a long document spans
                     frames, short ones share one)
    frame n          the index: documents (int64), then per document doc_id (int64),
                     whether it is null (uint8) and where its ids end (int64, in ids)
    skippable frame  per frame: compressed size, size, checksum (the low 32 bits of
                     XXH64 of its content), each little-endian uint32; then the
                     footer: frames (uint32), descriptor (0x80: with checksums), magic

``_files.json`` lists a table's files in order, with their documents and ids. It is
written last and names only the files of tasks that succeeded: without it there is no
table, and files of lost or repeated attempts are never read.

Spark writes and reads the files by the data source ``token_frames``; Spark sorts,
deals out and retries the work, a task writes one file in bounded memory.
"""

from __future__ import annotations

import json
import struct
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from revlens.llm.common import blocks, importable, keyed, strings
from revlens.llm.tokens import part_tokens, word_ids
from revlens.session import ensure_checkpoint_dir

#: Bytes of ids in a frame, before compression.
FRAME_BYTES = 1 << 18
#: Bytes of text whose distinct parts are encoded once.
BLOCK_BYTES = 4 << 20
#: Bytes of ids that a reader gives at a time (one document at least).
BATCH_BYTES = 4 << 20

# fixed values: the public seekable format of zstandard
SKIPPABLE, SEEKABLE, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
FOOTER = struct.Struct("<IBI")

LIST = "_files.json"
IDS = "doc_id long, token_ids binary"
ROWS = "doc_id long, start long, n_tokens long, token_ids binary"


def checksum(data) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def store(path: str):
    """(file system, path in it): a local path or any URI that Arrow knows."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class FrameWriter:
    """Writes one file to an open binary sink; holds a frame of ids and the index."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES):
        import zstandard

        if frame_bytes < 4 or frame_bytes % 4 or frame_bytes >= 1 << 32:
            raise ValueError(f"frame_bytes: {frame_bytes}")
        self.sink, self.frame_bytes = sink, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.buffer = bytearray()
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def _frame(self, data: bytes) -> None:
        packed = self.zstd.compress(data)
        self.sink.write(packed)
        self.entries.append((len(packed), len(data), checksum(data)))

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids) -> None:
        """Documents in order: their ids' counts, and all their ids as bytes."""
        self.doc_ids.append(doc_ids.astype("<i8"))
        self.nulls.append(nulls.astype("u1"))
        self.counts.append(counts.astype("<i8"))
        view = memoryview(ids)
        at = 0
        while at < len(view):
            take = min(len(view) - at, self.frame_bytes - len(self.buffer))
            self.buffer += view[at : at + take]
            at += take
            if len(self.buffer) == self.frame_bytes:
                self._frame(bytes(self.buffer))
                self.buffer.clear()

    def close(self) -> dict:
        """Write what is left, the index and the seek table; the file's figures."""
        if self.buffer:
            self._frame(bytes(self.buffer))
        none = np.zeros(0)
        doc_ids, nulls = np.concatenate([none.astype("<i8"), *self.doc_ids]), np.concatenate([none.astype("u1"), *self.nulls])
        ends = np.cumsum(np.concatenate([none.astype("<i8"), *self.counts]), dtype="<i8")
        self._frame(struct.pack("<q", len(doc_ids)) + doc_ids.tobytes() + nulls.tobytes() + ends.tobytes())
        table = np.array(self.entries, dtype=ENTRY).tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER.size) + table)
        self.sink.write(FOOTER.pack(len(self.entries), WITH_CHECKSUMS, SEEKABLE))
        known = doc_ids[nulls == 0]
        return {
            "documents": len(doc_ids), "ids": int(ends[-1]) if len(ends) else 0, "nulls": int(nulls.sum()),
            "least": int(known.min()) if len(known) else None, "most": int(known.max()) if len(known) else None,
        }


class FrameReader:
    """Reads one file through an open, seekable binary source; counts what it unpacks."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.zstd, self.unpacked = source, zstandard.ZstdDecompressor(), 0
        source.seek(size - FOOTER.size)
        frames, descriptor, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE or not descriptor & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums")
        length = frames * ENTRY.itemsize
        source.seek(size - FOOTER.size - length - 8)
        head = struct.unpack("<II", source.read(8))
        if head != (SKIPPABLE, length + FOOTER.size):
            raise ValueError("the seek table's length is wrong")
        self.table = np.frombuffer(source.read(length), dtype=ENTRY)
        self.at = np.r_[0, np.cumsum(self.table["packed"], dtype=np.int64)]
        self.ends = np.cumsum(self.table["size"][:-1], dtype=np.int64)
        index = self.frame(frames - 1)
        (n,) = struct.unpack_from("<q", index)
        self.doc_ids = np.frombuffer(index, "<i8", n, 8)
        self.nulls = np.frombuffer(index, "u1", n, 8 + 8 * n)
        self.stops = np.frombuffer(index, "<i8", n, 8 + 9 * n)
        self.starts = np.r_[0, self.stops[:-1]].astype(np.int64)
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        """The content of a frame, checked against its checksum."""
        entry = self.table[i]
        self.source.seek(int(self.at[i]))
        data = self.zstd.decompress(self.source.read(int(entry["packed"])), max_output_size=int(entry["size"]))
        if len(data) != entry["size"] or checksum(data) != entry["checksum"]:
            raise ValueError(f"frame {i} is damaged")
        self.unpacked += 1
        return data

    def ids(self, a: int, b: int) -> bytes:
        """The ids numbered a to b of the file, as bytes, from the frames that hold them."""
        a, b = 4 * a, 4 * b
        out, i = [], int(np.searchsorted(self.ends, a, side="right"))
        while a < b:
            if self._last[0] != i:
                self._last = (i, self.frame(i))
            first = int(self.ends[i]) - int(self.table["size"][i])
            stop = min(b, int(self.ends[i]))
            out.append(self._last[1][a - first : stop - first])
            a, i = stop, i + 1
        return out[0] if len(out) == 1 else b"".join(out)


# --- the data source ---------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    name: str
    figures: dict


class TokenFrameWriter(DataSourceArrowWriter):
    def __init__(self, path: str, frame_bytes: int, overwrite: bool):
        self.path, self.frame_bytes = path.rstrip("/"), frame_bytes
        files, root = store(self.path)
        if not overwrite and files.get_file_info(f"{root}/{LIST}").is_file:
            raise FileExistsError(self.path)

    def write(self, iterator):
        files, root = store(self.path)
        files.create_dir(root, recursive=True)
        name = f"ids-{uuid.uuid4().hex}.zst"  # an attempt's own: repeated tasks never meet
        with files.open_output_stream(f"{root}/{name}", compression=None) as sink:
            out = FrameWriter(sink, self.frame_bytes)
            for batch in iterator:
                docs, ids = batch.column(0), batch.column(1)
                if ids.null_count:
                    raise ValueError("token_ids is null")
                offsets, data = strings(ids)
                doc_ids = np.asarray(docs.fill_null(0), dtype=np.int64)
                out.add(doc_ids, np.asarray(docs.is_null().to_numpy(zero_copy_only=False)), np.diff(offsets) // 4, data[offsets[0] : offsets[-1]])
            figures = out.close()
        return Written(name, figures)

    def commit(self, messages):
        listed = [{"name": m.name, **m.figures} for m in messages if m is not None and m.figures["documents"]]
        files, root = store(self.path)
        files.create_dir(root, recursive=True)
        draft = f"{root}/{LIST}.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as sink:
            sink.write(json.dumps(listed, indent=0).encode())
        files.move(draft, f"{root}/{LIST}")

    def abort(self, messages):
        files, root = store(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{root}/{m.name}")


@dataclass
class OneFile(InputPartition):
    name: str
    base: int  # ids in the files before it


class TokenFrameReader(DataSourceReader):
    def __init__(self, path: str, doc_ids: list[int] | None):
        self.path, self.wanted = path.rstrip("/"), doc_ids

    def partitions(self):
        files, root = store(self.path)
        with files.open_input_file(f"{root}/{LIST}") as source:
            listed = json.loads(source.read())
        out, base = [], 0
        for f in listed:
            if self.wanted is None or (f["least"] is not None and any(f["least"] <= d <= f["most"] for d in self.wanted)):
                out.append(OneFile(f["name"], base))
            base += f["ids"]
        return out

    def read(self, partition):
        import pyarrow as pa

        if partition is None:  # a table without documents
            return
        files, root = store(self.path)
        name = f"{root}/{partition.name}"
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("token_ids", pa.binary())])
        with files.open_input_file(name) as source:
            file = FrameReader(source, files.get_file_info(name).size)
            rows = np.arange(len(file.doc_ids))
            if self.wanted is not None:
                rows = rows[np.isin(file.doc_ids, self.wanted) & (file.nulls == 0)]
            sizes = np.cumsum(4 * (file.stops[rows] - file.starts[rows]))
            for a, b in blocks(np.r_[0, sizes], BATCH_BYTES):
                some = rows[a:b]
                ids = pa.array([file.ids(int(file.starts[r]), int(file.stops[r])) for r in some], pa.binary())
                docs = pa.array(file.doc_ids[some], mask=file.nulls[some] == 1)
                counts = file.stops[some] - file.starts[some]
                yield pa.RecordBatch.from_arrays([docs, pa.array(file.starts[some] + partition.base), pa.array(counts), ids], schema=schema)


class TokenFrames(DataSource):
    """``token_frames``: options ``frame_bytes`` (write) and ``doc_ids`` (read: only
    these documents, comma-joined; only their files are opened, only their frames
    unpacked)."""

    @classmethod
    def name(cls):
        return "token_frames"

    def schema(self):
        return ROWS

    def reader(self, schema):
        wanted = self.options.get("doc_ids")
        return TokenFrameReader(self.options["path"], None if wanted is None else [int(x) for x in wanted.split(",") if x])

    def writer(self, schema, overwrite):
        return TokenFrameWriter(self.options["path"], int(self.options.get("frame_bytes", FRAME_BYTES)), overwrite)


def write_token_files(tokens: DataFrame, path: str, frame_bytes: int = FRAME_BYTES) -> None:
    """Write (doc_id, token_ids as little-endian uint32 bytes) under ``path``, one file
    per partition, rows in the order they have. The driver keeps one entry per file."""
    importable(tokens.sparkSession)
    tokens.sparkSession.dataSource.register(TokenFrames)
    tokens.select(F.col("doc_id").cast("long"), "token_ids").write.format("token_frames").option("frame_bytes", frame_bytes).mode("append").save(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, token_ids; all of a
    table, or some documents (no rows for ids that it lacks)."""
    importable(spark)
    spark.dataSource.register(TokenFrames)
    read = spark.read.format("token_frames")
    if doc_ids is not None:
        read = read.option("doc_ids", ",".join(map(str, doc_ids)))
    return read.load(path)


# --- documents to files --------------------------------------------------------------

def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id and token_ids of each row, in the rows' order: the text's ids, then ``end_id``."""

    def run(batches):
        import pyarrow as pa

        tokens = part_tokens(tokenizer_path)
        for batch in batches:
            text = batch.column(1)
            for a, b in blocks(strings(text)[0], BLOCK_BYTES):
                counts, ids = word_ids(text.slice(a, b - a), tokens)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4", copy=False)
                ends = np.r_[0, np.cumsum(4 * (counts + 1))]
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), binary.cast(pa.binary())], names=["doc_id", "token_ids"])

    return docs.select("doc_id", "text").mapInArrow(run, IDS)


def by_doc_id(docs: DataFrame) -> DataFrame:
    """doc_id and text in ascending doc_id order over ranges, null ids first.

    Rows of one id are told apart by their text's digest and equal rows by their place,
    so an id or a row that a third of the table repeats is spread over ranges too.
    ``docs`` must give the same rows when read again, as a scan of files does.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("tid").asc(), F.col("place").asc()]
    rows = keyed(docs).select("doc_id", "tid", F.monotonically_increasing_id().alias("place"), "text")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def op12_token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Ids of every whole text (null: empty) and id 2, written in ascending doc_id order
    and read back: doc_id, start, n_tokens, ids_crc32.

    A null doc_id stays null and comes first; repeated rows are documents of their own,
    one after the other; an empty table gives files without documents and no rows;
    other columns are left behind.
    """
    import public_tokenizers

    importable(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/token-files-{uuid.uuid4().hex}"
    write_token_files(token_ids(by_doc_id(docs), public_tokenizers.path("word_bpe_49k.json"), end_id=2), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))
