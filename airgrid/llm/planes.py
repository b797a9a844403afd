"""Token ids as files of bit or byte planes.

A file holds the ids of documents in a row, cut into blocks of BLOCK ids without regard to documents. Each block's
ids (32 bits, little endian) are transposed into 4 byte planes or 32 bit planes, and each plane is compressed by
itself with zstandard; a plane of zeros takes no room. Behind the blocks stands the chunk index: where each block
begins, its id count and plane sizes, and the documents' ids and token counts, so a reader finds any document's
blocks without reading others. A file ends with the index's place and the magic word.
"""

import posixpath
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airgrid.llm.common import steps, to_batch
from airgrid.llm.pieces import encoder
from airgrid.session import Workspace

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
FILE_IDS = 1 << 23
LEVEL = 3
#: Bytes of text that a task encodes together, about; a longer text is a step of its own.
ENCODED_TOGETHER = 1 << 21


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """`ids`: unsigned 32-bit. Planes from the lowest byte or bit to the highest, compressed; zeros become b""."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "bit":
        bits = np.unpackbits(by_byte[:, :, None], axis=2, bitorder="little")  # byte, id, bit
        planes = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1)
    else:
        planes = by_byte
    press = zstandard.ZstdCompressor(level=LEVEL).compress
    return [press(p.tobytes()) if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    size = -(-n // 8) if kind == "bit" else n
    out = np.zeros((len(planes), size), np.uint8)
    for row, plane in zip(out, planes, strict=True):
        if plane:
            row[:] = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane, max_output_size=size), np.uint8)
    if kind == "bit":
        bits = np.unpackbits(out, axis=1, count=n).reshape(4, 8, n).transpose(0, 2, 1)
        out = np.packbits(bits, axis=2, bitorder="little")[:, :, 0]
    return np.ascontiguousarray(out.T).view("<u4")[:, 0]


class PlaneWriter:
    """Takes documents in order; holds one block at most besides the document at hand."""

    def __init__(self, sink, kind: str):
        self.sink, self.kind, self.at = sink, kind, 0
        self.rest, self.n_rest = [], 0
        self.chunks, self.docs = [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.rest.append(ids)
        self.n_rest += len(ids)
        if self.n_rest >= BLOCK:
            held = np.concatenate(self.rest)
            full = len(held) // BLOCK * BLOCK
            for begin in range(0, full, BLOCK):
                self._block(held[begin : begin + BLOCK])
            self.rest, self.n_rest = [held[full:]], len(held) - full

    def _block(self, ids: np.ndarray) -> None:
        planes = to_planes(ids, self.kind)
        self.chunks.append([self.at, len(ids), *map(len, planes)])
        self._put(b"".join(planes))

    def close(self) -> int:
        """Write what is left and the index; the number of ids."""
        if self.n_rest:
            self._block(np.concatenate(self.rest))
        n_planes = 32 if self.kind == "bit" else 4
        table = np.array(self.chunks, "<i8").reshape(-1, 2 + n_planes)
        null = np.array([d is None for d, _ in self.docs], np.uint8)
        numbers = np.array([(d or 0, n) for d, n in self.docs], "<i8").reshape(-1, 2)
        index = struct.pack("<qqq", n_planes, len(table), len(numbers)) + table.tobytes() + numbers.tobytes() + null.tobytes()
        index, begin = zstandard.ZstdCompressor(level=LEVEL).compress(index), self.at
        self._put(index)
        self._put(struct.pack("<qq", begin, len(index)) + MAGIC)
        return int(numbers[:, 1].sum())


class PlaneReader:
    """`data`: a file's bytes."""

    def __init__(self, data):
        self.data = memoryview(data)
        begin, size, magic = struct.unpack("<qq8s", self.data[-24:])
        if magic != MAGIC:
            raise ValueError("not a plane file, or cut short")
        index = zstandard.ZstdDecompressor().decompress(self.data[begin : begin + size])
        n_planes, n_chunks, n_docs = struct.unpack("<qqq", index[:24])
        self.kind, at = "bit" if n_planes == 32 else "byte", 24 + n_chunks * (2 + n_planes) * 8
        self.chunks = np.frombuffer(index[24:at], "<i8").reshape(n_chunks, 2 + n_planes)
        self.docs = np.frombuffer(index[at : at + n_docs * 16], "<i8").reshape(n_docs, 2)
        self.null = np.frombuffer(index[at + n_docs * 16 :], np.uint8).astype(bool)
        self.starts = np.cumsum(self.docs[:, 1]) - self.docs[:, 1]

    def chunk(self, k: int) -> np.ndarray:
        at, n, *sizes = map(int, self.chunks[k])
        edges = np.cumsum([at, *sizes])
        return from_planes([bytes(self.data[a:b]) for a, b in zip(edges, edges[1:])], n, self.kind)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids `begin` to `end` of the file, from the blocks that hold them only."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // BLOCK, (end - 1) // BLOCK
        held = np.concatenate([self.chunk(k) for k in range(first, last + 1)])
        return held[begin - first * BLOCK : end - first * BLOCK]

    def __iter__(self):
        """(doc_id, start in the file, ids) of each document; each block is opened once."""
        held, base, nxt = np.zeros(0, np.uint32), 0, 0
        for (doc, n), null, start in zip(self.docs.tolist(), self.null.tolist(), self.starts.tolist(), strict=True):
            parts = [held[start - base :]]
            have = len(parts[0])
            base = start
            while have < n:
                parts.append(self.chunk(nxt))
                have += len(parts[-1])
                nxt += 1
            held = np.concatenate(parts) if len(parts) > 1 else parts[0]
            yield None if null else doc, start, held[:n]


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def encode_documents(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, ids (unsigned 32-bit, pressed) of each row's whole text; the end id stands last."""

    def run(batches):
        encode = encoder(tokenizer, kind)
        for batch in steps(batches, "text", ENCODED_TOGETHER):
            texts = batch.column("text").to_pylist()
            found = [np.append(x, np.uint32(end_id)).astype("<u4").tobytes() for x in encode.encode(texts)]
            press = zstandard.ZstdCompressor(level=1).compress
            yield to_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": [len(x) // 4 for x in found],
                    "ids_crc32": [zlib.crc32(x) for x in found],
                    "ids": [press(_halves(x)) for x in found],
                },
                ENCODED,
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, ids binary")


def _halves(ids: bytes) -> bytes:
    """Ids on their way between tasks: the four bytes' planes in a row."""
    return np.ascontiguousarray(np.frombuffer(ids, np.uint8).reshape(-1, 4).T).tobytes()


def _unpressed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0]


def write_planes(encoded: DataFrame, folder: str, plane: str = "byte", file_ids: int = FILE_IDS) -> DataFrame:
    """Write `encoded` (a written stage) in ascending doc_id order (null first; equal ids by their tokens' crc) as
    files of about `file_ids` ids, in `folder`, which all executors reach. One row per file: file, path, n_ids.

    A file gets its name when it is whole, so a lost or repeated task leaves no half file under that name."""
    n_ids = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    ranged = encoded.repartitionByRange(max(1, -(-n_ids // file_ids)), "doc_id", "ids_crc32", "n_tokens")
    ranged = ranged.sortWithinPartitions("doc_id", "ids_crc32", "n_tokens")

    def run(batches):
        writer = None
        number = TaskContext.get().partitionId()
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        begun = posixpath.join(root, f"begun-{number:06d}-{uuid.uuid4().hex}")
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(begun)
                    writer = PlaneWriter(sink, plane)
                writer.add(doc_id, _unpressed(ids.as_py()))
        if writer is not None:
            n = writer.close()
            sink.close()
            done = posixpath.join(root, f"ids-{number:06d}.planes")
            if store.get_file_info(done).type != pyarrow.fs.FileType.NotFound:
                store.delete_file(done)
            store.move(begun, done)
            yield pa.RecordBatch.from_pydict({"file": [f"ids-{number:06d}.planes"], "n_ids": [n]})

    return ranged.select("doc_id", "ids").mapInArrow(run, "file string, n_ids long")


READ = pa.schema([
    ("file", pa.string()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())
])


def read_planes(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Per document of the files (`files`: file, n_ids): doc_id, start, n_tokens, ids_crc32, from the ids read back."""

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = [(doc, start, len(ids), zlib.crc32(ids.tobytes())) for doc, start, ids in PlaneReader(data.as_buffer())]
                doc, start, n, crc = zip(*rows, strict=True)
                name = [posixpath.basename(path)] * len(rows)
                yield to_batch({"file": name, "doc_id": doc, "start": start, "n_tokens": n, "ids_crc32": crc}, READ)

    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # over files, not documents
    places = files.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.planes").load(folder).select("path", "content")
        .mapInArrow(run, "file string, doc_id long, start long, n_tokens long, ids_crc32 long")
    )
    return found.join(places, "file").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def as_uri(spark: SparkSession, folder: str) -> str:
    """`folder` with the scheme that Spark writes it under, so that tasks write where Spark reads; local ones with the
    empty host that URIs have."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return found if "://" in found else found.replace("file:", "file://", 1)


def plane_report(docs: DataFrame, work: Workspace, tokenizer: str, kind: str = "word", end_id: int = 2, plane: str = "byte") -> DataFrame:
    """Encode, write, read back. A null text has the end id alone; repeated rows are written as often as they come;
    without any row no file is written and no row returned."""
    spark = docs.sparkSession
    encoded = work.keep(encode_documents(docs, tokenizer, kind, end_id), "encoded")
    folder = as_uri(spark, work.path("planes"))
    files = work.keep(write_planes(encoded, folder, plane), "files")
    work.drop(encoded)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_planes(spark, folder, files)
