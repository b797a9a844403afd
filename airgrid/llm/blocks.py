"""Many small rows of numbers, dealt by a hashed key in blocks.

A row is a 64-bit hash with a few numbers. Tasks sort what they have by hash and send a bucket's rows, a bucket being a
range of hashes, as one row of a binary per column; Spark shuffles these by bucket, and the tasks that get them work on
whole buckets in column operations. Equal hashes always meet in one task.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Ranges of hashes; their number is 2 to this power.
BUCKET_BITS = 10
#: Rows that a task sorts together before it sends them, and that it works on together where it gets them.
ROWS = 1 << 20
#: Bytes of blocks handed to Spark at once.
SENT = 1 << 22


def block_ddl(columns: int) -> str:
    return ", ".join(["bucket int", *(f"c{k} binary" for k in range(columns))])


def _schema(columns: int) -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), *((f"c{k}", pa.binary()) for k in range(columns))])


def _binaries(column: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of `column` between `edges`, a binary for each range."""
    begin, end = edges[0], edges[-1]
    offsets = ((edges - begin) * column.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(column[begin:end]))])


def _sent(columns: list[np.ndarray]):
    """Batches of the blocks of `columns`, which are sorted by the first one, a hash."""
    buckets = (columns[0] >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]])
    width = sum(c.itemsize for c in columns)
    at = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + SENT // width, "right")) - 1)
        some = edges[at : to + 1]
        yield pa.RecordBatch.from_arrays([pa.array(buckets[some[:-1]]), *(_binaries(c, some) for c in columns)], schema=_schema(len(columns)))
        at = to


def to_blocks(parts, combine):
    """Arrow batches of blocks of `parts`, tuples of columns with the hash first. `combine` gets the columns of about ROWS
    rows at a time and returns them sorted by hash; it may put rows together."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= ROWS:
            yield from _sent(combine(*(np.concatenate(c) for c in zip(*held, strict=True))))
            held, n = [], 0
    if n:
        yield from _sent(combine(*(np.concatenate(c) for c in zip(*held, strict=True))))


def dealt(blocks: DataFrame) -> DataFrame:
    """Blocks of a bucket together, bucket after bucket."""
    return blocks.repartition("bucket").sortWithinPartitions("bucket")


def _pieces(held: list[list[np.ndarray]]) -> list[list[np.ndarray]]:
    """Blocks put together to pieces of about ROWS rows."""
    out, some, n = [], [], 0
    for block in held:
        some.append(block)
        n += len(block[0])
        if n >= ROWS:
            out.append(some)
            some, n = [], 0
    return [[np.concatenate(c) for c in zip(*p, strict=True)] for p in (*out, some) if p]


def from_blocks(batches, kinds: list):
    """Lists of pieces, each a list of columns of `kinds`; a list holds all rows of the buckets it has rows of. There is one
    piece, of about ROWS rows, unless a single bucket has more."""
    held, n, last = [], 0, None
    for batch in batches:
        for bucket, *found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != last and n >= ROWS // 2:
                yield _pieces(held)
                held, n = [], 0
            held.append([np.frombuffer(x, kind) for x, kind in zip(found, kinds, strict=True)])
            n += len(held[-1][0])
            last = bucket
    if held:
        yield _pieces(held)
