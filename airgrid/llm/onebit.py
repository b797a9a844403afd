"""Nearest neighbours by cosine from randomly rotated one-bit codes.

Unit vectors are turned by one random rotation, and each coordinate's sign is kept: D bits, packed. With s the vector
of signs divided by sqrt(D) and c = <s, turned vector>, kept as a correction scalar, <s, turned query> / c
estimates the cosine without bias over rotations, and its error is beyond WIDTH * sqrt((1 - c * c) / (c * c * (D - 1)))
only with a probability that falls exponentially in WIDTH squared. Each block of codes is scanned for the k-th best lower
bound; vectors whose upper bound reaches it are reranked by their exact cosine on the original vectors.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import vectors as V
from airgrid.llm.common import to_batch
from airgrid.session import Workspace

WIDTH = 2.5
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def rotation(dims: int, seed: int = 17) -> np.ndarray:
    """A random orthogonal matrix; the same for the same number of dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def lengths(data: np.ndarray) -> np.ndarray:
    """Row by row in one order of adding, so that equal vectors have equal lengths wherever they stand. Scaled, so
    that no square overflows or vanishes."""
    top = np.abs(data).max(axis=1, initial=0)
    scaled = data / np.where(top > 0, top, 1)[:, None]
    return top * np.sqrt((scaled * scaled).sum(1))


def units(data: np.ndarray) -> np.ndarray:
    return data / lengths(data)[:, None]


def encode(data: np.ndarray) -> bytes:
    """Correction scalars (float64) and then packed codes."""
    dims = data.shape[1]
    turned = units(data) @ rotation(dims)
    return (np.abs(turned).sum(1) / np.sqrt(dims)).tobytes() + np.packbits(turned > 0, axis=1).tobytes()


def estimates(code: bytes, n: int, dims: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries, n) with unit `queries`, and the codes' error bounds (n)."""
    scalars = np.frombuffer(code, np.float64, n)
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=8 * n).reshape(n, -1), axis=1, count=dims)
    turned = (queries @ rotation(dims)).astype(np.float32)
    # <s, q> from bits: twice the sum where a bit is set, less the whole sum
    products = (2 * (turned @ bits.T.astype(np.float32)) - turned.sum(1, keepdims=True)) / np.sqrt(dims)
    return products / scalars, WIDTH * np.sqrt(np.maximum(0, 1 - scalars**2) / (scalars**2 * max(1, dims - 1)))


def search_block(ids, data, code, query_ids, queries, k):
    """(query_id, vec_id, score) of the block's `k` best per query."""
    dims = data.shape[1]
    asked = units(queries)
    if asked.shape[1] != dims:  # other widths: no code fits, every vector is reranked
        chosen = np.ones((len(asked), len(ids)), bool)
        data, asked = V.same_width(data, asked)
    else:
        about, error = estimates(code, len(ids), dims, asked)
        lower = about - error
        lower[ids[None, :] == query_ids[:, None]] = -np.inf
        enough = np.partition(lower, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(asked), -np.inf)
        chosen = about + error >= enough[:, None] - 1e-4
    held, out = units(data), []
    for query_id, unit, mask in zip(query_ids, asked, chosen, strict=True):
        alive = np.flatnonzero(mask)
        alive = alive[ids[alive] != query_id]
        score = (held[alive] * unit).sum(1)
        top = np.lexsort((ids[alive], -score))[:k]
        out.append((np.full(len(top), query_id), ids[alive[top]], score[top]))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def nearest(table: DataFrame, work: Workspace, k: int = 5, every: int = 50) -> DataFrame:
    """Per query (vec_id divisible by `every`): its `k` nearest other rows found, by cosine: query_id, rank, vec_id, score.

    Every row is in the index. Rows whose vector is null, zero, or holds null or non-finite components take no part, nor do
    rows without id; equal rows count once, and all vectors of a repeated id are candidates and,
    if it asks, queries of that id; vectors of unequal width are compared as if padded with zeros.
    """
    clean = V.clean(table, lambda x: x).where(F.exists("v", lambda x: x != 0))
    rows = work.keep(clean, "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    n_queries = queries.count()
    index = work.keep(V.candidate_blocks(V.without_copies(rows, k + 1), F.size("v").cast("long"), encode), "index")
    asked = work.keep(V.query_blocks(queries, n_queries), "queries")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = search_block(
                    np.frombuffer(row["ids"], np.int64), V.matrix(row["n"], row["data"]), row["extra"],
                    np.frombuffer(row["q_ids"], np.int64), V.matrix(row["q_n"], row["q_data"]), k,
                )
                yield to_batch(dict(zip(FOUND.names, found, strict=True)), FOUND)

    pairs = V.paired(index, asked, n_queries).select("n", "ids", "data", "extra", "q_n", "q_ids", "q_data")
    return V.best(pairs.mapInArrow(run, "query_id long, vec_id long, score double"), k)
