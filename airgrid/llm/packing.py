"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most one bin's capacity and placed largest first. A shard's bins are kept in
order of residual room and carry bitmaps of the sources and duplicate clusters they hold. A piece looks for the first
bin in that order with room enough, and goes on to the next one while source or cluster conflict, so it ends in
the tightest compatible bin; if there is none, in a new one. Shards of a bounded number of pieces are packed side by
side: the price is a few half-empty bins per shard. Each distinct source and cluster of a shard has a bit of its own,
in as many words as that takes, so a bin is refused for a true conflict only.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm import jaccard
from airgrid.llm.common import n_words
from airgrid.session import Workspace

CAPACITY = 2048
SHARD_PIECES = 4096


def bits_of(values: list) -> np.ndarray:
    """Each value's bitmap, (values, words): one bit per distinct value; null has none, as nothing is known to conflict."""
    numbers = {v: k for k, v in enumerate(dict.fromkeys(v for v in values if v is not None))}
    out = np.zeros((len(values), max(1, -(-len(numbers) // 64))), np.int64)
    for i, v in enumerate(values):
        if v is not None:
            word, bit = divmod(numbers[v], 64)
            out[i, word] = np.int64(1) << np.int64(bit)
    return out


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of each piece, in the order given; sources and clusters are bitmaps of one bit at most, in
    one word, (pieces,), or several, (pieces, words)."""
    n = len(sizes)
    room, name = (np.zeros(n + 1, np.int64) for _ in range(2))  # in order of room
    places, held = [], []  # of both kinds: each piece's word and bit; the bins' words, by word and then bin
    for kind in (sources, clusters):
        kind = kind.reshape(n, -1)
        word = (kind != 0).argmax(1)
        places.append((word, kind[np.arange(n), word]))
        held.append(np.zeros((kind.shape[1], n), np.int64))
    (s_word, s_bit), (c_word, c_bit) = places
    src, clu = held
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    used = n_bins = 0
    for i in range(n):
        size, in_src, in_clu = sizes[i], src[s_word[i]], clu[c_word[i]]
        lo = np.searchsorted(room[:used], size)
        roomy = name[lo:used]
        fits = ((in_src[roomy] & s_bit[i]) | (in_clu[roomy] & c_bit[i])) == 0
        at = lo + int(fits.argmax()) if len(fits) else used
        if at < used and fits[at - lo]:
            left, number = room[at], name[at]
            for x in (room, name):
                x[at : used - 1] = x[at + 1 : used]
            used -= 1
        else:
            left, number = capacity, n_bins
            n_bins += 1
        in_src[number] |= s_bit[i]
        in_clu[number] |= c_bit[i]
        bins[i], offsets[i] = number, capacity - left
        left -= size
        to = np.searchsorted(room[:used], left)
        for x, value in ((room, left), (name, number)):
            x[to + 1 : used + 1] = x[to:used]
            x[to] = value
        used += 1
    return bins, offsets


def cluster_of(text: Column) -> Column:
    """Copies up to case and white space share a cluster; texts without words have none."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(F.length(plain) > 0, F.xxhash64(plain).cast("string"))


def pack(items: DataFrame, work: Workspace, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`items`: doc_id, size (tokens or words; 0 allowed), source, cluster. One row per piece: doc_id, copy, piece,
    piece_begin, size, source, cluster, bin_id, bin_offset.

    A document above the capacity becomes full pieces, each a bin of its own, and a last one; none is dropped or cut
    short. An empty document is one piece of size 0. Pieces with an equal known source, or an equal known cluster,
    never share a bin. Repeated rows are numbered by `copy` and packed each. Shards are dealt by a hash of the row,
    its copy and piece, so a source or cluster with a third of the rows is spread over all shards.
    """
    items = items.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("size").cast("long").alias("size"),
        F.col("source").cast("string").alias("source"), F.col("cluster").cast("string").alias("cluster"),
    )
    same = items.groupBy("doc_id", "size", "source", "cluster").agg(F.count(F.lit(1)).alias("n"))
    pieces = (
        same.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)))))
        .withColumn("piece_begin", F.col("piece") * capacity)
        .withColumn("size", F.least(F.col("size") - F.col("piece_begin"), F.lit(capacity).cast("long")))
    )
    pieces = work.keep(pieces, "pieces")
    full = pieces["size"] == capacity
    shards = max(1, math.ceil(pieces.where(~full).count() / shard_pieces))
    key = F.xxhash64("doc_id", "source", "cluster", "copy", "piece")
    columns = "doc_id long, size long, source string, cluster string, copy long, piece long, piece_begin long, shard long"

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), *((c, "ascending") for c in ("doc_id", "copy", "piece", "source", "cluster"))])
        bins, offsets = best_fit(
            group["size"].to_numpy(), bits_of(group["source"].to_pylist()), bits_of(group["cluster"].to_pylist()), capacity
        )
        return group.append_column("bin", pa.array(bins)).append_column("bin_offset", pa.array(offsets))

    packed = (
        pieces.where(~full).withColumn("shard", F.pmod(key, F.lit(shards)))
        .select(*[c.split()[0] for c in columns.split(", ")])
        .groupBy("shard").applyInArrow(run, f"{columns}, bin long, bin_offset long")
    )
    alone = pieces.where(full).withColumn("bin_id", F.concat_ws("-", F.lit("full"), "doc_id", "copy", "piece", F.hex(key))).withColumn("bin_offset", F.lit(0).cast("long"))
    packed = packed.withColumn("bin_id", F.concat_ws("-", F.lit("shard"), "shard", "bin")).drop("shard", "bin")
    out = ["doc_id", "copy", "piece", "piece_begin", "size", "source", "cluster", "bin_id", "bin_offset"]
    return packed.select(*out).unionByName(alone.select(*out))


def linked_items(docs: DataFrame, work: Workspace) -> DataFrame:
    """Per row of `docs`: doc_id, size in words, source, and cluster: the component that links of 0.8 or more over five-word
    shingles give a document with words. One reading of the texts makes sizes and sets.

    Letters are lower-cased first, as for `cluster_of`. A row without doc_id is a document by its text."""
    rows = docs.select(link_id().alias("doc_id"), F.lower("text").alias("text"), F.col("doc_id").alias("row_id"), "source")
    linked = jaccard.link_documents(rows, work, size=5, percent=80, carried=("row_id", "source"))
    cluster = F.when(F.col("n_words") > 0, F.col("component_id").cast("string"))
    return linked.select(F.col("row_id").alias("doc_id"), F.col("n_words").alias("size"), "source", cluster.alias("cluster"))


def link_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lower("text")))


def pack_documents(
    docs: DataFrame, work: Workspace, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, near: bool = True
) -> DataFrame:
    """`pack` for rows of documents: size in words; near copies are a cluster, or with `near` false, for documents
    without near copies, only copies up to case and white space."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "source")
    if near:
        return pack(linked_items(docs, work), work, capacity, shard_pieces)
    size = n_words(F.col("text")).alias("size")
    return pack(docs.select("doc_id", size, "source", cluster_of(F.col("text")).alias("cluster")), work, capacity, shard_pieces)
