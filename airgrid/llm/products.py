"""Exact search for the highest inner products of whole-number vectors, by norm-bucketed retrieval.

Candidates are grouped into buckets of nearly equal length. The longest ones are searched first and give each query
a lower bound of its k-th best product. In every other bucket the bound, divided by the query's length and the
bucket's greatest length, is a local cosine threshold. Above 1 the bucket is left out. If it is high, candidates are
pruned by coordinates: the query's largest ones give part of the cosine, and what is left of both unit vectors bounds
the rest. If it is low, they are pruned by their length. What remains is verified by its
product. No bound is ever rounded towards pruning more.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import vectors as V
from airgrid.llm.common import to_batch
from airgrid.session import Workspace

#: Lengths in a bucket differ by this factor at most.
RATIO = 1.05
#: Buckets' blocks that are searched first.
FIRST = 2
#: From this local threshold on, coordinates are used; so many of them.
HIGH, FOCUS = 0.3, 6
_SLACK = 1e-9

FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def products(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer products, (queries, candidates)."""
    top = np.abs(candidates).max(initial=0) * np.abs(queries).max(initial=0) * max(1, candidates.shape[1])
    if top < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object) @ np.array([[int(x) for x in row] for row in candidates], object).T
    return exact.astype(np.int64)


def survivors(candidates: np.ndarray, lengths: np.ndarray, units: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Which candidates (in order of falling length) may reach a product of `bound` with `query`."""
    length = math.sqrt(float(query @ query))
    longest = float(lengths[0]) if len(lengths) else 0.0
    if length * longest == 0 or bound <= 0:
        return np.arange(len(lengths)) if bound <= 0 else np.zeros(0, np.int64)
    threshold = bound / (length * longest) - _SLACK
    if threshold > 1:
        return np.zeros(0, np.int64)
    kept = np.searchsorted(-lengths, -(bound / length) * (1 - _SLACK), "right")
    if threshold < HIGH:
        return np.arange(kept)
    unit = query / length
    focus = np.argsort(-np.abs(unit))[:FOCUS]
    part = unit[focus] @ units[focus, :kept]
    rest = np.maximum(0, 1 - (units[focus, :kept] ** 2).sum(0)) * max(0.0, 1 - float(unit[focus] @ unit[focus]))
    return np.flatnonzero(part + np.sqrt(rest) >= threshold - _SLACK)


def search_block(ids, candidates, query_ids, queries, bounds, k):
    """(query_id, vec_id, score) of the block's `k` best per query that reach the query's bound."""
    candidates, queries = V.same_width(candidates, queries)
    lengths = np.sqrt(np.einsum("ij,ij->i", candidates, candidates))
    order = np.argsort(-lengths, kind="stable")
    ids, candidates, lengths = ids[order], candidates[order], lengths[order]
    units = np.ascontiguousarray((candidates / np.maximum(lengths, 1e-300)[:, None]).T)
    out = []
    for query_id, query, bound in zip(query_ids, queries, bounds, strict=True):
        alive = survivors(candidates, lengths, units, query, bound) if bound > -np.inf else np.arange(len(ids))
        alive = alive[ids[alive] != query_id]
        if not len(alive):
            continue
        score = products(candidates[alive] if len(alive) < len(ids) else candidates, query[None])[0]
        reach = np.flatnonzero(score >= bound)
        reach = reach[np.lexsort((ids[alive[reach]], -score[reach]))[:k]]
        out.append((np.full(len(reach), query_id), ids[alive[reach]], score[reach]))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                candidates, queries = V.matrix(row["n"], row["data"]), V.matrix(row["q_n"], row["q_data"])
                ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                bounds = np.full(len(query_ids), -np.inf)
                if row["q_bounds"]:
                    known = {r["query_id"]: r["bound"] for r in row["q_bounds"]}
                    bounds = np.array([known.get(int(q), -np.inf) for q in query_ids])
                found = search_block(ids, candidates, query_ids, queries, bounds, k)
                yield to_batch(dict(zip(FOUND.names, found, strict=True)), FOUND)

    return pairs.select("n", "ids", "data", "q_n", "q_ids", "q_data", "q_bounds").mapInArrow(run, "query_id long, vec_id long, score long")


def top_products(table: DataFrame, work: Workspace, k: int = 20, every: int = 20, scale: float = 64.0) -> DataFrame:
    """Per query (vec_id divisible by `every`): the `k` highest products of floor(scale * x) vectors with all other
    rows, ties to smaller ids: query_id, rank, vec_id, score. `table`: vec_id, embedding.

    Rows whose vector is null or holds null or non-finite components take no part, nor do rows without id; equal
    rows count once, and all vectors of a repeated id are candidates and, if it asks, queries of that id; vectors of unequal width are compared as if padded with zeros.
    """
    vectors = work.keep(V.clean(table, lambda x: F.floor(x * scale).cast("double")), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    n_queries = queries.count()
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    bucket = F.when(length > 0, F.floor(F.log(length) / math.log(RATIO))).otherwise(-1).cast("long")
    blocks = work.keep(V.candidate_blocks(V.without_copies(vectors, k + 1), bucket), "blocks")
    asked = work.keep(V.query_blocks(queries, n_queries), "queries")
    asked = asked.withColumn("bounds", F.lit(None).cast("array<struct<query_id:long,bound:double>>"))
    kind = F.split_part("block", F.lit("/"), F.lit(1)).cast("long")
    first = [r["block"] for r in blocks.select("block", kind.alias("kind")).orderBy(F.desc("kind"), "block").limit(FIRST).collect()]
    early = work.keep(_searched(V.paired(blocks.where(F.col("block").isin(first)), asked, n_queries), k), "first")
    nth = V.best(early, k).where(F.col("rank") == k)
    places = queries.select("vec_id", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(max(1, -(-n_queries // V.QUERIES)))).alias("q"))
    bounds = (
        nth.join(places.withColumnRenamed("vec_id", "query_id"), "query_id")
        .groupBy("q").agg(F.collect_list(F.struct("query_id", F.col("score").cast("double").alias("bound"))).alias("bounds"))
    )
    asked = asked.drop("bounds").join(bounds, "q", "left")
    later = _searched(V.paired(blocks.where(~F.col("block").isin(first)), asked, n_queries), k)
    return V.best(early.unionByName(later), k)
