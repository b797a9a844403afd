"""Vector tables for the two searches: cleaning, blocks of a bounded number of rows, and queries against all rows
block by block."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a block on average, of candidates and of queries, and copies of the queries that share out the candidates.
CANDIDATES, QUERIES, SHARES = 4096, 1024, 32


def clean(table: DataFrame, component) -> DataFrame:
    """vec_id, v (array<double>) of usable rows: not null, without null or non-finite components, with an id.
    `component` maps a component (double). Equal rows count once; a
    vec_id with several vectors keeps them all."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = F.transform("embedding", lambda x: component(x.cast("double")))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), vectors.alias("v")).distinct()


def without_copies(vectors: DataFrame, enough: int) -> DataFrame:
    """Of rows with equal vectors the `enough` smallest ids: as ties go to smaller ids, no others can be among a
    query's best `enough - 1` (its own row may be one). A large group of copies is cut in every task already."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return vectors.withColumn("nth", nth).where(F.col("nth") <= enough).drop("nth")


def _packed(rows: DataFrame, group: str, extra) -> DataFrame:
    """One row per value of `group`: ids and vectors (padded with zeros to one width) in binary, and what `extra`, a
    function of the vectors, adds in binary."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        vectors = table["v"].combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        flat, width = vectors.flatten().to_numpy(), int(lengths.max(initial=0))
        if (lengths == width).all():
            data = flat.reshape(len(lengths), width)
        else:
            data = np.zeros((len(lengths), width))
            data[np.arange(width) < lengths[:, None]] = flat
        return pa.table({
            group: table[group].slice(0, 1), "n": pa.array([len(data)], pa.int64()), "ids": [table["vec_id"].to_numpy().tobytes()],
            "data": [data.tobytes()], "extra": [extra(data)],
        })

    kind = dict(rows.dtypes)[group]
    return rows.select(group, "vec_id", "v").groupBy(group).applyInArrow(run, f"{group} {kind}, n long, ids binary, data binary, extra binary")


def query_blocks(vectors: DataFrame, n_queries: int, extra=lambda data: b"") -> DataFrame:
    blocks = max(1, -(-n_queries // QUERIES))
    return _packed(vectors.withColumn("q", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))), "q", extra)


def candidate_blocks(vectors: DataFrame, kind: Column, extra=lambda data: b"") -> DataFrame:
    """Blocks of vectors of one `kind` (a long); a kind with many rows is dealt over several blocks."""
    rows = vectors.withColumn("kind", kind)
    sizes = rows.groupBy("kind").agg(F.ceil(F.count(F.lit(1)) / CANDIDATES).alias("blocks"))
    rows = rows.join(sizes, "kind")
    dealt = F.concat_ws("/", F.col("kind").cast("string"), F.pmod(F.xxhash64("vec_id", "v", F.lit(2)), F.col("blocks")).cast("string"))
    return _packed(rows.withColumn("block", dealt), "block", extra)


def paired(candidates: DataFrame, queries: DataFrame, n_queries: int) -> DataFrame:
    """Every block of `candidates` beside every block of `queries`; the queries' columns begin with q_."""
    blocks = max(1, -(-n_queries // QUERIES))
    left = candidates.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    left = left.withColumn("share", F.pmod(F.xxhash64("block"), F.lit(SHARES)))
    right = queries.select("q", *[F.col(c).alias(f"q_{c}") for c in queries.columns if c != "q"])
    right = right.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))))
    return left.join(right, ["q", "share"]).drop("share")


def matrix(n: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(n, -1)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the larger width, padded with zeros."""
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def best(found: DataFrame, k: int) -> DataFrame:
    """The `k` highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
