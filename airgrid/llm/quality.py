"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

Word vectors: every word has a fixed sparse random vector (its index vector: NONZERO entries of +1 or -1, from a
hash). A word's vector is the sum of the index vectors of itself and of its neighbours up to REACH words away, over
all occurrences in all documents; these are sums of whole numbers, so the order of adding doesn't matter.
Words share BUCKETS rows by hash, so the table has a fixed size whatever the vocabulary (BUCKETS x DIMS numbers, 4 MB),
which is what lets it be sent to every task.

Documents: their words' vectors pooled by mean, standard deviation and step from word to word. A network with one hidden layer gives a logit; a
temperature, fitted on labelled rows that the network hasn't seen, turns it into a probability.
"""

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import fresh, learnable, steps

BUCKETS, DIMS, NONZERO, REACH = 1 << 15, 32, 2, 2
#: Labelled rows that the network is fitted on, at most; taken by a hash of the id.
MAX_LABELLED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 3e-3, 1e-4
#: Words whose buckets a Python worker remembers at most.
REMEMBERED = 100_000
POOLED = 3 * DIMS
_TOKEN = re.compile(r"\w+|[^\w\s]+").findall


class Buckets(dict):
    """Word to bucket; what has been asked before is remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = bucket = zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS
        return bucket


_buckets = Buckets()


def words(text: str | None) -> np.ndarray:
    """Buckets of a text's words and runs of marks, in order; case counts."""
    found = _TOKEN(text or "")
    return np.fromiter(map(_buckets.__getitem__, found), np.int64, len(found))


def index_vectors(seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket the places and signs of its index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def add_contexts(table: np.ndarray, texts: list[np.ndarray]) -> None:
    """Add the texts' occurrences to `table` (BUCKETS * DIMS, float64: exact for sums below 2**53)."""
    places, signs = index_vectors()
    gap = np.full(REACH, -1)
    flat = np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap
    for away in range(REACH + 1):
        left, right = flat[: len(flat) - away], flat[away:]
        real = (left >= 0) & (right >= 0)
        left, right = left[real], right[real]
        for word, neighbour in ((left, right), (right, left))[: 2 if away else 1]:
            for k in range(NONZERO):
                table += np.bincount(word * DIMS + places[neighbour, k], signs[neighbour, k], len(table))


_COLUMNS = [f"c{k}" for k in range(DIMS)]
_SCHEMA = "bucket int, " + ", ".join(f"{c} long" for c in _COLUMNS)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of all documents' words, (BUCKETS, DIMS) float32, damped by a logarithm, centred and of length 1.
    Each task adds up its own documents; the tasks' tables are summed by bucket."""

    def run(batches):
        table, seen = np.zeros(BUCKETS * DIMS), False
        for batch in steps(batches, "text"):
            add_contexts(table, [words(t) for t in batch.column("text").to_pylist()])
            seen = True
        if seen:
            table = table.reshape(BUCKETS, DIMS).astype(np.int64)
            used = np.flatnonzero(table.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), *(pa.array(table[used, k]) for k in range(DIMS))], names=["bucket", *_COLUMNS]
            )

    sums = (
        docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, _SCHEMA)
        .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _COLUMNS])
    )
    found = sums.toArrow()  # BUCKETS rows at most
    table = np.zeros((BUCKETS, DIMS))
    if found.num_rows:
        table[found["bucket"].to_numpy()] = np.stack([found[c].to_numpy() for c in _COLUMNS], 1)
    used = table.any(1)
    table = np.sign(table) * np.log1p(np.abs(table))
    if used.any():
        table[used] -= table[used].mean(0)
    return (table / np.maximum(1e-9, np.linalg.norm(table, axis=1, keepdims=True))).astype(np.float32)


def pooled(vectors: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """Of each text's word vectors: mean, standard deviation, and mean distance from one word to the next, by
    coordinate (this tells running prose from lists and repetitions); zeros without words."""
    out = np.zeros((len(texts), POOLED), np.float32)
    for row, text in zip(out, texts, strict=True):
        found = words(text)
        total, squares, away = np.zeros((3, DIMS))
        for a in range(0, len(found), 1 << 14):
            held = vectors[found[max(0, a - 1) : a + (1 << 14)]]
            away += np.abs(held[1:] - held[:-1]).sum(0)
            held = held[1:] if a else held
            total += held.sum(0)
            squares += np.einsum("ij,ij->j", held, held)
        if len(found):
            mean = total / len(found)
            row[:] = np.concatenate([mean, np.sqrt(np.maximum(0, squares / len(found) - mean**2)), away / max(1, len(found) - 1)])
    return out


@dataclass
class Classifier:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        """Added up term by term: a matrix product's last bits depend on how many rows it has, and a document's score must
        not depend on the documents beside it."""
        x = (features - self.centre) / self.scale
        hidden, out = np.zeros((len(x), HIDDEN)) + self.b1, np.full(len(x), float(self.b2))
        for k in range(POOLED):
            hidden += x[:, k : k + 1] * self.w1[k]
        hidden = np.maximum(0, hidden)
        for k in range(HIDDEN):
            out += hidden[:, k] * self.w2[k]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled(self.vectors, texts)) / self.temperature, -30, 30)))


def fit_network(vectors: np.ndarray, features: np.ndarray, labels: np.ndarray, seed: int = 1) -> Classifier:
    """Adam on four fifths of the rows; the temperature is the one that makes the last fifth's labels likeliest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held = order[: len(order) // 5]
    learnt = order[len(held) :]
    x, y = features[learnt].astype(np.float64), labels[learnt].astype(np.float64)
    net = Classifier(
        vectors, x.mean(0), x.std(0) + 1e-6, rng.normal(0, (2 / POOLED) ** 0.5, (POOLED, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))),
    )
    x = (x - net.centre) / net.scale
    parts = ["w1", "b1", "w2", "b2"]
    mean, power, k = {p: 0.0 for p in parts}, {p: 0.0 for p in parts}, 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            rows, k = shuffled[a : a + BATCH], k + 1
            before = x[rows] @ net.w1 + net.b1
            hidden = np.maximum(0, before)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, net.w2) * (before > 0)
            grads = {
                "w1": x[rows].T @ back + DECAY * net.w1, "b1": back.sum(0), "w2": hidden.T @ error + DECAY * net.w2, "b2": error.sum(),
            }
            for p, g in grads.items():
                mean[p] = 0.9 * mean[p] + 0.1 * g
                power[p] = 0.999 * power[p] + 0.001 * g * g
                setattr(net, p, getattr(net, p) - RATE * (mean[p] / (1 - 0.9**k)) / (np.sqrt(power[p] / (1 - 0.999**k)) + 1e-8))
    if len(held):
        logit, sign = net.logits(features[held]), 2.0 * labels[held] - 1
        choices = np.geomspace(0.25, 20, 60)
        net.temperature = float(min(choices, key=lambda t: np.logaddexp(0, -sign * logit / t).mean()))
    return net


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier | None:
    """Word vectors from all of `docs` (doc_id, text); the network from learnable rows of `labels` (doc_id, quality 0
    or 1; others and nulls are left out), `max_labelled` at most. None without labelled documents."""
    vectors = word_vectors(docs)
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(learnable(F.col("doc_id")) & F.col("quality").isin(0, 1))
        .orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id", "quality").limit(max_labelled)
    )
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for batch in steps(batches, "text"):
            found = pooled(sent.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(list(found), pa.list_(pa.float32()))],
                names=["doc_id", "quality", "features"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = (
        read.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
        .mapInArrow(run, "doc_id long, quality int, features array<float>")
        .orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id", "quality").limit(max_labelled).collect()
    )
    sent.unpersist()
    if not rows:
        return None
    order = sorted(rows, key=lambda r: (r["doc_id"], r["quality"], r["features"]))
    return fit_network(vectors, np.array([r["features"] for r in order], np.float32), np.array([r["quality"] for r in order]))


def _scorer(spark, net: Classifier | None):
    sent = spark.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def run(texts):
        import pandas as pd

        column, found = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"]), []
        for part in steps([column], "text"):
            texts_ = part.column("text").to_pylist()
            found.append(sent.value.scores(texts_) if sent.value is not None else np.full(len(texts_), 0.5))
        return pd.Series(np.concatenate(found) if found else [], dtype=float)

    return run


def score(docs: DataFrame, net: Classifier | None) -> DataFrame:
    """Per row of `docs`: doc_id, score, predicted. A null text counts as empty; without a network every score is 0.5."""
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _scorer(docs.sparkSession, net)(F.col("text").cast("string")).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, net: Classifier | None, least: float = 0.5) -> DataFrame:
    """The rows of `docs` that score `least` or more, by default those that `score` predicts to be good, with their columns."""
    name = fresh(docs, "score")
    return docs.withColumn(name, _scorer(docs.sparkSession, net)(F.col("text").cast("string"))).where(F.col(name) >= least).select(*docs.columns)
