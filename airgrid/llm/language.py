"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

A text's UTF-8 bytes are read in windows of WINDOW bytes, from the first to the last. In each window one network
runs forward and one backward; both states together label every position, and a document's probabilities are the
mean over all its positions. Training is by backpropagation through time on a bounded sample of windows.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import fresh, learnable, steps, to_batch

WINDOW = 64
HIDDEN = 8
#: The training sample: documents per language and of all languages (on average; at least one of each language), and
#: windows per document.
SAMPLE_DOCS, SAMPLE_TOTAL, SAMPLE_WINDOWS = 600, 600 * 64, 4
TRAIN_STEPS, TRAIN_BATCH, RATE = 400, 256, 0.01
UNKNOWN = "und"
_PAD = 256
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """Arrays have the direction first: 0 forward, 1 backward. Gates in a row: update, reset, candidate."""

    langs: list[str]
    x: np.ndarray  # (2, 257, 3H): what a byte adds to the gates
    u: np.ndarray  # (2, H, 2H): from the state to update and reset
    v: np.ndarray  # (2, H, H): from the reset state to the candidate
    out: np.ndarray  # (2, H, C)
    bias: np.ndarray  # (C,)

    PARTS = ("x", "u", "v", "out", "bias")


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, padded, and which text each belongs to."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    flat = np.full(counts.sum() * WINDOW, _PAD, np.uint16)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += n * WINDOW
    return flat.reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _run(net: Network, windows: np.ndarray, keep: bool = False):
    """States after each step, (T, 2, N, H), and with `keep` what backpropagation needs."""
    n, steps_, hidden = len(windows), windows.shape[1], net.v.shape[1]
    both = np.stack([windows, windows[:, ::-1]])
    at = np.ascontiguousarray((both + np.array([0, _PAD + 1], np.uint16)[:, None, None]).transpose(2, 0, 1))
    table = net.x.reshape(-1, 3 * hidden)
    for_gates, for_candidate = np.ascontiguousarray(table[:, : 2 * hidden]), np.ascontiguousarray(table[:, 2 * hidden :])
    states = np.empty((steps_, 2, n, hidden), np.float32)
    state = np.zeros((2, n, hidden), np.float32)
    kept = []
    for t in range(steps_):
        gates = for_gates[at[t]]
        gates += state @ net.u
        _sigmoid(gates)
        update, reset = gates[..., :hidden], gates[..., hidden:]
        was_reset = reset * state
        candidate = was_reset @ net.v
        candidate += for_candidate[at[t]]
        np.tanh(candidate, out=candidate)
        if keep:
            kept.append((state, update, reset, was_reset, candidate))
        move = candidate - state
        move *= update
        np.add(state, move, out=states[t])
        state = states[t]
    return (states, both, kept) if keep else states


def _label(net: Network, states: np.ndarray) -> np.ndarray:
    """Probabilities of every position, (T, N, C)."""
    logits = states[:, 0] @ net.out[0] + states[::-1, 1] @ net.out[1] + net.bias
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    return logits / logits.sum(-1, keepdims=True)


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    states, both, kept = _run(net, windows, keep=True)
    real = (windows != _PAD).T[..., None]
    error = _label(net, states)
    error[:, np.arange(len(labels)), labels] -= 1
    error = np.where(real, error, 0).astype(np.float32) / max(1, real.sum())
    grads = {p: np.zeros_like(getattr(net, p)) for p in Network.PARTS}
    grads["bias"] = error.sum((0, 1))
    errors = np.stack([error, error[::-1]], 1)  # per step and direction
    grads["out"] = np.einsum("tdnh,tdnc->dhc", states, errors, optimize=True)
    from_label = errors @ net.out.transpose(0, 2, 1)
    d_state = np.zeros_like(states[0])
    for t in range(len(states) - 1, -1, -1):
        state, update, reset, was_reset, candidate = kept[t]
        d_state = d_state + from_label[t]
        d_candidate = d_state * update * (1 - candidate**2)
        d_update = d_state * (candidate - state) * update * (1 - update)
        d_was = d_candidate @ net.v.transpose(0, 2, 1)
        d_reset = d_was * state * reset * (1 - reset)
        d_gates = np.concatenate([d_update, d_reset], -1)
        grads["v"] += was_reset.transpose(0, 2, 1) @ d_candidate
        grads["u"] += state.transpose(0, 2, 1) @ d_gates
        d_add = np.concatenate([d_gates, d_candidate], -1)
        for way in (0, 1):
            one_hot = both[way, :, t]
            order = np.argsort(one_hot, kind="stable")
            seen, first = np.unique(one_hot[order], return_index=True)
            grads["x"][way][seen] += np.add.reduceat(d_add[way][order], first, axis=0)
        d_state = d_state * (1 - update) + d_was * reset + d_gates @ net.u.transpose(0, 2, 1)
    return grads


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], steps_: int = TRAIN_STEPS, seed: int = 11) -> Network:
    """Adam with a falling rate; languages are drawn evenly, so rare ones are learnt too. The same input gives the same network."""
    rng = np.random.default_rng(seed)
    h, c = HIDDEN, len(langs)

    def start(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    net = Network(
        langs, start(2, 257, 3 * h, scale=0.3), start(2, h, 2 * h, scale=h**-0.5), start(2, h, h, scale=h**-0.5),
        start(2, h, c, scale=h**-0.5), np.zeros(c, np.float32),
    )
    mean = {p: np.zeros_like(getattr(net, p)) for p in Network.PARTS}
    power = {p: np.zeros_like(getattr(net, p)) for p in Network.PARTS}
    chance = 1 / np.bincount(labels, minlength=c)[labels]
    chance /= chance.sum()
    for k in range(1, steps_ + 1):
        pick = rng.choice(len(windows), TRAIN_BATCH, p=chance)
        grads = _gradients(net, windows[pick], labels[pick])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 2 * (1 - (k - 1) / steps_))
        for p, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            mean[p] += 0.1 * (g - mean[p])
            power[p] += 0.01 * (g * g - power[p])
            step = rate * (mean[p] / (1 - 0.9**k)) / (np.sqrt(power[p] / (1 - 0.99**k)) + 1e-8)
            setattr(net, p, (getattr(net, p) - step).astype(np.float32))
    return net


def probabilities(net: Network, texts: list[bytes], block: int = 1024) -> np.ndarray:
    """Each text's mean over its positions, (texts, languages); zeros for an empty text. Many languages go in smaller blocks."""
    windows, owner = windows_of(texts)
    block = max(1, min(block, block * 64 // len(net.langs)))
    sums = np.zeros((len(windows), len(net.langs)))
    for a in range(0, len(windows), block):
        part = windows[a : a + block]
        labelled = _label(net, _run(net, part))
        sums[a : a + block] = (labelled * (part != _PAD).T[..., None]).sum(0)
    out = np.zeros((len(texts), len(net.langs)))
    np.add.at(out, owner, sums)
    return out / np.maximum(1, [[len(t)] for t in texts])


def predict(net: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and probability of each text; `und` and 0 where it is null or has no letter, or nothing was learnt."""
    known = [i for i, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if known:
        found = probabilities(net, [texts[i].encode("utf-8", "replace") for i in known])
        for i, row in zip(known, found, strict=True):
            langs[i], scores[i] = net.langs[int(row.argmax())], float(min(1.0, row.max()))
    return langs, scores


WINDOWS = pa.schema([("lang", pa.string()), ("window", pa.binary())])


def fit(docs: DataFrame) -> Network | None:
    """A network from `docs` (doc_id, text, lang), learnable rows with a language only; None if there are none.

    Every language is learnt. Documents with text are counted per language; the sample takes them by a hash of their
    id, at a rate per language that yields about SAMPLE_DOCS, or fewer where many languages share SAMPLE_TOTAL, and
    always the one with the smallest hash. From each come up to SAMPLE_WINDOWS windows, spread over the text.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where(learnable(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = rows.where(F.col("text") != "").withColumn("turn", F.xxhash64("doc_id", F.lit(5)))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("first")).collect()
    if not counts:
        return None
    each = min(SAMPLE_DOCS, SAMPLE_TOTAL / len(counts))
    rates = docs.sparkSession.createDataFrame([(r["lang"], each / r["n"], r["first"]) for r in counts], "lang string, rate double, first long")
    place = F.pmod("turn", F.lit(1 << 20)) / float(1 << 20)

    def run(batches):
        for batch in steps(batches, "text"):
            langs, windows = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "replace")
                n = -(-len(data) // WINDOW)
                for k in sorted({i * n // SAMPLE_WINDOWS for i in range(SAMPLE_WINDOWS)} if n else ()):
                    langs.append(lang)
                    windows.append(data[k * WINDOW : (k + 1) * WINDOW])
            yield to_batch({"lang": langs, "window": windows}, WINDOWS)

    taken = rows.join(F.broadcast(rates), "lang").where((place < F.col("rate")) | (F.col("turn") == F.col("first")))
    sample = taken.select("lang", "text").mapInArrow(run, "lang string, window binary")
    found = sorted((r["lang"], bytes(r["window"])) for r in sample.collect())
    if not found:
        return None
    langs = sorted({lang for lang, _ in found})
    windows, _ = windows_of([w for _, w in found])
    number = {lang: k for k, lang in enumerate(langs)}
    return train(windows, np.array([number[lang] for lang, _ in found]), langs)


def _predictor(net: Network | None):
    @F.pandas_udf("lang_pred string, score double")
    def run(texts):
        import pandas as pd

        column, langs, scores = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"]), [], []
        for part in steps([column], "text"):
            found = predict(net, part.column("text").to_pylist())
            langs += found[0]
            scores += found[1]
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return run


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """Per row of `docs`: doc_id, lang_pred, score. Only the text is read."""
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _predictor(net)(F.col("text").cast("string")).alias("found")
    )
    return found.select("doc_id", "found.lang_pred", "found.score")


def least_score(n_langs: int, sure: float) -> float:
    """The score that lies `sure` of the way from a blind guess among so many languages to certainty."""
    blind = 1 / max(1, n_langs)
    return blind + sure * (1 - blind)


def keep_identified(docs: DataFrame, net: Network | None, sure: float = 0.2) -> DataFrame:
    """The rows of `docs` whose text has letters and a language that is `sure` enough, with their columns."""
    least = least_score(len(net.langs) if net else 1, sure)
    name = fresh(docs, "found")
    marked = docs.withColumn(name, _predictor(net)(F.col("text").cast("string")))
    sure = (F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least)
    return marked.where(sure).select(*docs.columns)
