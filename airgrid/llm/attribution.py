"""Token counts of fields and sections: each whole text is encoded once, and its tokens' character spans are joined
to the sections' spans.

A token that lies in one section counts there. One that crosses a boundary is allocated by a rule:
  "start"     the section that holds its first character;
  "majority"  the section that holds most of its characters, the earlier one of equals;
  "share"     each section by its share of the characters.
A token without characters (white space that the tokenizer trims from its span) counts where it stands; behind the
text's end, in the last section.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import fresh, steps
from airgrid.llm.pieces import encoder

RULES = ("start", "majority", "share")
#: Bytes of text that a task encodes together, about; a longer text is a step of its own.
ENCODED_TOGETHER = 1 << 20


def allocate(spans: np.ndarray, starts: np.ndarray, length: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of them cross its end. Sections begin at `starts` (ascending, the first 0) and
    reach to the next one or to `length`; an empty section holds nothing. `spans`: (begin, end) of each token."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    n = len(starts)
    begin, end = spans[:, 0], spans[:, 1]
    first = np.searchsorted(starts, begin, "right") - 1
    last = np.maximum(first, np.searchsorted(starts, end - 1, "right") - 1)
    crossing = np.flatnonzero(last > first)
    counts = np.bincount(first[last == first] if rule != "start" else first, minlength=n).astype(float)
    crossed = np.bincount(first[crossing], minlength=n)
    if rule != "start" and len(crossing):
        # A row per crossing token and section it lies in, with the characters it has there.
        edges, spread = np.append(starts, length), last[crossing] - first[crossing] + 1
        rows = np.cumsum(spread) - spread
        token = np.repeat(crossing, spread)
        section = np.arange(spread.sum()) - np.repeat(rows, spread) + first[token]
        held = np.minimum(edges[section + 1], end[token]) - np.maximum(edges[section], begin[token])
        if rule == "majority":
            most = np.flatnonzero(held == np.repeat(np.maximum.reduceat(held, rows), spread))
            counts += np.bincount(section[most[np.searchsorted(most, rows)]], minlength=n)
        else:
            counts += np.bincount(section, held / np.repeat(np.add.reduceat(held, rows), spread), n)
    return counts, crossed


def line_starts(text: str) -> np.ndarray:
    """Where lines begin; a line's break belongs to it. A text has one line at least."""
    found, at = [0], text.find("\n")
    while at >= 0 and at + 1 < len(text):
        found.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(found, np.int64)


OUT = pa.schema([
    ("section", pa.int64()), ("begin_char", pa.int64()), ("end_char", pa.int64()), ("n_tokens", pa.float64()), ("n_crossing", pa.int64())
])


def _counted(docs: DataFrame, key: str, arrays: str, texts_of, tokenizer: str, kind: str, rule: str, column: str) -> DataFrame:
    def run(batches):
        spans_of = encoder(tokenizer, kind).spans
        for batch in steps(batches, column, ENCODED_TOGETHER):
            texts, starts = texts_of(batch)
            rows, parts = [], []
            for row, (text, begins, spans) in enumerate(zip(texts, starts, spans_of(texts), strict=True)):
                counts, crossed = allocate(spans, begins, len(text), rule)
                rows.append(np.full(len(begins), row))
                parts.append((np.arange(len(begins)), begins, np.append(begins[1:], len(text)), counts, crossed))
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            keys = batch.column(key).take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True))], names=[key, *OUT.names]
            )

    kind_of_key = dict(docs.dtypes)[key]
    return docs.mapInArrow(run, f"{key} {kind_of_key}, {arrays}")


SCHEMA = "section long, begin_char long, end_char long, n_tokens double, n_crossing long"


def count_by_line(docs: DataFrame, tokenizer: str, kind: str = "byte", rule: str = "majority") -> DataFrame:
    """Per row of `docs` (doc_id, text) and line of its text: doc_id, section (from 0), begin_char, end_char, n_tokens,
    n_crossing (tokens that begin in the line and end beyond it). A null or empty text is one empty line; repeated
    rows are counted each."""

    def texts_of(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        return texts, [line_starts(t) for t in texts]

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _counted(read, "doc_id", SCHEMA, texts_of, tokenizer, kind, rule, "text")


def count_by_field(rows: DataFrame, key: str, fields: list[str], tokenizer: str, separator: str = "\n", rule: str = "majority") -> DataFrame:
    """The same for rows whose `fields`, joined with `separator` (null: empty), are encoded as one text: section is the
    field's place in `fields`; a separator belongs to the field before it."""

    def texts_of(batch):
        columns = [[t or "" for t in batch.column(f"f{k}").to_pylist()] for k in range(len(fields))]
        texts = [separator.join(parts) for parts in zip(*columns, strict=True)]
        lengths = np.array([[len(t) for t in c] for c in columns], np.int64).reshape(len(fields), -1).T + len(separator)
        return texts, [np.concatenate([[0], np.cumsum(x)[:-1]]) for x in lengths]

    long = fresh(rows, "size")
    read = rows.select(key, *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{k}") for k, f in enumerate(fields)])
    read = read.withColumn(long, F.concat(*[f"f{k}" for k in range(len(fields))]))
    return _counted(read, key, SCHEMA, texts_of, tokenizer, "byte", rule, long)
