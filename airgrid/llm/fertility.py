"""Quality rules from tokeniser fertility: how public vocabularies cut up a text's words.

Each word of a text is encoded with a blank before it, once per distinct word at hand, by a piece vocabulary with byte
fallback and by a byte-level one. A text's measures are
  chars_per_piece  code points of its words per piece,
  chars_per_byte   the same per token of the byte-level vocabulary,
  byte_share       share of pieces that are fallback bytes,
  token_entropy    entropy of its pieces, in bits.
They differ by language and script, and entropy by length, so a text is judged by a band of its own cell: its language
within its script, or its script where the language is unknown or rare; for entropy, also the power of two that its
piece count reaches. Bands are fences around the quartiles of all texts of the cell that pass the base rules. Quartiles
come from counts of fine bins over all rows, so no group is ever gathered.

Defined results: a null or empty text has no words, all counts 0 and fails the base rules. Repeated rows, and rows
without doc_id, are judged each. A text of any length is one text, read whole. A cell of fewer than LEAST texts has no
band: the script's is taken, and without one too, the measure rejects nothing. An empty table gives an empty result.
"""

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from airgrid.llm.common import fresh, steps, to_batch
from airgrid.session import Workspace

#: Words learnt in one go, and how many words and characters an encoder remembers at most before it starts anew.
LEARNT, REMEMBERED, REMEMBERED_CHARS = 4096, 500_000, 10_000_000
#: Texts of a cell that make a band; width of the fences in quartile ranges.
LEAST, FENCE = 200, 6.0
#: Per measure: bins per unit, the least quartile range taken, and whether small values are rejected too.
MEASURES = {
    "chars_per_piece": (256, 0.05, True),
    "chars_per_byte": (256, 0.05, True),
    "byte_share": (1024, 0.02, False),
    "token_entropy": (256, 0.1, True),
}

#: First code points of ranges of letters and their scripts (fixed values from the Unicode code charts).
SCRIPTS = ["Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Devanagari", "Thai", "Georgian", "Hangul", "Kana", "Han"]
RANGES = [
    (0x0041, 0x005A, "Latin"), (0x0061, 0x007A, "Latin"), (0x00C0, 0x00D6, "Latin"), (0x00D8, 0x00F6, "Latin"),
    (0x00F8, 0x024F, "Latin"), (0x0370, 0x03FF, "Greek"), (0x0400, 0x052F, "Cyrillic"), (0x0531, 0x0587, "Armenian"),
    (0x05D0, 0x05F2, "Hebrew"), (0x0620, 0x06FF, "Arabic"), (0x0904, 0x0963, "Devanagari"), (0x0E01, 0x0E4E, "Thai"),
    (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"),
    (0x3041, 0x30FF, "Kana"), (0x3400, 0x4DBF, "Han"), (0x4E00, 0x9FFF, "Han"), (0xAC00, 0xD7A3, "Hangul"),
]
#: The script of each code point below 0x10000; len(SCRIPTS) for no letter. No range reaches further, nor to the last one.
_SCRIPT = np.full(1 << 16, len(SCRIPTS), np.uint8)
for _begin, _end, _name in RANGES:
    _SCRIPT[_begin : _end + 1] = SCRIPTS.index(_name)
_BLANKS = " \t\n\x0b\x0c\r"


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_SPACE, _SYMBOL = _table(_BLANKS), _table("#*$%&|<>")


class Vocabularies:
    """Both public vocabularies; remembers a bounded number of words."""

    def __init__(self, pieces: str, ranks: str, pattern: str):
        self.pieces = SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.widths = np.zeros(max(table.values()) + 1, np.int64)  # of each token, in bytes
        self.widths[list(table.values())] = list(map(len, table))
        self.size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.size)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(0, np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.first = np.zeros(1, np.int64)
        self.n_bytes = np.zeros(0, np.int32)

    def _byte_tokens(self, words: list[str]) -> np.ndarray:
        """How many byte-level tokens each word has with a blank before it.

        Words are encoded in one go: the pattern puts a blank to what follows it, and ends no match behind it, unless white
        space is beside it, which printable words don't have. So no token reaches over a word's edge."""
        joined = " " + " ".join(words)
        if not joined.isprintable():
            found = np.zeros(len(words), np.int32)
            plain = [i for i, w in enumerate(words) if w.isprintable()]
            if plain:
                found[plain] = self._byte_tokens([words[i] for i in plain])
            for i, w in enumerate(words):
                if not w.isprintable():
                    found[i] = len(self.bytes.encode_ordinary(" " + w))
            return found
        ends = np.cumsum(self.widths[self.bytes.encode_to_numpy(joined)])
        blanks = np.flatnonzero(np.frombuffer(joined.encode(), np.uint8) == 32)
        return np.diff(np.searchsorted(ends, [*blanks, ends[-1]], "right")).astype(np.int32)

    def _learn(self, words: list[str]) -> None:
        ids, ends, n_bytes = [self.ids], [self.first], [self.n_bytes]
        at = self.first[-1]
        for begin in range(0, len(words), LEARNT):
            some = words[begin : begin + LEARNT]
            found = self.pieces.encode(some, num_threads=1)
            ids.append(np.fromiter(chain.from_iterable(found), self.ids.dtype))
            ends.append(at + np.cumsum(list(map(len, found))))
            at = ends[-1][-1]
            n_bytes.append(self._byte_tokens(some))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.chars += sum(map(len, words))
        self.ids, self.first, self.n_bytes = np.concatenate(ids), np.concatenate(ends), np.concatenate(n_bytes)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The places of distinct `words` among those remembered; all of them are remembered until the next call."""
        found = list(map(self.known.get, words))
        new = [i for i, k in enumerate(found) if k is None]
        if new and (len(self.known) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS):
            self._forget()
            new = range(len(words))
        begin = len(self.known)
        if new:
            self._learn([words[i] for i in new])
        for k, i in enumerate(new, begin):
            found[i] = k
        return np.array(found, np.int64)


_loaded: dict[tuple, Vocabularies] = {}


def _vocabularies(*paths: str) -> Vocabularies:
    if paths not in _loaded:
        _loaded[paths] = Vocabularies(*paths)
    return _loaded[paths]


def repeated_words(words: np.ndarray) -> int:
    """How many of the words (as numbers) stand in a window of three that comes twice or more."""
    n = len(words)
    if n < 4:
        return 0
    wide = int(words.max()) + 1
    pairs = words[:-1].astype(np.int64) * wide + words[1:]
    if wide >= 1 << 21:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * wide + words[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _scripts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Per text, which script most of its letters are in (the first of equals; -1: no letters)."""
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    kinds = _SCRIPT[np.minimum(points, len(_SCRIPT) - 1)]
    raw = np.frombuffer(data, np.uint8)
    lead = (raw & 0xC0) != 0x80
    lengths = np.add.reduceat(lead, np.concatenate([[0], ends[:-1]]), dtype=np.int64)  # code points of each text and its blank
    begins = np.cumsum(lengths) - lengths
    counts = np.zeros((len(ends), len(SCRIPTS)), np.int64)
    for k in np.flatnonzero(np.bincount(kinds, minlength=len(SCRIPTS))[: len(SCRIPTS)]):
        counts[:, k] = np.add.reduceat(kinds == k, begins, dtype=np.int64)
    return np.where(counts.any(1), counts.argmax(1), -1)


def measured_texts(texts: list[str | None], known: Vocabularies) -> dict[str, list | np.ndarray]:
    """Counts and measures of whole texts."""
    texts = [t or "" for t in texts]
    n = len(texts)
    encoded = [t.encode() for t in texts]
    data = b" ".join([*encoded, b""])
    ends = np.cumsum([len(e) + 1 for e in encoded])
    raw = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, lengths = edges[::2], edges[1::2] - edges[::2]
    text_of = np.searchsorted(ends, begins, "right")
    n_words = np.bincount(text_of, minlength=n)
    text_begins = np.concatenate([[0], ends[:-1]])  # with its blank, each text has a byte at least
    word_chars = np.add.reduceat(inside & ((raw & 0xC0) != 0x80), text_begins, dtype=np.int64)
    n_symbols = np.add.reduceat(_SYMBOL[raw], text_begins, dtype=np.int64)

    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(raw[inside].tobytes()))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    number = known.numbers(coded.dictionary.to_pylist())
    tokens_of = (known.first[number + 1] - known.first[number])[codes]
    bytes_of = known.n_bytes[number][codes]
    stops = np.cumsum(tokens_of)
    ids = known.ids[np.arange(stops[-1] if len(stops) else 0) + np.repeat(known.first[number][codes] - (stops - tokens_of), tokens_of)]
    doc = np.repeat(text_of, tokens_of)
    n_pieces, n_bytes = (np.bincount(text_of, weights=w, minlength=n).astype(np.int64) for w in (tokens_of, bytes_of))
    n_fallback = np.bincount(doc[known.is_byte[ids]], minlength=n)
    pairs, counts = np.unique(doc * known.size + ids, return_counts=True)
    surprise = np.bincount(pairs // known.size, weights=counts * np.log2(counts), minlength=n)
    some = np.maximum(n_pieces, 1)

    first = np.cumsum(n_words) - n_words
    of_text = [codes[a : a + k] for a, k in zip(first.tolist(), n_words.tolist(), strict=True)]
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
        "n_dup_lines": [repeated_lines(t) for t in texts], "n_repeat_words": [repeated_words(c) for c in of_text],
        "script": [SCRIPTS[k] if k >= 0 else "none" for k in _scripts(data, ends)],
        "n_pieces": n_pieces, "chars_per_piece": word_chars / some, "chars_per_byte": word_chars / np.maximum(n_bytes, 1),
        "byte_share": n_fallback / some, "token_entropy": np.maximum(np.log2(some) - surprise / some, 0.0),
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURED = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), *((c, pa.int64()) for c in COUNTS), ("script", pa.string()), ("n_pieces", pa.int64())]
    + [(m, pa.float64()) for m in MEASURES]
)


def measure(docs: DataFrame, pieces: str, ranks: str, pattern: str) -> DataFrame:
    """Per row of `docs` (doc_id, text, lang): the counts of the base rules and the vocabularies' measures."""

    def run(batches):
        known = _vocabularies(pieces, ranks, pattern)
        for batch in steps(batches, "text", 1 << 19):
            found = measured_texts(batch.column("text").to_pylist(), known)
            yield to_batch(found | {"doc_id": batch.column("doc_id"), "lang": batch.column("lang")}, MEASURED)

    counts = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"doc_id long, lang string, {counts}, script string, n_pieces long, " + ", ".join(f"{m} double" for m in MEASURES)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("text", "lang")])
    return read.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _cell(name: str) -> Column:
    """The cell of a measure within a language or script."""
    if name != "token_entropy":
        return F.lit(name)
    return F.concat(F.lit(f"{name}/"), F.floor(F.log2(F.greatest("n_pieces", F.lit(1).cast("long")))).cast("string"))


def fit_bands(measured: DataFrame, least: int = LEAST, fence: float = FENCE) -> DataFrame:
    """key (script, or script/language), bands (map: cell to lo and hi) from all rows of `measured` that pass the base rules."""
    keys = F.when(F.col("lang").isNull(), F.array("script")).otherwise(F.array(F.col("script"), F.concat_ws("/", "script", "lang")))
    values = F.array(*[
        F.struct(_cell(m).alias("cell"), F.lit(m).alias("measure"), F.floor(F.col(m) * bins).alias("bin")) for m, (bins, _, _) in MEASURES.items()
    ])
    rows = measured.where(~base_failed()).select(keys.alias("keys"), F.explode(values).alias("v"))
    rows = rows.select(F.explode("keys").alias("key"), "v.cell", "v.measure", "v.bin")
    counted = rows.groupBy("key", "cell", "measure", "bin").agg(F.count(F.lit(1)).alias("n"))
    quartiles = counted.groupBy("key", "cell", "measure").agg(
        F.percentile("bin", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"), F.sum("n").alias("texts")
    )
    lo, hi = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (bins, narrow, below) in MEASURES.items():
        first, third = F.col("q")[0] / bins, (F.col("q")[1] + 1) / bins
        reach = fence * F.greatest(third - first, F.lit(narrow))
        here = F.col("measure") == name
        lo = F.when(here, first - reach if below else F.lit(float("-inf"))).otherwise(lo)
        hi = F.when(here, third + reach).otherwise(hi)
    bands = quartiles.where(F.col("texts") >= least).select("key", "cell", lo.alias("lo"), hi.alias("hi"))
    entry = F.struct("cell", F.struct("lo", "hi"))
    return bands.groupBy("key").agg(F.map_from_entries(F.collect_list(entry)).alias("bands"))


def judge(measured: DataFrame, bands: DataFrame) -> DataFrame:
    """`measured` with base_failed, outside (measures beyond their band) and kept."""
    own, wide = fresh(measured, "own"), fresh(measured, "wide")
    rows = measured.withColumn(own, F.concat_ws("/", "script", "lang"))
    rows = rows.join(bands.select(F.col("key").alias(own), F.col("bands").alias(f"{own}_bands")), own, "left")
    rows = rows.join(bands.select(F.col("key").alias("script"), F.col("bands").alias(f"{wide}_bands")), "script", "left")

    def beyond(name: str) -> Column:
        band = F.coalesce(F.try_element_at(f"{own}_bands", _cell(name)), F.try_element_at(f"{wide}_bands", _cell(name)))
        out = ~F.col(name).between(band["lo"], band["hi"])
        return F.when(F.coalesce(out, F.lit(False)), F.lit(name))

    rows = rows.withColumn("base_failed", base_failed())
    rows = rows.withColumn("outside", F.array_compact(F.array(*[beyond(m) for m in MEASURES])))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
    return rows.drop(own, f"{own}_bands", f"{wide}_bands")


def apply_rules(docs: DataFrame, work: Workspace, pieces: str, ranks: str, pattern: str, least: int = LEAST, fence: float = FENCE) -> DataFrame:
    """Per row of `docs`: doc_id, the base counts, base_failed, kept, and the measures that decided."""
    measured = work.keep(measure(docs, pieces, ranks, pattern), "measured")
    judged = judge(measured, work.keep(fit_bands(measured, least, fence), "bands"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "script", "n_pieces", *MEASURES, "outside")
