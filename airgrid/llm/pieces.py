"""Encoding whole texts with a tokenizer file, remembering the pieces that come again.

A byte-pair tokenizer first splits a text into pieces (words, numbers, runs of marks) and merges within each piece
alone. So a text's tokens are its pieces' tokens in a row, and each distinct piece needs to be encoded once. Pieces
are found here only in texts whose characters are all below U+0100, where splitting is beyond doubt; any other text,
and any that holds a special token's string, goes to the tokenizer as it is. A test compares both ways.

Memory is bounded whatever the texts: a long text is cut where no piece and no token can go on, pieces are learnt
a few thousand at a time, and an encoder that remembers too many pieces or characters starts anew.
"""

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces and their characters that are remembered at most, and pieces learnt at a time.
REMEMBERED, REMEMBERED_CHARS, LEARNT = 500_000, 6_000_000, 4096
#: Characters that a long text is cut after, and that are encoded together, about.
PART, TOGETHER = 1 << 18, 1 << 20
#: A single blank between letters or digits: both kinds of tokenizer begin a piece there, whatever stands around it.
_BETWEEN = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
#: How the two kinds of tokenizer files split (fixed values, limited to characters below U+0100).
PIECES = {
    "word": f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+",
    "byte": (
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
        f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    ),
}


_CHARS = [chr(i) for i in range(256)]
_BLANK, _MARK = 0, 3
#: Of each character below U+0100, its lower-case one and its kind: white space, letter, number, or any other mark.
_LOWER = np.frombuffer("".join(pc.utf8_lower(pa.array(_CHARS)).to_pylist()).encode("latin-1"), np.uint8)
_KIND = np.array([next((k for k, x in enumerate((_SPACE, _LETTER, _NUMBER)) if re.match(f"[{x}]", c)), _MARK) for c in _CHARS], np.uint8)


def word_begins(raw: np.ndarray) -> np.ndarray:
    """Where pieces of the "word" kind begin in lower-case characters below U+0100: what PIECES["word"] finds, for all at
    once. A piece goes on while its kind does, but each number stands alone, and 's and its like end where they end."""
    kind = _KIND[raw]
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    begins = ((kind != before) | (kind == _KIND[ord("0")])) & (kind != _BLANK)
    quotes = np.flatnonzero((raw == ord("'")) & (before != _MARK))  # a quote within a run of marks is one of them
    if len(quotes):
        padded = np.concatenate([raw, np.full(3, ord(" "), np.uint8)])
        first, second = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        both = first.astype(np.int32) << 8 | second
        long = np.isin(both, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])
        begins[quotes[short | long] + 1] = False
        ends = np.concatenate([quotes[short] + 2, quotes[long] + 3])
        ends = ends[ends < len(raw)]
        begins[ends] = _KIND[raw[ends]] != _BLANK
    return begins


def parts(text: str):
    """(begin, part) of `text` in parts of about PART characters that can be encoded one by one."""
    at = 0
    while len(text) - at > PART:
        found = _BETWEEN.search(text, at + PART)
        if not found:
            break
        yield at, text[at : found.start()]
        at = found.start()
    yield at, text[at:]


def groups(texts: list[str | None]):
    """All texts' parts as lists of (text's number, begin, part), each list of about TOGETHER characters."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for begin, part in parts(text or ""):
            if group and size + len(part) > TOGETHER:
                yield group
                group, size = [], 0
            group.append((i, begin, part))
            size += len(part)
    if group:
        yield group


class Column:
    """Numbers in a row that more are added to; the room doubles when it is full."""

    def __init__(self, kind, *first):
        self.room, self.n = np.array([*first, 0], kind), len(first)

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            self.room = np.resize(self.room, max(2 * len(self.room), self.n + len(values)))
        self.room[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def held(self) -> np.ndarray:
        return self.room[: self.n]


class PieceEncoder:
    """`kind`: "word" lower-cases and drops white space, "byte" keeps every character."""

    def __init__(self, path: str, kind: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.lower = kind == "word"
        self.find = re.compile(PIECES[kind]).findall
        ends = [t for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])]
        self.closes = np.array([t.endswith("</w>") for t in ends]) if self.lower else None
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str | bytes, int] = {}
        self.chars = 0
        self.first = Column(np.int64, 0)  # where each known piece's tokens begin
        self.ids = Column(np.uint32)
        self.ends, self.begins = Column(np.int32), Column(np.int32)  # per token, offsets within its piece
        self.lengths = Column(np.int32)

    def _whole(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return True
        return any(s in text for s in self.specials)

    def _ids_of_words(self, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        """Ids alone: one text of all pieces is encoded, and a token that closes a word ends its piece."""
        text = b" ".join(pieces).decode("latin-1")
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("the tokenizer doesn't close each piece with its end-of-word mark")
        return ends, ids

    def _ids_and_offsets(self, pieces: list[str]) -> tuple[np.ndarray, ...]:
        found = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
        offsets = np.array([o for e in found for o in e.offsets], np.int32).reshape(-1, 2)
        return (
            np.cumsum([len(e.ids) for e in found], dtype=np.int64), np.array([i for e in found for i in e.ids], np.uint32),
            offsets[:, 0], offsets[:, 1], np.array([len(p) for p in pieces], np.int32),
        )

    def _learn(self, pieces: list) -> None:
        columns = [self.ids] if self.lower else [self.ids, self.begins, self.ends, self.lengths]
        for begin in range(0, len(pieces), LEARNT):
            some = pieces[begin : begin + LEARNT]
            ends, *found = (self._ids_of_words if self.lower else self._ids_and_offsets)(some)
            self.first.add(self.first.held[-1] + ends)
            for column, values in zip(columns, found, strict=True):
                column.add(values)
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.chars += sum(map(len, pieces))

    def _remember(self, new: list, needed: list) -> bool:
        """Learn `new`, or all that is `needed` now where too much is remembered already; whether it was the latter."""
        full = len(self.known) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS
        if full:
            self._forget()
        self._learn(needed if full else new)
        return full

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Per text, the numbers of its pieces, which hold until the next call."""
        if self.lower:
            return self._word_numbers(texts)
        found = [self.find(t) for t in texts]
        new = list({p for pieces in found for p in pieces if p not in self.known})
        if new:
            self._remember(new, list({p for pieces in found for p in pieces}))
        get = self.known.__getitem__
        return [np.fromiter(map(get, pieces), np.int64, len(pieces)) for pieces in found]

    def _word_numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The same by column operations: white space dropped, what is left cut into pieces, known here by their bytes."""
        if not texts:
            return []
        raw = _LOWER[np.frombuffer("\n".join(texts).encode("latin-1"), np.uint8)]
        begins = word_begins(raw)
        inside = _KIND[raw] != _BLANK
        edges = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside))
        buffers = [None, pa.py_buffer(edges), pa.py_buffer(raw[inside])]
        coded = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = self._known_numbers(pieces)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            if self._remember(new, pieces):
                number = self._known_numbers(pieces)
            else:
                number[missing] = self._known_numbers(new)
        firsts = np.cumsum([len(t) + 1 for t in texts[:-1]], dtype=np.int64)  # of the second text and on
        return np.split(number[coded.indices.to_numpy(zero_copy_only=False)], np.searchsorted(np.flatnonzero(begins), firsts))

    def _known_numbers(self, pieces: list) -> np.ndarray:
        """Each piece's number, -1 for those that are not known."""
        return np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))

    def _tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pieces in a row: which remembered token each token is, and each piece's token count."""
        begins = self.first.held[numbers]
        counts = self.first.held[numbers + 1] - begins
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - counts), counts)
        return at, counts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text (null: none)."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for group in groups(texts):
            plain = [bool(t.strip(_SPACE)) and not self._whole(t) for _, _, t in group]
            numbers = iter(self._numbers([t for (_, _, t), p in zip(group, plain, strict=True) if p]))
            for (i, _, text), known in zip(group, plain, strict=True):
                if known:
                    out[i].append(self.ids.held[self._tokens(next(numbers))[0]])
                elif text:
                    out[i].append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
        return [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def spans(self, texts: list[str | None]) -> list[np.ndarray]:
        """Character spans of each text's tokens, an array of (begin, end) rows. For the "byte" kind only."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for group in groups(texts):
            plain = [bool(t) and not self._whole(t) for _, _, t in group]
            numbers = iter(self._numbers([t for (_, _, t), p in zip(group, plain, strict=True) if p]))
            for (i, begin, text), known in zip(group, plain, strict=True):
                if known:
                    mine = next(numbers)
                    at, counts = self._tokens(mine)
                    lengths = self.lengths.held[mine].astype(np.int64)
                    base = np.repeat(begin + np.cumsum(lengths) - lengths, counts)
                    out[i].append(np.stack([base + self.begins.held[at], base + self.ends.held[at]], 1))
                elif text:
                    found = self.tokenizer.encode(text, add_special_tokens=False).offsets
                    out[i].append(begin + np.array(found, np.int64).reshape(-1, 2))
        return [np.concatenate(x) if x else np.zeros((0, 2), np.int64) for x in out]


_encoders: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, kind: str) -> PieceEncoder:
    """One encoder per Python worker, so what one batch has learnt serves the next."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = PieceEncoder(path, kind)
    return _encoders[path, kind]
