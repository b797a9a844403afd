"""N-gram Jaccard join by prefix filtering under several global token orders.

If two sets are similar enough, then under any one order of all tokens their prefixes (the first
n - ceil(t * n) + 1 tokens of n) share a token. Candidates come from the order that puts tokens of many documents
last; a pair must then also share prefix tokens under ORDERS further orders, which are pseudo-random, before its
sets are compared. All of this is exact: the orders only decide how many pairs are looked at. As tokens of many documents
stand last, what a token's documents make of pairs stays within a fixed multiple of their number. Tokens are counted, and
brought together, in blocks; nearly all of them are of one document alone and end there.

Large groups are not expanded into their pairs. Documents with equal sets are one class, and only its smallest id goes
on. Of the documents that share a prefix token, each is first compared with a leader, and so are those that share one of a
few keys made of smallest hashes, which similar sets do most of the time; what these links connect is then one component, and the full search runs between documents of different components only. There a bitmap of each set
passes over pairs that differ too much, before they are pairs; a wider one of each long set does so before texts are gathered.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airgrid.llm.blocks import block_ddl, dealt, from_blocks, to_blocks
from airgrid.llm.common import fresh, perhaps_in, steps, to_batch
from airgrid.llm.components import components
from airgrid.session import Workspace

#: Tokens whose document counts the first order knows, at most, and how many documents make a token one of them. Tokens
#: are counted exactly where they may come into a prefix: REACH times its length from its begin, by their hash.
FREQUENT, FEW, REACH = 1 << 19, 4, 1.5
ORDERS = 2
#: Keys by which similar sets meet for a first comparison, each of so many smallest hashes under orders of their own.
KEYS, SMALLEST = 6, 2
#: Words of the bitmaps that tell sets apart which can't be similar.
WORDS = 16
#: Bytes whose words are hashed together; bytes of texts that are compared together.
PIECE, COMPARED = 1 << 20, 1 << 19
#: Postings of a token whose pairs are looked at where they meet.
LISTED = 16
#: A leader's partners are dealt over tasks by so many of their shingles.
PARTNERS = 1 << 15
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word that is hashed by eight bytes at a time; the first bytes of eight.
SHORT = 64
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers (the splitmix64 finaliser)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


_SPACE = _is_space()
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    """The first `n` powers of the prime, modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 64), _PRIME)
        factors[0] = 1
        _powers = np.multiply.accumulate(factors)
    return _powers[:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-cased `data` begin, and a 64-bit hash of each: a polynomial of its bytes, taken eight at a
    time in words of up to SHORT bytes, then mixed with its length. All words at once, in column operations."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eights = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    hashes = eights[starts] & _FIRST_BYTES[np.minimum(lengths, 8)]
    at = 8
    rest = np.flatnonzero(lengths > at)
    while len(rest) and at < SHORT:
        hashes[rest] = _mixed(hashes[rest]) + (eights[starts[rest] + at] & _FIRST_BYTES[np.minimum(lengths[rest] - at, 8)])
        at += 8
        rest = rest[lengths[rest] > at]
    if len(rest):
        first = np.cumsum(lengths[rest]) - lengths[rest]  # of each long word among all long words' bytes
        place = np.arange(first[-1] + lengths[rest[-1]]) - np.repeat(first, lengths[rest])
        terms = _power_table(int(lengths[rest].max()))[place]
        terms *= raw[place + np.repeat(starts[rest], lengths[rest])]
        hashes[rest] = np.add.reduceat(terms, first)
    return starts, _mixed(_mixed(hashes, 1) + lengths.astype(np.uint64))


def _pieces(data: bytes):
    """`data` in pieces of about PIECE bytes that end before white space, with their places; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield at, data[at:end]
        at = end


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """The distinct `hashes`, sorted. (A plain sort; np.unique builds a hash table first, which takes longer for a text.)"""
    hashes = np.sort(hashes)
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    return hashes[new]


def shingle_sets(texts: list[str | None], size: int, n_words: list[int] | None = None) -> list[np.ndarray]:
    """The set of each text's word shingles as sorted 64-bit hashes. A to Z are lower-cased; fewer words are one shingle.
    `n_words`, if given, gets each text's number of words."""
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    data = b" ".join(encoded).lower()
    found = [(at + starts, hashes) for at, piece in _pieces(data) for starts, hashes in [word_hashes(piece)]]
    starts, words = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    ends = np.cumsum([len(e) + 1 for e in encoded])
    last = np.searchsorted(starts, ends)
    rolled = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for k in range(size):
        rolled *= _PRIME
        rolled += words[k : k + len(rolled)]
    rolled, out, begin = _mixed(rolled), [], 0
    for end in last.tolist():
        n = end - begin
        if n >= size:
            out.append(_distinct(rolled[begin : end - size + 1]))
        elif n:
            whole = np.uint64(n)
            for w in words[begin:end]:
                whole = np.multiply(whole, _PRIME, dtype=np.uint64) + w
            out.append(_mixed(np.array([whole], np.uint64)))
        else:
            out.append(words[:0])
        begin = end
        if n_words is not None:
            n_words.append(n)
    return out


def n_prefix(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def counted(token: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens, sorted, and the sum of each one's counts `n`."""
    if not len(token):
        return token, n
    order = np.argsort(token)
    token, n = token[order], n[order]
    begins = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1])
    return token[begins], np.add.reduceat(n, begins)


def frequent_tokens(docs: DataFrame, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of many documents with their counts, FREQUENT at most, in order of token.

    Without counts, a prefix would be a set's first hashes. Frequent ones of these are what makes many candidates, so all
    documents' first hashes are counted, half as many again as a prefix has: put last, they make room for the next ones."""

    def first(batches):
        for batch in steps(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            tokens = np.concatenate([x[: math.ceil(REACH * n_prefix(len(x), percent))] for x in sets])
            yield tokens, np.ones(len(tokens), np.int32)

    def many(batches):
        schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])
        for pieces in from_blocks(batches, [np.uint64, np.int32]):
            token, n = (np.concatenate(c) for c in zip(*pieces, strict=True))
            token, n = counted(token, n.astype(np.int64))
            yield to_batch({"token": token[n > FEW].view(np.int64), "n": n[n > FEW]}, schema)

    blocks = docs.select("text").mapInArrow(lambda batches: to_blocks(first(batches), counted), block_ddl(2))
    found = dealt(blocks).mapInArrow(many, "token long, n long").orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    token, n = found["token"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


SETS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("prefix", pa.binary()), ("orders", pa.binary()),
    ("bits", pa.list_(pa.int64())), ("wide", pa.binary()), ("keys", pa.list_(pa.int64())),
])


def keys_of(sets: list[np.ndarray]) -> list[np.ndarray | None]:
    """KEYS numbers of each set that sets share the likelier the more similar they are: each mixes the first tokens under
    SMALLEST pseudo-random orders, those of products with odd numbers. None for an empty set."""
    full = [x for x in sets if len(x)]
    if not full:
        return [None] * len(sets)
    tokens, begins = np.concatenate(full), np.cumsum([0, *map(len, full[:-1])])
    out = np.tile(np.arange(KEYS, dtype=np.uint64), (len(full), 1))
    odd = _mixed(np.arange(100, 100 + KEYS * SMALLEST, dtype=np.uint64)) | np.uint64(1)
    for k, factor in enumerate(odd):
        first = np.minimum.reduceat(tokens * factor, begins)
        out[:, k // SMALLEST] = _mixed(out[:, k // SMALLEST] ^ first, 7)
    found = iter(out.view(np.int64))
    return [next(found) if len(x) else None for x in sets]


def bitmap(tokens: np.ndarray, words: int = WORDS) -> np.ndarray:
    """`words` words, a power of two, with a bit for each hash: whether an odd number of tokens has it. Each token that only
    one of two sets has turns one bit, so the sets differ in at least as many tokens as their bitmaps in bits."""
    counts = np.bincount(((tokens >> np.uint64(32)) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words)
    return np.packbits(counts & 1 == 1, bitorder="little").view(np.int64)


def bitmaps(sets: list[np.ndarray]) -> list[np.ndarray | None]:
    """The bitmap of each set, None for an empty one; a few hundred sets at once."""
    out = []
    for begin in range(0, len(sets), 256):
        some = sets[begin : begin + 256]
        place = (np.concatenate(some) >> np.uint64(32)).astype(np.int64) & (64 * WORDS - 1)
        place += np.repeat(np.arange(len(some)) * (64 * WORDS), [len(x) for x in some])
        odd = np.bincount(place, minlength=64 * WORDS * len(some)) & 1 == 1
        bits = np.packbits(odd, bitorder="little").view(np.int64).reshape(len(some), WORDS)
        out += [b if len(x) else None for x, b in zip(some, bits, strict=True)]
    return out


def wide_bitmap(tokens: np.ndarray) -> bytes | None:
    """A bitmap of a bit for each token and more, for sets that turn most bits of WORDS words."""
    words = 1 << max(0, math.ceil(len(tokens) / 64) - 1).bit_length()
    return bitmap(tokens, words).tobytes() if words > WORDS else None


def wide_apart(a: bytes | None, b: bytes | None) -> int:
    """In how many bits wide bitmaps differ, the wider one folded; 0 without one."""
    if a is None or b is None:
        return 0
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    least = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, least), 0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _differ_little(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """What bitmaps allow: sets with `percent` of their union in common differ in (100 - percent) of it at most."""
    apart = sum((F.bit_count(a["bits"][k].bitwiseXOR(b["bits"][k])) for k in range(WORDS)), F.lit(0))
    return apart * (100 + percent) <= (a["n"] + b["n"]) * (100 - percent)


def order_prefixes(sets: list[np.ndarray], percent: int) -> list[bytes | None]:
    """Each set's prefixes under the further orders, one after the other: 16 bits of each token, so that equal tokens stay
    equal. Prefixes that meet by their bits alone are one more pair to compare, never a pair lost. None for an empty set."""
    tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
    ends = np.cumsum([len(x) for x in sets])
    found = [[] for _ in sets]
    for k in range(ORDERS):
        mixed = _mixed(tokens, k + 1)
        for parts, x, end in zip(found, sets, ends, strict=True):
            if len(x):
                p, own = n_prefix(len(x), percent), mixed[end - len(x) : end]
                own.partition(p - 1)
                parts.append(own[:p].astype(np.uint16))  # the lower bits
    return [b"".join(x.tobytes() for x in parts) if parts else None for parts in found]


def orders_meet(a: bytes, b: bytes) -> bool:
    """Whether two documents share prefix tokens under every further order."""
    x, y = (np.frombuffer(o, np.uint16).reshape(ORDERS, -1) for o in (a, b))
    return all(np.isin(x[k], y[k]).any() for k in range(ORDERS))


def first_prefixes(sets: list[np.ndarray], token: np.ndarray, n: np.ndarray, percent: int) -> list[np.ndarray]:
    """The prefix of each set in the first order: by the counts `n` of frequent tokens (sorted), others 0, then by hash."""
    sizes = [n_prefix(len(x), percent) if len(x) else 0 for x in sets]
    out = [x[:p] for x, p in zip(sets, sizes, strict=True)]
    if not len(token) or not any(sizes):
        return out
    heads = np.concatenate(out)
    hit = token[np.minimum(np.searchsorted(token, heads), len(token) - 1)] == heads
    of = np.repeat(np.arange(len(sets)), sizes)
    for k in np.unique(of[hit]).tolist():  # the others' first tokens by hash are all of count 0
        found = sets[k]
        at = np.minimum(np.searchsorted(token, found), len(token) - 1)
        out[k] = found[np.argsort(np.where(token[at] == found, n[at], 0), kind="stable")[: sizes[k]]]
    return out


def signed_sets(docs: DataFrame, work: Workspace, size: int, percent: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_words, n (set size), sig (equal for equal sets; null for the empty set), prefix (first order), orders, bits, wide, keys,
    and the columns `carried`."""
    with work.running():
        frequent = frequent_tokens(docs, size, percent)
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        token, n = sent.value
        for batch in steps(batches, "text"):
            rows = {"doc_id": batch.column("doc_id"), "n_words": [], "n": [], "sig": [], "wide": []}
            sets = shingle_sets(batch.column("text").to_pylist(), size, rows["n_words"])
            rows |= {"keys": keys_of(sets), "orders": order_prefixes(sets, percent), "bits": bitmaps(sets)}
            rows["prefix"] = [x.tobytes() for x in first_prefixes(sets, token, n, percent)]
            for found in sets:
                rows["n"].append(len(found))
                rows["sig"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                rows["wide"].append(wide_bitmap(found))
            schema = pa.schema([*SETS, *map(batch.schema.field, carried)])
            yield to_batch(rows | {c: batch.column(c) for c in carried}, schema)

    kinds = "doc_id long, n_words long, n long, sig binary, prefix binary, orders binary, bits array<long>, wide binary, keys array<long>"
    return docs.mapInArrow(run, ", ".join([kinds, *(f"`{c}` {kind}" for c, kind in docs.select(*carried).dtypes)]))


def _near(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """What sizes and places of a shared prefix token allow: an overlap of `percent` of the union.

    Tokens before the shared one can be shared only as often as the shorter head, tokens behind it as the shorter tail."""
    most = F.least(a["pos"], b["pos"]) + 1 + F.least(a["n"] - a["pos"], b["n"] - b["pos"]) - 1
    return (100 * most >= percent * (a["n"] + b["n"] - most)) & (100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"]))


def _near_first(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """The same for the first prefix token that two sets share, at which every similar pair passes: no token before it is
    shared, so the shorter tail bounds the overlap."""
    most = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return (100 * most >= percent * (a["n"] + b["n"] - most)) & (100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"]))


def _meeting(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of `pairs` (a, b) whose bitmaps differ little and whose prefixes meet under all further orders, with n, the size
    of b's set."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                both = zip(*(part.column(c).to_pylist() for c in ("na", "n", "wa", "wb", "va", "vb")), strict=True)
                met = pa.array([
                    wide_apart(wa, wb) * (100 + percent) <= (na + nb) * (100 - percent) and orders_meet(va, vb) for na, nb, wa, wb, va, vb in both
                ], pa.bool_())
                yield part.select(["a", "b", "n"]).filter(met)

    leading, others = (perhaps_in(classes, "doc", pairs.select(side).distinct()) for side in "ab")
    left = leading.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("orders").alias("va"), F.col("bits").alias("ba"), F.col("wide").alias("wa"))
    right = others.select(F.col("doc").alias("b"), "n", F.col("orders").alias("vb"), F.col("bits").alias("bb"), F.col("wide").alias("wb"))
    near = _differ_little({"n": F.col("na"), "bits": F.col("ba")}, {"n": F.col("n"), "bits": F.col("bb")}, percent)
    found = pairs.join(left, "a").join(right, "b").where(near).select("a", "b", "na", "n", "wa", "wb", "va", "vb").mapInArrow(run, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.max("n").alias("n"))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, several: DataFrame, work: Workspace, size: int, percent: int) -> DataFrame:
    """Those of `pairs` (a, b, distinct) that share prefixes under all further orders and whose sets are similar.

    Only texts of documents in pairs that pass the orders are gathered. Each goes to its partner a once, and a's own text
    stands before its partners', dealt over several tasks where these are many: so a task holds one set of a and a
    few texts at a time, and sets are built once. `several`: ids with more than one text; any of them may do.
    """
    meeting = work.keep(_meeting(pairs, classes, percent), "meeting")
    needed = meeting.select(F.col("a").alias("doc_id")).unionByName(meeting.select(F.col("b").alias("doc_id"))).distinct()
    texts = perhaps_in(docs, "doc_id", needed)
    if not several.isEmpty():
        once = perhaps_in(texts, "doc_id", several, inside=False)
        again = perhaps_in(texts, "doc_id", several).groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
        texts = once.unionByName(again.select("doc_id", "text"))
    shares = meeting.groupBy("a").agg(F.ceil(F.sum("n") / PARTNERS).alias("shares"))
    dealt = meeting.join(shares, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"))
    asked = dealt.select("a", "share", F.col("b").alias("doc_id"), F.lit(True).alias("partner")).unionByName(
        dealt.select("a", "share", F.col("a").alias("doc_id"), F.lit(False).alias("partner")).distinct()
    )

    def run(batches):
        hub, sets = None, []  # the document at hand and the sets of its texts
        for batch in steps(batches, "text", COMPARED):
            keys = zip(*(batch.column(c).to_pylist() for c in ("a", "share", "doc_id", "partner")), strict=True)
            linked = {"a": [], "b": []}
            for (a, share, doc, partner), found in zip(keys, shingle_sets(batch.column("text").to_pylist(), size), strict=True):
                if not partner:
                    hub, sets = ((a, share), [found]) if hub != (a, share) else (hub, [*sets, found])
                elif any(similar(x, found, percent) for x in sets):
                    linked["a"].append(a)
                    linked["b"].append(doc)
            yield to_batch(linked, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    placed = asked.join(texts, "doc_id").select("a", "share", "partner", "doc_id", "text")
    placed = placed.repartition("a", "share").sortWithinPartitions("a", "share", "partner")
    links = work.keep(placed.mapInArrow(run, "a long, b long").distinct(), "links")
    work.drop(meeting)
    return links


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets, sorted, have `percent` of their union in common."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared)


SHARED = pa.schema([
    ("token", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("lead_pos", pa.int32()), ("leader", pa.int64()), ("lead_n", pa.int32()),
    ("first", pa.bool_()),
])
_POSTING = [np.uint64, np.int64, np.int32, np.int32]


def _by_token(token, doc, n, pos):
    order = np.argsort(token)
    return token[order], doc[order], n[order], pos[order]


def _repeated(token, *columns):
    """The rows whose token another row has too."""
    order = np.argsort(token)
    same = token[order[1:]] == token[order[:-1]]
    order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    return [c[order] for c in (token, *columns)]


def _leaders(token, m, pos, doc, n):
    """Of each token, in order: how many postings (sum of `m`), and the least pos, then doc, with its n."""
    order = np.lexsort((doc, pos, token))
    token, m, pos, doc, n = token[order], m[order], pos[order], doc[order], n[order]
    begins = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1])
    return token[begins], np.add.reduceat(m, begins), pos[begins], doc[begins], n[begins]


def _near_any(token, n, pos, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each posting, sorted by token, whether _near, and whether _near_first, allows a pair of it and any other one of its
    token. True for all of a token with more than LISTED postings, as its pairs are not listed here."""
    near, first = (np.zeros(len(token), bool) for _ in range(2))
    if len(token) > LISTED:
        at = np.flatnonzero(token[LISTED:] == token[:-LISTED])
        for k in range(LISTED + 1):
            near[at + k] = first[at + k] = True
    x = np.arange(len(token))
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    for k in range(1, LISTED):
        x = x[x + k < len(token)]
        x = x[token[x] == token[x + k]]
        y = x + k
        tail, both = np.minimum(n[x] - pos[x], n[y] - pos[y]), n[x] + n[y]
        sized = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        for found, most in ((near, tail + np.minimum(pos[x], pos[y])), (first, tail)):
            may = sized & (100 * most >= percent * (both - most))
            found[x[may]] = found[y[may]] = True
    return near, first


def led_postings(pieces: list, percent: int):
    """For each piece of postings (token, doc, n, pos), all of their tokens' together, the rows of SHARED."""
    near = [(np.ones(len(p[0]), bool),) * 2 for p in pieces]
    if len(pieces) == 1:
        pieces = [_repeated(*pieces[0])]
        near = [_near_any(*(pieces[0][k] for k in (0, 2, 3)), percent)]
    # A token of very many documents may fill several pieces; only its leader is held beside them.
    led = [_leaders(t, np.ones(len(t), np.int64), pos, doc, n) for t, doc, n, pos in pieces if len(t)]
    led = _leaders(*(np.concatenate(c) for c in zip(*led, strict=True))) if led else None
    if led is None or not (led[1] > 1).any():
        return
    tokens, _, lead_pos, leader, lead_n = (c[led[1] > 1] for c in led)
    for (t, doc, n, pos), (any_near, first) in zip(pieces, near, strict=True):
        at = np.minimum(np.searchsorted(tokens, t), len(tokens) - 1)
        kept = (tokens[at] == t) & any_near
        at = at[kept]
        yield {
            "token": t[kept].view(np.int64), "doc": doc[kept], "n": n[kept], "pos": pos[kept],
            "lead_pos": lead_pos[at], "leader": leader[at], "lead_n": lead_n[at], "first": first[kept],
        }


def shared_postings(classes: DataFrame, percent: int) -> DataFrame:
    """token, doc, n, pos and lead_pos, leader, lead_n: postings of tokens that several documents of `classes` have in their
    prefix, each with its token's leader, the document that has fewest rarer tokens. Of copies that were changed in places,
    this is the one they were made of. `first`: the token may be the first one that it shares with a similar set.

    The tokens that one document alone has, nearly all, never become rows, nor do postings that sizes and places
    leave no partner."""

    def postings(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            prefixes = [np.frombuffer(x, np.uint64) for x in batch.column("prefix").to_pylist()]
            sizes = np.array([len(x) for x in prefixes])
            doc, n = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("doc", "n"))
            pos = np.arange(sizes.sum(), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
            yield np.concatenate(prefixes), doc, n, pos

    def met(batches):
        for pieces in from_blocks(batches, _POSTING):
            for rows in led_postings(pieces, percent):
                yield to_batch(rows, SHARED)

    sets = classes.select("doc", F.col("n").cast("int").alias("n"), "prefix")
    blocks = sets.mapInArrow(lambda batches: to_blocks(postings(batches), _by_token), block_ddl(4))
    return dealt(blocks).mapInArrow(met, "token long, doc long, n int, pos int, lead_pos int, leader long, lead_n int, first boolean")


def _one_each(signed: DataFrame, work: Workspace) -> tuple[DataFrame, list[DataFrame]]:
    """Rows of `signed` with an id and words, one for each set, under the smallest id that has it (doc), and the stages that
    they are read from besides. Only sets that several rows may have are grouped and written; the others stay where they are."""
    columns = ("n", "prefix", "orders", "bits", "wide", "keys")
    rows = signed.where("doc_id is not null and sig is not null")
    place = fresh(signed, "place")
    copies = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.xxhash64("sig").alias("h"))
    copies = work.keep(copies, "copies")
    marked = rows.withColumn(place, F.xxhash64("sig"))
    again = perhaps_in(marked, place, copies).groupBy("sig").agg(F.min("doc_id").alias("doc"), *[F.first(c).alias(c) for c in columns])
    again = work.keep(again, "again")
    once = perhaps_in(marked, place, copies, inside=False).select("sig", F.col("doc_id").alias("doc"), *columns)
    return once.unionByName(again), [copies, again]


def _to_leader(led: DataFrame, percent: int) -> DataFrame:
    """b, a: each document of `led` (token, doc, n, pos, leader, lead_n, lead_pos) with the one of its tokens' leaders that it
    has most prefix tokens in common with, of those that sizes and places allow."""
    me, lead = ({c: F.col(f"{side}{c}") for c in ("n", "pos")} for side in ("", "lead_"))
    return (
        led.where((F.col("doc") != F.col("leader")) & _near(me, lead, percent))
        .groupBy("doc", "leader").agg(F.count(F.lit(1)).alias("common"))
        .groupBy("doc").agg(F.max(F.struct("common", "leader")).alias("best"))
        .select(F.col("best.leader").alias("a"), F.col("doc").alias("b"))
    )


def _to_key_leader(classes: DataFrame) -> DataFrame:
    """b, a: each document with the first one of those that it shares a key with."""

    def keyed(batches):
        for batch in batches:
            found = batch.column("keys")
            sizes = np.diff(found.offsets.to_numpy())
            yield found.flatten().to_numpy().view(np.uint64), np.repeat(batch.column("doc").to_numpy(), sizes)

    def met(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for pieces in from_blocks(batches, [np.uint64, np.int64]):
            if len(pieces) == 1:
                pieces = [_repeated(*pieces[0])]
            first = _first_documents(*(np.concatenate(c) for c in zip(*map(lambda p: _first_documents(*p), pieces), strict=True)))
            for key, doc in pieces:
                leader = first[1][np.searchsorted(first[0], key)]
                other = leader != doc
                yield to_batch({"a": leader[other], "b": doc[other]}, schema)

    def sort(key, doc):
        order = np.argsort(key)
        return key[order], doc[order]

    blocks = classes.select("doc", "keys").mapInArrow(lambda batches: to_blocks(keyed(batches), sort), block_ddl(2))
    return dealt(blocks).mapInArrow(met, "a long, b long")


def _first_documents(key, doc):
    """The distinct keys, sorted, and the least document of each."""
    if not len(key):
        return key, doc
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    begins = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return key[begins], np.minimum.reduceat(doc, begins)


def _apart(postings: DataFrame, known: DataFrame, work: Workspace) -> DataFrame:
    """`postings` (token, doc, n, pos) of tokens that documents of different components (`known`) share, with the component."""
    placed = postings.join(known.withColumnRenamed("node", "doc"), "doc", "left")
    placed = work.keep(placed.withColumn("component", F.coalesce("component", "doc")), "placed")
    mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    apart = work.keep(placed.join(mixed, "token", "left_semi"), "apart")
    work.drop(placed)
    return apart


def _joined(known: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """Components (node, component) when `links` (a, b) are added to those `known`: only components that they connect are
    worked on again."""
    at = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"{side}_in"))
    between = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    again = components(between.select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b")), work)
    moved = again.select(F.col("node").alias("component"), F.col("component").alias("to"))
    before = known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return before.unionByName(again.join(known.select("node"), "node", "left_anti"))


def link_documents(docs: DataFrame, work: Workspace, size: int = 4, percent: int = 85, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_shingles, sig, component_id, and its columns `carried`.

    Two documents link when 100 * intersection >= percent * union of their shingle sets. component_id is the smallest
    doc_id that links reach from the row. Texts without words link with nothing. Rows that share a doc_id are
    one document with several texts, so links of any of them connect it; rows without doc_id link with nothing and have a
    null component_id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    docs = rows.select("doc_id", "text")
    signed = work.keep(signed_sets(rows, work, size, percent, carried), "signed")
    classes, read = _one_each(signed, work)
    members = work.keep(signed.select("doc_id", "n_words", "n", "sig", *carried), "members")
    known_ids = members.where("doc_id is not null and sig is not null")
    several = work.keep(known_ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "several")

    shared = work.keep(shared_postings(classes, percent), "postings")
    slim = work.keep(classes.select("sig", "doc", "n", "orders", "bits", "wide"), "documents")
    first = work.keep(_to_leader(shared, percent).unionByName(_to_key_leader(classes)).distinct(), "first-pairs")
    work.drop(signed, *read)

    links = verified(first, slim, docs, several, work, size, percent)
    work.drop(first)
    known = components(links, work)
    apart = _apart(shared.where("first").select("token", "doc", "n", "pos"), known, work)
    work.drop(shared, links)

    # A document of several texts has no one bitmap, and in one of a long text any two sets differ in half of the bits, which
    # is allowed: they are told apart later.
    telling = 2 * F.col("n") * (100 - percent) < 38 * WORDS * (100 + percent)
    single = slim.where(telling).select("doc", "bits").join(several.withColumnRenamed("doc_id", "doc"), "doc", "left_anti")
    marked = apart.join(single, "doc", "left")
    x, y = marked.alias("x"), marked.alias("y")
    left, right = ({c: F.col(f"{s}.{c}") for c in ("n", "pos", "bits")} for s in "xy")
    across = (
        x.join(y, F.col("x.token") == F.col("y.token"))
        .where((F.col("x.doc") < F.col("y.doc")) & (F.col("x.component") != F.col("y.component")) & _near_first(left, right, percent))
        .where(F.coalesce(_differ_little(left, right, percent), F.lit(True)))
        .select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()
    )
    across = work.keep(across, "across")
    work.drop(apart)
    more = verified(across, slim, docs, several, work, size, percent)

    named = known_ids.select("doc_id", "sig").join(several, "doc_id", "left_semi").join(slim.select("sig", "doc"), "sig")
    twice = named.groupBy("doc_id").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo <> hi")
    same = named.join(twice, "doc_id").where("doc <> lo").select(F.col("lo").alias("a"), F.col("doc").alias("b"))
    known, before = work.keep(_joined(known, more.unionByName(same), work), "components"), known
    work.drop(across, more, before)

    found = members.join(slim.select("sig", "doc"), "sig", "left")
    found = found.join(known.withColumnRenamed("node", "doc"), "doc", "left")
    smallest = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id"))
    found = work.keep(found.select("doc_id", "n_words", F.col("n").alias("n_shingles"), "sig", smallest.alias("component_id"), *carried), "linked")
    work.drop(members, slim, several, known)
    return found


def keep_one(docs: DataFrame, work: Workspace, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` without near copies: of each component the document with the smallest id stays, with the
    columns of `docs`. Of rows that share this id one stays. Rows without words or without id all stay."""
    found = link_documents(docs, work, size, percent)
    goes = F.expr("not (sig is null or doc_id = component_id)")
    stays = found.where(F.coalesce(~goes, F.lit(True))).select(F.col("doc_id").alias("k_doc"), F.col("sig").isNull().alias("k_empty")).distinct()
    # Only documents of which a row goes, or which have several rows, need the join: the others pass as they are.
    touched = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or(goes).alias("gone"))
    touched = work.keep(touched.where("n > 1 or gone").select("doc_id"), "touched")
    id_, empty, nth = fresh(docs, "id"), fresh(docs, "empty"), fresh(docs, "nth")
    marked = docs.withColumn(id_, F.col("doc_id").cast("long"))
    asked = perhaps_in(marked, id_, touched)
    asked = asked.withColumn(empty, ~F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    joined = asked.join(stays, F.col(id_).eqNullSafe(F.col("k_doc")) & (F.col(empty) == F.col("k_empty")))
    twin = Window.partitionBy("k_doc", "k_empty").orderBy(F.xxhash64("text"))
    joined = joined.withColumn(nth, F.row_number().over(twin))
    one = joined.where((F.col(nth) == 1) | F.col("k_empty") | F.col("k_doc").isNull())
    return perhaps_in(marked, id_, touched, inside=False).select(*docs.columns).unionByName(one.select(*docs.columns))
