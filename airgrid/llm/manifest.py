"""Merkle manifest of a dataset, with checkpoints and recomputation.

A tree per source stands over its documents in order of doc_id; a tree over the sources' roots, in order of the
source's bytes (null first), gives the root. Runs of FANOUT nodes become the hash of their digests. Only every LEVELS-th
level is written: a row of it is an aligned subtree's SPAN bottom nodes. Whoever needs a proof regenerates the nodes in
between from these, takes the siblings on each node's way up, and forgets the rest; the way above a subtree comes from
the written level above. All trees climb together, one stage a written level, so the stages grow with the logarithm of
the largest source.

Defined results: rows with equal doc_id are ordered by their leaf; a null doc_id comes first, counts as `-` and is never
tampered with; a source that is empty text is not a null one. A document without siblings has the proof of no bytes.
An empty table gives an empty result and no root.
"""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import arrow_schema, to_batch
from airgrid.llm.numbering import numbered
from airgrid.session import Workspace

FANOUT, LEVELS = 3, 3
SPAN = FANOUT**LEVELS


def hashed(digests: list[bytes]) -> bytes:
    """SHA-256 of the digests as lower-case hexadecimal text in a row."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def regenerate(nodes: list[bytes], whole: bool) -> list[list[bytes]]:
    """The levels over an aligned subtree's bottom `nodes`, those first: LEVELS of them, or, of a subtree that is the
    `whole` rest of its tree, as many as lead to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([hashed(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def way_up(levels: list[list[bytes]], place: int) -> bytes:
    """The siblings on the way from a bottom node to the top: per level a byte for how many stand left of the node, one
    for how many right, and their digests."""
    out = []
    for level in levels[:-1]:
        begin = place // FANOUT * FANOUT
        left, right = level[begin:place], level[place + 1 : begin + FANOUT]
        out.append(bytes([len(left), len(right)]) + b"".join(left + right))
        place //= FANOUT
    return b"".join(out)


def siblings(way: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    """A way up as lists of left and right siblings, level by level."""
    out, at = [], 0
    while at < len(way):
        n_left, n = way[at], way[at] + way[at + 1]
        found = [way[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(n)]
        out.append((found[:n_left], found[n_left:]))
        at += 2 + 32 * n
    return out


def fold(node: bytes, steps: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The root that a node and its siblings lead to."""
    for left, right in steps:
        node = hashed([*left, node, *right])
    return node


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 (32 bytes) of the fields: `-` if null, else the byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256))


@dataclass
class Forest:
    """Trees that stand side by side. `levels`: the written levels from the bottom, each with rows of tree, block, total
    (nodes of the tree on that level) and nodes (at most SPAN structs, the last field the digest). `roots`: tree, digest."""

    levels: list[DataFrame]
    roots: DataFrame


def _blocks(nodes: DataFrame, fields: list[str]) -> DataFrame:
    """Rows of tree, pos, total and `fields` gathered to aligned subtrees of at most SPAN nodes."""
    found = nodes.groupBy("tree", F.expr(f"pos div {SPAN}").alias("block"), "total").agg(
        F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("nodes")
    )
    return found.select("tree", "block", "total", F.transform("nodes", lambda x: x.dropFields("pos")).alias("nodes"))


def _digests(nodes: pa.ListArray) -> list[list[bytes]]:
    """Each row's digests: the last field of its nodes."""
    return [[tuple(x.values())[-1] for x in row] for row in nodes.to_pylist()]


def _tops(level: DataFrame, whole: bool) -> DataFrame:
    """tree, pos (its block), total (nodes on the level that the digests make up), digest over each row of a level."""
    schema = "tree string, pos long, total long, digest binary"

    def run(batches):
        for batch in batches:
            tops = [regenerate(nodes, whole)[-1][0] for nodes in _digests(batch.column("nodes"))]
            yield to_batch({"tree": batch["tree"], "pos": batch["block"], "total": batch["total"], "digest": tops}, arrow_schema(schema))

    last = level.schema["nodes"].dataType.elementType.names[-1]
    above = F.expr(f"(total + {SPAN - 1}) div {SPAN}").alias("total")
    slim = level.select("tree", "block", above, F.transform("nodes", lambda x: F.struct(x[last].alias("digest"))).alias("nodes"))
    return slim.mapInArrow(run, schema)


def plant(leaves: DataFrame, order: list[str], fields: list[str], work: Workspace) -> Forest:
    """Trees over `leaves` (tree, not null; `order`, `fields`, of which the last is the digest)."""
    placed = numbered(leaves, "tree", order, work)
    levels = [work.keep(_blocks(placed, fields), "level")]
    most = levels[0].agg(F.max("total")).first()[0] or 0
    roots = []
    while True:
        level = levels[-1]
        roots.append(_tops(level.where(F.col("total") <= SPAN), whole=True).select("tree", "digest"))
        if most <= SPAN:
            break
        tops = _tops(level.where(F.col("total") > SPAN), whole=False)
        levels.append(work.keep(_blocks(tops, ["digest"]), "level"))
        most = -(-most // SPAN)
    found = roots[0]
    for other in roots[1:]:
        found = found.unionByName(other)
    return Forest(levels, work.keep(found, "roots"))


def ways(forest: Forest, above: DataFrame, work: Workspace) -> DataFrame:
    """The bottom level's rows with `way`, the siblings above each of them. `above` has, per tree, what leads on from its
    root as `way` (binary) and may have further columns, which go along."""
    carried = [c for c in above.columns if c not in ("tree", "way")]
    kinds = {f.name: f.dataType.simpleString() for f in above.schema}
    down = None
    for k in range(len(forest.levels) - 1, -1, -1):
        level = forest.levels[k]
        found = level.where(F.col("total") <= SPAN).join(above, "tree")
        if down is not None:
            found = found.unionByName(level.where(F.col("total") > SPAN).join(down, ["tree", "block"]))
        if k == 0:
            return found

        def run(batches):
            for batch in batches:
                rows, blocks, out = [], [], []
                for row, (nodes, block, total, way) in enumerate(zip(
                    _digests(batch.column("nodes")), *(batch.column(c).to_pylist() for c in ("block", "total", "way")), strict=True
                )):
                    levels = regenerate(nodes, whole=total <= SPAN)
                    rows += [row] * len(nodes)
                    blocks += range(block * SPAN, block * SPAN + len(nodes))
                    out += [way_up(levels, i) + way for i in range(len(nodes))]
                same = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("tree", *carried)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(blocks, pa.int64()), pa.array(out, pa.binary())], names=["tree", *carried, "block", "way"]
                )

        schema = ", ".join(["tree string", *(f"{c} {kinds[c]}" for c in carried), "block long", "way binary"])
        down = work.keep(found.mapInArrow(run, schema), "ways")


def extract(forest: Forest, above: DataFrame, work: Workspace, run: Callable, schema: str, wanted: Column | None = None) -> DataFrame:
    """Proofs of the leaves: `run` is called with each bottom row (a dict with its nodes, way and what `above` has), the
    levels regenerated over it, and gives a list of tuples of `schema`. With `wanted`, a condition on such rows, for
    those subtrees only."""
    rows = ways(forest, above, work)
    rows = rows if wanted is None else rows.where(wanted)

    def each(batches):
        for batch in batches:
            # A slice at a time: proofs are longer than the nodes they come from.
            for begin in range(0, batch.num_rows, 64):
                found = []
                for row in batch.slice(begin, 64).to_pylist():
                    nodes = [tuple(x.values())[-1] for x in row["nodes"]]
                    found += run(row, regenerate(nodes, whole=row["total"] <= SPAN))
                if found:
                    kinds = arrow_schema(schema)
                    yield to_batch(dict(zip(kinds.names, zip(*found, strict=True), strict=True)), kinds)

    return rows.mapInArrow(each, schema)


#: Before a source's name, so that null, as empty text, comes first and differs from an empty name.
_NAMED = "+"


def tree_of(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit(_NAMED), source.cast("string")), F.lit(""))


@dataclass
class Manifest:
    """`documents`: a tree per source, with doc_id, claimed and leaf of its documents. `sources`: the tree of their roots."""

    documents: Forest
    sources: Forest


def build(leaves: DataFrame, work: Workspace) -> Manifest:
    """`leaves`: doc_id, source, leaf (binary), claimed (binary; what somebody says the leaf is, null: the same)."""
    rows = leaves.select("doc_id", "claimed", "leaf", tree_of(F.col("source")).alias("tree"))
    documents = plant(work.keep(rows, "leaves"), ["doc_id", "leaf"], ["doc_id", "claimed", "leaf"], work)
    roots = documents.roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    return Manifest(documents, plant(roots, ["source"], ["source", "digest"], work))


def above_sources(manifest: Manifest, work: Workspace) -> DataFrame:
    """Per source: tree, subroot, root (both binary) and way, the siblings above its root."""

    def run(row, levels):
        return [(x["source"], x["digest"], row["root"], way_up(levels, i) + row["way"]) for i, x in enumerate(row["nodes"])]

    top = manifest.sources.roots.select("tree", F.col("digest").alias("root"), F.lit(b"").alias("way"))
    found = extract(manifest.sources, top, work, run, "tree string, subroot binary, root binary, way binary")
    return work.keep(found, "sources")


def proofs(manifest: Manifest, work: Workspace, wanted: Column | None = None) -> DataFrame:
    """Per document (of subtrees that hold a `wanted` one): doc_id, leaf, subroot, root, proof (array of the siblings as
    text, left to right, level by level)."""

    def run(row, levels):
        out = []
        for i, x in enumerate(row["nodes"]):
            steps = siblings(way_up(levels, i) + row["way"])
            out.append((x["doc_id"], *(d.hex() for d in (x["leaf"], row["subroot"], row["root"])), [d.hex() for s in steps for d in s[0] + s[1]]))
        return out

    schema = "doc_id long, leaf string, subroot string, root string, proof array<string>"
    return extract(manifest.documents, above_sources(manifest, work), work, run, schema, wanted)


REPORT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verification(manifest: Manifest, work: Workspace) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256 (hash of its siblings), folded_root (what its claimed leaf
    and its siblings lead to), verified (whether that is the root)."""

    def run(row, levels):
        out, upper, root = [], siblings(row["way"]), row["root"]
        end = {}  # where each top that this subtree's leaves lead to ends: most lead to the same
        for i, x in enumerate(row["nodes"]):
            lower = siblings(way_up(levels, i))
            top = fold(x["claimed"] or x["leaf"], lower)
            if top not in end:
                end[top] = fold(top, upper)
            proof = hashed([d for left, right in lower + upper for d in left + right])
            out.append((x["doc_id"], x["leaf"].hex(), row["subroot"].hex(), root.hex(), proof.hex(), end[top].hex(), end[top] == root))
        return out

    return extract(manifest.documents, above_sources(manifest, work), work, run, REPORT)


def document_leaves(docs: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """Leaves of `docs` (doc_id, source, lang, n_chars, text); claimed is the leaf with `changed` for a text where
    `tampered` and the text differs."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *fields[1:3], F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    differs = F.coalesce(tampered & (changed != F.col("text")), F.lit(False))
    claimed = F.when(differs, leaf_hash(*fields[:4], changed))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf_hash(*fields).alias("leaf"), claimed.alias("claimed"))


def tampering(docs: DataFrame, work: Workspace) -> DataFrame:
    """Manifest and proofs of untampered `docs`, verified against documents of which those with an even crc32 of their
    id have lost their line breaks."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = document_leaves(docs, even, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return verification(build(leaves, work), work)
