"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

A source's ratio of target to size is the expected number of copies of each of its documents. The whole part is
taken outright; the fractions are rounded in pairs: mass moves at random from one document of a pair to the
other, keeping the pair's expected words, until one of them is at 0 or 1, and the other goes on to the next pair.
Groups of about FAN_IN documents do this side by side, and what they leave over meets in the next level of a
tree, so a source ends within one document of its target, and no task ever holds a source.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airgrid.llm.common import BITMAP_WORDS, fresh, n_words
from airgrid.session import Workspace

FAN_IN = 64
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
_NEAR = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """One row per source of `sizes` (source, size): source, n_docs, source_size, target.

    Sources in code point order, null last, take the weights in turn. Their targets are in proportion to the
    weights, but none above `most` times its size: what is beyond goes to the others by weight until none is above.
    So there is a level with target = min(cap, level * weight); it is found in one pass over the sources ordered by
    cap / weight, as the highest of the levels that the remaining sources
    reach once the sources before them are at their caps. The windows are over sources, not documents.
    """
    sources = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")))
    sources = sources.withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(share)
    sources = sources.withColumn(
        "level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    )
    level = F.max("level").over(everything)  # rises as long as caps bind, and falls behind
    target = F.least("cap", level * F.col("weight"))
    sources = sources.withColumn("target", target)
    return sources.select("source", "n_docs", "source_size", "target")


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on `parts` alone."""
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)


def _meet(state: Column, unit: Column, seed: int) -> Column:
    """One step of the rounding: what is left so far meets the next unit. state: left (unit or null), done (units)."""
    left, p, w, q, v = state["left"], state["left"]["p"], state["left"]["w"], unit["p"], unit["w"]
    up, down = F.least(1 - p, q * v / w), F.least(p, (1 - q) * v / w)  # p may rise or fall by so much
    rises = _draw(left["doc_id"], left["size"], unit["doc_id"], unit["size"], F.lit(seed)) * (up + down) < down
    moved = F.when(rises, up).otherwise(-down)

    def snapped(x: Column) -> Column:
        return F.when(x < _NEAR, 0.0).when(x > 1 - _NEAR, 1.0).otherwise(x)

    one, other = left.withField("p", snapped(p + moved)), unit.withField("p", snapped(q - moved * w / v))
    open_one = (one["p"] > 0) & (one["p"] < 1)
    open_other = (other["p"] > 0) & (other["p"] < 1)
    nothing = F.when(F.lit(False), unit)
    met = F.struct(
        F.when(open_one, one).when(open_other, other).otherwise(nothing).alias("left"),
        F.concat(
            state["done"],
            F.when(open_one, F.array(other)).when(open_other, F.array(one)).otherwise(F.array(one, other)),
        ).alias("done"),
    )
    return F.when(left.isNull(), F.struct(unit.alias("left"), state["done"].alias("done"))).otherwise(met)


#: Largest first: what a group leaves over is then small, and so is the last draw.
UNIT = "struct<turn:double,order:bigint,doc_id:bigint,size:bigint,p:double,w:double>"


def _level(units: DataFrame, seed: int) -> DataFrame:
    """Round within each (source, bucket). One row per group: source, bucket, left, done."""
    gathered = units.groupBy("source", "bucket").agg(
        F.sort_array(
            F.collect_list(
                F.struct((-F.col("w")).alias("turn"), F.xxhash64(F.lit(seed), "doc_id", "size").alias("order"), "doc_id", "size", "p", "w")
            )
        ).alias("all")
    )
    start = F.struct(F.lit(None).cast(UNIT).alias("left"), F.array().cast(f"array<{UNIT}>").alias("done"))
    folded = F.aggregate("all", start, lambda state, unit: _meet(state, unit, seed))
    return gathered.select("source", "bucket", folded.alias("state")).select("source", "bucket", "state.left", "state.done")


def copies(sized: DataFrame, work: Workspace, seed: int = 7, **mix) -> DataFrame:
    """How often each document goes into the mix.

    `sized`: doc_id, source, size (words, not null), one row per document; read several times, so pass a written
    stage. Returns one row per distinct (doc_id, source, size): with n_same (rows that share it), source_size, target
    and copies (0, 1 or 2). Rows that agree in all three share one decision; the rounding weighs them together.
    Null ids and null sources are values like any other. Documents without words never enter the mix. The draws
    depend on ids and sizes only: reruns agree on any partitioning.
    """
    targets = work.keep(source_targets(sized, **mix), "targets")
    units = work.keep(_with_targets(sized, targets), "units")
    whole = F.floor(F.col("ratio") + _NEAR)
    part = F.greatest(F.col("ratio") - whole, F.lit(0.0))
    part = F.when(part < _NEAR, 0.0).otherwise(part)
    units = units.withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(0)).withColumn("p", part)
    buckets = F.ceil(F.col("n_docs") / FAN_IN)
    level = units.where((F.col("p") > 0) & (F.col("size") > 0)).select(
        "source", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), buckets).alias("bucket"),
        "doc_id", "size", "p", (F.col("size") * F.col("n_same")).cast("double").alias("w"),
    )
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    levels = 1 + max(0, math.ceil(math.log(max(1, math.ceil(largest / FAN_IN)), FAN_IN) - 1e-9))
    rounded = []
    for k in range(levels):
        state = work.keep(_level(level, seed + k), f"rounded-{k}")
        rounded.append(state.select("source", F.explode("done").alias("unit")))
        level = state.where(F.col("left").isNotNull()).select(
            "source", F.floor(F.col("bucket") / FAN_IN).alias("bucket"), "left.doc_id", "left.size", "left.p", "left.w"
        )
    last = level.select(
        "source",
        F.struct(
            (-F.col("w")).alias("turn"), F.lit(0).cast("long").alias("order"), "doc_id", "size",
            F.when(_draw(F.col("doc_id"), F.col("size"), F.lit(seed + levels)) < F.col("p"), 1.0).otherwise(0.0).alias("p"),
            "w",
        ).alias("unit"),
    )
    drawn = last
    for done in rounded:
        drawn = drawn.unionByName(done)
    drawn = drawn.select("source", "unit.doc_id", "unit.size", F.col("unit.p").cast("int").alias("extra"))
    same = [units[c].eqNullSafe(drawn[c]) for c in ("doc_id", "source", "size")]
    extra = F.coalesce(drawn["extra"], F.lit(0))
    return units.join(drawn, same[0] & same[1] & same[2], "left").select(
        units["doc_id"], units["source"], units["size"], "n_same", "source_size", "target",
        (units["whole"] + extra).cast("int").alias("copies"),
    )


def _with_targets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    units = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_same"))
    ratio = F.when(targets["source_size"] > 0, targets["target"] / targets["source_size"]).otherwise(0.0)
    return units.join(targets, units["source"].eqNullSafe(targets["source"])).select(
        "doc_id", units["source"], "size", "n_same", "n_docs", "source_size", "target", ratio.alias("ratio")
    )


def mix_report(docs: DataFrame, work: Workspace, **mix) -> DataFrame:
    """One row per row of `docs` (doc_id, source, text): doc_id, size, source_size, target, taken."""
    sized = work.keep(docs.select(F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size")), "sizes")
    decided = copies(sized, work, **mix)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_same")))
    return decided.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), each.alias("nth")
    ).drop("nth")


def mix_documents(docs: DataFrame, work: Workspace, **mix) -> DataFrame:
    """The mix itself: each row of `docs` as often as it was taken, with the columns of `docs`.

    Three bitmaps over hashed ids and sources tell which documents come never, once and twice. A row's own one has its
    bit, so a row with a single bit is certain, and its text stays where it is; the others join the counts exactly."""
    sized = work.keep(docs.select(F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size")), "sizes")
    decided = copies(sized, work, **mix).select(
        F.col("doc_id").alias("k_doc"), F.col("source").alias("k_source"), F.col("size").alias("k_size"),
        F.col("copies").alias("k_copies"),
    )
    decided = work.keep(decided, "copies")
    place = lambda doc, source: F.pmod(F.xxhash64(doc, source), F.lit(64 * BITMAP_WORDS))
    held = decided.select(place(F.col("k_doc"), F.col("k_source")).alias("p"), "k_copies").selectExpr(
        "p div 64 as b_word", "shiftleft(1L, cast(p % 64 as int)) as bit", "k_copies"
    )
    words = held.groupBy("b_word").agg(*[
        F.bit_or(F.when((F.col("k_copies") == k) | (F.col("k_copies") > 2), F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"b_{k}")
        for k in range(3)
    ])
    words = work.keep(words, "bitmaps")

    at, bit, number, size, nth = (fresh(docs, x) for x in ("place", "bit", "copies", "size", "nth"))
    marked = docs.withColumn(at, place(F.col("doc_id").cast("long"), F.col("source"))).withColumn(bit, F.expr(f"shiftleft(1L, cast({at} % 64 as int))"))
    found = marked.join(F.broadcast(words), F.expr(f"{at} div 64") == words["b_word"])
    may = [(words[f"b_{k}"].bitwiseAND(marked[bit]) != 0).cast("int") for k in range(3)]
    certain = F.when(may[0] + may[1] + may[2] == 1, may[1] + 2 * may[2])
    found = found.select(*[marked[c] for c in docs.columns], certain.alias(number))
    sure = found.where(F.col(number) > 0).withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(number))))
    asked = found.where(F.col(number).isNull()).withColumn(size, n_words(F.col("text")))
    same = (
        asked["doc_id"].eqNullSafe(decided["k_doc"])
        & asked["source"].eqNullSafe(decided["k_source"])
        & (asked[size] == decided["k_size"])
        & (decided["k_copies"] > 0)
    )
    rest = asked.join(decided, same).withColumn(nth, F.explode(F.sequence(F.lit(1), decided["k_copies"])))
    return sure.select(*docs.columns).unionByName(rest.select(*[asked[c] for c in docs.columns]))
