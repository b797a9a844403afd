"""Gradient-boosted trees for all segments at once, with a small parameter search.

Every segment needs a model per depth and validation fold, and one per depth on all rows. All of these replicas grow
together, level by level: tasks sum the gradients of their rows per segment, replica, node, feature and bin, the sums are
added up per segment and replica, and the best split is chosen there. So a search is a fixed number of Spark jobs, about
one per level and tree, whatever the number of segments, replicas and rows.

Trees are symmetric: all nodes of a level share one split, the one that lowers the squared error most. A tree's levels
therefore are the first levels of any deeper tree on the same residuals, and a boosted model's first trees are a
shorter model, so shorter runs are scored on the way, and the refit on all rows is a replica like the others.

Features are cut into bins at quantiles, once per segment. Rows are kept in chunks with the predictions of all replicas,
written anew after each tree: a lost executor costs a level at most.
"""

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid import config
from airgrid.operators.segments import join_per_segment
from airgrid.schema import SEGMENT
from airgrid.session import Workspace

LOWEST = -1.7976931348623157e308
#: Replica fold that leaves no row out.
ALL_ROWS = -1
#: Bytes of sums that a task holds before it hands them on, and that it hands on at once.
HELD, HANDED = 64 << 20, 4 << 20
#: Bytes of a chunk's predictions.
CHUNK_BYTES = 2 << 20
#: Bytes of a tree's leaves up to which they go to every task, instead of the chunks going where the leaves are.
LEAVES_SENT = 32 << 20
#: With more tasks than this, sums are first added up in shares.
SHARED_BEYOND = 16


@dataclass(frozen=True)
class BoostingSettings:
    """`rate`: what of a leaf's mean is taken; `shrink`: rows that a leaf's mean is drawn towards zero by."""

    iterations: list[int] = field(default_factory=lambda: config.BOOSTING_ITERATIONS)
    depths: list[int] = field(default_factory=lambda: config.BOOSTING_DEPTHS)
    cv_folds: int = 3
    rate: float = 0.5
    shrink: float = 3.0
    bins: int = 32

    @property
    def several(self) -> bool:
        return len(self.iterations) * len(self.depths) > 1

    @property
    def replicas(self) -> list[tuple[int, int]]:
        """(depth, fold left out): what is grown for each segment."""
        folds = [*range(self.cv_folds), ALL_ROWS] if self.several else [ALL_ROWS]
        depths = sorted(set(self.depths)) if self.several else self.depths[:1]
        return [(depth, fold) for depth in depths for fold in folds]


@dataclass(frozen=True)
class Boosted:
    """What became of all segments. `models`: segment, iterations, depth, base, trees (the best setting's); `grid`:
    segment, iterations, depth, r2; `errors`: segment, error of those without a model."""

    models: DataFrame
    grid: DataFrame
    errors: DataFrame


def with_cv_folds(train: DataFrame, folds: int) -> DataFrame:
    """Give each segment's rows contiguous validation folds of about equal size, in order of time.

    Fold borders are found on row counts per day and slot, a table bounded by the calendar; the rows
    themselves are never sorted or numbered. A border inside a day and slot is a share of its rows: a
    hash of the block decides which side a row is on, so that a moment with many rows is split too.
    """
    moment = F.col("blockdate").cast("long") * 100 + F.col("hour")
    cells = train.groupBy(*SEGMENT, moment.alias("moment")).agg(F.count(F.lit(1)).alias("n"))
    segment = Window.partitionBy(*SEGMENT)
    cells = cells.withColumn("until", F.sum("n").over(segment.orderBy("moment"))).withColumn("total", F.sum("n").over(segment))
    borders = cells.groupBy(*SEGMENT).agg(*[
        F.min(F.when(F.col("until") * folds > F.col("total") * k, F.struct(
            "moment", (F.ceil(F.col("total") * k / folds - F.col("until") + F.col("n")) / F.col("n")).alias("share"),
        ))).alias(f"from_{k}") for k in range(1, folds)
    ])
    # The first 32 bits of a digest, as a number from 0 to 1.
    place = F.conv(F.substring(F.md5(F.col("blockid").cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    fold = sum((
        F.coalesce((
            (moment > F.col(f"from_{k}.moment")) | ((moment == F.col(f"from_{k}.moment")) & (F.coalesce(place, F.lit(0.0)) >= F.col(f"from_{k}.share")))
        ).cast("int"), F.lit(0))
        for k in range(1, folds)
    ), F.lit(0))
    return join_per_segment(train, borders).select(*train.columns, fold.alias("cv_fold"))


def training_table(train: DataFrame, settings: BoostingSettings, work: Workspace) -> DataFrame:
    """Only what the fits need, written by segment, so that a chunk holds rows of one segment."""
    rows = with_cv_folds(train, settings.cv_folds)
    rows = rows.select(*SEGMENT, *config.FEATURES, config.LABEL, "cv_fold")
    return work.keep(rows, "train", partition_by=SEGMENT)


def fold_statistics(train: DataFrame, segments: list[tuple[str, str]]) -> dict[tuple[str, str], dict[int, tuple]]:
    """Per listed segment and validation fold: rows, label sum and variance, and rows that can't be learned from. One
    pass; a few numbers per segment."""
    found = {segment: {} for segment in segments}
    values = [F.col(c).cast("double") for c in (*config.FEATURES, config.LABEL)]
    sound = F.coalesce(F.forall(F.array(*values), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)), F.lit(False))
    rows = train.groupBy(*SEGMENT, "cv_fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(config.LABEL).alias("total"), F.var_pop(config.LABEL).alias("spread"), F.count_if(~sound).alias("unsound")
    )
    for r in rows.collect():
        if (r["cnlname"], r["day_type"]) in found:
            found[r["cnlname"], r["day_type"]][r["cv_fold"]] = r["n"], r["total"], r["spread"], r["unsound"]
    return found


def borders(train: DataFrame, bins: int) -> DataFrame:
    """Per segment and feature, the distinct values at which its rows are cut into `bins` parts of about equal size."""
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    return train.groupBy(*SEGMENT).agg(
        F.array(*[F.array_sort(F.array_distinct(F.percentile_approx(F.col(c).cast("double"), shares, F.lit(10_000)))) for c in config.FEATURES]).alias("borders")
    )


def _below(value: Column):
    return lambda border: border < value


def _index(segments: pa.RecordBatch):
    """(segment, its rows' places) of a batch."""
    pairs = list(zip(*(segments.column(c).to_pylist() for c in SEGMENT), strict=True))
    where: dict[tuple, list[int]] = {}
    for i, pair in enumerate(pairs):
        where.setdefault(pair, []).append(i)
    return where.items()


CHUNK = "cnlname string, day_type string, n long, bins binary, labels binary, folds binary, predicted binary, errors array<double>"


def chunks(train: DataFrame, cuts: DataFrame, settings: BoostingSettings, bases: dict[tuple, list[float]]) -> DataFrame:
    """Rows of one segment together, those of an Arrow batch or fewer, so that their predictions have a bounded size: bins
    (n, features), labels, folds, and what each replica predicts so far (replicas, n), at first the mean label it may see."""
    most = max(1, CHUNK_BYTES // (8 * len(settings.replicas)))
    binned = join_per_segment(train, cuts).select(
        *SEGMENT, F.col(config.LABEL).cast("double").alias("label"), F.col("cv_fold").cast("int").alias("fold"),
        *[
            F.size(F.filter(F.get("borders", F.lit(k)), _below(F.col(c).cast("double")))).alias(f"bin_{k}")
            for k, c in enumerate(config.FEATURES)
        ],
    )

    def run(batches):
        for batch in batches:
            columns = [batch.column(f"bin_{k}").to_numpy() for k in range(len(config.FEATURES))]
            bins, labels, folds = np.stack(columns, 1).astype(np.uint8), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for segment, places in _index(batch):
                for k in range(0, len(places), most):
                    where = places[k : k + most]
                    start = np.repeat(np.array(bases[segment])[:, None], len(where), 1)
                    yield _chunk(segment, bins[where], labels[where], folds[where].astype(np.int16), start, None)

    return binned.mapInArrow(run, CHUNK)


def _chunk(segment, bins, labels, folds, predicted, errors) -> pa.RecordBatch:
    held = [x.tobytes() for x in (bins, labels, folds, predicted)]
    arrays = [
        pa.array([segment[0]], pa.string()), pa.array([segment[1]], pa.string()), pa.array([len(labels)], pa.int64()),
        *[pa.array([x], pa.binary()) for x in held], pa.array([errors], pa.list_(pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in CHUNK.split(", ")])


def _opened(batches, columns=("bins", "labels", "folds", "predicted")):
    """(segment, arrays, the batch's other columns at that row) of each chunk."""
    kinds = {"bins": np.uint8, "labels": np.float64, "folds": np.int16, "predicted": np.float64}
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column("n")[i].as_py()
            found = [np.frombuffer(batch.column(c)[i].as_buffer(), kinds[c]) for c in columns]
            shapes = {"bins": (n, -1), "predicted": (-1, n)}
            found = [x.reshape(shapes[c]) if c in shapes else x for c, x in zip(columns, found, strict=True)]
            yield tuple(batch.column(c)[i].as_py() for c in SEGMENT), found, (batch, i)


def node_of(bins: np.ndarray, splits: list[tuple[int, int]]) -> np.ndarray:
    """Each row's node below `splits`: a bit per level, set where the row's bin lies beyond the border."""
    node = np.zeros(len(bins), np.int64)
    for feature, border in splits:
        node = 2 * node + (bins[:, feature] > border)
    return node


def best_split(gradients: np.ndarray, counts: np.ndarray, shrink: float) -> tuple[float, int, int]:
    """(what it explains, feature, border) of the split that explains most of the squared error, the first of equals.
    Sums and counts are (nodes, features, bins); a border leaves the bins up to its own on the left."""
    left, n_left = gradients.cumsum(2)[:, :, :-1], counts.cumsum(2)[:, :, :-1]
    right, n_right = gradients.sum(2, keepdims=True) - left, counts.sum(2, keepdims=True) - n_left
    explained = (left**2 / (n_left + shrink) + right**2 / (n_right + shrink)).sum(0)
    feature, border = divmod(int(explained.argmax()), explained.shape[1])
    return float(explained[feature, border]), feature, border


def leaf_values(gradients: np.ndarray, counts: np.ndarray, feature: int, border: int, settings: BoostingSettings) -> np.ndarray:
    """Values of the leaves that a last split makes, (2 * nodes,)."""
    sums = np.stack([x[:, feature, : border + 1].sum(1) for x in (gradients, counts)] + [x[:, feature, border + 1 :].sum(1) for x in (gradients, counts)])
    return (settings.rate * np.stack([sums[0] / np.maximum(sums[1] + settings.shrink, 1e-300), sums[2] / np.maximum(sums[3] + settings.shrink, 1e-300)], 1)).ravel()


SUMS = "cnlname string, day_type string, replica int, share int, sums binary"
CHOSEN = "cnlname string, day_type string, replica int, ends int, feature int, border int, leaves array<double>, error string"


def _level(state: DataFrame, settings: BoostingSettings, splits: dict, active: list[int], ends: dict[int, int]) -> DataFrame:
    """The next split (CHOSEN) of every segment and active replica, given the current tree's `splits` so far. Replicas in
    `ends` have their last split here and get leaves; `ends` says which replica these are for."""
    replicas, width, bins = settings.replicas, len(config.FEATURES), settings.bins
    tasks = state.rdd.getNumPartitions()
    shares = math.ceil(math.sqrt(tasks))

    def add(batches):
        share = TaskContext.get().partitionId() % shares
        held, size = {}, 0

        def report():
            """All that is held, in batches of bounded bytes, given up on the way."""
            while held:
                rows, bytes_ = [], 0
                while held and bytes_ < HANDED:
                    rows.append(held.popitem())
                    bytes_ += rows[-1][1].nbytes
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s[0] for (s, _), _ in rows]), pa.array([s[1] for (s, _), _ in rows]), pa.array([r for (_, r), _ in rows], pa.int32()),
                     pa.array([share] * len(rows), pa.int32()), pa.array([x.tobytes() for _, x in rows], pa.binary())],
                    names=[c.split()[0] for c in SUMS.split(", ")],
                )

        for segment, (binned, labels, folds, predicted), _ in _opened(batches):
            if segment not in splits:
                continue
            cells = binned + np.arange(width, dtype=np.int64) * bins
            for r in active:
                mine = folds != replicas[r][1]
                node = node_of(binned[mine], splits[segment][r])
                places = (node[:, None] * (width * bins) + cells[mine]).ravel()
                least = (1 << len(splits[segment][r])) * width * bins
                gradient = np.repeat((labels - predicted[r])[mine], width)
                # Of no rows, as in a chunk within the fold left out, numpy makes whole numbers.
                found = np.stack([np.bincount(places, gradient, least), np.bincount(places, minlength=least)]).astype(np.float64)
                if (segment, r) in held:
                    held[segment, r] += found
                else:
                    held[segment, r] = found
                    size += found.nbytes
            if size > HELD:
                yield from report()
                size = 0
        yield from report()

    def summed(table: pa.Table) -> np.ndarray:
        table = table.sort_by("share")
        total = np.frombuffer(table["sums"][0].as_buffer()).copy()
        for x in table["sums"][1:]:
            total += np.frombuffer(x.as_buffer())
        return total

    def together(table: pa.Table) -> pa.Table:
        same = {c: table[c].slice(0, 1) for c in (*SEGMENT, "replica", "share")}
        return pa.table(same | {"sums": pa.array([summed(table).tobytes()], pa.binary())})

    def choose(table: pa.Table) -> pa.Table:
        gradients, counts = summed(table).reshape(2, -1, width, bins)
        with np.errstate(all="ignore"):
            explained, feature, border = best_split(gradients, counts, settings.shrink)
            replica = table["replica"][0].as_py()
            leaves = leaf_values(gradients, counts, feature, border, settings) if replica in ends else None
        sound = np.isfinite(explained) and (leaves is None or np.isfinite(leaves).all())
        return pa.table({c: table[c].slice(0, 1) for c in (*SEGMENT, "replica")} | {
            "ends": pa.array([ends.get(replica)], pa.int32()), "feature": pa.array([feature], pa.int32()), "border": pa.array([border], pa.int32()),
            "leaves": pa.array([leaves if sound else None], pa.list_(pa.float64())),
            "error": pa.array([None if sound else "OverflowError: the labels' squares are beyond a double"], pa.string()),
        })

    sums = state.select(*SEGMENT, "n", "bins", "labels", "folds", "predicted").mapInArrow(add, SUMS)
    if tasks > SHARED_BEYOND:
        sums = sums.groupBy(*SEGMENT, "replica", "share").applyInArrow(together, SUMS)
    return sums.groupBy(*SEGMENT, "replica").applyInArrow(choose, CHOSEN)


def _updated(state: DataFrame, settings: BoostingSettings, splits: dict, leaves: DataFrame) -> DataFrame:
    """Chunks with the current tree added to every replica's predictions, and each replica's squared error on the rows it
    may not see."""
    replicas = settings.replicas
    per_segment = leaves.groupBy(*SEGMENT).agg(F.collect_list(F.struct("replica", "leaves")).alias("grown"))
    # The chunks are the whole sample many times over, and a segment's would all go to one task.
    if len(splits) * sum(8 << depth for depth, _ in replicas) <= LEAVES_SENT:
        per_segment = F.broadcast(per_segment)

    def run(batches):
        for segment, (bins, labels, folds, predicted), (batch, i) in _opened(batches):
            if segment not in splits:
                continue
            values = {x["replica"]: np.array(x["leaves"]) for x in batch.column("grown")[i].as_py()}
            predicted, errors = predicted.copy(), []
            for r, (_, fold) in enumerate(replicas):
                predicted[r] += values[r][node_of(bins, splits[segment][r])]
                unseen = folds == fold
                errors.append(float(((labels - predicted[r])[unseen] ** 2).sum()))
            yield _chunk(segment, bins, labels, folds, predicted, errors)

    return join_per_segment(state, per_segment).select(*SEGMENT, "n", "bins", "labels", "folds", "predicted", "grown").mapInArrow(run, CHUNK)


def _unseen_errors(state: DataFrame) -> dict[tuple, dict[int, float]]:
    """Per segment and replica, the squared error on the rows it may not see."""
    rows = state.select(*SEGMENT, F.posexplode("errors").alias("replica", "error"))
    found: dict = {}
    for r in rows.groupBy(*SEGMENT, "replica").agg(F.sum("error").alias("error")).collect():
        found.setdefault((r["cnlname"], r["day_type"]), {})[r["replica"]] = r["error"]
    return found


class _Growth:
    """The trees grown so far. The driver holds splits only (a few numbers per segment, replica and level); leaves are in
    written stages."""

    def __init__(self, settings: BoostingSettings, segments: list[tuple[str, str]]):
        self.settings, self.replicas = settings, settings.replicas
        self.trees = {s: [] for s in segments}  # per tree, the splits of each replica
        self.leaves: list[DataFrame] = []  # per tree: segment, replica, leaves
        self.errors: dict[tuple, str] = {}

    def grow(self, state: DataFrame, work: Workspace, first: bool) -> tuple[DataFrame, dict]:
        """One tree for every replica: its leaves and its splits. While no tree is grown, replicas of one fold have equal
        residuals, so the deepest one's levels serve all."""
        deepest = {fold: r for r, (_, fold) in enumerate(self.replicas)}  # replicas ascend by depth
        leads = sorted(deepest.values()) if first else list(range(len(self.replicas)))
        splits = {s: [[] for _ in self.replicas] for s in self.trees}
        ended = []
        for level in range(1, max(d for d, _ in self.replicas) + 1):
            active = [r for r in leads if self.replicas[r][0] >= level]
            if first:
                ends = {deepest[fold]: r for r, (depth, fold) in enumerate(self.replicas) if depth == level}
            else:
                ends = {r: r for r in active if self.replicas[r][0] == level}
            chosen = _level(state, self.settings, splits, active, ends)
            if ends:
                chosen = work.keep(chosen, "level")
                ended.append(chosen.where("ends is not null").select(*SEGMENT, F.col("ends").alias("replica"), "leaves"))
            with work.running():
                found = chosen.drop("leaves").collect()
            for r in found:
                segment = r["cnlname"], r["day_type"]
                if r["error"]:
                    self.errors.setdefault(segment, r["error"])
                else:
                    splits[segment][r["replica"]].append((r["feature"], r["border"]))
            for segment in self.errors:
                splits.pop(segment, None)
                self.trees.pop(segment, None)
        if first:
            for grown in splits.values():
                lead = [list(grown[deepest[fold]]) for _, fold in self.replicas]
                grown[:] = [x[:depth] for x, (depth, _) in zip(lead, self.replicas, strict=True)]
        leaves = ended[0]
        for more in ended[1:]:
            leaves = leaves.unionByName(more)
        leaves = work.keep(leaves.where("leaves is not null"), "leaves")
        for segment, grown in splits.items():
            self.trees[segment].append(grown)
        self.leaves.append(leaves)
        return leaves, splits


def _rank(r2: float) -> float:
    return float("-inf") if math.isnan(r2) else r2


def _models(growth: _Growth, best: dict[tuple, tuple[int, int]], bases: dict, cuts: DataFrame, work: Workspace) -> DataFrame:
    """segment, iterations, depth, base, trees: array of (splits: feature and border value, leaves)."""
    spark, replicas = work.spark, growth.replicas
    full = {s: replicas.index((depth, ALL_ROWS)) for s, (_, depth) in best.items()}
    rows = [
        (*s, full[s], tree, [(feature, border) for feature, border in growth.trees[s][tree][full[s]]])
        for s, (iterations, _) in best.items() for tree in range(iterations)
    ]
    wanted = spark.createDataFrame(rows, "cnlname string, day_type string, replica int, tree int, cuts array<struct<feature: int, bin: int>>")
    leaves = None
    for tree, grown in enumerate(growth.leaves):
        part = grown.withColumn("tree", F.lit(tree))
        leaves = part if leaves is None else leaves.unionByName(part)
    grown = wanted.join(leaves, [*SEGMENT, "replica", "tree"]).join(cuts, SEGMENT)
    # A bin beyond a feature's last border holds no row: such a split has all rows on its left.
    split = F.transform("cuts", lambda c: F.struct(
        c.feature.alias("feature"), F.coalesce(F.get(F.get("borders", c.feature), c.bin), F.lit(math.inf)).alias("border")
    ))
    trees = grown.groupBy(*SEGMENT).agg(F.sort_array(F.collect_list(F.struct("tree", split.alias("splits"), "leaves"))).alias("trees"))
    chosen = spark.createDataFrame(
        [(*s, iterations, depth, bases[s][full[s]]) for s, (iterations, depth) in best.items()],
        "cnlname string, day_type string, iterations int, depth int, base double",
    )
    return work.keep(chosen.join(trees, SEGMENT), "models")


MODELS = (
    "cnlname string, day_type string, iterations int, depth int, base double, "
    "trees array<struct<tree: int, splits: array<struct<feature: int, border: double>>, leaves: array<double>>>"
)


def fit_boosted(
    train: DataFrame, segments: list[tuple[str, str]], work: Workspace, settings: BoostingSettings = BoostingSettings()
) -> Boosted:
    """Search the grid by mean validation r2 and keep the best setting's model on all rows, for each listed segment.

    A segment that can't be learned from is recorded and the rest go on. Only folds with rows on both sides and a spread of
    labels count; a search without a result leaves the first setting, as does a grid of one.
    """
    spark, replicas = work.spark, settings.replicas
    found = fold_statistics(train, segments)
    errors = {s: "ValueError: no training rows" for s, folds in found.items() if not folds}
    errors |= {s: "ValueError: a feature or label is missing or not finite" for s, folds in found.items() if any(f[3] for f in folds.values())}
    usable = [s for s in found if s not in errors]
    bases, best, grid = {}, {}, []
    for s in usable:
        n, total = (sum(f[k] for f in found[s].values()) for k in (0, 1))
        seen = {fold: (n - f[0], total - f[1]) for fold, f in found[s].items()}
        bases[s] = [seen.get(fold, (n, total))[1] / max(1, seen.get(fold, (n, total))[0]) for _, fold in replicas]
    errors |= {s: "OverflowError: the labels' sum is beyond a double" for s in usable if not np.isfinite(bases[s]).all()}
    usable = [s for s in usable if s not in errors]
    models = spark.createDataFrame([], MODELS)
    if usable:
        # Spark takes a list from the driver for a table of any size, and would send all rows to their segment's task.
        listed = F.broadcast(spark.createDataFrame(usable, "cnlname string, day_type string"))
        rows = join_per_segment(train, listed)
        cuts = work.keep(borders(rows, settings.bins), "borders")
        state = work.keep(chunks(rows, cuts, settings, bases), "chunks", long_rows=True)
        growth, scores = _Growth(settings, usable), {}
        for tree in range(1, max(settings.iterations) + 1):
            leaves, splits = growth.grow(state, work, first=tree == 1)
            if not splits:
                break
            before, state = state, work.keep(_updated(state, settings, splits, leaves), "chunks", long_rows=True)
            work.drop(before)
            if settings.several and tree in settings.iterations:
                for s, by_replica in _unseen_errors(state).items():
                    for r, (depth, fold) in enumerate(replicas):
                        n, _, spread, _ = found[s].get(fold, (0, 0, None, 0))
                        if n and len(found[s]) > 1:
                            r2 = 1.0 - by_replica[r] / n / spread if spread else math.nan
                            scores.setdefault(s, {}).setdefault((tree, depth), []).append(r2)
        work.drop(state)
        errors |= growth.errors
        for s in usable:
            if s not in errors:
                means = {setting: sum(r2) / len(r2) for setting, r2 in sorted(scores.get(s, {}).items())}
                best[s] = max(means, key=lambda x: _rank(means[x])) if means else (settings.iterations[0], settings.depths[0])
                grid += [(*s, *setting, r2) for setting, r2 in means.items()]
        if best:
            models = _models(growth, best, bases, cuts, work)
    return Boosted(
        models,
        spark.createDataFrame(grid, "cnlname string, day_type string, iterations int, depth int, r2 double"),
        spark.createDataFrame([(*s, e) for s, e in errors.items()], "cnlname string, day_type string, error string"),
    )


def boosted_score(features: list[str] = config.FEATURES) -> Column:
    """What a row's model (columns base and trees) predicts. A missing feature counts as lower than any other value."""
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(LOWEST)) for c in features])
    leaf = lambda tree: F.aggregate(
        tree["splits"], F.lit(0), lambda node, split: node * 2 + (F.get(values, split["feature"]) > split["border"]).cast("int")
    )
    return F.aggregate("trees", F.col("base"), lambda sum_, tree: sum_ + F.get(tree["leaves"], leaf(tree)))


def score_boosted(rows: DataFrame, models: DataFrame, name: str = "Pred_GBT") -> DataFrame:
    """Predictions for the rows of every segment with a model."""
    fitted = models.select(*SEGMENT, F.col("base").alias("base"), "trees")
    return join_per_segment(rows, fitted).withColumn(name, boosted_score()).select(*rows.columns, name)
