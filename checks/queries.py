"""One query per operator over grids derived from the given tables."""

import math
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import calendar as cal
from airgrid.functions.scoring import linear_score, sgd_step, strict_score, weights_of
from airgrid.operators import boosting, features, history, moments, nnls, segments, sgd, targets
from airgrid.operators.asof import per_fold
from airgrid.plans import forecast, sample
from airgrid.schema import SEGMENT
from airgrid.session import Workspace
from airgrid.sources import merge, sinks
from airgrid.sources.daily import DailySums
from airgrid.sources.runs import RunTables
from airgrid.sources.steps import Step, StepLog, run_steps
from airgrid.sources.tables import read_blocks, write_blocks
from checks.calendars import calendar_frame, rows_as_of
from checks.grids import (
    EVENT_CALENDAR, EVENT_CHANNELS, LINE_CALENDAR, LINE_CHANNELS, LINE_EXCLUDED,
    event_blocks, event_grids, line_blocks,
)

# Fixed weights for the queries that score or step without a fit.
WEIGHTS = [0.25, 0.125, 0.0625, 0.5, 0.03125, 0.015625, 0.75, 0.375]
ETA = 0.5
AVERAGES = ["average_grp", "average_grp_week", "average_grp_month", "average_grp_line_prg", "average_pro2"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, without negative zeros."""
    return df.select(*[
        (F.round(name, digits) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
    ])


def fixed_weights():
    return [F.lit(w) for w in WEIGHTS]


def event_model(spark: SparkSession, sf_dir: str) -> forecast.Modelled:
    return forecast.model_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, EVENT_CHANNELS, Workspace(spark))


def line_model(spark: SparkSession, sf_dir: str) -> forecast.Modelled:
    channels = segments.listed_channels(LINE_CHANNELS, LINE_EXCLUDED)
    return forecast.model_sample(line_blocks(spark, sf_dir), LINE_CALENDAR, channels, Workspace(spark))


# Sources, scans, sinks

def unify_sources(spark, sf_dir):
    return event_blocks(spark, sf_dir)


def step_row_counts(spark, sf_dir):
    old, new = event_grids(spark, sf_dir)
    steps = [
        Step("old_days", "select blockdate, count(*) as blocks from {old} group by blockdate"),
        Step("new_days", "select blockdate, count(*) as blocks from {new} group by blockdate"),
        Step("both_days", "select o.blockdate, o.blocks + n.blocks as blocks from {old_days} o join {new_days} n on o.blockdate = n.blockdate"),
        Step("late_blocks", "select blockid from {old} where blocktime >= 86400 union all select blockid from {new} where blocktime >= 86400"),
    ]
    _, counts = run_steps(spark, steps, {"old": old, "new": new}, Workspace(spark))
    return spark.createDataFrame(counts, "step string, row_count long")


def history_distinct(spark, sf_dir):
    return history.history(event_blocks(spark, sf_dir), EVENT_CALENDAR)


def target_grid(spark, sf_dir):
    return targets.target_grid(event_blocks(spark, sf_dir), EVENT_CALENDAR)


def forecast_append(spark, sf_dir):
    """Two runs three days apart appended to one table, the second one written again in place; a third that ends empty."""
    path = Workspace(spark).path("forecast")
    rows = targets.target_grid(event_blocks(spark, sf_dir), EVENT_CALENDAR)
    test = rows.where(F.col("blockdate") >= EVENT_CALENDAR.start_key).select(
        "blockid", "VIMB_type", "cnlname", "forecastratebase"
    )
    later = cal.FoldCalendar(start=date(2024, 1, 28), lookback=14, step=7)
    sinks.append_run(sinks.stamp(test, EVENT_CALENDAR), path)
    sinks.append_run(sinks.stamp(test, later), path)
    sinks.append_run(sinks.stamp(test, later), path, replace_run=True)
    last = cal.FoldCalendar(start=date(2024, 2, 1), lookback=14, step=7)
    sinks.append_run(sinks.stamp(test, last), path)
    sinks.append_run(None, path, replace_run=True, run_date=last.run_date)  # a run without rows clears its own date, no other
    return sinks.read_run_table(spark, path, sinks.stamp(test, later).schema)


def _corrected(blocks):
    """A part of a week's blocks, some a day later, some with another rating."""
    part = blocks.where(F.col("blockdate").between(20240105, 20240112) & (F.col("blockid") % 5 != 0))
    return part.withColumns({
        "blockdate": F.when(F.col("blockid") % 3 == 0, F.col("blockdate") + 1).otherwise(F.col("blockdate")),
        "factratebase": F.when(F.col("blockid") % 4 == 0, F.col("factratebase") * 2).otherwise(F.col("factratebase")),
    })


def _merged(spark, sf_dir, whole_days):
    """A network table without one block in seven, and a corrected grid merged into it: the table's folder, the changes."""
    work, blocks = Workspace(spark), event_blocks(spark, sf_dir)
    path = work.path("network")
    merge.merge_blocks(blocks.where("blockid % 7 <> 0"), path, work)
    return path, merge.merge_blocks(_corrected(blocks), path, work, whole_days)


def merge_grids(spark, sf_dir):
    """Blocks of a network table after a grid with a part of a week was merged into it."""
    return read_blocks(spark, _merged(spark, sf_dir, whole_days=False)[0])


def merge_grids_whole(spark, sf_dir):
    """The same for a grid that holds all blocks of its days."""
    return read_blocks(spark, _merged(spark, sf_dir, whole_days=True)[0])


def merge_changes(spark, sf_dir):
    """What a merge changes, by day, for both kinds of grid."""
    found = None
    for whole in (False, True):
        changes = _merged(spark, sf_dir, whole)[1].where("change <> 'same'").withColumn("whole_days", F.lit(whole))
        found = changes if found is None else found.unionByName(changes)
    days = found.select("whole_days", "change", F.explode(F.array_union("old_days", "new_days")).alias("blockdate"))
    return days.groupBy("whole_days", "change", "blockdate").agg(F.count(F.lit(1)).alias("blocks"))


def published_runs(spark, sf_dir):
    """What readers see after one run was published twice, one was killed between two tables, one was replaced by fewer
    rows, and another came last."""
    work = Workspace(spark)
    tables = RunTables(spark, work.path("tables"))
    rows = targets.target_grid(event_blocks(spark, sf_dir), EVENT_CALENDAR).select("blockid", "VIMB_type", "cnlname")
    counts = rows.groupBy("cnlname").agg(F.count(F.lit(1)).alias("blocks"))
    tables.publish("first", {"rows": rows, "counts": counts})
    tables.publish("first", {"rows": rows, "counts": counts})
    tables.stage("killed", {"rows": rows})
    tables.publish("second", {"rows": rows, "counts": counts})
    few = rows.where("blockid % 2 = 0")
    tables.publish("second", {"rows": few, "counts": counts.where("false")}, replace=True)
    tables.publish("third", {"counts": counts})
    found = None
    for name, frame in (("rows", rows), ("counts", counts)):
        part = tables.read(name, frame.schema, with_run=True).groupBy("run_id", "cnlname").agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit(name))
        found = part if found is None else found.unionByName(part)
    return found


def restarted_steps(spark, sf_dir):
    """Row counts of steps in a run that goes on after one that came to its second step, and whether the first two were
    read rather than made again."""
    work = Workspace(spark)
    old, new = (work.keep(grid, name) for grid, name in zip(event_grids(spark, sf_dir), ("old", "new"), strict=True))
    log = StepLog(spark, work.path("steps"))
    steps = [
        Step("old_days", "select blockdate, count(*) as blocks from {old} group by blockdate"),
        Step("new_days", "select blockdate, count(*) as blocks from {new} group by blockdate"),
        Step("both_days", "select o.blockdate, o.blocks + n.blocks as blocks from {old_days} o join {new_days} n on o.blockdate = n.blockdate"),
    ]
    run_steps(spark, steps[:2], {"old": old, "new": new}, work, log)
    before = log.done()
    made, counts = run_steps(spark, steps, {"old": old, "new": new}, work, log)
    after = log.done()
    rows = [(name, n, len(after) == len(before) + 1 == 3) for name, n in counts]
    return spark.createDataFrame(rows, "step string, row_count long, goes_on boolean")


# Calendar and scalar expressions

def day_key(spark, sf_dir):
    day = F.col("blockdate")
    return line_blocks(spark, sf_dir).groupBy("blockdate").agg(
        F.count(F.lit(1)).alias("blocks")
    ).select("blockdate", cal.day_key(day).alias("weekday"), cal.day_type(cal.day_key(day)).alias("day_type"), "blocks")


def slots(spark, sf_dir):
    time = F.col("blocktime")
    return event_blocks(spark, sf_dir).select(
        "blockid", "VIMB_type", "blocktime", cal.slot(time).alias("hour"), cal.wrapped_slot(time).alias("history_hour")
    )


def day_names(spark, sf_dir):
    day = cal.key_date(F.col("blockdate"))
    return (
        line_blocks(spark, sf_dir).groupBy("blockdate").agg(F.count(F.lit(1)).alias("blocks"))
        .groupBy(F.date_format(day, "EEEE").alias("day_name")).agg(F.sum("blocks").alias("blocks"))
        .select("day_name", cal.day_number(F.col("day_name")).alias("day_number"), "blocks")
    )


def start_day(spark, sf_dir):
    """For a run made on each day of the table: the first day to forecast, and how many days from it on the table holds."""
    day = cal.key_date(F.col("blockdate"))
    days = line_blocks(spark, sf_dir).select("blockdate").distinct()
    last = days.agg(F.max(day).alias("last"))
    start = cal.start_day(day)
    return days.select(
        F.col("blockdate").alias("today"), cal.date_key(start).alias("start"), F.date_diff(last.scalar(), start).alias("days_left")
    )


def fold_calendar(spark, sf_dir):
    """The fold calendar with the number of blocks each fold has before and after its cutoff."""
    counts = rows_as_of(line_blocks(spark, sf_dir), [], LINE_CALENDAR)
    return calendar_frame(LINE_CALENDAR, spark).join(counts, "fold", "left").fillna(0, ["n_history", "n_target"])


def asof_folds(spark, sf_dir):
    return rows_as_of(event_blocks(spark, sf_dir), ["cnlname"], EVENT_CALENDAR)


# Averages, joins, gaps, differences

def avg_time_slots(spark, sf_dir):
    return rounded(per_fold(history.time_averages(event_blocks(spark, sf_dir), EVENT_CALENDAR)))


def avg_time_slots_wide(spark, sf_dir):
    return rounded(per_fold(history.time_averages(line_blocks(spark, sf_dir), LINE_CALENDAR)))


def avg_programme_line(spark, sf_dir):
    return rounded(per_fold(history.line_averages(event_blocks(spark, sf_dir), EVENT_CALENDAR)))


def avg_programme_line_wide(spark, sf_dir):
    return rounded(per_fold(history.line_averages(line_blocks(spark, sf_dir), LINE_CALENDAR)))


def avg_title(spark, sf_dir):
    return rounded(per_fold(history.title_averages(event_blocks(spark, sf_dir), EVENT_CALENDAR)))


def avg_title_wide(spark, sf_dir):
    return rounded(per_fold(history.title_averages(line_blocks(spark, sf_dir), LINE_CALENDAR)))


def feature_join(spark, sf_dir):
    rows, _ = sample.raw_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, Workspace(spark))
    return rounded(rows.select("fold", "blockid", "VIMB_type", *AVERAGES))


def imputation(spark, sf_dir):
    rows = sample.filled_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, Workspace(spark))
    return rounded(rows.select("fold", "blockid", "VIMB_type", *AVERAGES))


def feature_sample(spark, sf_dir):
    return rounded(sample.feature_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, Workspace(spark)))


def _updated_sums(spark, sf_dir):
    """Daily sums after three updates: all but the last days, the last days and a corrected one, nothing new. The sums, the
    blocks, and the days that each update read."""
    work, blocks = Workspace(spark), event_blocks(spark, sf_dir)
    network, sums = work.path("network"), DailySums(spark, work.path("state"))
    late, wrong = F.col("blockdate") > 20240118, F.col("blockdate") == 20240110
    first = blocks.where(~late).withColumn("factratebase", F.when(wrong, F.lit(1.0)).otherwise(F.col("factratebase")))
    read = []
    for written in (first, blocks.where(late | wrong), None):
        if written is not None:
            write_blocks(written, network)
        read.append(sums.update(network, work))
    return sums, read_blocks(spark, network), read


def features_from_state(spark, sf_dir):
    """The feature sample, its averages made of daily sums that several updates brought up to date."""
    sums, blocks, _ = _updated_sums(spark, sf_dir)
    return rounded(sample.feature_sample(blocks, EVENT_CALENDAR, Workspace(spark), sums))


def state_updates(spark, sf_dir):
    """The days that each update of the daily sums read."""
    _, _, read = _updated_sums(spark, sf_dir)
    return spark.createDataFrame([(k, day) for k, days in enumerate(read) for day in days], "update int, blockdate int")


def feature_sample_wide(spark, sf_dir):
    return rounded(sample.feature_sample(line_blocks(spark, sf_dir), LINE_CALENDAR, Workspace(spark)))


# Segments

def train_test_split(spark, sf_dir):
    rows = targets.target_grid(event_blocks(spark, sf_dir), EVENT_CALENDAR)
    return rows.select("blockid", "VIMB_type", "fold", (F.col("blockdate") < EVENT_CALENDAR.start_key).alias("is_train"))


def segment_rows(spark, sf_dir):
    rows = targets.target_grid(event_blocks(spark, sf_dir), EVENT_CALENDAR)
    rows = segments.with_segments(rows, EVENT_CALENDAR, EVENT_CHANNELS)
    return rows.groupBy(*SEGMENT, "weekday", "is_train").agg(F.count(F.lit(1)).alias("blocks"))


def channel_filter(spark, sf_dir):
    channels = segments.listed_channels(LINE_CHANNELS, LINE_EXCLUDED)
    rows = segments.with_segments(targets.target_grid(line_blocks(spark, sf_dir), LINE_CALENDAR), LINE_CALENDAR, channels)
    return rows.groupBy("cnlname").agg(F.count(F.lit(1)).alias("blocks"))


def three_sigma_trim(spark, sf_dir):
    modelled = event_model(spark, sf_dir)
    kept = modelled.train.groupBy(*SEGMENT).agg(
        F.count(F.lit(1)).alias("n_kept"), F.max("factratebase").alias("highest"), F.min("factratebase").alias("lowest")
    )
    return rounded(modelled.statistics.join(kept, SEGMENT, "left"))


def _status(spark, modelled):
    kept = moments.segment_moments(modelled.train)
    return segments.segment_status(spark, modelled.statistics, kept, modelled.channels)


def segment_status(spark, sf_dir):
    return _status(spark, event_model(spark, sf_dir))


def segment_status_wide(spark, sf_dir):
    return _status(spark, line_model(spark, sf_dir))


# Linear models

def gram(spark, sf_dir):
    packed = moments.segment_moments(event_model(spark, sf_dir).train)
    named = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), moments.moment(i, j).alias("total"))
        for i, j in moments.moment_pairs()
    ])
    return rounded(packed.select(*SEGMENT, "n_kept", F.inline(named)), 4)


def linear_scores(spark, sf_dir):
    rows = sample.feature_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, Workspace(spark))
    return rounded(rows.select("blockid", "VIMB_type", linear_score(fixed_weights()).alias("score")))


RUNAWAY = {
    "not_a_number": {1: math.nan}, "infinite": {0: math.inf}, "opposite": {0: math.inf, 3: -math.inf}, "mixed": {0: math.nan, 6: -math.inf},
}


def linear_score_runaway(spark, sf_dir):
    """Scores of weights that ran off: terms that are not a number count as zero, infinite ones stay."""
    rows = sample.feature_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, Workspace(spark))
    scores = [
        F.struct(F.lit(name).alias("weights"), linear_score([F.lit(runaway.get(i, w)) for i, w in enumerate(WEIGHTS)]).alias("score"))
        for name, runaway in RUNAWAY.items()
    ]
    scored = rows.select("blockid", "VIMB_type", F.inline(F.array(*scores)))
    kind = (
        F.when(F.isnan("score"), "not a number").when(F.col("score") == math.inf, "above").when(F.col("score") == -math.inf, "below").otherwise("finite")
    )
    return rounded(scored.select("blockid", "VIMB_type", "weights", kind.alias("kind"), F.when(kind == "finite", F.col("score")).alias("score")))


def linear_predict_strict(spark, sf_dir):
    """Missing features make the prediction missing: here on rows whose averages are not filled."""
    rows, _ = sample.raw_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, Workspace(spark))
    rows = features.add_differences(rows)
    return rounded(rows.select(
        "blockid", "VIMB_type",
        strict_score(fixed_weights()).alias("strict"),
        linear_score(fixed_weights()).alias("lenient"),
    ))


def _nnls_conditions(modelled):
    """Optimality of the coefficients, from the training rows themselves rather than from the moments."""
    fitted = nnls.fit_nnls(moments.segment_moments(modelled.train)).where("nnls is not null")
    rows = segments.join_per_segment(modelled.train, fitted.select(*SEGMENT, "nnls"))
    residual = F.col(config.LABEL) - strict_score(weights_of("nnls"))
    slopes = rows.groupBy(*SEGMENT, "nnls").agg(
        F.array(*[F.sum(residual * F.col(f)) / F.count(F.lit(1)) for f in config.FEATURES]).alias("slope")
    )
    pairs = F.zip_with("nnls", "slope", lambda c, s: F.struct(c.alias("c"), s.alias("s")))
    return slopes.select(
        *SEGMENT,
        F.forall("nnls", lambda c: c >= 0).alias("not_negative"),
        F.forall(pairs, lambda p: (p.c == 0) | (F.abs(p.s) < 1e-6)).alias("flat_where_positive"),
        F.forall(pairs, lambda p: p.s < 1e-6).alias("no_descent_left"),
    )


def nnls_kkt(spark, sf_dir):
    return _nnls_conditions(event_model(spark, sf_dir))


def nnls_kkt_wide(spark, sf_dir):
    return _nnls_conditions(line_model(spark, sf_dir))


def coefficients(spark, sf_dir):
    modelled, work = event_model(spark, sf_dir), Workspace(spark)
    fitted, _ = forecast.fit_linear(modelled, work)
    path = work.path("coefficient_log")
    sinks.append_run(sinks.stamp(sinks.coefficient_rows(fitted), EVENT_CALENDAR), path)
    return spark.read.parquet(path).select(
        *SEGMENT, "position", "feature", (F.col("nnls") >= 0).alias("nnls_valid"), F.col("sgd").isNotNull().alias("sgd_found")
    )


def sgd_single_step(spark, sf_dir):
    """Weights after one step on each training row, from fixed weights."""
    modelled = event_model(spark, sf_dir)
    sizes = modelled.train.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("n"))
    rows = segments.join_per_segment(modelled.train, sizes)
    stepped = sgd_step(fixed_weights(), F.col("n"), F.lit(ETA))
    return rounded(rows.select(
        "blockid", "VIMB_type", *[w.alias(f"w_{name}") for w, name in zip(stepped, config.FEATURES)]
    ))


def all_pairs_error(spark, sf_dir):
    packed = moments.segment_moments(event_model(spark, sf_dir).train)
    return rounded(packed.select(
        *SEGMENT,
        moments.all_pairs_error(fixed_weights()).alias("all_pairs_error"),
        moments.squared_error(fixed_weights()).alias("squared_error"),
    ))


def sgd_invariants(spark, sf_dir):
    """Two runs with one seed agree, another seed differs, steps stay within bounds, weights stay finite."""
    modelled, work = event_model(spark, sf_dir), Workspace(spark)
    linear = work.keep(nnls.fit_nnls(moments.segment_moments(modelled.train)), "nnls")
    runs = {
        name: sgd.final_weights(sgd.sgd_trace(modelled.train, linear, sgd.SgdSettings(seed=seed)))
        for name, seed in [("first", 1), ("again", 1), ("other", 2)]
    }
    joined = runs["first"]
    for name in ["again", "other"]:
        joined = joined.join(runs[name].select(*SEGMENT, F.col("sgd").alias(name)), SEGMENT)
    return joined.select(
        *SEGMENT,
        (F.col("sgd") == F.col("again")).alias("repeatable"),
        (F.col("sgd") != F.col("other")).alias("seed_matters"),
        F.col("steps").between(1, config.SGD_MAX_ITER).alias("steps_in_range"),
        F.col("sgd_finite").alias("finite"),
    )


def sgd_trace(spark, sf_dir):
    """Steps are numbered without gap, and the last error is the one the rows themselves give."""
    modelled, work = event_model(spark, sf_dir), Workspace(spark)
    _, trace = forecast.fit_linear(modelled, work)
    last = trace.groupBy(*SEGMENT).agg(
        F.max("iter").alias("steps"), F.count(F.lit(1)).alias("n"), F.min("iter").alias("first"),
        F.max_by("all_pairs_error", "iter").alias("error"), F.max_by("weights", "iter").alias("sgd"),
    )
    rows = segments.join_per_segment(modelled.train, last)
    label, score = F.col(config.LABEL), strict_score(weights_of("sgd"))
    from_rows = F.var_pop(label) + F.var_pop(score) + F.pow(F.avg(label) - F.avg(score), 2)
    checked = rows.groupBy(*SEGMENT, "steps", "n", "first", "error").agg(from_rows.alias("from_rows"))
    return checked.select(
        *SEGMENT,
        ((F.col("first") == 1) & (F.col("steps") == F.col("n"))).alias("no_gap"),
        (F.abs(F.col("error") - F.col("from_rows")) <= 1e-9 * F.greatest(F.lit(1.0), F.col("error"))).alias("error_matches"),
    )


# Boosting and the forecast

def _all_segments(modelled):
    return [(c, d) for c in modelled.channels for d in segments.DAY_TYPES]


def _searched(modelled, work, settings):
    """The training table and what the search makes of it: every setting, every fold, the best one's model."""
    train = boosting.training_table(modelled.train, settings, work)
    return train, boosting.fit_boosted(train, _all_segments(modelled), work, settings)


def boosted_forecast(spark, sf_dir):
    """Every segment's trees fit its training rows better than the mean does, and predict every test row."""
    modelled, work = event_model(spark, sf_dir), Workspace(spark)
    train, boosted = _searched(modelled, work, boosting.BoostingSettings())
    columns = [*SEGMENT, *config.FEATURES, config.LABEL]
    rows = train.select(*columns, F.lit(True).alias("is_train")).unionByName(
        modelled.rows.where(~F.col("is_train")).select(*columns, "is_train")
    )
    scored = boosting.score_boosted(rows, boosted.models)
    label, error = F.when(F.col("is_train"), F.col(config.LABEL)), F.col(config.LABEL) - F.col("Pred_GBT")
    return scored.groupBy(*SEGMENT).agg(
        (F.avg(F.when(F.col("is_train"), error * error)) < F.var_pop(label)).alias("beats_mean"),
        F.count_if(~F.col("is_train") & F.col("Pred_GBT").isNotNull()).alias("n_predicted"),
    )


def _grid_rows(boosted):
    """Per segment and setting: whether its r2 is a possible value, and whether it is the model's just if it is the best."""
    order = Window.partitionBy(*SEGMENT).orderBy(F.desc("r2"), "iterations", "depth")
    models = boosted.models.select(*SEGMENT, F.col("iterations").alias("i"), F.col("depth").alias("d"), F.size("trees").alias("n"))
    grid = boosted.grid.withColumn("first", F.row_number().over(order) == 1).join(models, SEGMENT)
    refitted = (F.col("iterations") == F.col("i")) & (F.col("depth") == F.col("d")) & (F.col("n") == F.col("i"))
    possible = ~F.isnan("r2") & (F.abs("r2") < math.inf) & (F.col("r2") <= 1)
    return grid.select(*SEGMENT, "iterations", "depth", possible.alias("r2_possible"), (refitted == F.col("first")).alias("refitted_if_best"))


def grid_search(spark, sf_dir, settings=boosting.BoostingSettings()):
    """Cross-validated r2 of each parameter setting, on every segment; by default all settings of the job."""
    modelled = event_model(spark, sf_dir)
    return _grid_rows(_searched(modelled, Workspace(spark), settings)[1])


def cv_folds(spark, sf_dir):
    """Validation folds follow one another in time and hold about the same number of rows."""
    modelled = event_model(spark, sf_dir)
    rows = boosting.with_cv_folds(modelled.train, 3)
    return rows.groupBy(*SEGMENT, "cv_fold").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.min(F.col("blockdate").cast("long") * 100 + F.col("hour")).alias("first_moment"),
        F.max(F.col("blockdate").cast("long") * 100 + F.col("hour")).alias("last_moment"),
    )


def _field(name):
    return lambda x: x[name]


def forecast_run(spark, sf_dir):
    """A whole run, published and read back: rows per segment, and whether each prediction is what the stored
    coefficients, or the best setting's trees, make of the row."""
    work = Workspace(spark)
    run = forecast.run_forecast(event_blocks(spark, sf_dir), EVENT_CALENDAR, work, EVENT_CHANNELS, [], boosting_settings=boosting.BoostingSettings())
    tables = RunTables(spark, work.path("tables"))
    forecast.publish_forecast(run, tables)
    done = tables.read("forecast", forecast.FORECAST)
    done = done.withColumn("day_type", cal.day_type(F.col("weekday")))
    stored = tables.read("coefficients", run.coefficients.schema)
    weights = stored.groupBy(*SEGMENT).agg(*[
        F.transform(F.sort_array(F.collect_list(F.struct("position", name))), _field(name)).alias(name) for name in ("nnls", "sgd")
    ])
    score = {n: sum((F.coalesce(F.col(n)[i] * F.col(f), F.lit(0.0)) for i, f in enumerate(config.FEATURES)), F.lit(0.0)) for n in ("nnls", "sgd")}
    checked = boosting.score_boosted(done.join(weights, SEGMENT), run.boosted.models, "again")
    near = lambda name, other: F.count_if(F.abs(F.col(name) - other) <= 1e-9 * (1 + F.abs(other)))
    found = checked.groupBy(*SEGMENT, "Today").agg(
        F.count(F.lit(1)).alias("blocks"),
        near("Pred_GBT", F.col("again")).alias("with_gbt"),
        near("Pred_SGD", score["sgd"]).alias("with_sgd"),
        near("Pred_NNLS", score["nnls"]).alias("with_nnls"),
    )
    best = _grid_rows(run.boosted).groupBy(*SEGMENT).agg(F.bool_and("refitted_if_best").alias("best_refitted"))
    return found.join(best, SEGMENT)


def run_status(spark, sf_dir):
    """What a run reports about each segment, a channel without blocks included."""
    work = Workspace(spark)
    run = forecast.run_forecast(
        event_blocks(spark, sf_dir), EVENT_CALENDAR, work, [*EVENT_CHANNELS, "off air"], [], boosting_settings=boosting.BoostingSettings()
    )
    return run.status.drop("error")


QUERIES = {
    "features_wide": feature_sample_wide,
    "unify_sources": unify_sources,
    "merge_grids": merge_grids,
    "merge_grids_whole": merge_grids_whole,
    "merge_changes": merge_changes,
    "published_runs": published_runs,
    "step_row_counts": step_row_counts,
    "restarted_steps": restarted_steps,
    "history_distinct": history_distinct,
    "target_grid": target_grid,
    "forecast_append": forecast_append,
    "day_key": day_key,
    "slots": slots,
    "day_names": day_names,
    "start_day": start_day,
    "fold_calendar": fold_calendar,
    "asof_folds": asof_folds,
    "avg_time_slots": avg_time_slots,
    "avg_time_slots_wide": avg_time_slots_wide,
    "avg_programme_line": avg_programme_line,
    "avg_programme_line_wide": avg_programme_line_wide,
    "avg_title": avg_title,
    "avg_title_wide": avg_title_wide,
    "feature_join": feature_join,
    "imputation": imputation,
    "features": feature_sample,
    "features_from_state": features_from_state,
    "state_updates": state_updates,
    "train_test_split": train_test_split,
    "segments": segment_rows,
    "channel_filter": channel_filter,
    "three_sigma_trim": three_sigma_trim,
    "segment_status": segment_status,
    "segment_status_wide": segment_status_wide,
    "gram": gram,
    "linear_score": linear_scores,
    "linear_score_runaway": linear_score_runaway,
    "linear_predict_strict": linear_predict_strict,
    "nnls_kkt": nnls_kkt,
    "nnls_kkt_wide": nnls_kkt_wide,
    "coefficients": coefficients,
    "sgd_step": sgd_single_step,
    "all_pairs_error": all_pairs_error,
    "sgd_invariants": sgd_invariants,
    "sgd_trace": sgd_trace,
    "cv_folds": cv_folds,
    "boosted_forecast": boosted_forecast,
    "forecast": forecast_run,
    "run_status": run_status,
    "grid_search": grid_search,
}
