"""The rules of the averages and of the joined features, on rows small enough to work out by hand."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airgrid.functions.calendar import FoldCalendar
from airgrid.operators import features, history, targets
from airgrid.operators.asof import per_fold
from airgrid.plans import sample
from checks.calendars import rows_as_of
from tests.micro import CALENDAR, as_set, blocks, full_blocks


def test_time_averages_by_hand(spark):
    # Slot 49 wraps to 1, slot 48 stays; copies count once; the null channel is no group; a null rating is skipped.
    found = per_fold(history.time_averages(blocks(spark), CALENDAR))
    assert as_set(found.select("weekday", "cnlname", "hour", "average_grp", "average_grp_week", "average_grp_month")) == {
        (2, "A", 1, 6.0, 6.0, 6.0), (2, "A", 11, 5.0, 3.0, 5.0), (2, "A", 48, 8.0, 8.0, 8.0),
    }


def test_line_averages_by_hand(spark):
    # All channels and copies count, slots are not wrapped, a missing line is a group.
    found = per_fold(history.line_averages(blocks(spark), CALENDAR))
    assert as_set(found.select("proid", "hour", "average_grp_line_prg")) == {
        (1, 11, 15.75), (1, 48, 8.0), (1, 49, 6.0), (None, 11, 4.0),
    }


def test_title_averages_by_hand(spark):
    # Title 0 is left out, the null channel is a group.
    found = per_fold(history.title_averages(blocks(spark), CALENDAR))
    assert as_set(found.select("pro2", "hour", "cnlname", "average_pro2")) == {
        (5, 11, "A", 6.5), (5, 11, None, 50.0), (5, 49, "A", 6.0),
    }


def test_history_floor_only_bounds_the_time_averages(spark):
    calendar = FoldCalendar(start=CALENDAR.start, lookback=0, last_horizon=14, history_floor=20240101)
    time = per_fold(history.time_averages(blocks(spark), calendar)).where("hour = 11")
    assert time.first()["average_grp"] == 3.0
    assert as_set(per_fold(history.line_averages(blocks(spark), calendar))) == as_set(
        per_fold(history.line_averages(blocks(spark), CALENDAR))
    )


def test_raw_features_of_targets(spark, work):
    rows, mean = sample.raw_sample(blocks(spark), CALENDAR, work)
    # Late target slots (49) miss the wrapped history, a null line meets the null group.
    assert as_set(rows.select("blockid", "average_grp", "average_grp_line_prg", "average_pro2")) == {
        (9, 5.0, 4.0, 6.5), (10, None, 6.0, None), (11, 8.0, 8.0, None),
    }
    assert mean.first()[0] == 6.5


def test_gaps_are_filled_in_order(spark, work):
    rows = sample.filled_sample(blocks(spark), CALENDAR, work)
    found = rows.select("blockid", "average_grp", "average_grp_week", "average_grp_line_prg", "average_pro2")
    assert as_set(found) == {(9, 5.0, 3.0, 4.0, 6.5), (10, 6.5, 6.5, 6.0, 6.0), (11, 8.0, 8.0, 8.0, 8.0)}


def test_differences_start_from_one_base(spark):
    rows = spark.createDataFrame([(3.0, 1.0, 0, 1), (3.0, 1.0, 1, 0), (1.0, 3.0, 1, 1)],
                                 "average_pro2 double, average_grp_line_prg double, is_movie int, is_series int")
    found = features.add_differences(rows).select("Movies_diff", "Series_diff")
    assert [tuple(r) for r in found.collect()] == [(0.0, 2.0), (2.0, 0.0), (-2.0, -2.0)]


def test_title_lookup_matches_null_channels(spark):
    rows = spark.createDataFrame([(0, 5, 11, None), (0, 5, 11, "A")], "fold int, pro2 int, hour int, cnlname string")
    averages = spark.createDataFrame([(5, 11, None, [1.0])], "pro2 int, hour int, cnlname string, average_pro2 array<double>")
    found = features.look_up(rows, averages, ["pro2", "hour", "cnlname"], ["cnlname"])
    assert as_set(found.select("cnlname", "average_pro2")) == {(None, 1.0), ("A", None)}


def random_blocks(seed, n, first=date(2024, 1, 1), days=40):
    rng = np.random.default_rng(seed)
    day = [first + timedelta(days=int(d)) for d in rng.integers(0, days, n)]
    return pd.DataFrame({
        "blockid": np.arange(n),
        "blockdate": [d.year * 10000 + d.month * 100 + d.day for d in day],
        "blocktime": rng.choice([18000, 20000, 21000, 86500, 88300, 100000], n),
        "cnlname": rng.choice(["A", "B", None], n, p=[0.6, 0.3, 0.1]),
        "factratebase": np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 6, n) / 4),
        "proid": rng.choice([1, 2, None], n),
        "pro2": rng.choice([0, 3, 4, None], n),
    })


def to_rows(pdf):
    return [{k: None if pd.isna(v) else v for k, v in r.items()} for r in pdf.to_dict("records")]


def loop_time_averages(pdf, calendar):
    """One fold after the other, straight from the definition."""
    out = {}
    h = pdf[pdf.blockdate >= calendar.history_floor].drop_duplicates(["cnlname", "blocktime", "blockdate", "factratebase"])
    h = h[h.cnlname.notna()].assign(weekday=h.blockdate % 7, hour=h.blocktime // 1800)
    h["hour"] = h.hour.where(h.hour <= 48, h.hour - 48)
    for f in calendar.folds:
        seen = h[h.blockdate <= f.cutoff]
        for key, g in seen.groupby(["weekday", "cnlname", "hour"]):
            means = [g.factratebase.mean()] + [
                g[g.blockdate >= start].factratebase.mean() for start in (f.week_from, f.month_from)
            ]
            out[(f.number, *key)] = [None if pd.isna(m) else round(m, 9) for m in means]
    return out


@pytest.mark.parametrize("seed, lookback, step", [(1, 0, 14), (2, 14, 7), (3, 12, 2), (4, 10, 1), (5, 28, 14)])
def test_single_pass_equals_a_loop_over_folds(spark, seed, lookback, step):
    pdf = random_blocks(seed, 600)
    calendar = FoldCalendar(start=date(2024, 2, 1), lookback=lookback, step=step, last_horizon=20, history_floor=20240103)
    found = per_fold(history.time_averages(full_blocks(spark, to_rows(pdf)), calendar)).collect()
    got = {
        (r.fold, r.weekday, r.cnlname, r.hour): [
            None if v is None else round(v, 9) for v in (r.average_grp, r.average_grp_week, r.average_grp_month)
        ] for r in found
    }
    assert got == loop_time_averages(pdf, calendar)


def test_no_fold_sees_past_its_cutoff(spark):
    pdf = random_blocks(7, 500)
    calendar = FoldCalendar(start=date(2024, 2, 1), lookback=14, step=7, last_horizon=5)
    for r in rows_as_of(full_blocks(spark, to_rows(pdf)), ["cnlname"], calendar).collect():
        cutoff = calendar.folds[r.fold].cutoff
        assert r.last_history <= cutoff
        assert r.first_target is None or r.first_target > cutoff


def test_later_ratings_leave_earlier_folds_alone(spark):
    pdf = random_blocks(8, 400)
    calendar = FoldCalendar(start=date(2024, 2, 1), lookback=14, step=7, last_horizon=5)
    cutoff = calendar.folds[0].cutoff
    changed = pdf.assign(factratebase=pdf.factratebase.where(pdf.blockdate <= cutoff, 99.0))
    for averages in (history.time_averages, history.line_averages, history.title_averages):
        before, after = [
            as_set(per_fold(averages(full_blocks(spark, to_rows(p)), calendar)).where("fold = 0")) for p in (pdf, changed)
        ]
        assert before == after and before


def test_every_target_day_has_one_fold(spark):
    pdf = random_blocks(9, 500)
    calendar = FoldCalendar(start=date(2024, 2, 1), lookback=14, step=7, last_horizon=5)
    grid = targets.target_grid(full_blocks(spark, to_rows(pdf)), calendar)
    inside = pdf[(pdf.blockdate > calendar.folds[0].cutoff) & (pdf.blockdate <= calendar.folds[-1].target_to)]
    assert grid.count() == len(inside)
    assert grid.where(F.col("fold").isNull()).count() == 0


def test_filled_sample_has_no_gap_if_there_is_any_average(spark, work):
    pdf = random_blocks(10, 300)
    calendar = FoldCalendar(start=date(2024, 2, 1), lookback=14, step=7, last_horizon=5)
    rows = sample.filled_sample(full_blocks(spark, to_rows(pdf)), calendar, work)
    names = ["average_grp", "average_grp_week", "average_grp_month", "average_grp_line_prg", "average_pro2"]
    assert rows.count() > 0
    assert rows.where(" or ".join(f"{n} is null" for n in names)).count() == 0


def test_joins_agree_with_and_without_broadcast_under_a_hot_key(spark, work):
    """A third of the rows on one channel, slot, line and title; the shuffled plan gives the same rows."""
    pdf = random_blocks(11, 900)
    hot = pdf.index % 3 == 0
    pdf.loc[hot, ["cnlname", "blocktime", "proid", "pro2"]] = ["A", 20000, None, 3]
    calendar = FoldCalendar(start=date(2024, 2, 1), lookback=14, step=7, last_horizon=5)
    rows = full_blocks(spark, to_rows(pdf))
    broadcast = as_set(sample.feature_sample(rows, calendar, work), digits=9)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = sample.feature_sample(rows, calendar, work)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().toString()
        assert as_set(shuffled, digits=9) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
