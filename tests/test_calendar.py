from datetime import date, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airgrid.functions import calendar as cal
from checks.calendars import calendar_frame
from tests.micro import as_set


def days(first, last):
    return {int((first + timedelta(days=i)).strftime("%Y%m%d")) for i in range((last - first).days + 1)}


def test_full_size_calendar():
    folds = cal.FoldCalendar(start=date(2019, 6, 1)).folds
    assert [f.cutoff for f in folds] == [20190222, 20190308, 20190322, 20190405, 20190419, 20190503, 20190517, 20190531]
    assert (folds[0].week_from, folds[0].month_from, folds[0].target_to) == (20190215, 20190122, 20190308)
    assert folds[-1].target_to == 20200530


@given(
    start=st.dates(date(2016, 1, 1), date(2030, 1, 1)), step=st.integers(1, 30), steps=st.integers(0, 12),
    horizon=st.integers(1, 400),
)
def test_targets_tile_the_days_once(start, step, steps, horizon):
    calendar = cal.FoldCalendar(start=start, lookback=step * steps, step=step, last_horizon=horizon)
    covered = []
    for f in calendar.folds:
        first = datetime.strptime(str(f.cutoff), "%Y%m%d").date() + timedelta(days=1)
        covered += sorted(days(first, datetime.strptime(str(f.target_to), "%Y%m%d").date()))
    assert covered == sorted(days(start - timedelta(days=step * steps), start + timedelta(days=horizon - 1)))
    assert [f.cutoff for f in calendar.folds] == sorted({f.cutoff for f in calendar.folds})


@pytest.mark.parametrize("lookback, step, horizon", [(10, 3, 5), (-7, 7, 5), (7, 0, 5), (7, 7, 0)])
def test_uneven_calendars_are_refused(lookback, step, horizon):
    with pytest.raises(ValueError):
        cal.FoldCalendar(start=date(2024, 1, 1), lookback=lookback, step=step, last_horizon=horizon)


def test_calendar_table_equals_the_fold_list(spark):
    for calendar in [cal.FoldCalendar(start=date(2024, 3, 5)), cal.FoldCalendar(date(2024, 1, 25), 14, 7, 30)]:
        listed = {(f.number, f.cutoff, f.week_from, f.month_from, f.target_to) for f in calendar.folds}
        assert as_set(calendar_frame(calendar, spark)) == listed


def test_run_dates():
    assert cal.default_start(date(2024, 3, 2)) == date(2024, 2, 28)
    assert cal.FoldCalendar(start=date(2024, 2, 28)).run_date == "2024-03-02"


def test_slots_and_day_keys(spark):
    times = spark.createDataFrame([(0,), (1799,), (1800,), (86399,), (86400,), (88199,), (88200,), (104399,)], "t int")
    found = times.select(cal.slot(F.col("t")), cal.wrapped_slot(F.col("t")))
    assert [tuple(r) for r in found.collect()] == [
        (0, 0), (0, 0), (1, 1), (47, 47), (48, 48), (48, 48), (49, 1), (57, 9),
    ]
    keys = spark.createDataFrame([(20240103,), (20240131,), (20240201,)], "d int")
    found = keys.select(cal.day_key(F.col("d")), cal.day_type(cal.day_key(F.col("d"))))
    # The key is a remainder of the integer, so it jumps from one month to the next.
    assert [tuple(r) for r in found.collect()] == [(2, "weekdays"), (2, "weekdays"), (2, "weekdays")]
    assert keys.select(cal.date_key(cal.key_date(F.col("d"))) == F.col("d")).distinct().collect()[0][0]


def test_weekend_keys(spark):
    found = spark.range(7).select(cal.day_type(F.col("id").cast("int")))
    assert [r[0] for r in found.collect()] == ["weekdays"] * 3 + ["weekend"] * 2 + ["weekdays"] * 2


def test_day_numbers(spark):
    names = spark.createDataFrame([("Monday",), ("Sunday",), ("Holiday",), (None,)], "name string")
    assert [r[0] for r in names.select(cal.day_number(F.col("name"))).collect()] == [1, 7, None, None]
