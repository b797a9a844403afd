"""Day keys, half-hour slots, and the calendar of as-of cutoffs."""

from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config


def day_key(blockdate: Column) -> Column:
    """Remainder of the yyyymmdd integer by 7. It repeats weekly only within a month; kept for parity."""
    return blockdate % 7


def slot(blocktime: Column) -> Column:
    """Half-hour slot of the broadcast day; runs past 48 after midnight."""
    return F.floor(blocktime / config.SLOT_SECONDS).cast("int")


def wrapped_slot(blocktime: Column) -> Column:
    """Slot as the time averages key it: 49 and later fold back to 1 and later, 48 itself stays."""
    s = slot(blocktime)
    return F.when(s <= config.SLOTS_PER_DAY, s).otherwise(s - config.SLOTS_PER_DAY)


def date_key(day: Column) -> Column:
    """A date as a yyyymmdd integer."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def key_date(key: Column) -> Column:
    """A yyyymmdd integer as a date."""
    return F.to_date(key.cast("string"), "yyyyMMdd")


def day_number(name: Column) -> Column:
    """Monday..Sunday as 1..7; null for anything else."""
    pairs = [F.lit(part) for item in config.DAY_NUMBERS.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), name)


def day_type(weekday: Column) -> Column:
    """The segment label of a day key."""
    return F.when(weekday.isin(config.WEEKEND_DAY_KEYS), "weekend").otherwise("weekdays")


def start_day(today: Column) -> Column:
    """First day to forecast, as a date: actual ratings arrive three days late."""
    return F.date_sub(today, config.ACTUALS_LAG_DAYS)


def default_start(today: date | None = None) -> date:
    """The same for a run made on `today`."""
    return (today or date.today()) - timedelta(days=config.ACTUALS_LAG_DAYS)


def as_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


@dataclass(frozen=True)
class Fold:
    """One as-of cutoff. Days are yyyymmdd integers; targets are the days in (cutoff, target_to]."""

    number: int
    cutoff: int
    week_from: int
    month_from: int
    target_to: int


@dataclass(frozen=True)
class FoldCalendar:
    """Cutoffs every `step` days over the lookback; the last one reaches `last_horizon` days ahead.

    Target ranges follow one another without gap or overlap, so a day has at most one fold.
    The number of folds is set by these parameters, never by the data.
    """

    start: date
    lookback: int = config.LOOKBACK_DAYS
    step: int = config.STEP_DAYS
    last_horizon: int = config.LAST_HORIZON_DAYS
    history_floor: int = config.HISTORY_FLOOR

    def __post_init__(self):
        if self.step < 1 or self.lookback < 0 or self.last_horizon < 1 or self.lookback % self.step:
            raise ValueError("lookback must be a whole number of steps, and step and horizon at least a day")

    @cached_property
    def folds(self) -> list[Fold]:
        folds = []
        for number, delta in enumerate(range(self.lookback, -1, -self.step)):
            cutoff = self.start - timedelta(days=delta + 1)
            horizon = self.step if delta else self.last_horizon
            folds.append(Fold(
                number=number,
                cutoff=as_key(cutoff),
                week_from=as_key(cutoff - timedelta(days=config.WEEK_DAYS)),
                month_from=as_key(cutoff - timedelta(days=config.MONTH_DAYS)),
                target_to=as_key(cutoff + timedelta(days=horizon)),
            ))
        return folds

    @property
    def start_key(self) -> int:
        return as_key(self.start)

    @property
    def run_date(self) -> str:
        """The stamp on forecast rows: the day the run was made."""
        return (self.start + timedelta(days=config.ACTUALS_LAG_DAYS)).isoformat()

    @property
    def last_cutoff(self) -> int:
        return self.folds[-1].cutoff

    def is_target(self, blockdate: Column) -> Column:
        """Literal bounds, so that the scan can skip files and partitions."""
        return (blockdate > self.folds[0].cutoff) & (blockdate <= self.folds[-1].target_to)

    def fold_of(self, blockdate: Column) -> Column:
        """Fold whose target range holds the day: a plain expression, since the ranges tile."""
        first, *rest = self.folds
        number = F.when((blockdate > first.cutoff) & (blockdate <= first.target_to), first.number)
        for fold in rest:
            number = number.when((blockdate > fold.cutoff) & (blockdate <= fold.target_to), fold.number)
        return number
