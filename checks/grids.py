"""Broadcast grids derived from the given tables, one SQL text per grid for both engines.

Ratings are whole hundredths over a power of two, so sums and averages of them come out
bit-equal in any order of addition.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from airgrid.functions.calendar import FoldCalendar
from airgrid.schema import conform
from airgrid.sources.unify import unify

# The broadcast day starts at 05:00; ratings from the start day on are not known yet.
EVENT_CALENDAR = FoldCalendar(start=date(2024, 1, 25), lookback=14, step=7, history_floor=20230101)
EVENT_CHANNELS = ["click", "error", "purchase", "signup", "view"]

EVENT_GRID = """
select blockid, blockdate, blocknumber, blocktime, cnlname,
  case when blockdate >= 20240125 or blockid % 41 = 0 then null else rating end as factratebase,
  rating / 2 as forecastratebase, isprime, prgname, pro2, proid, progid, is_series, is_movie,
  tnsblockfactdur, tnsblockfactid, tnsblockfacttime, border
from (
  select cast(event_id as bigint) as blockid,
    cast(year(b) * 10000 + month(b) * 100 + day(b) as int) as blockdate,
    cast(event_id % 8 + 1 as int) as blocknumber,
    cast(18000 + hour(b) * 3600 + minute(b) * 60 + floor(second(b)) as int) as blocktime,
    case when event_id % 97 = 0 then null else event_type end as cnlname,
    round(value * 100) / 4096.0 as rating,
    case when hour(b) between 14 and 18 then 1 else 0 end as isprime,
    concat('prg', cast(k as string)) as prgname,
    cast(k % 7 as int) as pro2,
    case when k % 10 = 0 then null else cast(k % 20 as int) end as proid,
    cast(k as int) as progid,
    case when event_id % 3 = 0 then 1 else 0 end as is_series,
    case when event_id % 3 = 1 then 1 else 0 end as is_movie,
    cast(60 + event_id % 240 as int) as tnsblockfactdur,
    cast(event_id * 10 as bigint) as tnsblockfactid,
    cast(18000 + hour(b) * 3600 as int) as tnsblockfacttime,
    cast(event_id % 5 as int) as border
  from (select event_id, event_type, value, ts - interval 5 hour as b, cast({json} as int) as k from {events}) e
) g"""

# Years of history and many channels, for folds of full size.
LINE_CALENDAR = FoldCalendar(start=date(1999, 6, 1), history_floor=19950101)
LINE_CHANNELS = [f"ch{i}" for i in range(22)]
LINE_EXCLUDED = ["ch4", "ch7"]

LINE_GRID = """
select cast(l_orderkey * 10 + l_linenumber as bigint) as blockid,
  cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) as blockdate,
  cast(l_linenumber as int) as blocknumber,
  cast(18000 + (l_orderkey * 37 + l_linenumber * 1801 + l_partkey * 613) % 86400 as int) as blocktime,
  concat('ch', cast(l_suppkey % 22 as string)) as cnlname,
  case when year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) >= 19990601 then null
    else round(l_extendedprice * 100) / 4194304.0 end as factratebase,
  case when l_returnflag = 'R' then 1 else 0 end as isprime,
  cast(l_partkey % 200 as int) as proid,
  cast(l_partkey % 7 as int) as pro2,
  case when l_partkey % 3 = 0 then 1 else 0 end as is_series,
  case when l_partkey % 3 = 1 then 1 else 0 end as is_movie,
  case when l_orderkey % 2 = 0 then 'old' else 'new' end as VIMB_type
from {lineitem}"""

NEW_GRID_NAMES = {"title": "prgname", "position": "blocknumber"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_grids(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An old and a new grid: a tenth of the old blocks is repeated in the new one, which names two columns otherwise."""
    grid = spark.sql(
        EVENT_GRID.replace("{json}", "get_json_object(props, '$.k')"), events=table(spark, sf_dir, "events")
    )
    old = grid.where("blockid % 2 = 0")
    new = grid.where("blockid % 2 = 1 or blockid % 20 = 0")
    return old, new.withColumnsRenamed({v: k for k, v in NEW_GRID_NAMES.items()})


def event_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = event_grids(spark, sf_dir)
    return unify(old, new, rename_new=NEW_GRID_NAMES)


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(spark.sql(LINE_GRID, lineitem=table(spark, sf_dir, "lineitem")))
