"""The same results in plain SQL, row by row and fold by fold, for an independent engine."""

from airgrid import config
from checks.grids import EVENT_CHANNELS, EVENT_GRID, LINE_CHANNELS, LINE_EXCLUDED, LINE_GRID
from checks.queries import ETA, RUNAWAY, WEIGHTS

AVERAGES = ["average_grp", "average_grp_week", "average_grp_month", "average_grp_line_prg", "average_pro2"]
BLOCK_COLUMNS = (
    "blockid, blockdate, blocknumber, blocktime, cnlname, factratebase, forecastratebase, isprime, prgname, pro2, "
    "proid, progid, is_series, is_movie, tnsblockfactdur, tnsblockfactid, tnsblockfacttime, border, VIMB_type"
)


def _key(day: str) -> str:
    return f"cast(strftime({day}, '%Y%m%d') as int)"


def _folds(start: str, lookback: int, step: int) -> str:
    last = lookback // step
    return f"""
select cast(i as int) as fold, {_key('c')} as cutoff, {_key('c - interval 7 day')} as week_from,
  {_key('c - interval 31 day')} as month_from,
  {_key(f'c + (case when i = {last} then 365 else {step} end) * interval 1 day')} as target_to
from (select i, date '{start}' - cast({lookback} - {step} * i + 1 as int) as c from range({last + 1}) r(i)) t"""


def _in(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _filled() -> str:
    mean = "(select mean from overall)"
    return f"""
select * replace (
  coalesce(average_grp, {mean}) as average_grp,
  coalesce(average_grp_week, average_grp, {mean}) as average_grp_week,
  coalesce(average_grp_month, average_grp, {mean}) as average_grp_month,
  coalesce(average_grp_line_prg, average_grp, {mean}) as average_grp_line_prg,
  coalesce(average_pro2, average_grp_line_prg, average_grp, {mean}) as average_pro2)
from raw"""


def _tables(blocks: dict[str, str], folds: str, floor: int, start: int, channels: list[str]) -> dict[str, str]:
    """Named intermediate results, each defined on the ones before it."""
    return blocks | {
        "folds": folds,
        "history": f"""
select distinct blockdate % 7 as weekday, cnlname, blocktime, blockdate, factratebase
from blocks where blockdate >= {floor} and blockdate <= (select max(cutoff) from folds)""",
        "by_time": """
select f.fold, h.weekday, h.cnlname, h.hour, avg(factratebase) as average_grp,
  avg(case when blockdate >= week_from then factratebase end) as average_grp_week,
  avg(case when blockdate >= month_from then factratebase end) as average_grp_month
from (select *, case when blocktime // 1800 <= 48 then blocktime // 1800 else blocktime // 1800 - 48 end as hour from history) h
join folds f on h.blockdate <= f.cutoff
where h.cnlname is not null group by all""",
        "by_line": """
select f.fold, b.proid, b.blocktime // 1800 as hour, b.blockdate % 7 as weekday,
  sum(factratebase) / count(factratebase) as average_grp_line_prg
from blocks b join folds f on b.blockdate <= f.cutoff
group by f.fold, b.proid, b.blocktime // 1800, b.blockdate % 7""",
        "by_title": """
select f.fold, b.pro2, b.blocktime // 1800 as hour, b.cnlname,
  sum(factratebase) / count(factratebase) as average_pro2
from blocks b join folds f on b.blockdate <= f.cutoff
where b.pro2 <> 0 group by f.fold, b.pro2, b.blocktime // 1800, b.cnlname""",
        "target": f"""
select f.fold, {BLOCK_COLUMNS}, blockdate % 7 as weekday, blocktime // 1800 as hour
from blocks b join folds f on b.blockdate > f.cutoff and b.blockdate <= f.target_to""",
        "raw": """
select t.*, a.average_grp, a.average_grp_week, a.average_grp_month, l.average_grp_line_prg, p.average_pro2
from target t
left join by_time a on t.fold = a.fold and t.weekday = a.weekday and t.cnlname = a.cnlname and t.hour = a.hour
left join by_line l on t.fold = l.fold and t.proid is not distinct from l.proid and t.hour = l.hour and t.weekday = l.weekday
left join by_title p on t.fold = p.fold and t.pro2 = p.pro2 and t.hour = p.hour and t.cnlname is not distinct from p.cnlname""",
        "overall": "select avg(average_grp) as mean from raw",
        "filled": _filled(),
        "sample": """
select *, (average_pro2 - average_grp_line_prg) * is_movie as "Movies_diff",
  (average_pro2 - average_grp_line_prg) * is_series as "Series_diff" from filled""",
        "labelled": f"""
select *, case when weekday in (3, 4) then 'weekend' else 'weekdays' end as day_type, blockdate < {start} as is_train
from sample where cnlname in {_in(channels)}""",
        "stats": """
select cnlname, day_type, avg(case when is_train then factratebase end) as label_mean,
  stddev_samp(case when is_train then factratebase end) as label_std,
  count(*) filter (where is_train) as n_train, count(*) filter (where not is_train) as n_test
from labelled group by cnlname, day_type""",
        "train": """
select l.* from labelled l join stats s on l.cnlname = s.cnlname and l.day_type = s.day_type
where l.is_train and l.factratebase < s.label_mean + 3 * s.label_std""",
    }


EVENT_TABLES = _tables(
    {
        "grid": EVENT_GRID.replace("{json}", "json_extract_string(props, '$.k')").replace("{events}", "events"),
        "blocks": f"""
select {BLOCK_COLUMNS} from (
  select *, 'old' as VIMB_type from grid where blockid % 2 = 0
  union all select *, 'new' as VIMB_type from grid where blockid % 2 = 1 or blockid % 20 = 0) u""",
    },
    _folds("2024-01-25", 14, 7), 20230101, 20240125, EVENT_CHANNELS,
)
LINE_TABLES = _tables(
    {
        "blocks": f"""
select {BLOCK_COLUMNS} from (
  select *, cast(null as double) as forecastratebase, cast(null as varchar) as prgname, cast(null as int) as progid,
    cast(null as int) as tnsblockfactdur, cast(null as bigint) as tnsblockfactid, cast(null as int) as tnsblockfacttime,
    cast(null as int) as border
  from ({LINE_GRID.replace("{lineitem}", "lineitem")}) g) u""",
    },
    _folds("1999-06-01", 98, 14), 19950101, 19990601, [c for c in LINE_CHANNELS if c not in LINE_EXCLUDED],
)


def _sql(tables: dict[str, str], body: str) -> str:
    kept = {name: " materialized" if name in ("raw", "overall") else "" for name in tables}
    return "with " + ",\n".join(f"{name} as{kept[name]} ({text})" for name, text in tables.items()) + "\n" + body.strip()


def events(body: str) -> str:
    return _sql(EVENT_TABLES, body)


def lines(body: str) -> str:
    return _sql(LINE_TABLES, body)


def _round(*names: str, digits: int = 6) -> str:
    return ", ".join(f'round({n}, {digits}) + 0.0 as {n}' for n in names)


TIME_AVERAGES = f"select fold, weekday, cnlname, hour, {_round(*AVERAGES[:3])} from by_time"
LINE_AVERAGES = f"select fold, proid, hour, weekday, {_round('average_grp_line_prg')} from by_line"
TITLE_AVERAGES = f"select fold, pro2, hour, cnlname, {_round('average_pro2')} from by_title"
FEATURES = f"""
select * replace ({_round('factratebase', 'forecastratebase', *AVERAGES, '"Movies_diff"', '"Series_diff"')}) from sample"""

COUNTS = """
sum(case when b.blockdate <= f.cutoff then 1 else 0 end)::bigint as n_history,
max(case when b.blockdate <= f.cutoff then b.blockdate end) as last_history,
sum(case when b.blockdate > f.cutoff and b.blockdate <= f.target_to then 1 else 0 end)::bigint as n_target,
min(case when b.blockdate > f.cutoff and b.blockdate <= f.target_to then b.blockdate end) as first_target"""

CHANNEL_ROWS = " union all ".join(f"select '{c}' as cnlname" for c in EVENT_CHANNELS)
LINE_ROWS = " union all ".join(f"select '{c}' as cnlname" for c in LINE_CHANNELS if c not in LINE_EXCLUDED)


def _status(channel_rows: str) -> str:
    return f"""
, listed as (select * from ({channel_rows}) c cross join (select 'weekdays' as day_type union all select 'weekend') d),
kept as (select cnlname, day_type, count(*) as n_kept, count(*) filter (where {" or ".join(f"{f} is null" for f in config.FEATURES)}) as n_null
  from train group by cnlname, day_type)
select l.cnlname, l.day_type, coalesce(n_train, 0) as n_train, coalesce(n_test, 0) as n_test,
  coalesce(n_kept, 0) as n_kept, coalesce(n_null, 0) as n_null,
  case when coalesce(n_train, 0) = 0 or coalesce(n_test, 0) = 0 then 'empty'
    when coalesce(n_kept, 0) = 0 or n_null > 0 then 'failed' else 'ready' end as status
from listed l left join stats s on l.cnlname = s.cnlname and l.day_type = s.day_type
left join kept k on l.cnlname = k.cnlname and l.day_type = k.day_type"""


def _with(tables: dict[str, str], more: str) -> str:
    """Tables followed by further ones, given as text that starts with a comma."""
    return _sql(tables, "").rstrip() + more


TERMS = [f"{w} * {f}" for w, f in zip(WEIGHTS, config.FEATURES)]
STRICT = " + ".join(TERMS)
LENIENT = " + ".join(f"coalesce({t}, 0)" for t in TERMS)
TOTAL = sum(WEIGHTS)


def _runaway(name: str) -> str:
    weights = [RUNAWAY[name].get(i, w) for i, w in enumerate(WEIGHTS)]
    terms = [f"'{w}'::double * {f}::double" for w, f in zip(weights, config.FEATURES)]
    return " + ".join(f"coalesce(case when isnan({t}) then 0.0::double else {t} end, 0)" for t in terms)


STEPPED = ", ".join(
    f"round({w} + 2 * {ETA} / n * {f} * residual, 6) + 0.0 as w_{f}" for w, f in zip(WEIGHTS, config.FEATURES)
)
FITTED_SEGMENTS = """
select distinct t.cnlname, t.day_type from train t"""

MERGED = """
, existing as (select * from blocks where blockid % 7 <> 0),
incoming as (select * replace (
    case when blockid % 3 = 0 then blockdate + 1 else blockdate end as blockdate,
    case when blockid % 4 = 0 then factratebase * 2 else factratebase end as factratebase)
  from blocks where blockdate between 20240105 and 20240112 and blockid % 5 <> 0),
keys as (select blockid, "VIMB_type" from incoming), days as (select distinct blockdate from incoming)"""
CHANGED = """
select case when o.blockid is null then 'added' when n.blockid is null then 'gone' else 'changed' end as change, o.blockdate as before, n.blockdate as after
from {existing} o full join incoming n on o.blockid = n.blockid and o."VIMB_type" = n."VIMB_type"
where o.blockid is null or n.blockid is null or o.blockdate <> n.blockdate or o.factratebase is distinct from n.factratebase"""

ORACLES = {
    "unify_sources": events("select * from blocks"),
    "step_row_counts": events("""
, old_days as (select blockdate, count(*) as n from grid where blockid % 2 = 0 group by blockdate),
new_days as (select blockdate, count(*) as n from grid where blockid % 2 = 1 or blockid % 20 = 0 group by blockdate)
select 'old_days' as step, count(*) as row_count from old_days
union all select 'new_days', count(*) from new_days
union all select 'both_days', count(*) from old_days o join new_days n on o.blockdate = n.blockdate
union all select 'late_blocks', count(*) from blocks where blocktime >= 86400"""),
    "merge_grids": events(MERGED + """
select * from incoming union all
select e.* from existing e anti join keys k on e.blockid = k.blockid and e."VIMB_type" = k."VIMB_type\""""),
    "merge_grids_whole": events(MERGED + """
select * from incoming union all
select e.* from existing e anti join keys k on e.blockid = k.blockid and e."VIMB_type" = k."VIMB_type" where e.blockdate not in (from days)"""),
    "merge_changes": events(MERGED + f"""
, asked as (select e.* from existing e semi join keys k on e.blockid = k.blockid and e."VIMB_type" = k."VIMB_type"),
there as (select e.* from existing e anti join keys k on e.blockid = k.blockid and e."VIMB_type" = k."VIMB_type" where e.blockdate in (from days)),
whole as (select * from asked union all select * from there),
c as (select false as whole_days, * from ({CHANGED.format(existing="asked")}) a union all select true, * from ({CHANGED.format(existing="whole")}) b)
select whole_days, change, blockdate, count(*) as blocks from (
  select whole_days, change, before as blockdate from c where before is not null
  union all select whole_days, change, after from c where after is not null and after is distinct from before) d
group by all"""),
    "published_runs": events("""
, r as (select 'first' as run_id, cnlname, blockid from target union all select 'second', cnlname, blockid from target where blockid % 2 = 0)
select run_id, cnlname, count(*) as n, 'rows' as "of" from r group by run_id, cnlname
union all select d.run_id, c.cnlname, 1::bigint, 'counts' from (select distinct cnlname from target) c
  cross join (select 'first' as run_id union all select 'third') d"""),
    "restarted_steps": events("""
, old_days as (select blockdate, count(*) as n from grid where blockid % 2 = 0 group by blockdate),
new_days as (select blockdate, count(*) as n from grid where blockid % 2 = 1 or blockid % 20 = 0 group by blockdate)
select 'old_days' as step, count(*) as row_count, true as goes_on from old_days
union all select 'new_days', count(*), true from new_days
union all select 'both_days', count(*), true from old_days o join new_days n on o.blockdate = n.blockdate"""),
    "history_distinct": events("select * from history"),
    "target_grid": events("select * from target"),
    "forecast_append": events("""
select blockid, VIMB_type, cnlname, forecastratebase, "Today" from target
cross join (select '2024-01-28' as "Today" union all select '2024-01-31') d where blockdate >= 20240125"""),
    "day_key": lines("""
select blockdate, blockdate % 7 as weekday,
  case when blockdate % 7 in (3, 4) then 'weekend' else 'weekdays' end as day_type, count(*) as blocks
from blocks group by blockdate"""),
    "slots": events("""
select blockid, VIMB_type, blocktime, blocktime // 1800 as hour,
  case when blocktime // 1800 > 48 then blocktime // 1800 - 48 else blocktime // 1800 end as history_hour from blocks"""),
    "day_names": lines("""
select dayname(day) as day_name, cast(isodow(day) as int) as day_number, count(*) as blocks
from (select strptime(cast(blockdate as varchar), '%Y%m%d') as day from blocks) d group by dayname(day), isodow(day)"""),
    "start_day": lines("""
select blockdate as today, cast(strftime(day - interval 3 day, '%Y%m%d') as int) as start,
  cast(date_diff('day', day - interval 3 day, max(day) over ()) as int) as days_left
from (select distinct blockdate, strptime(cast(blockdate as varchar), '%Y%m%d') as day from blocks) d"""),
    "fold_calendar": lines(f"select f.*, {COUNTS} from folds f cross join blocks b group by all"),
    "asof_folds": events(f"""
select fold, cnlname, {COUNTS} from folds f cross join blocks b
group by fold, cnlname having min(b.blockdate) <= min(f.cutoff)"""),
    "avg_time_slots": events(TIME_AVERAGES),
    "avg_time_slots_wide": lines(TIME_AVERAGES),
    "avg_programme_line": events(LINE_AVERAGES),
    "avg_programme_line_wide": lines(LINE_AVERAGES),
    "avg_title": events(TITLE_AVERAGES),
    "avg_title_wide": lines(TITLE_AVERAGES),
    "feature_join": events(f"select fold, blockid, VIMB_type, {_round(*AVERAGES)} from raw"),
    "imputation": events(f"select fold, blockid, VIMB_type, {_round(*AVERAGES)} from filled"),
    "features": events(FEATURES),
    "features_wide": lines(FEATURES),
    "features_from_state": events(FEATURES),
    "state_updates": events("""
select cast(0 as int) as "update", blockdate from blocks where blockdate <= 20240118 group by blockdate
union all select cast(1 as int), blockdate from blocks where blockdate > 20240118 or blockdate = 20240110 group by blockdate"""),
    "train_test_split": events("select blockid, VIMB_type, fold, blockdate < 20240125 as is_train from target"),
    "segments": events("""
select cnlname, day_type, weekday, is_train, count(*) as blocks from labelled group by all"""),
    "channel_filter": lines("""
select cnlname, count(*) as blocks from target where cnlname not in ('ch4', 'ch7') group by cnlname"""),
    "three_sigma_trim": events(f"""
select s.cnlname, s.day_type, round(label_mean, 6) as label_mean, round(label_std, 6) as label_std, n_train, n_test,
  n_kept, round(highest, 6) as highest, round(lowest, 6) as lowest
from stats s left join (
  select cnlname, day_type, count(*) as n_kept, max(factratebase) as highest, min(factratebase) as lowest
  from train group by cnlname, day_type) k on s.cnlname = k.cnlname and s.day_type = k.day_type"""),
    "segment_status": _with(EVENT_TABLES, _status(CHANNEL_ROWS)),
    "segment_status_wide": _with(LINE_TABLES, _status(LINE_ROWS)),
    "gram": events(f"""
, z as (select cnlname, day_type, [1.0::double, {", ".join(f"{f}::double" for f in config.FEATURES)}, factratebase] as z from train)
select cnlname, day_type, count(*) as n_kept, cast(i as int) as i, cast(j as int) as j,
  round(sum(z[i + 1] * z[j + 1]), 4) + 0.0 as total
from z, range(10) a(i), range(10) b(j) where i <= j group by cnlname, day_type, i, j"""),
    "linear_score": events(f"select blockid, VIMB_type, round({LENIENT}, 6) + 0.0 as score from sample"),
    "linear_score_runaway": events(f"""
, scored as ({" union all ".join(f"select blockid, VIMB_type, '{name}' as weights, {_runaway(name)} as s from sample" for name in RUNAWAY)})
select blockid, VIMB_type, weights,
  case when isnan(s) then 'not a number' when s = 'inf'::double then 'above' when s = '-inf'::double then 'below' else 'finite' end as kind,
  case when isfinite(s) then round(s, 6) + 0.0 end as score from scored"""),
    "linear_predict_strict": events(f"""
select blockid, VIMB_type, round({STRICT}, 6) + 0.0 as strict, round({LENIENT}, 6) + 0.0 as lenient
from (select *, (average_pro2 - average_grp_line_prg) * is_movie as "Movies_diff",
  (average_pro2 - average_grp_line_prg) * is_series as "Series_diff" from raw) r"""),
    "nnls_kkt": events(f"select *, true as not_negative, true as flat_where_positive, true as no_descent_left from ({FITTED_SEGMENTS}) s"),
    "nnls_kkt_wide": lines(f"select *, true as not_negative, true as flat_where_positive, true as no_descent_left from ({FITTED_SEGMENTS}) s"),
    "coefficients": events(f"""
select s.cnlname, s.day_type, cast(f.position as int) as position, f.feature, true as nnls_valid, true as sgd_found
from ({FITTED_SEGMENTS}) s cross join ({" union all ".join(
    f"select {i} as position, '{name}' as feature" for i, name in enumerate(config.FEATURES))}) f"""),
    "sgd_step": events(f"""
select blockid, VIMB_type, {STEPPED} from (
  select *, count(*) over (partition by cnlname, day_type) as n,
    factratebase - ({STRICT}) + case when factratebase > {STRICT} then 0.9 * {TOTAL} else 0 end as residual
  from train) t"""),
    "all_pairs_error": events(f"""
, p as (select cnlname, day_type, factratebase as y, {STRICT} as p from train),
own as (select cnlname, day_type, avg((y - p) * (y - p)) as squared_error from p group by cnlname, day_type),
pairs as (select a.cnlname, a.day_type, avg((a.y - b.p) * (a.y - b.p)) as all_pairs_error
  from p a join p b on a.cnlname = b.cnlname and a.day_type = b.day_type group by a.cnlname, a.day_type)
select o.cnlname, o.day_type, round(all_pairs_error, 6) as all_pairs_error, round(squared_error, 6) as squared_error
from own o join pairs r on o.cnlname = r.cnlname and o.day_type = r.day_type"""),
    "sgd_invariants": events(f"""
select *, true as repeatable, true as seed_matters, true as steps_in_range, true as finite from ({FITTED_SEGMENTS}) s"""),
    "sgd_trace": events(f"select *, true as no_gap, true as error_matches from ({FITTED_SEGMENTS}) s"),
    "cv_folds": events("""
, r as (select cnlname, day_type, blockdate::bigint * 100 + hour as moment,
    ('0x' || substr(md5(blockid::varchar), 1, 8))::bigint / 4294967296.0 as place from train),
c as (select *, count(*) over (partition by cnlname, day_type, moment) as n, count(*) over (partition by cnlname, day_type) as total,
    rank() over (partition by cnlname, day_type order by moment) - 1 as before from r),
placed as (select *,
    case when total * 1 / 3.0 <= before then 1 when total * 1 / 3.0 < before + n and place >= ceil(total * 1 / 3.0 - before) / n then 1 else 0 end
    + case when total * 2 / 3.0 <= before then 1 when total * 2 / 3.0 < before + n and place >= ceil(total * 2 / 3.0 - before) / n then 1 else 0 end
    as fold from c)
select cnlname, day_type, cast(fold as int) as cv_fold, count(*) as blocks, min(moment) as first_moment, max(moment) as last_moment
from placed group by cnlname, day_type, fold"""),
    "boosted_forecast": events("""
select s.cnlname, s.day_type, true as beats_mean, n_test as n_predicted from stats s"""),
    "grid_search": events("""
select s.cnlname, s.day_type, cast(i as int) as iterations, cast(d as int) as depth, true as r2_possible, true as refitted_if_best
from stats s cross join (select unnest([5, 10]) as i) x cross join (select unnest([5, 6, 7, 8, 9, 10]) as d) y"""),
    "forecast": events("""
select cnlname, day_type, '2024-01-28' as "Today", n_test as blocks, n_test as with_gbt, n_test as with_sgd, n_test as with_nnls,
  true as best_refitted from stats"""),
    "run_status": _with(EVENT_TABLES, _status(CHANNEL_ROWS + " union all select 'off air' as cnlname").replace(
        "select l.cnlname, l.day_type", "select '2024-01-28' as \"Today\", l.cnlname, l.day_type").replace(
        "coalesce(n_kept, 0) as n_kept, coalesce(n_null, 0) as n_null,", "coalesce(n_kept, 0) as n_kept,").replace(
        "'ready'", "'loaded'")),
}
