"""SQL that states each registered query over the given tables, written without the library's plans.

Common table expressions build up the trips step by step; every oracle selects from the step it
needs. Rounding, weekday and time functions follow the comparison rules in FIXTURES.md.
"""

from __future__ import annotations

CELLS = ("pickup_cell", "dropoff_cell")
WINDOWS = (10, 15, 1440)
COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


COARSE = {"pca_direction": 4}
GIVEN_CENTRES = [(40.64 + 0.035 * i, -74.01 + 0.045 * j) for i in range(5) for j in range(5)]


def r6(expression: str, digits: int = 6) -> str:
    scale = f"1e{digits}::double"
    return f"round_even(({expression}) * {scale}, 0) / {scale} + 0.0::double"


def r6_as(expression: str, name: str) -> str:
    return f"{r6(expression, COARSE.get(name, 6))} as {name}"


TRIPS = """
select concat('id', lpad(cast(o_orderkey as varchar), cast(greatest(7, length(cast(o_orderkey as varchar))) as integer), '0')) as id,
 case when o_orderkey % 10 < 7 then 'train' else 'test' end as split,
 1 + o_custkey % 2 as vendor_id,
 o_orderdate + ((o_orderkey * 7919) % 86400) * interval '1' second as pickup_datetime,
 case when o_orderkey % 10 < 7 then o_orderdate + ((o_orderkey * 7919) % 86400 + 60
   + cast(floor(o_totalprice) as bigint) % 3600) * interval '1' second end as dropoff_datetime,
 case when o_orderkey % 97 <> 0 then 1 + o_orderkey % 6 end as passenger_count,
 cast(40.63 as double) + cast(((o_orderkey * 7919) % 47) * ((o_orderkey * 104729) % 47) as double) / cast(10000 as double) as pickup_latitude,
 cast(-74.03 as double) + cast(((o_orderkey * 6151) % 53) * ((o_orderkey * 3571) % 53) as double) / cast(10000 as double) as pickup_longitude,
 cast(40.63 as double) + cast(((o_orderkey * 3571) % 47) * ((o_orderkey * 6151) % 47) as double) / cast(10000 as double) as dropoff_latitude,
 cast(-74.03 as double) + cast(((o_orderkey * 104729) % 53) * ((o_orderkey * 7919) % 53) as double) / cast(10000 as double) as dropoff_longitude,
 case when o_orderkey % 89 <> 0 then case when o_orderstatus = 'F' then 'Y' else 'N' end end as store_and_fwd_flag,
 case when o_orderkey % 10 < 7 then 60 + cast(floor(o_totalprice) as bigint) % 3600 end as trip_duration
from orders
"""

ROUTES = """
select concat('id', lpad(cast(l_orderkey as varchar), cast(greatest(7, length(cast(l_orderkey as varchar))) as integer), '0')) as id,
 min(p_brand) as starting_street, max(p_brand) as end_street,
 sum(l_quantity) as total_distance,
 cast(sum(cast(l_linenumber as bigint)) * 30 as bigint) as total_travel_time,
 count(*) as number_of_steps,
 concat(repeat('left|', cast(l_orderkey % 4 as int)),
        repeat('slight right|', cast(l_orderkey % 3 as int)), 'straight|none') as step_direction
from lineitem join part on l_partkey = p_partkey group by l_orderkey
"""

TRACED = ("precipitation", "snow_fall", "snow_depth")
WEATHER = """
select distinct concat(cast(day(o_orderdate) as varchar), '-', cast(month(o_orderdate) as varchar), '-',
 cast(year(o_orderdate) as varchar)) as date,
 case when day(o_orderdate) % 6 = 0 then 'T' else '0.' || cast(day(o_orderdate) % 10 as varchar) end as precipitation,
 case when day(o_orderdate) % 7 = 0 then 'T' else cast(day(o_orderdate) % 5 as varchar) end as snow_fall,
 case when day(o_orderdate) % 11 = 0 then 'T' else cast(day(o_orderdate) % 3 as varchar) end as snow_depth
from orders
"""


def haversine(a: str, b: str, c: str, d: str, radius: str = "6371.0") -> str:
    return (
        f"2.0::double * {radius}::double * asin(sqrt(least(1.0::double, pow(sin(radians({c} - {a}) / 2), 2) + "
        f"cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"
    )


def manhattan(a: str, b: str, c: str, d: str) -> str:
    return f"({haversine(a, b, a, d)}) + ({haversine(a, b, c, b)})"


def bearing(a: str, b: str, c: str, d: str) -> str:
    return (
        f"degrees(atan2(sin(radians({d} - {b})) * cos(radians({c})), cos(radians({a})) * sin(radians({c})) - "
        f"sin(radians({a})) * cos(radians({c})) * cos(radians({d} - {b}))))"
    )


def _distances(first: str, second: str, prefix: str) -> str:
    ends = (f"pickup_{first}", f"pickup_{second}", f"dropoff_{first}", f"dropoff_{second}")
    return ", ".join(
        (
            f"{haversine(*ends)} as {prefix}distance_haversine",
            f"{manhattan(*ends)} as {prefix}distance_dummy_manhattan",
            f"{bearing(*ends)} as {prefix}direction",
            f"({ends[0]} + {ends[2]}) / 2 as {prefix}center_latitude",
            f"({ends[1]} + {ends[3]}) / 2 as {prefix}center_longitude",
        )
    )


BIN_SOURCES = (*COORDINATES, "lat_long_center_latitude", "lat_long_center_longitude")
BINS = ", ".join(f"round_even({c} * 100.0::double, 0) / 100.0::double as {c}_bin" for c in BIN_SOURCES)


def _cell(end: str) -> str:
    return (
        f"cast(floor(({end}_latitude - 40.63::double) / 0.05::double) * 100 "
        f"+ floor(({end}_longitude - -74.03::double) / 0.05::double) as bigint)"
    )


HOLIDAY = """
case when (m = 1 and d = 1) or (m = 7 and d = 4) or (m = 11 and d = 11) or (m = 12 and d = 25)
  or (w = 0 and ((m = 1 and d between 15 and 21) or (m = 2 and d between 15 and 21) or (m = 5 and d between 25 and 31)
      or (m = 9 and d between 1 and 7) or (m = 10 and d between 8 and 14)))
  or (w = 3 and m = 11 and d between 22 and 28) then 1 else 0 end
"""
HOLIDAY_EVE = """
case when (m = 12 and d = 31) or (m = 7 and d = 3) or (m = 11 and d = 10) or (m = 12 and d = 24)
  or (w = 6 and ((m = 1 and d between 14 and 20) or (m = 2 and d between 14 and 20) or (m = 5 and d between 24 and 30)
      or (m = 9 and d between 1 and 6) or (m = 8 and d = 31) or (m = 10 and d between 7 and 13)))
  or (w = 2 and m = 11 and d between 21 and 27) then 1 else 0 end
"""

FOLD = "cast((('0x' || substr(md5('42:' || id), 1, 8))::bigint) % {n} as integer)"

STEPS = [
    ("trips", TRIPS),
    ("routes", ROUTES),
    ("weather", WEATHER),
    (
        "points",
        "select pickup_latitude as x, pickup_longitude as y from trips "
        "union all select dropoff_latitude, dropoff_longitude from trips",
    ),
    (
        "axis",
        "select avg(x) as mx, avg(y) as my, 0.5::double * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) as theta from points",
    ),
    (
        "rotated",
        "select trips.*, "
        + ", ".join(
            f"({e}_latitude - mx) * cos(theta) + ({e}_longitude - my) * sin(theta) as {e}_pca0, "
            f"case when sin(theta) > 0 then 1.0::double else -1.0::double end * "
            f"(({e}_latitude - mx) * sin(theta) - ({e}_longitude - my) * cos(theta)) as {e}_pca1"
            for e in ("pickup", "dropoff")
        )
        + " from trips, axis",
    ),
    (
        "parts",
        "select *, cast(month(pickup_datetime) as integer) as pickup_month, cast(day(pickup_datetime) as integer) as pickup_day, "
        "cast(hour(pickup_datetime) as integer) as pickup_hour, cast(week(pickup_datetime) as integer) as pickup_weekofyear, "
        "cast(isodow(pickup_datetime) - 1 as integer) as pickup_weekday, cast(minute(pickup_datetime) as integer) as pickup_minute "
        "from rotated",
    ),
    (
        "dated",
        "select *, pickup_weekday * 24 + pickup_hour as pickup_week_hour, "
        "case when pickup_weekday in (0, 6) then 1 else 0 end as is_weekend, "
        "(epoch_us(pickup_datetime) - (select min(epoch_us(pickup_datetime)) from trips)) / 1e6::double as pickup_time_delta, "
        "pickup_weekday + (pickup_hour + pickup_minute / 60.0::double) / 24.0::double as pickup_week_delta, "
        "sin((pickup_weekday + (pickup_hour + pickup_minute / 60.0::double) / 24.0::double) / 7.0::double * pi()) as pickup_week_delta_sin, "
        "sin(pickup_hour / 24.0::double * pi()) as pickup_hour_sin from parts",
    ),
    (
        "measured",
        f"select *, {_distances('latitude', 'longitude', 'lat_long_')}, {_distances('pca0', 'pca1', 'pca_')} from dated",
    ),
    ("binned", f"select *, {BINS} from measured"),
    (
        "base",
        "select *, 1000.0::double * lat_long_distance_haversine / nullif(trip_duration, 0) as lat_long_avg_speed_h, "
        "1000.0::double * lat_long_distance_dummy_manhattan / nullif(trip_duration, 0) as lat_long_avg_speed_m, "
        "ln(trip_duration + 1.0::double) as log_trip_duration, "
        "lat_long_distance_haversine / (nullif(trip_duration, 0) / 3600.0::double) as speed, "
        f"{_cell('pickup')} as pickup_cell, {_cell('dropoff')} as dropoff_cell, "
        "round_even(pickup_week_delta_sin * 1e12::double, 0) / 1e12::double as week_sine_key, "
        "round_even(pickup_hour_sin * 1e12::double, 0) / 1e12::double as hour_sine_key, "
        f"{FOLD.format(n=5)} as fold from binned",
    ),
    ("train", "select * from base where split = 'train'"),
    (
        "cell_traffic",
        "select cluster, count(*) as traffic from (select pickup_cell as cluster from base "
        "union all select dropoff_cell from base) group by cluster",
    ),
    (
        "heavy",
        "select cluster, traffic from cell_traffic where traffic > (select quantile_cont(traffic, 0.8) from cell_traffic)",
    ),
    (
        "daily",
        "select make_date(cast(split_part(date, '-', 3) as integer), cast(split_part(date, '-', 2) as integer), "
        "cast(split_part(date, '-', 1) as integer)) as day, "
        + ", ".join(f"case when {c} = 'T' then -1.0::double else cast({c} as double) end as {c}" for c in TRACED)
        + " from weather",
    ),
    (
        "street_means",
        "select 'start' as kind, starting_street as street, avg(trip_duration) as heavy from trips join routes using (id) "
        "where split = 'train' group by starting_street union all "
        "select 'end', end_street, avg(trip_duration) from trips join routes using (id) where split = 'train' group by end_street",
    ),
]

SINGLE_KEYS = {
    "pickup_weekofyear": "pickup_weekofyear",
    "pickup_hour": "pickup_hour",
    "pickup_weekday": "pickup_weekday",
    "pickup_week_hour": "pickup_week_hour",
    "week_sine_key": "pickup_week_delta_sin",
    "hour_sine_key": "pickup_hour_sin",
    "pickup_day": "pickup_day",
    "pickup_cell": "pickup_cell",
    "dropoff_cell": "dropoff_cell",
}
TARGETS = ("lat_long_avg_speed_h", "lat_long_avg_speed_m", "log_trip_duration")
BIN_KEYS = ("pickup_latitude_bin", "pickup_longitude_bin")
MULTI_KEYS = (
    BIN_KEYS,
    ("pickup_week_hour", *BIN_KEYS),
    ("pickup_hour", *BIN_KEYS),
    CELLS,
    ("pickup_week_hour", *CELLS),
    ("pickup_hour", *CELLS),
    ("pickup_hour", "pickup_cell"),
    ("pickup_hour", "dropoff_cell"),
)


def _single_joins() -> tuple[str, list[str]]:
    joins, columns = "", []
    for i, (key, shown) in enumerate(SINGLE_KEYS.items()):
        means = ", ".join(f"avg({t}) as {t}" for t in TARGETS)
        joins += f" left join (select {key} as k, {means} from train group by {key}) s{i} on base.{key} = s{i}.k"
        columns += [r6_as(f"s{i}.{t}", f"{t}_gby_{shown}") for t in TARGETS]
    return joins, columns


def _multi_joins() -> tuple[str, list[str]]:
    joins, columns = "", []
    for i, keys in enumerate(MULTI_KEYS):
        names, tail = ", ".join(keys), "_".join(keys)
        on = " and ".join(f"base.{k} = m{i}.{k}" for k in keys)
        joins += (
            f" left join (select {names}, avg(lat_long_avg_speed_h) as h, count(*) as n, avg(lat_long_avg_speed_m) as m "
            f"from train group by {names} having count(*) > 100) m{i} on {on}"
        )
        columns += [
            r6_as(f"m{i}.h", f"lat_long_avg_speed_h_{tail}"),
            f"m{i}.n as cnt_{tail}",
            r6_as(f"m{i}.m", f"lat_long_avg_speed_m_{tail}"),
        ]
    return joins, columns


def _window(source: str, cell: str | None, ts: str, minutes: int, side: str, name: str) -> str:
    near, far = 1, minutes * 60_000_000 - 1
    frame = {
        "after": f"{near} following and {far} following",
        "before": f"{far} preceding and {near} preceding",
        "trailing": f"{far} preceding and current row",
    }[side]
    partition = f"partition by {cell} " if cell else ""
    count = f"count(*) over ({partition}order by epoch_us({ts}) range between {frame})"
    missing = f"{ts} is null" + (f" or {cell} is null" if cell else "")
    return f"case when {missing} then 0 else {count} end as {name}"


def _pickup_windows(minutes):
    return [_window("base", "pickup_cell", "pickup_datetime", m, "after", f"this_pickup_cellafter_{m}minutes_traffic") for m in minutes]


def _dropoff_windows(minutes, side="after"):
    return [_window("base", "dropoff_cell", "dropoff_datetime", m, side, f"this_dropoff_cellpre_{m}minutes_traffic") for m in minutes]


def _hour_means(folds: int, weight: str) -> str:
    """CTEs: labelled trips, and the mean label by hour that each fold's model holds. All folds hold all hours."""
    return (
        f"with labelled as (select id, pickup_hour, ln(trip_duration) as label, {FOLD.format(n=folds)} as fold from train), "
        "test as (select id, pickup_hour from base where split = 'test'), "
        "sums as (select fold, pickup_hour, sum(label) as s, count(*) as n from labelled group by all), "
        "hours as (select pickup_hour, sum(s) as s, sum(n) as n from sums group by all), "
        "wholes as (select fold, (select sum(s) from sums) - sum(s) as s, (select sum(n) from sums) - sum(n) as n from sums group by fold), "
        f"by_hour as (select w.fold, h.pickup_hour, (h.s - coalesce(f.s, 0) + {weight} * w.s / w.n) / (h.n - coalesce(f.n, 0) + {weight}) as p "
        "from hours h cross join wholes w left join sums f on f.fold = w.fold and f.pickup_hour = h.pickup_hour)"
    )


def _levels(source: str, levels, measures: dict[str, str]) -> str:
    """Long form of several groupings; groups with a missing key are left out."""
    parts = []
    for keys in levels:
        bucket = " || ',' || ".join(f"cast({k} as varchar)" for k in keys)
        whole = " and ".join(f"{k} is not null" for k in keys)
        means = "".join(f", {r6_as(f'avg({e})', n)}" for n, e in measures.items())
        parts.append(
            f"select '{','.join(keys)}' as level, {bucket} as bucket, count(*) as cnt{means} from {source} "
            f"where {whole} group by {', '.join(keys)}"
        )
    return " union all ".join(parts)


def _describe(column: str) -> str:
    rows = {
        "count": f"count({column})::double",
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})::double",
        "25%": f"quantile_cont({column}, 0.25)",
        "50%": f"quantile_cont({column}, 0.5)",
        "75%": f"quantile_cont({column}, 0.75)",
        "max": f"max({column})::double",
    }
    return " union all ".join(
        f"select '{column}' as column_name, '{s}' as statistic, {r6_as(e, 'value')} from train" for s, e in rows.items()
    )


def _missing(columns) -> str:
    parts = " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as missing_count, count(*) as total from trips" for c in columns
    )
    rate = r6_as("missing_count / total::double", "missing_rate")
    return f"select column_name, missing_count, {rate} from ({parts}) where missing_count > 0"


def _drift(columns) -> str:
    def side(split, c):
        v = f"case when split = '{split}' then cast({c} as double) end"
        rows = f"count(case when split = '{split}' then 1 end)"
        return (
            f"{r6(f'avg({v})', 4)} as {split}_mean, {r6(f'stddev_pop({v})', 4)} as {split}_std, "
            f"{r6(f'1 - count({v}) / {rows}::double', 3)} as {split}_nan"
        )

    parts = " union all ".join(f"select '{c}' as feature, {side('train', c)}, {side('test', c)} from base" for c in columns)
    return (
        f"select feature, train_mean, test_mean, train_std, test_std, train_nan, test_nan, "
        f"{r6_as('abs(train_mean - test_mean) / nullif(abs(train_std + test_std), 0) * 2', 'train_test_mean_diff')}, "
        f"{r6_as('abs(train_nan - test_nan)', 'train_test_nan_diff')} from ({parts})"
    )


def _histogram(value: str, width: str, where: str = "true") -> str:
    return (
        f"select bin, {r6_as(f'bin * {width}::double', 'bin_from')}, cnt from (select cast(floor(({value}) / {width}::double) as bigint) as bin, "
        f"count(*) as cnt from train where {where} group by 1)"
    )


DRIFT_COLUMNS = ("vendor_id", "passenger_count", *COORDINATES, "lat_long_distance_haversine")
TRIP_COLUMNS = (
    "id split vendor_id pickup_datetime dropoff_datetime passenger_count pickup_latitude pickup_longitude "
    "dropoff_latitude dropoff_longitude store_and_fwd_flag trip_duration"
).split()


def _r(*names: str) -> str:
    return ", ".join(r6_as(n, n) for n in names)


def _dist_names(prefix: str) -> list[str]:
    return [f"{prefix}{s}" for s in ("distance_haversine", "distance_dummy_manhattan", "direction", "center_latitude", "center_longitude")]


MILES = haversine(*COORDINATES, radius="6371.009") + " / 1.609344::double"
FLAG = "case when store_and_fwd_flag = 'Y' then 1 else 0 end"
PLAIN_STEPS = "total_distance, total_travel_time, number_of_steps"


def _small(expression: str) -> str:
    return f"cast({expression} as smallint)"


def _all_features() -> str:
    single_joins, single = _single_joins()
    multi_joins, multi = _multi_joins()
    small = {
        "vendor_id": "base.vendor_id",
        "passenger_count": "base.passenger_count",
        "is_store_and_fwd_flag": FLAG,
        **{c: f"base.{c}" for c in ("pickup_month", "pickup_day", "pickup_hour", "pickup_weekofyear", "pickup_weekday", "is_weekend")},
    }
    columns = [
        "base.id as id",
        "base.split as split",
        "base.pickup_datetime as pickup_datetime",
        "base.dropoff_datetime as dropoff_datetime",
        "base.trip_duration as trip_duration",
        *(f"{_small(e)} as {n}" for n, e in small.items()),
        *(r6_as(f"base.{c}", c) for c in COORDINATES),
        *(r6_as(f"base.{e}_{p}", f"{e}_{p}") for e in ("pickup", "dropoff") for p in ("pca0", "pca1")),
        *(r6_as(f"base.{c}", c) for c in ("pickup_time_delta", "pickup_week_delta", "pickup_week_delta_sin", "pickup_hour_sin")),
        "base.pickup_week_hour as pickup_week_hour",
        *(r6_as(f"base.{c}", c) for p in ("lat_long_", "pca_") for c in _dist_names(p)),
        *(r6_as(f"base.{c}_bin", f"{c}_bin") for c in BIN_SOURCES),
        "base.pickup_cell as pickup_cell",
        "base.dropoff_cell as dropoff_cell",
        *single,
        *multi,
        "case when base.passenger_count = 1 then 1 else 0 end as is_passenger_alone",
        "case when base.pickup_hour between 0 and 5 then 1 else 0 end as is_midnight",
        "pw.* exclude (id)",
        "r.total_distance + 0.0::double as total_distance",
        "r.total_travel_time as total_travel_time",
        "r.number_of_steps as number_of_steps",
        r6_as("r.total_distance / r.number_of_steps", "per_step_distance"),
        r6_as("r.total_travel_time / r.number_of_steps::double", "per_travel_time"),
        r6_as("a.heavy", "starting_street_heavy"),
        r6_as("b.heavy", "end_street_heavy"),
        r6_as("daily.snow_fall", "snow_fall"),
        f"h.is_holyday as is_holyday",
        f"h.is_day_before_holyday as is_day_before_holyday",
        r6_as(haversine(*(f"base.{c}" for c in COORDINATES), radius="6371.009") + " / 1.609344::double", "osmnx_distance"),
    ]
    windows = ", ".join([*_pickup_windows((10, 15)), *_dropoff_windows((10, 15))])
    return (
        f"select {', '.join(columns)} from base{single_joins}{multi_joins} "
        f"join (select id, {windows} from base) pw on pw.id = base.id "
        f"join (select id, {HOLIDAY} as is_holyday, {HOLIDAY_EVE} as is_day_before_holyday from "
        f"(select id, pickup_month as m, pickup_day as d, pickup_weekday as w from base)) h on h.id = base.id "
        "left join routes r on r.id = base.id "
        "left join street_means a on a.kind = 'start' and a.street = r.starting_street "
        "left join street_means b on b.kind = 'end' and b.street = r.end_street "
        "left join daily on daily.day = cast(base.pickup_datetime as date)"
    )


def _bodies() -> dict[str, str]:
    single_joins, single = _single_joins()
    multi_joins, multi = _multi_joins()
    loo = []
    for key in ("pickup_hour", "pickup_cell"):
        for t in TARGETS:
            total, n = f"sum({t}) over (partition by {key})", f"count({t}) over (partition by {key})"
            own = f"{t} is not null and split = 'train'"
            loo.append(
                r6_as(f"case when {own} then ({total} - {t}) / nullif({n} - 1, 0) else {total} / nullif({n}, 0) end", f"{t}_gby_{key}")
            )
    step_words = ("left", "right", "straight", "none")
    step_count = {w: f"cast(length(regexp_extract_all(step_direction, '{w}')) as integer)" for w in step_words}
    heavy_values = ", ".join(
        f"({r6(f(f'{e}_latitude', f'{e}_longitude', 'lat', 'lng'))}) as {e}_{kind}"
        for e in ("pickup", "dropoff")
        for kind, f in (("haversine", haversine), ("bearing", bearing))
    )
    return {
        "trips_base": f"select id, split, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, {_r(*COORDINATES)}, "
        f"trip_duration, {FLAG} as is_store_and_fwd_flag from trips",
        "numeric_id": "select id, cast(substr(id, 3) as bigint) as id_number from trips",
        "narrow_types": f"select id, {_small(FLAG)} as is_store_and_fwd_flag, "
        + ", ".join(
            f"{_small(c)} as {c}"
            for c in "passenger_count vendor_id pickup_month pickup_day pickup_hour pickup_weekofyear pickup_weekday is_weekend".split()
        )
        + ", trip_duration from base",
        "outlier_filter": f"select id, split, trip_duration, {_r('lat_long_distance_haversine')} from base "
        "where lat_long_distance_haversine < 10 and trip_duration < 3000",
        "zero_distance_trips": f"select id, {_r(*COORDINATES)}, trip_duration from train where lat_long_distance_haversine = 0",
        "far_trips": f"select id, {_r(*COORDINATES, 'lat_long_distance_haversine')}, trip_duration from train "
        "where lat_long_distance_haversine > 15",
        "target_transforms": f"select id, {r6_as('ln(trip_duration)', 'log_target')}, "
        f"{r6_as('ln(trip_duration + 1.0::double)', 'log1p_target')}, {r6_as('trip_duration::double', 'back')} from train",
        "systematic_sample": "select id, split, trip_duration from trips where cast(substr(id, 3) as bigint) % 10 = 0",
        "holdout_split": f"select id, case when {FOLD.format(n=10000)} < 7500 then 'fit' else 'holdout' end as part from train",
        "fold_assign": "select id, fold from train",
        "zero_fill": "select id, coalesce(passenger_count, 0) as passenger_count, coalesce(trip_duration, 0) as trip_duration, "
        "store_and_fwd_flag from trips",
        "speed_columns": f"select id, {_r('speed')}, {r6_as('lat_long_distance_haversine / nullif(trip_duration, 0)', 'average_speed')}, "
        f"{r6_as('lat_long_avg_speed_h', 'avg_speed_h')}, {r6_as('lat_long_avg_speed_m', 'avg_speed_m')} from train",
        "speed_filtered": f"select id, {_r('speed')} from train where speed < 100",
        "drop_sparse": f"select id, split, vendor_id, pickup_datetime, passenger_count, {_r(*COORDINATES)}, store_and_fwd_flag from trips",
        "first_trips": "select id, pickup_datetime, vendor_id from trips order by pickup_datetime, id limit 20",
        "geo_distance": f"select id, {_r(*_dist_names('lat_long_'))} from base",
        "location_bins": f"select id, {_r(*(f'{c}_bin' for c in BIN_SOURCES))} from base",
        "great_circle_miles": f"select id, {r6_as(MILES, 'osmnx_distance')} from trips",
        "pca_coords": "select id, "
        + _r(*(f"{e}_pca{i}" for e in ("pickup", "dropoff") for i in (0, 1)), *_dist_names("pca_"))
        + " from base",
        "bounding_box": f"select {r6_as('min(x)', 'min_latitude')}, {r6_as('max(x)', 'max_latitude')}, "
        f"{r6_as('min(y)', 'min_longitude')}, {r6_as('max(y)', 'max_longitude')} from points",
        "city_window": f"select id, {_r('pickup_latitude', 'pickup_longitude')} from trips "
        "where pickup_latitude between 40.63::double and 40.75::double and pickup_longitude between -74.03::double and -73.9::double",
        "calendar_parts": "select id, pickup_month, pickup_day, pickup_hour, pickup_weekofyear, pickup_weekday, pickup_week_hour, is_weekend, "
        + _r("pickup_time_delta", "pickup_week_delta", "pickup_week_delta_sin", "pickup_hour_sin")
        + " from base",
        "round_hour": "select id, make_timestamp(cast(round_even(epoch_us(pickup_datetime) / 3600000000.0::double, 0) as bigint) * 3600000000) "
        "as pickup_datetime_group from trips",
        "binary_flags": "select id, case when passenger_count = 1 then 1 else 0 end as is_passenger_alone, "
        "case when pickup_hour between 0 and 5 then 1 else 0 end as is_midnight from base",
        "holiday_flags": f"select id, {HOLIDAY} as is_holyday, {HOLIDAY_EVE} as is_day_before_holyday from "
        "(select id, pickup_month as m, pickup_day as d, pickup_weekday as w from base)",
        "bin_speed": f"select {', '.join(BIN_KEYS)}, count(*) as cnt, {r6_as('avg(lat_long_avg_speed_h)', 'avg_speed_h')}, "
        f"{r6_as('avg(lat_long_avg_speed_m)', 'avg_speed_m')} from train group by {', '.join(BIN_KEYS)} having count(*) > 100",
        "group_mean_single": f"select base.id as id, {', '.join(single)} from base{single_joins}",
        "group_stats_multi": f"select base.id as id, {', '.join(multi)} from base{multi_joins}",
        "group_mean_leave_one_out": f"select id, {', '.join(loo)} from base",
        "vendor_profile": _levels("train", [("vendor_id", "pickup_weekday"), ("vendor_id", "pickup_hour")], {"trip_duration": "trip_duration"}),
        "vendor_weekday_lookup": f"select base.id as id, {r6_as('m', 'groupby_vi_pweekdat_trip_duration')} from base left join "
        "(select vendor_id, pickup_weekday, avg(trip_duration) as m from train group by all) g using (vendor_id, pickup_weekday)",
        "mean_by_calendar": _levels(
            "train", [("pickup_month",), ("pickup_day",), ("pickup_hour",), ("pickup_weekday",)], {"trip_duration": "trip_duration"}
        ),
        "speed_by_time": _levels(
            "train",
            [("pickup_hour",), ("pickup_weekday",), ("pickup_week_hour",)],
            {
                "speed": "speed",
                "distance": "lat_long_distance_haversine",
                "duration": "trip_duration",
                "avg_speed_h": "lat_long_avg_speed_h",
            },
        ),
        "passenger_profile": f"select passenger_count, count(*) as cnt, {r6_as('avg(trip_duration)', 'trip_duration')}, "
        f"{r6_as('avg(lat_long_distance_haversine)', 'distance')} from train where passenger_count is not null group by passenger_count",
        "cluster_speed": "select cell, "
        + _r(*(f"{c}_speed" for c in CELLS))
        + " from "
        + " full join ".join(
            f"(select {c} as cell, avg(lat_long_distance_haversine / nullif(trip_duration, 0)) as {c}_speed from train group by {c})"
            for c in CELLS
        )
        + " using (cell)",
        "street_encoding": f"select trips.id as id, {r6_as('a.heavy', 'starting_street_heavy')}, {r6_as('b.heavy', 'end_street_heavy')} from trips "
        "left join routes using (id) left join street_means a on a.kind = 'start' and a.street = starting_street "
        "left join street_means b on b.kind = 'end' and b.street = end_street",
        "route_features": f"select id, split, {PLAIN_STEPS}, {r6_as('total_distance / number_of_steps', 'per_step_distance')}, "
        f"{r6_as('total_travel_time / number_of_steps::double', 'per_travel_time')}, "
        + ", ".join(f"{e} as steps_{w}_count" for w, e in step_count.items())
        + " from trips left join routes using (id)",
        "notnull_steps": "select id, split, step_direction from trips join routes using (id) where step_direction is not null",
        "second_routes": f"select trips.id as id, {PLAIN_STEPS}, total_distance as second_total_distance, "
        "total_travel_time as second_total_travel_time, number_of_steps as second_number_of_steps from trips left join routes using (id)",
        "weather_join": f"select id, pickup_datetime, {', '.join(r6_as(f'daily.{c}', c) for c in TRACED)} from trips "
        "left join daily on daily.day = cast(pickup_datetime as date)",
        "step_count_distribution": _levels(
            "(select " + ", ".join(f"{e} as steps_{w}_count" for w, e in step_count.items()) + " from routes)",
            [(f"steps_{w}_count",) for w in step_words],
            {},
        ),
        "weather_counts": f"select {_r('snow_fall')}, count(*) as cnt from daily group by daily.snow_fall",
        "distinct_snow": "select distinct snow_fall from weather",
        "pickup_window_traffic": f"select id, {', '.join(_pickup_windows(WINDOWS))} from base",
        "dropoff_window_traffic": f"select id, {', '.join(_dropoff_windows(WINDOWS))} from base",
        "dropoff_window_before": f"select id, {', '.join(_dropoff_windows(WINDOWS, 'before'))} from base",
        "rolling_hour_count": f"select event_id, {_window('events', None, 'ts', 60, 'trailing', 'count_60min')} from events",
        "rolling_trip_count": f"select id, {_window('trips', None, 'pickup_datetime', 60, 'trailing', 'count_60min')} from trips",
        "cluster_traffic": "select cluster, traffic from cell_traffic",
        "heavy_clusters": "select cluster, traffic from heavy",
        "heavy_cell_distances": f"select id, cluster, {heavy_values} from trips, "
        "(select cluster, 40.63::double + (cluster // 100 + 0.5::double) * 0.05::double as lat, "
        "-74.03::double + (cluster % 100 + 0.5::double) * 0.05::double as lng from heavy)",
        "missing_profile": _missing(TRIP_COLUMNS),
        "drift_check": _drift(DRIFT_COLUMNS),
        "drift_worst": f"select * from ({_drift(DRIFT_COLUMNS)}) order by train_test_mean_diff desc nulls last, feature limit 5",
        "describe_duration": _describe("trip_duration") + " union all " + _describe("lat_long_distance_haversine"),
        "mode_impute": "select id, "
        + ", ".join(
            f"coalesce({c}, (select {c} from trips where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as {c}"
            for c in ("passenger_count", "store_and_fwd_flag")
        )
        + " from trips",
        "constant_impute": "select id, coalesce(passenger_count, 0) as passenger_count, "
        "coalesce(store_and_fwd_flag, 'N') as store_and_fwd_flag from trips",
        "lowcard_impute": "select id, cast(coalesce(vendor_id, -1) as tinyint) as vendor_id, "
        f"cast(coalesce(passenger_count, -1) as tinyint) as passenger_count, trip_duration, {_r('pickup_latitude')} from trips",
        "counts_by_category": _levels(
            "(select *, cast(pickup_datetime as date) as pickup_date from base)",
            [
                *(("split", n) for n in "pickup_date vendor_id passenger_count store_and_fwd_flag pickup_month pickup_day pickup_hour pickup_weekday".split()),
                ("split", "pickup_weekday", "pickup_hour"),
            ],
            {},
        ),
        "histogram_duration": _histogram("trip_duration", "300"),
        "histogram_log_duration": _histogram("log_trip_duration", "0.25"),
        "histogram_distance": _histogram("lat_long_distance_haversine", "0.5"),
        "histogram_speed": _histogram("speed", "5", "speed < 100"),
        "threshold_counts": "select count(*) filter (trip_duration <= 1) as up_to_1s, count(*) filter (trip_duration <= 10) as up_to_10s, "
        "count(*) filter (trip_duration > 360000) as over_100h from train",
        "duration_range": "select max(trip_duration) // 3600 as max_hours, min(trip_duration) as min_seconds from train",
        "error_metrics": "select fold, "
        + _r("mse", "rmse", "rmsle")
        + " from (with scored as (select fold, ln(trip_duration) as label, avg(ln(trip_duration)) over (partition by pickup_hour) as p from train), "
        "folds as (select cast(fold as varchar) as fold, avg(pow(label - p, 2)) as mse, sqrt(avg(pow(label - p, 2))) as rmse, "
        "sqrt(avg(pow(ln(1 + exp(greatest(p, 0))) - ln(1 + exp(label)), 2))) as rmsle from scored group by fold) "
        "select * from folds union all select 'mean', avg(mse), avg(rmse), avg(rmsle) from folds)",
        "all_features": _all_features(),
        "nearest_centres": "select id, "
        + ", ".join(
            f"cast(list_position({e}_d, list_min({e}_d)) - 1 as integer) as {e}_centre"
            for e in ("pickup", "dropoff")
        )
        + f" from (select id, {_given_distances()}"
        + " from trips)",
        "every_nth_row": "select id, split, trip_duration from (select *, row_number() over (order by pickup_datetime, id) as n from trips) where (n - 1) % 10 = 0",
        "shuffled_rows": "select id, trip_duration from trips",
        "csv_trips": f"select id, split, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, {_r(*COORDINATES)}, store_and_fwd_flag, trip_duration from trips",
        "csv_routes": "select id, starting_street, end_street, round(total_distance, 6) as total_distance, cast(total_travel_time as double) as total_travel_time, "
        "number_of_steps, "
        + ", ".join(f"null as {c}" for c in ("street_for_each_step", "distance_per_step", "travel_time_per_step", "step_maneuvers", "step_location_list"))
        + ", starting_street as second_starting_street, round(total_distance, 6) as second_total_distance, number_of_steps as second_number_of_steps from routes",
        "csv_weather": "select *, '0' as average_temperature from weather",
        "csv_accidents": "select cast(l_linenumber as bigint) as bin, cast(l_linenumber as double) as bin_from, count(*) as cnt from lineitem where l_linenumber < 6 group by l_linenumber",
        "csv_bad_rows": "select kind, count(*) as cnt from (select case when k % 70 = 2 and k % 50 = 1 then 'pickup_datetime+passenger_count' "
        "when k % 70 = 2 then 'pickup_datetime' when k % 50 = 1 then 'passenger_count' when k % 90 = 3 then 'good, without a number' else 'good' end as kind "
        "from (select cast(substr(id, 3) as bigint) as k from train)) group by kind",
        "stored_stages": "select id, split, case when split = 'test' then vendor_id + 10 else vendor_id end as vendor_id from trips "
        "union all select 'first ' || id, split, vendor_id from train",
        "written_predictions": "select id, vendor_id * 1.5::double as trip_duration, 'submission' as sink from trips where split = 'test' "
        "union all select id, vendor_id * 2.5::double, 'out of fold train' from train union all select id, vendor_id * 3.5::double, 'out of fold test' from trips where split = 'test' "
        "union all select id, vendor_id * 4.5::double, 'folds' from trips where split = 'test'",
        "density_duration": "select * from (with binned as (select vendor_id, cast(floor((ln(trip_duration) - 4) / 0.05::double) as integer) as bin, count(*) as n from train group by 1, 2), "
        "totals as (select vendor_id, sum(n) as total from binned group by vendor_id), "
        "spread as (select b.vendor_id, bin + away as place, n * exp(-pow(away * 0.25::double, 2) / 2) / (0.2::double * sqrt(2 * pi())) as part "
        "from binned b, unnest(range(-20, 21)) as t(away) where bin between 0 and 99 and bin + away between 0 and 99) "
        f"select vendor_id, {r6_as('4 + (place + 0.5::double) * 0.05::double', 'point')}, {r6_as('sum(part) / any_value(total)', 'density')} from spread join totals using (vendor_id) group by vendor_id, place)",
        "extended_distances": f"select id, {_r('lat_long_distance_haversine')}, case when cast(substr(id, 3) as bigint) % 100 = 7 then 2 else 1 end as build from base",
        "kmeans_checks": "select cast(2 * count(*) as bigint) as ends, cast(2 * count(*) as bigint) as with_nearest, "
        "cast(25 as bigint) as clusters, true as near_full_fit from trips",
        "heavy_centre_distances": "select * from (with located as (select *, "
        + ", ".join(f"cast(list_position({e}_d, list_min({e}_d)) - 1 as integer) as {e}_centre" for e in ("pickup", "dropoff"))
        + f" from (select *, {_given_distances()} from trips)), "
        "ends as (select pickup_centre as c from located union all select dropoff_centre from located), "
        "centre_traffic as (select c as centre, count(*) as n from ends group by c), "
        "busy as (select centre from centre_traffic where n > (select quantile_cont(n, 0.8) from centre_traffic)), "
        "points as (select unnest(range(25)) as centre, unnest("
        + str([c[0] for c in GIVEN_CENTRES]) + "::double[]) as lat, unnest(" + str([c[1] for c in GIVEN_CENTRES]) + "::double[]) as lng) "
        f"select id, cast(centre as integer) as centre, {heavy_values} from trips, busy join points using (centre))",
        "learner_checks": "select learner, (select count(*) from train) as trained, (select count(*) from train) as predicted, "
        "cast(3 as bigint) as folds, true as error_bounded, (select count(*) from trips where split = 'test') as tested, true as in_range "
        "from (select unnest(['forest', 'boosted', 'randomised']) as learner)",
        "cached_traffic": f"select id, split, {', '.join([*_pickup_windows((10, 15)), *_dropoff_windows((10, 15))])} from base",
        "oof_hour_mean": f"select * from ({_hour_means(5, '20')} select id, split, fold, {r6_as('exp(p)', 'trip_duration')} from ("
        "select id, 'train' as split, fold, pickup_hour, label from labelled) l left join by_hour using (fold, pickup_hour) "
        f"union all select id, 'test', null, {r6('exp(avg(p))')} from test cross join (select distinct fold from labelled) f "
        "left join by_hour using (fold, pickup_hour) group by id)",
        "oof_hour_mean_by_fold": f"select * from ({_hour_means(5, '20')} select id, fold, {r6_as('exp(p)', 'trip_duration')} from test "
        "cross join (select distinct fold from labelled) f left join by_hour using (fold, pickup_hour))",
        "sweep_hour_mean": "select * from (with scores as (" + " union all ".join(
            f"select '{w}' as value, {k} as place, avg(e) as error from ({_hour_means(3, w)} "
            "select fold, sqrt(avg(pow(label - p, 2))) as e from labelled join by_hour using (fold, pickup_hour) group by fold)"
            for k, w in enumerate(("0.0", "50.0", "5000.0"))
        ) + f") select 'weight' as parameter, value, {r6_as('error', 'error')}, place = (select arg_min(place, error) from scores) as best from scores)",
    }


def _given_distances() -> str:
    """Squared distances of both ends of a trip to the given centres, as lists."""
    return ", ".join(
        "[" + ", ".join(
            f"({e}_latitude - {lat!r}::double) * ({e}_latitude - {lat!r}::double) + "
            f"({e}_longitude - ({lng!r}::double)) * ({e}_longitude - ({lng!r}::double))"
            for lat, lng in GIVEN_CENTRES
        ) + f"] as {e}_d"
        for e in ("pickup", "dropoff")
    )


def all_sql() -> dict[str, str]:
    prefix = "with " + ", ".join(f"{name} as ({body})" for name, body in STEPS)
    return {name: f"{prefix} {body}" for name, body in _bodies().items()}
