"""SQL that says independently what every query must return, for an engine with the parquet tables as views."""

from __future__ import annotations

from itertools import combinations

from millrace.sources.observations import OBS_BIG_CTES, OBS_CTES

ZERO = "cast(0 as double)"


def r(expr: str) -> str:
    """Six decimals, without negative zero; the nudge keeps exact halves off the rounding edge."""
    return f"(round({expr} + cast(1e-9 as double), 6) + {ZERO})"


def hash52(key: str, seed: int) -> str:
    return f"cast(concat('0x', substr(md5(concat({key}, ':{seed}')), 1, 13)) as bigint)"


TEST_LIMIT = int(0.2 * (1 << 52))

# numeric columns of the labelled table, without the key
NUMERIC = ["distance_km", "duration_normal_min", "duration_traffic_min", "delay_min", "temperature", "wind", "rain",
           "hour", "day_of_week", "is_weekend", "is_rush_hour", "is_bad_weather", "speed_normal", "hour_sin", "hour_cos"]
FILLED = ["distance_km", "duration_normal_min", "duration_traffic_min", "temperature", "wind", "rain",
          "hour", "day_of_week", "hour_sin", "hour_cos"]
MODEL = ["distance_km", "duration_normal_min", "day_of_week", "is_weekend", "temperature", "wind", "is_rush_hour",
         "is_bad_weather", "speed_normal", "hour_sin", "hour_cos"]


def chain(big: bool = False) -> str:
    """CTEs raw -> feat -> imp -> ded -> wins -> lab."""
    source, ts = (OBS_BIG_CTES, "timestamp") if big else (OBS_CTES, "ts_text")
    table = "obs_big" if big else "obs"
    fills = ", ".join(f"coalesce(cast({c} as double), (select {c} from med)) as {c}" for c in FILLED)
    meds = ", ".join(f"quantile_cont(cast({c} as double), 0.5) as {c}" for c in FILLED)
    return f"""{source.strip()},
timed as (select *, try_cast({ts} as timestamp) as t from {table}),
feat as materialized (
  select obs_id, t, origin, destination, distance_km, duration_normal_min, duration_traffic_min, delay_min,
    temperature, wind, rain,
    cast(hour(t) as integer) as hour, cast(isodow(t) - 1 as integer) as day_of_week,
    case when isodow(t) in (6, 7) then 1 else 0 end as is_weekend,
    concat(coalesce(origin, 'unknown'), ' → ', coalesce(destination, 'unknown')) as route,
    case when hour(t) in (7, 8, 9, 16, 17) then 1 else 0 end as is_rush_hour,
    case when rain > 0 or wind > 8 then 1 else 0 end as is_bad_weather,
    distance_km / (duration_normal_min + cast(1e-5 as double)) as speed_normal,
    sin(2 * pi() * hour(t) / 24) as hour_sin, cos(2 * pi() * hour(t) / 24) as hour_cos
  from timed),
med as materialized (select {meds} from feat),
imp as (
  select obs_id, t, origin, destination, delay_min, is_weekend, route, is_rush_hour, is_bad_weather, {fills},
    coalesce(speed_normal, (select quantile_cont(speed_normal, 0.5) from feat)) as speed_normal
  from feat),
ded as materialized (select min(obs_id) as obs_id, imp.* exclude (obs_id) from imp group by all),
wb as materialized (
  select quantile_cont(delay_min, 0.01) as dl, quantile_cont(delay_min, 0.99) as dh,
         quantile_cont(speed_normal, 0.01) as sl, quantile_cont(speed_normal, 0.99) as sh from ded),
wins as materialized (
  select ded.* exclude (delay_min, speed_normal),
    least(greatest(delay_min, dl), dh) as delay_min, least(greatest(speed_normal, sl), sh) as speed_normal
  from ded, wb),
thr as materialized (
  select q1, q3, q99, m, s, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from (
    select quantile_cont(delay_min, 0.25) as q1, quantile_cont(delay_min, 0.75) as q3,
           quantile_cont(delay_min, 0.99) as q99, avg(delay_min) as m, stddev_pop(delay_min) as s from wins)),
marked as (
  select wins.*, delay_min > hi or delay_min >= q99 as is_high, delay_min < lo or delay_min > hi as off_fence,
    delay_min >= q99 as is_top, s > 0 and abs((delay_min - m) / s) > 3 as beyond_z,
    delay_min < -3 or speed_normal <= 0 or duration_normal_min = 0 as is_bad
  from wins, thr),
lab as materialized (
  select *, case when is_bad then 'invalid'
                 when is_high and (is_rush_hour = 1 or is_bad_weather = 1) then 'valid'
                 when is_high or off_fence or is_top then 'suspicious' else 'normal' end as outlier_type
  from marked)"""


def q(body: str, big: bool = False, more: str = "") -> str:
    extra = f",\n{more.strip()}" if more else ""
    return f"with {chain(big)}{extra}\n{body.strip()}"


PREDS = """
preds as materialized (
  select obs_id, outlier_type, is_rush_hour, delay_min as y, avg(delay_min) over (partition by hour) as p from lab)"""

METRICS = f"""count(*) as n, {r('avg(abs(y - p))')} as mae, {r('sqrt(avg((y - p) * (y - p)))')} as rmse,
  {r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} as r2,
  {r('log10(avg(abs(y - p) / greatest(abs(y), cast(2.220446049250313e-16 as double))))')} as mape_log10"""


def _per_column(columns, template: str) -> str:
    return "\nunion all\n".join(template.format(c=c) for c in columns)


def _box(series: str, name: str) -> str:
    return f"""select '{name}' as grouping, v.series, {r('q1')} as q1, {r('median')} as median, {r('q3')} as q3,
  {r('min(x) filter (x between lo and hi)')} as whisker_low, {r('max(x) filter (x between lo and hi)')} as whisker_high,
  count(*) filter (x < lo or x > hi) as outliers, count(*) as n
from (select {series} as series, delay_min as x from lab) v join (
  select series, q1, median, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from (
    select {series} as series, quantile_cont(delay_min, 0.25) as q1, quantile_cont(delay_min, 0.5) as median,
           quantile_cont(delay_min, 0.75) as q3 from lab group by 1)) b on v.series = b.series
group by v.series, q1, median, q3"""


def _hist(c: str, bins: int = 30) -> str:
    return f"""select '{c}' as column_name, bin, {r('lo + bin * w')} as low, {r('lo + (bin + 1) * w')} as high, count(*) as n from (
  select lo, (hi - lo) / {bins} as w,
    case when hi > lo then cast(least(floor(({c} - lo) / ((hi - lo) / {bins})), {bins - 1}) as bigint) else 0 end as bin
  from lab, (select cast(min({c}) as double) as lo, cast(max({c}) as double) as hi from lab))
group by bin, lo, w"""


def _improve(a: str, b: str) -> str:
    return f"100 * ({a} - {b}) / {b}"


def oracle_sql() -> dict[str, str]:
    raw_cols = "obs_id, ts_text, origin, destination, distance_km, duration_normal_min, duration_traffic_min, delay_min, temperature, wind, rain"
    train = f"({hash52('obs_id', 42)} >= {TEST_LIMIT})"
    pairs = list(combinations(sorted(NUMERIC), 2))
    corr = "\nunion all\n".join(f"select '{a}' as feature_a, '{b}' as feature_b, corr({a}, {b}) as c from lab" for a, b in pairs)
    corr_out = "\nunion all\n".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, corr({a}, {b}) as c from lab where outlier_type <> 'normal'" for a, b in pairs)
    fscore = "\nunion all\n".join(
        f"select '{c}' as feature, corr({c}, delay_min) as r, count(*) as n from lab where {train}" for c in MODEL)
    fscore = f"""fs as materialized (select feature, coalesce(r * r / (1 - r * r) * (n - 2), 0) as f_score from ({fscore}))"""
    continuous = ["distance_km", "duration_normal_min", "duration_traffic_min", "delay_min", "temperature", "wind", "hour",
                  "speed_normal", "hour_sin", "hour_cos"]
    split = f"""cut as (
  select target_class, max(h) as h from (
    select target_class, h, row_number() over (partition by target_class order by h) as rn,
           count(*) over (partition by target_class) as n from hashed) where rn = ceil(0.2 * n) group by 1)"""
    hashed = f"""hashed as (select obs_id, case when outlier_type = 'normal' then 0 else 1 end as target_class,
    {hash52('obs_id', 42)} as h from lab where outlier_type <> 'invalid')"""
    knn_x = ["distance_km", "duration_normal_min", "wind"]
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in knn_x)

    out: dict[str, str] = {}
    out["scan_csv"] = f"with {OBS_CTES} select {raw_cols}, cast(distance_km as varchar) is not null as has_text from obs"
    out["scope_sample"] = f"""with {OBS_CTES} select obs_id, delay_min from obs
order by {hash52('obs_id', 42)}, obs_id limit 5000"""
    out["plot_sample"] = f"""{q(f'''select obs_id, {r('delay_min')} as delay_min, {r('speed_normal')} as speed_normal, outlier_type from lab
order by {hash52('obs_id', 42)}, obs_id limit 12000''')}"""
    out["sink_roundtrip"] = q(f"select route, outlier_type, count(*) as n, {r('avg(delay_min)')} as mean_target from lab group by 1, 2")
    out["feature_engineering"] = q(f"""
select obs_id, t is not null as has_time, hour, day_of_week, is_weekend, route, is_rush_hour, is_bad_weather,
  {r('speed_normal')} as speed_normal, {r('hour_sin')} as hour_sin, {r('hour_cos')} as hour_cos from feat""")
    out["route_onehot"] = q("""select concat('route_', route) as column_name, count(*) as ones from lab
where route <> (select min(route) from lab) group by 1""")
    out["route_onehot_vector"] = q("""select route, count(*) as n, cast(case when route = (select min(route) from lab) then 0 else count(*) end as double) as ones,
  cast((select count(distinct route) - 1 from lab) as integer) as width from lab group by 1""", big=True)
    kinds = {c: ("int" if c in ("hour", "day_of_week", "is_weekend", "is_rush_hour", "is_bad_weather") else "double") for c in NUMERIC}
    kinds |= {"origin": "string", "destination": "string", "route": "string", "ts_text": "timestamp_ntz", "obs_id": "bigint"}
    groups = {"numeric": ["distance_km", "duration_normal_min", "duration_traffic_min", "delay_min", "temperature", "wind"],
              "categorical": ["origin", "destination"], "temporal": ["ts_text"], "binary": ["is_weekend", "rain"], "discrete": ["hour", "day_of_week"]}
    grouped = {c: g for g, cs in groups.items() for c in cs}
    no_feature = {"obs_id", "delay_min"}
    contextual = {"hour_sin", "hour_cos", "day_of_week", "is_weekend", "is_rush_hour", "is_bad_weather", "temperature", "wind", "rain"}
    out["type_audit"] = q("\nunion all\n".join(
        f"""select '{grouped.get(c, 'other')}' as "group", '{c}' as "column", true as present, '{t}' as dtype, {t in ('int', 'double', 'bigint')} as numeric,
  {t in ('int', 'double', 'bigint') and c not in no_feature} as feature, {c in contextual} as contextual, '{c}' as safe_name,
  count({'t' if c == 'ts_text' else c}) as "values" from feat""" for c, t in kinds.items()))
    out["model_roundtrip"] = q(f"select count(*) as n, cast(0 as double) as largest_difference from lab where not {train}")
    out["readiness_cleanup"] = q("select distinct " + ", ".join(
        (f"{r(c)} as {c}" if c in ("speed_normal", "hour_sin", "hour_cos", "delay_min", "temperature") else c)
        for c in ["distance_km", "duration_normal_min", "delay_min", "day_of_week", "is_weekend", "temperature", "wind",
                  "is_rush_hour", "is_bad_weather", "speed_normal", "hour_sin", "hour_cos"]) + " from lab")
    out["target_bins"] = f"""with {OBS_CTES} select obs_id, delay_min as label,
  case when delay_min < 3 then 'Low' when delay_min < 7 then 'Medium' when delay_min >= 7 then 'High' end as traffic_level,
  case when delay_min < 3 then 0 when delay_min < 7 then 1 when delay_min >= 7 then 2 end as level_rank from obs"""
    out["class_and_weights"] = q("""select obs_id, outlier_type, case when outlier_type = 'normal' then 0 else 1 end as target_class,
  cast(case outlier_type when 'suspicious' then 0.65 when 'invalid' then 0.35 else 1.0 end as double) as sample_weight,
  case is_weekend when 0 then 'Weekday' when 1 then 'Weekend' end as day_type from lab""")
    out["valid_rows"] = q("select obs_id, outlier_type, outlier_type in ('valid', 'suspicious') as is_extreme from lab where outlier_type <> 'invalid'")
    out["delay_by_label"] = q(f"""select outlier_type <> 'normal' as is_outlier, count(*) as n, {r('avg(delay_min)')} as mean_target,
  {r('quantile_cont(delay_min, 0.5)')} as median_target from lab group by 1""")
    out["robust_train_filter"] = q(f"""
select count(*) as train_before, count(*) filter (a and b and c) as train_after, count(*) filter (not (a and b and c)) as removed_total,
  count(*) filter (not a) as removed_iqr, count(*) filter (not b) as removed_z_score, count(*) filter (not c) as removed_context
from (select delay_min between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as a, s = 0 or abs((delay_min - m) / s) <= 3 as b,
        outlier_type not in ('invalid', 'suspicious') as c
      from lab, (select quantile_cont(delay_min, 0.25) as q1, quantile_cont(delay_min, 0.75) as q3, avg(delay_min) as m,
                        stddev_pop(delay_min) as s from lab where {train}) where {train})""")
    out["median_impute"] = q(f"""select obs_id, temperature, wind, rain, hour, day_of_week, {r('hour_sin')} as hour_sin,
  {r('hour_cos')} as hour_cos from imp""")
    others = raw_cols.removeprefix("obs_id, ")
    out["dedup"] = f"with {OBS_CTES} select min(obs_id) as obs_id, {others} from obs group by {others}"
    guarded = ["delay_min", "speed_normal", "rain", "day_of_week"]
    out["iqr_counts"] = q(_per_column(guarded, """select '{c}' as column_name,
  case when d <= 10 or q3 - q1 <= 0 then 0 else outside end as guarded_count, outside as plain_count from (
  select count(distinct {c}) as d, any_value(q1) as q1, any_value(q3) as q3,
    count(*) filter ({c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as outside
  from ded, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from ded))"""))
    out["winsorize"] = q(f"select obs_id, {r('delay_min')} as delay_min, {r('speed_normal')} as speed_normal from wins")
    out["zscore_top1"] = q("select obs_id, beyond_z, is_top, off_fence from lab")
    out["outlier_labels"] = q(f"select obs_id, {r('delay_min')} as delay_min, outlier_type from lab")
    out["outlier_labels_big"] = q(f"select outlier_type, count(*) as n, {r('avg(delay_min)')} as mean_target from lab group by 1", big=True)
    out["outlier_labels_inferred"] = q("""select obs_id, case when is_bad then 'invalid'
  when is_high and (is_rush_hour = 1 or is_bad_weather = 1) then 'valid' when is_high then 'suspicious' else 'normal' end as outlier_type from lab""")
    nulls = " + ".join(f"count(*) filter ({c} is null)" for c in
                       ["obs_id", "t", "origin", "destination", "route", *NUMERIC])
    out["clean_summary"] = q(f"""
select 'rows_before' as measure, '' as column_name, cast(count(*) as double) as value from feat
union all select 'null_before', '', cast({nulls} as double) from feat
union all select 'rows_after_impute_dedup', '', cast(count(*) as double) from ded
union all select 'null_after', '', cast({nulls} as double) from ded
union all select 'median_imputed', c, {r('v')} from (unpivot (select temperature, wind, rain, hour, day_of_week, hour_sin, hour_cos from med)
    on temperature, wind, rain, hour, day_of_week, hour_sin, hour_cos into name c value v)
union all select 'p01', 'delay_min', {r('dl')} from wb union all select 'p99', 'delay_min', {r('dh')} from wb
union all select 'p01', 'speed_normal', {r('sl')} from wb union all select 'p99', 'speed_normal', {r('sh')} from wb
union all select 'values_clipped', 'delay_min', cast(count(*) filter (delay_min < dl or delay_min > dh) as double) from ded, wb
union all select 'values_clipped', 'speed_normal', cast(count(*) filter (speed_normal < sl or speed_normal > sh) as double) from ded, wb
union all {_per_column(['delay_min', 'speed_normal'], '''select 'iqr_outliers', '{c}', cast(count(*) filter ({c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as double)
  from ded, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from ded)''')}""")
    out["completeness"] = f"with {OBS_CTES}\n" + _per_column(raw_cols.split(", "), f"""select '{{c}}' as column_name, count(*) as rows,
  count(*) filter ({{c}} is null) as nulls, {r('100 - 100.0 * count(*) filter ({c} is null) / count(*)').replace('{c}', '{{c}}').format(c='{c}')} as complete_pct from obs""")
    out["completeness_totals"] = q(f"""select count(*) as rows, cast(20 as bigint) as columns, count(*) * 20 as total_cells,
  count(*) * 20 - cast({nulls} as bigint) as complete_cells, cast({nulls} as bigint) as null_cells from feat""")
    out["quality"] = q(f"""select cast({nulls} as bigint) as total_missing, count(*) - (select count(*) from (select distinct * exclude (obs_id) from feat)) as duplicate_rows,
  {r(f'100 - 100.0 * ({nulls}) / (count(*) * 20)')} as quality_score from feat""")
    out["distincts"] = q(_per_column(["origin", "destination", "route", *NUMERIC], """select '{c}' as column_name,
  count(distinct {c}) as distinct_values, count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_with_null,
  count(distinct {c}) <= 2 as is_indicator from feat""").replace("max(case", "cast(max(case").replace("else 0 end) as distinct", "else 0 end) as bigint) as distinct"))
    out["describe"] = q(_per_column(continuous, f"""select '{{c}}' as column_name, count({{c}}) as n, {r('avg({c})')} as mean, {r('stddev_samp({c})')} as std,
  {r('min({c})')} as min, {r('quantile_cont({c}, 0.25)')} as q25, {r('quantile_cont({c}, 0.5)')} as q50, {r('quantile_cont({c}, 0.75)')} as q75,
  {r('max({c})')} as max from lab"""))
    out["class_distribution"] = q(f"""
select 'outlier_type' as target, outlier_type as class, count(*) as n, {r('100.0 * count(*) / (select count(*) from lab)')} as pct from lab group by 2
union all
select 'traffic_level', case when delay_min < 3 then 'Low' when delay_min < 7 then 'Medium' when delay_min >= 7 then 'High' end,
  count(*), {r('100.0 * count(*) / (select count(*) from lab)')} from lab group by 2""")
    out["detection_summary"] = q(f"""select {r('q1')} as q1, {r('q3')} as q3, {r('iqr')} as iqr, {r('lo')} as low_bound, {r('hi')} as high_bound,
  {r('q99')} as q99_threshold, cast(3 as double) as z_threshold, (select count(*) filter (off_fence) from lab) as iqr_count,
  (select count(*) filter (is_top) from lab) as top_count, (select count(*) filter (beyond_z) from lab) as z_count from thr""")
    counts = f"""cnt as (select count(*) as total_rows, count(*) filter (outlier_type <> 'normal') as outlier_rows,
  count(*) filter (outlier_type = 'normal') as normal_rows, count(*) filter (outlier_type = 'valid') as valid,
  count(*) filter (outlier_type = 'suspicious') as suspicious, count(*) filter (outlier_type = 'invalid') as invalid,
  count(*) filter (outlier_type <> 'normal' and is_rush_hour = 1) as rush_outliers,
  count(*) filter (outlier_type <> 'normal' and is_bad_weather = 1) as weather_outliers from lab)"""
    out["outlier_counts"] = q(f"""select *, {r('100.0 * outlier_rows / total_rows')} as outliers_of_dataset_pct,
  {r('100.0 * valid / outlier_rows')} as valid_of_outliers_pct, {r('100.0 * suspicious / outlier_rows')} as suspicious_of_outliers_pct,
  {r('100.0 * invalid / outlier_rows')} as invalid_of_outliers_pct, {r('100.0 * rush_outliers / outlier_rows')} as outliers_in_rush_hour_pct,
  {r('100.0 * weather_outliers / outlier_rows')} as outliers_in_bad_weather_pct from cnt""", more=counts)
    out["outlier_hours"] = q("select hour, count(*) as n from lab where outlier_type <> 'normal' group by 1", big=True)
    out["top_routes"] = q(_per_column([("outliers", "outlier_type <> 'normal'", 10), ("normal", "outlier_type = 'normal'", 10), ("all", "true", 15)],
                                      "select * from (select '{c[0]}' as scope, route, " + r("avg(delay_min)") +
                                      " as mean_target from lab where {c[1]} group by route order by avg(delay_min) desc, route limit {c[2]})"), big=True)
    out["corr_long"] = q(f"select feature_a, feature_b, {r('c')} as corr from ({corr})")
    out["corr_shift"] = q(f"""select feature_a, feature_b, {r('f.c')} as full_corr, {r('o.c')} as outlier_corr, {r('abs(o.c - f.c)')} as abs_delta
from ({corr}) f join ({corr_out}) o using (feature_a, feature_b) where not isnan(o.c) and not isnan(f.c)
order by abs(o.c - f.c) desc, feature_a, feature_b limit 10""")
    out["skew_rank"] = q("select * from (" + _per_column(continuous, f"""select '{{c}}' as column_name, {r('skewness({c})')} as skewness,
  count(*) filter ({{c}} < q1 - 1.5 * (q3 - q1) or {{c}} > q3 + 1.5 * (q3 - q1)) as outlier_count
  from lab, (select quantile_cont({{c}}, 0.25) as q1, quantile_cont({{c}}, 0.75) as q3 from lab)""") + ") order by abs(skewness) desc, column_name limit 10")
    out["histogram"] = q("\nunion all\n".join(_hist(c) for c in ["delay_min", "speed_normal", "temperature", "wind"]))
    out["density_hist"] = q(f"""select series, bin, {r('lo + bin * w')} as low, {r('count(*) / (total * w)')} as density from (
  select series, lo, total, (hi - lo) / 40 as w, cast(least(floor((x - lo) / ((hi - lo) / 40)), 39) as bigint) as bin from (
    select outlier_type <> 'normal' as series, delay_min as x from lab) join (
    select outlier_type <> 'normal' as series, min(delay_min) as lo, max(delay_min) as hi, count(*) as total from lab group by 1) using (series))
group by series, bin, lo, w, total""")
    out["boxplot_stats"] = q("\nunion all\n".join([
        _box("cast(is_rush_hour as varchar)", "is_rush_hour"), _box("cast(is_bad_weather as varchar)", "is_bad_weather"),
        _box("case is_weekend when 0 then 'Weekday' else 'Weekend' end", "day_type"), _box("'all'", "column")]), big=True)
    out["hour_mean_sd"] = q(f"select hour, {r('avg(delay_min)')} as mean_target, {r('stddev_samp(delay_min)')} as sd_target from lab group by 1", big=True)
    out["grid2d"] = q("""select cell_x, cell_y, count(*) as n from (
  select cast(least(floor((distance_km - xl) / ((xh - xl) / 20)), 19) as bigint) as cell_x,
         cast(least(floor((delay_min - yl) / ((yh - yl) / 20)), 19) as bigint) as cell_y
  from lab, (select min(distance_km) as xl, max(distance_km) as xh, min(delay_min) as yl, max(delay_min) as yh from lab)) group by 1, 2""")
    out["hexagons"] = q(f"""select {r('i * sx + xl')} as center_x, {r('j * sy + yl')} as center_y, count(*) as n from (
  select xl, yl, sx, sy, case when near then i1 else i2 end as i, case when near then j1 else j2 end as j from (
    select *, (u - i1) * (u - i1) + 3 * (v - j1) * (v - j1) < (u - i2) * (u - i2) + 3 * (v - j2) * (v - j2) as near from (
      select *, floor(u + 0.5) as i1, floor(v + 0.5) as j1, floor(u) + 0.5 as i2, floor(v) + 0.5 as j2 from (
        select xl, yl, sx, sy, (distance_km - xl) / sx as u, (delay_min - yl) / sy as v from lab, (
          select min(distance_km) as xl, (max(distance_km) - min(distance_km)) / 20 as sx,
                 min(delay_min) as yl, (max(delay_min) - min(delay_min)) / 11 as sy from lab)))))
group by i, j, sx, sy, xl, yl""")
    out["ols_trend"] = q(f"""select {r('regr_slope(delay_min, distance_km)')} as slope, {r('regr_intercept(delay_min, distance_km)')} as intercept,
  {r('regr_r2(delay_min, distance_km)')} as r2, count(*) as n from lab""")
    out["label_counts_filled"] = q("""select position, l.outlier_type, count(lab.outlier_type) as n
from (values (0, 'normal'), (1, 'valid'), (2, 'suspicious'), (3, 'invalid'), (4, 'unlabelled')) l(position, outlier_type)
left join lab on lab.outlier_type = l.outlier_type group by 1, 2""")
    out["interpretation"] = q(f"""select {r('100.0 * invalid / outlier_rows')} as invalid_of_outliers_pct,
  {r('100.0 * suspicious / outlier_rows')} as suspicious_of_outliers_pct, {r('100.0 * rush_outliers / outlier_rows')} as outliers_in_rush_hour_pct,
  case when 100.0 * invalid / outlier_rows >= 20 then 'data_quality' when 100.0 * suspicious / outlier_rows >= 40 then 'unexplained' else 'realistic' end as verdict
from cnt""", more=counts)
    out["holdout_split"] = q(f"select obs_id, not {train} as is_test from lab")
    out["stratified_split"] = q("select obs_id, target_class, hashed.h <= cut.h as is_test from hashed join cut using (target_class)",
                                more=f"{hashed},\n{split}")
    out["labels_for_train"] = q(f"select obs_id, {r('delay_min')} as delay_min, outlier_type from lab where {train}")
    out["kfold"] = q(f"select obs_id, cast({hash52('obs_id', 43)} % 5 as integer) as fold from lab where {train}")
    out["metrics_regression"] = q(f"select {METRICS} from preds", more=PREDS)
    out["metrics_by_label"] = q(f"select outlier_type, {METRICS} from preds where outlier_type in ('normal', 'valid', 'suspicious') group by 1", more=PREDS)
    cells = """cells as (select count(*) filter (a and b) as tp, count(*) filter (not a and b) as fp, count(*) filter (a and not b) as fn,
  count(*) filter (not a and not b) as tn from (select outlier_type <> 'normal' as a, is_rush_hour = 1 as b from lab))"""
    out["metrics_classification"] = q(f"""select *, {r('1.0 * (tp + tn) / (tp + fp + fn + tn)')} as accuracy, {r('1.0 * tp / (tp + fp)')} as precision,
  {r('1.0 * tp / (tp + fn)')} as recall, {r('2.0 * tp / (2 * tp + fp + fn)')} as f1 from cells""", more=cells)
    out["confusion"] = q("""select g.actual, g.predicted, count(lab.obs_id) as n
from (values (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted) left join lab
  on g.actual = case when outlier_type = 'normal' then 0 else 1 end and g.predicted = is_rush_hour group by 1, 2""")
    model_metrics = """mm as (
  select model, avg(abs(y - p)) as mae, sqrt(avg((y - p) * (y - p))) as rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) as r2
  from (select 'hourly' as model, delay_min as y, avg(delay_min) over (partition by hour) as p from lab
        union all select 'route', delay_min, avg(delay_min) over (partition by route) from lab
        union all select 'overall', delay_min, avg(delay_min) over () + 0.25 from lab) group by model)"""
    out["improvement_pct"] = q(f"""select n.model, {r(f"-({_improve('n.mae', 'b.mae')})")} as mae_improvement_pct,
  {r(f"-({_improve('n.rmse', 'b.rmse')})")} as rmse_improvement_pct, {r(_improve('n.r2', 'b.r2'))} as r2_improvement_pct,
  {r('b.mae - n.mae')} as mae_delta, {r('b.rmse - n.rmse')} as rmse_delta, {r('n.r2 - b.r2')} as r2_delta
from mm n, mm b where b.model = 'overall' and n.model <> 'overall'""", more=model_metrics)
    out["residual_confidence"] = q(f"""select {r('avg(abs(y - p))')} as mean_abs_residual, {r('stddev_pop(y - p)')} as std_residual,
  {r('1 - stddev_pop(y - p) / avg(abs(y))')} as confidence from preds""", more=PREDS)
    out["prediction_table"] = q(f"""select obs_id, {r('y')} as y_true, {r('p')} as y_pred, {r('abs(y - p)')} as abs_error from preds""", more=PREDS)
    out["knn_predict"] = q(f"""
select query_id, {r("case when count(*) filter (d = 0) > 0 then avg(v) filter (d = 0) else sum(v / d) filter (d > 0) / sum(1 / d) filter (d > 0) end")} as prediction
from (select a.obs_id as query_id, b.delay_min as v, sqrt({d2}) as d,
        row_number() over (partition by a.obs_id order by sqrt({d2}), b.obs_id) as rn
      from lab a, lab b where not {train.replace('obs_id', 'a.obs_id')} and {train.replace('obs_id', 'b.obs_id')})
where rn <= 15 group by 1""")
    out["standardize"] = q(f"select obs_id, " + ", ".join(
        f"{r(f'({c} - m_{c}) / s_{c}')} as {c}" for c in knn_x) + " from lab, (select " + ", ".join(
        f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in knn_x) + f" from lab where {train})")
    out["f_select"] = q(f"select feature, {r('f_score')} as f_score from fs order by fs.f_score desc, feature limit 7", more=fscore)
    out["interaction_pairs"] = q(f"""select a.feature as feature_a, b.feature as feature_b, {r('a.w * b.w')} as score
from top a join top b on a.rk < b.rk order by a.w * b.w desc, 1, 2 limit 5""", more=fscore + """,
top as materialized (select feature, f_score / (select sum(f_score) from fs) as w, row_number() over (order by f_score desc, feature) as rk
  from fs order by f_score desc, feature limit 5)""")
    return out
