"""Observation tables derived from the star-schema parquet tables.

``obs`` is a single-table view with faults planted on purpose (copied rows, bad
times, missing weather, zero durations); ``obs_big`` joins six tables and is
the scale view. Both are given as SQL that other engines read as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.roles import Roles

OBS_ROLES = Roles(timestamp="ts_text")

OBS_CTES = """
base as (
  select event_id, user_id, value, event_type,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
         cast(ts as string) as ts_text, hour(ts) as h
  from events),
o as (
  select event_id as obs_id,
    case when event_id % 1000 = 3 then 'not-a-time' else ts_text end as ts_text,
    event_type as origin, concat('Z', cast(user_id % 10 as string)) as destination,
    (user_id % 40) + cast(0.5 as double) as distance_km,
    k * cast(0.5 as double) as duration_normal_min,
    k * cast(0.5 as double) + value / 10 - 4 as duration_traffic_min,
    value / 10 - 4 as delay_min,
    case when event_id % 500 = 0 then null
         else round(20 + 8 * sin(2 * pi() * h / 24), 2) + (user_id % 7) end as temperature,
    case when event_id % 500 = 0 then null else cast(user_id % 12 as double) end as wind,
    case when event_id % 500 = 0 then null when user_id % 9 = 0 then cast(1 as double)
         else cast(0 as double) end as rain
  from base),
obs as (select * from o union all select * from o where obs_id % 200 = 1)
"""

OBS_BIG_CTES = """
obs_big as (
  select l.l_orderkey * 8 + l.l_linenumber as obs_id,
    o.o_orderdate + interval '1' hour * (l.l_partkey % 24) as timestamp,
    sn.n_name as origin, cn.n_name as destination,
    l.l_quantity * cast(0.9 as double) as distance_km,
    l.l_quantity * cast(2.0 as double) as duration_normal_min,
    l.l_quantity * cast(2.0 as double) - 4 - 5 * ln(1 - (((l.l_partkey * 7919 + l.l_orderkey) % 10007)
        + cast(0.5 as double)) / 10008) as duration_traffic_min,
    -4 - 5 * ln(1 - (((l.l_partkey * 7919 + l.l_orderkey) % 10007)
        + cast(0.5 as double)) / 10008) as delay_min,
    c.c_acctbal / 300 as temperature, l.l_tax * 150 as wind,
    cast(case when l.l_returnflag = 'R' then 1 else 0 end as double) as rain
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
    join customer c on o.o_custkey = c.c_custkey
    join supplier sp on l.l_suppkey = sp.s_suppkey
    join nation sn on sp.s_nationkey = sn.n_nationkey
    join nation cn on c.c_nationkey = cn.n_nationkey)
"""


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    return spark.sql(f"with {OBS_CTES} select * from obs")


def obs_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join sides are left to Catalyst, which broadcasts only below its size threshold."""
    _views(spark, sf_dir, "lineitem", "orders", "customer", "supplier", "nation")
    return spark.sql(f"with {OBS_BIG_CTES} select * from obs_big")
