"""Fixture views over the given tables, as SQL text for both engines.

The text is the same but for a few functions, so both sides start from the same rows; what an
operator does to them is written twice, in Spark and in the SQL of each query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from catalogue.registry import table


@dataclass(frozen=True)
class Dialect:
    millis: str
    quotient: str
    table: str

    def ms(self, column: str) -> str:
        return self.millis.format(column)

    def div(self, a: str, b: str) -> str:
        return f"({a} {self.quotient} {b})"

    def of(self, name: str) -> str:
        return self.table.format(name)


SPARK = Dialect("unix_millis(cast({} as timestamp))", "div", "{{{}}}")
DUCK = Dialect("(epoch_us({}) // 1000)", "//", "{}")


def versions_sql(d: Dialect) -> str:
    """V: order lines as published versions of an event."""
    return f"""
select l_orderkey as event_id,
  case when o_orderpriority in ('1-URGENT','2-HIGH') then 'traced' else 'control' end as cohort,
  'Place ' || o_orderpriority || ' ' || o_orderstatus as place,
  o_orderdate as event_time, l_shipdate as published_at,
  {d.ms('l_shipdate')} as published_epoch_ms,
  l_quantity as magnitude,
  case l_returnflag when 'A' then 'mb' when 'N' then 'mww' else 'ml' end as magnitude_type,
  case l_linestatus when 'O' then 'automatic' else 'reviewed' end as review_status,
  'net' || (l_suppkey % 20) as contributor,
  case when l_orderkey % 9 = 0 then null else l_partkey % 100 end as station_count,
  cast(null as double) as magnitude_station_count,
  cast(l_partkey % 360 as double) as azimuthal_gap,
  l_discount as minimum_distance, l_linenumber as phase_count, l_tax as standard_error,
  case when l_orderkey % 7 = 0 then null else l_discount + l_tax end as horizontal_error,
  cast(null as double) as magnitude_error,
  cast(l_suppkey % 70 as double) as depth_km,
  cast(l_partkey % 90 as double) as latitude, cast(l_orderkey % 180 as double) as longitude,
  l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax
from {d.of('lineitem')} join {d.of('orders')} on l_orderkey = o_orderkey"""


VERSION_ORDER = ("published_epoch_ms", "l_linenumber", "l_partkey", "l_suppkey",
                 "l_extendedprice", "l_discount", "l_tax")


def features_sql(d: Dialect) -> str:
    """N: features that reach the lake from two origins, one row per publication."""
    k = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
    return f"""
with raw as (
  select event_id, user_id, {k} as k, event_type,
    'us' || event_id as id,
    ',u' || user_id || ',us' || event_id
      || case when event_type = 'purchase' then ',usauto' || event_id else '' end || ',' as ids,
    {d.ms('ts')} as time_ms,
    cast(floor(value / 10) as double) as mag,
    case event_type when 'view' then 'mww' when 'click' then 'Mb_Lg' when 'error' then 'ml'
      when 'purchase' then 'MD' else 'xx' end as mag_type,
    case when {k} < 50 then 'automatic' else 'reviewed' end as status,
    'Zone ' || event_type as place,
    cast(user_id % 360 - 180 as double) as lon, cast({k} % 90 as double) as lat,
    case when event_id % 10 = 0 then null else cast({k} as double) end as depth,
    cast({k} as bigint) as nst, cast({k} * 3 as double) as gap,
    cast({k} % 7 as double) / 2 as rms,
    case when event_type = 'view' then null else cast({k} % 11 as bigint) end as felt,
    case when event_type = 'view' then null else cast(user_id % 9 as double) end as cdi,
    case when event_type = 'click' then null else cast({k} % 7 as double) end as mmi,
    case when {k} % 3 = 0 then 'us' else 'ak' end as net,
    case when event_id % 2 = 0 then 'live' else 'catalog' end as first_origin,
    case when event_id % 97 = 0 then null else {d.ms('ts')} + 90000 * {k} end as first_update
  from {d.of('events')})
select *, first_origin as origin, first_update as updated_ms from raw
union all
select *, case first_origin when 'live' then 'catalog' else 'live' end, first_update + 3600000
from raw where event_type in ('view', 'signup')"""


def messages_sql(d: Dialect) -> str:
    """E: a live stream of magnitudes and states per user."""
    return f"""
select user_id, event_id, ts, cast(floor(value / 100) as double) as magnitude,
  case when cast(regexp_extract(props, '([0-9]+)', 1) as int) % 2 = 0
       then 'automatic' else 'reviewed' end as status
from {d.of('events')}"""


def identities_sql(d: Dialect) -> str:
    """I: orders as records with alias sets that overlap in pairs."""
    return f"""
select 'us' || o_orderkey as usgs_id,
  ',' || case when o_orderkey % 15 = 0 then 'usauto' || o_orderkey || ',' else '' end
    || 'us' || o_orderkey || ','
    || case when o_orderkey % 4 = 0 then 'at' || {d.div('o_orderkey', '8')} || ',' else '' end
    || case when o_orderkey % 6 = 0 then 'pt' || {d.div('o_orderkey', '12')} || ',' else '' end
    as ids
from {d.of('orders')}"""


def reports_sql(d: Dialect) -> str:
    """H: human reports per order."""
    return f"""
select o_orderkey as event_id,
  case when o_orderkey % 3 = 0 then null else o_orderkey % 11 end as felt_reports,
  case when o_orderkey % 3 = 0 then null else cast(o_custkey % 9 as double) end
    as community_intensity,
  case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 7 as double) end
    as instrumental_intensity
from {d.of('orders')}"""


def landed_sql(d: Dialect) -> str:
    """L: orders as catalogue lines of their month."""
    month = ("date_format(o_orderdate, 'yyyy-MM')" if d is SPARK
             else "strftime(o_orderdate, '%Y-%m')")
    return f"""
select {month} as period, o_orderkey, o_orderpriority,
  o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority as value
from {d.of('orders')}"""


def rings_sql(d: Dialect) -> str:
    """G: points of a ring per user, in order of time."""
    return f"""
select user_id, ts, event_id, cast(floor(value / 50) as double) as x,
  cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 10 as double) as y
from {d.of('events')}"""


def spark_view(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    names = [name for name in ("lineitem", "orders", "events") if "{" + name + "}" in build(SPARK)]
    return spark.sql(build(SPARK), **{name: table(spark, sf_dir, name) for name in names})


# Oracle text shared by several queries.
V = f"v as ({versions_sql(DUCK)})"
N = f"n as ({features_sql(DUCK)})"
E = f"e as ({messages_sql(DUCK)})"
I = f"i as ({identities_sql(DUCK)})"
H = f"h as ({reports_sql(DUCK)})"
L = f"l as ({landed_sql(DUCK)})"
G = f"g as ({rings_sql(DUCK)})"

RANKED = V + f""", ranked as (
  select *, row_number() over w as version_rank, count(*) over (partition by event_id) as
      version_count, lag(magnitude) over w as previous_magnitude,
    round((published_epoch_ms / 1000.0 - epoch_ms(event_time) // 1000) / 60.0, 2)
      as minutes_since_quake
  from v window w as (partition by event_id order by {', '.join(VERSION_ORDER)}))"""

FAMILY = """case when {0} like 'mw%' then 'moment' when {0} like 'ms%' then 'surface_wave'
  when {0} like 'mb%' then 'body_wave' when {0} like 'ml%' then 'local'
  when {0} like 'md%' or {0} like 'mh%' then 'duration' else 'inconnue' end"""
CEILING = """case when {0} like 'mw%' then 10.0 when {0} like 'ms%' then 8.0
  when {0} like 'mb%' or {0} like 'ml%' then 6.5 else 5.0 end::double"""

PAIRED = RANKED + f""", paired as (
  select f.event_id, f.cohort, f.place, f.event_time, f.version_count,
    f.magnitude as first_magnitude, z.magnitude as final_magnitude,
    f.magnitude_type as first_magnitude_type, z.magnitude_type as final_magnitude_type,
    f.review_status as first_review_status, z.review_status as final_review_status,
    f.station_count as first_station_count, z.station_count as final_station_count,
    f.contributor as first_contributor, f.horizontal_error as first_horizontal_error,
    f.minutes_since_quake as first_minutes_since_quake,
    z.minutes_since_quake as final_minutes_since_quake,
    f.latitude as first_latitude, f.longitude as first_longitude
  from ranked f join ranked z on f.event_id = z.event_id
  where f.version_rank = 1 and z.version_rank = z.version_count),
revised as (
  select *, round(final_magnitude - first_magnitude, 2) as shift,
    abs(round(final_magnitude - first_magnitude, 2)) as shift_abs,
    abs(final_magnitude - first_magnitude) >= 0.05 as moved,
    case when final_magnitude - first_magnitude >= 0.05 then 'hausse'
         when final_magnitude - first_magnitude <= -0.05 then 'baisse' else 'stable' end
      as direction,
    {FAMILY.format('first_magnitude_type')} as first_family,
    {FAMILY.format('final_magnitude_type')} as final_family,
    first_magnitude_type <> final_magnitude_type as scale_changed,
    {CEILING.format('first_magnitude_type')} as first_saturation,
    final_station_count - first_station_count as station_growth,
    round(final_minutes_since_quake - first_minutes_since_quake, 1) as review_delay_minutes
  from paired)"""

FINGERPRINT = """sha256(concat_ws('|', coalesce(mag::varchar, '~'), coalesce(lower(mag_type), '~'),
    coalesce(status, '~'), coalesce(lat::varchar, '~'), coalesce(lon::varchar, '~'),
    coalesce(depth::varchar, '~'), coalesce(nst::varchar, '~'), coalesce(gap::varchar, '~'),
    coalesce(rms::varchar, '~'), id))"""

FLAT = N + f""", flat as (
  select coalesce(list_sort(list_distinct(list_filter(string_split(ids, ','),
           lambda x: x <> '')))[1], id) as event_key,
    array_to_string(list_sort(list_distinct(list_filter(string_split(ids, ','),
           lambda x: x <> ''))), ',') as all_ids,
    len(list_distinct(list_filter(string_split(ids, ','), lambda x: x <> '')))
      as identifier_count,
    ids like '%,usauto%' as automatic_origin,
    *, make_timestamp_ms(time_ms) as event_time, make_timestamp_ms(updated_ms) as updated_time,
    lower(mag_type) as magnitude_type, {FAMILY.format('lower(mag_type)')} as magnitude_family,
    {CEILING.format('lower(mag_type)')} as saturation_threshold,
    {FINGERPRINT} as fingerprint
  from n),
deduped as (select * from flat qualify row_number() over (
  partition by event_key, fingerprint order by updated_ms nulls last, origin) = 1),
timeline as (
  select *, row_number() over w as version, count(*) over (partition by event_key) as versions,
    updated_time as valid_from, lead(updated_time) over w as valid_to,
    row_number() over w = count(*) over (partition by event_key) as is_current,
    lag(mag) over w as previous_magnitude, lag(status) over w as previous_status
  from deduped window w as (partition by event_key order by updated_ms nulls last, id,
    fingerprint)),
current as (select * from timeline where is_current)"""
