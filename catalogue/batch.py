"""Queries on tables: scans, projections, joins, aggregates, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import ORACLES, query, table
from catalogue.views import (CEILING, E, FAMILY, FLAT, G, H, I, L, N, PAIRED, RANKED, V,
                             VERSION_ORDER, features_sql, identities_sql, messages_sql,
                             reports_sql, rings_sql, spark_view, versions_sql)
from palimpsest.functions.content import fingerprint
from palimpsest.functions.geometry import bar_height, sphere_point
from palimpsest.functions.identifiers import canonical_key, split_aliases
from palimpsest.functions.scales import (display_ceiling, family_of, is_reference,
                                         is_saturated, saturation_of)
from palimpsest.operators import identity, live, pairing, postings, profiles, sketches, thresholds, timeline
from palimpsest.operators import witness as reports
from palimpsest.operators.digests import bucket_number, compare_states, store_state
from palimpsest.operators.normalise import flatten_features, union_sources
from palimpsest.operators.rings import compact_rings
from palimpsest.operators.skew import same_keys
from palimpsest.operators.snapshot_diff import COMPARED, compare_snapshots, diff_summary, largest_gaps
from palimpsest.plans.bundle import build_bundle
from palimpsest.scratch import all_files_there, materialise, new_folder
from palimpsest.sources.schemas import FEATURE
from palimpsest.streaming.revisions import batch_revisions

THRESHOLDS = tuple(float(t) for t in range(5, 50, 5))


# Shared inputs ------------------------------------------------------------------------------

def versions(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, versions_sql)


def version_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("event_id"))


def ranked(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.rank_versions(versions(spark, sf), VERSION_ORDER,
                                  keys_of=version_keys(spark, sf))


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Revision pairs with all columns, by the form without windows."""
    return pairing.revision_columns(
        pairing.pairs_by_key(versions(spark, sf), VERSION_ORDER, keys_of=version_keys(spark, sf)))


REVISED = ("magnitude", "magnitude_type", "station_count", "minutes_since_quake")


def shifts(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The pairs with what the reports read: an aggregate carries every column it is given."""
    return pairing.revision_columns(pairing.pairs_by_key(
        versions(spark, sf), VERSION_ORDER, ("cohort",), (*REVISED, *more), REVISED,
        version_keys(spark, sf)))


def magnitude_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.pairs_by_key(versions(spark, sf), VERSION_ORDER, (), ("magnitude",),
                                ("magnitude",), version_keys(spark, sf))


_LANDED: dict[tuple[str, str], DataFrame] = {}


def nested_features(spark: SparkSession, sf: str) -> DataFrame:
    """Landed features, written once per application and again when the files are gone:
    operators start from a scan, as they do behind an ingestion."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED or not all_files_there(_LANDED[key]):
        _LANDED[key] = materialise(_published(spark, sf), "landed")
    return _LANDED[key]


def _published(spark: SparkSession, sf: str) -> DataFrame:
    """Features as they are published: nested, with short coordinates where depth is null."""
    flat = spark_view(spark, sf, features_sql)
    point = F.when(F.col("depth").isNull(), F.array("lon", "lat")).otherwise(
        F.array("lon", "lat", "depth"))
    properties = {
        "mag": "mag", "place": "place", "time": "time_ms", "updated": "updated_ms",
        "felt": "felt", "cdi": "cdi", "mmi": "mmi", "status": "status", "net": "net",
        "ids": "ids", "nst": "nst", "rms": "rms", "gap": "gap", "magType": "mag_type"}
    fixed = {"sources": F.lit(",us,ak,"), "type": F.lit("earthquake")}
    fields = []
    for field in FEATURE["properties"].dataType:
        value = (F.col(properties[field.name]) if field.name in properties
                 else fixed.get(field.name, F.lit(None)))
        fields.append(value.cast(field.dataType).alias(field.name))
    return flat.select(
        F.lit("Feature").alias("type"), "id", F.struct(*fields).alias("properties"),
        F.struct(F.lit("Point").alias("type"), point.alias("coordinates")).alias("geometry"),
        "origin")


def flat_events(spark: SparkSession, sf: str) -> DataFrame:
    nested = nested_features(spark, sf)
    return union_sources([
        flatten_features(nested.filter(F.col("origin") == name), name)
        for name in ("catalog", "live")])


def events_timeline(spark: SparkSession, sf: str) -> DataFrame:
    events = flat_events(spark, sf)
    return timeline.version_timeline(timeline.first_copies(events), keys_of=events)


def current_events(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.current_versions(events_timeline(spark, sf))


def witness_rows(spark: SparkSession, sf: str) -> DataFrame:
    pairs = shifts(spark, sf).select("event_id", "first_magnitude", "final_magnitude", "shift",
                                      "shift_abs", "direction", "cohort")
    return reports.witness_columns(
        reports.join_reports(pairs, spark_view(spark, sf, reports_sql), "event_id"))


def identity_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Order identities in the shape of current records."""
    records = spark_view(spark, sf, identities_sql)
    blank = F.lit(None).cast("string")
    aliases = split_aliases(F.col("ids"))
    return identity.identity_history(records.select(
        canonical_key(aliases, F.col("usgs_id")).alias("event_key"), "usgs_id",
        aliases.alias("all_ids"),
        *[blank.alias(name) for name in ("networks", "reporting_network", "review_status",
                                         "magnitude", "magnitude_type", "event_time", "place")]))


# Projections --------------------------------------------------------------------------------

@query("normalise_features", f"""with {FLAT}
select event_key, id as usgs_id, all_ids, 'us,ak' as networks, net as reporting_network,
  status as review_status, mag as magnitude, magnitude_type, magnitude_family,
  saturation_threshold, mag >= saturation_threshold as magnitude_saturated,
  magnitude_family = 'moment' as magnitude_is_reference, event_time, updated_time, place,
  lon as longitude, lat as latitude, depth as depth_km, nst as station_count,
  gap as azimuthal_gap, rms as residual_rms, felt as felt_reports,
  cdi as community_intensity, mmi as instrumental_intensity, origin from flat""")
def normalise_features(spark, sf):
    flat = flat_events(spark, sf).drop("nearest_station_deg", "alert_level", "tsunami_flag",
                                       "significance", "event_type")
    return flat.withColumns({name: F.array_join(name, ",") for name in ("all_ids", "networks")})


@query("union_sources", f"""with {FLAT} select origin, count(*) as records,
  count(updated_time) as dated, count(distinct event_key) as keys from flat group by origin""")
def union_of_sources(spark, sf):
    return flat_events(spark, sf).groupBy("origin").agg(
        F.count(F.lit(1)).alias("records"), F.count("updated_time").alias("dated"),
        F.count_distinct("event_key").alias("keys"))


@query("split_aliases", f"""with {I} select usgs_id, array_to_string(list_sort(list_distinct(
  list_filter(string_split(ids, ','), lambda x: x <> ''))), ',') as aliases from i""")
def split_aliases_query(spark, sf):
    return spark_view(spark, sf, identities_sql).select(
        "usgs_id", F.array_join(split_aliases(F.col("ids")), ",").alias("aliases"))


@query("canonical_key", f"""with {I} select usgs_id, coalesce(list_min(list_filter(
  string_split(ids, ','), lambda x: x <> '')), usgs_id) as event_key from i""")
def canonical_key_query(spark, sf):
    return spark_view(spark, sf, identities_sql).select(
        "usgs_id", canonical_key(split_aliases(F.col("ids")), F.col("usgs_id"))
        .alias("event_key"))


@query("classify_prefix", f"""with {N} select mag_type, origin,
  {FAMILY.format('lower(mag_type)')} as family, {CEILING.format('lower(mag_type)')} as threshold,
  count(*) as n from n group by all""")
def classify_prefix(spark, sf):
    scale = F.col("mag_type")
    return (spark_view(spark, sf, features_sql)
            .groupBy("mag_type", "origin", family_of(scale).alias("family"),
                     saturation_of(scale).alias("threshold"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("saturation_flags", f"""with {V} select event_id, l_linenumber, l_partkey, l_suppkey,
  published_epoch_ms, magnitude / 5 >= {CEILING.format('magnitude_type')} as saturated,
  magnitude_type = 'mww' as is_reference from v""")
def saturation_flags(spark, sf):
    scale = F.col("magnitude_type")
    return versions(spark, sf).select(
        "event_id", "l_linenumber", "l_partkey", "l_suppkey", "published_epoch_ms",
        is_saturated(F.col("magnitude") / 5, scale).alias("saturated"),
        is_reference(scale).alias("is_reference"))


@query("scale_ceiling", f"""with {N} select id, origin, case when lower(mag_type) like 'mb%'
  or lower(mag_type) like 'ml%' then 6.5::double when lower(mag_type) like 'md%'
  then 5.0::double end as ceiling from n""")
def scale_ceiling(spark, sf):
    return spark_view(spark, sf, features_sql).select(
        "id", "origin", display_ceiling(F.col("mag_type")).alias("ceiling"))


@query("fingerprint", f"with {FLAT} select id as usgs_id, origin, fingerprint from flat")
def fingerprint_query(spark, sf):
    return flat_events(spark, sf).select("usgs_id", "origin",
                                         fingerprint().alias("fingerprint"))


@query("search_place", f"""with {N} select id, origin, place from n
  where contains(lower(place), 'pur')""")
def search_place(spark, sf):
    return live.search_place(spark_view(spark, sf, features_sql).select("id", "origin", "place"),
                             "  PUR ")


@query("search_place_indexed", ORACLES["search_place"])
def search_place_indexed(spark, sf):
    """The same from posting lists; folders without the trigrams are not read."""
    rows = spark_view(spark, sf, features_sql).select("id", "origin", "place")
    return postings.search(postings.build_index(rows, "place", new_folder(spark, "places"), 16, 16), "  PUR ")


@query("sphere_points", f"""with {PAIRED}, p as (select event_id, shift,
  radians(90.0 - first_latitude) as phi, radians(first_longitude + 180.0) as theta,
  0.04 + least(abs(shift), 1.6) * 0.34 as height from revised)
select event_id, round(-1.005 * sin(phi) * cos(theta), 6) as x, round(1.005 * cos(phi), 6) as y,
  round(1.005 * sin(phi) * sin(theta), 6) as z, round(height, 6) as height from p""")
def sphere_points(spark, sf):
    point = sphere_point(F.col("first_latitude"), F.col("first_longitude"), F.lit(1.005))
    return shifts(spark, sf, "latitude", "longitude").select(
        "event_id", *[F.round(value, 6).alias(name) for name, value in point.items()],
        F.round(bar_height(F.col("shift")), 6).alias("height"))


# Timelines ----------------------------------------------------------------------------------

@query("dedup_versions", f"""with {FLAT} select event_key, id as usgs_id, origin, updated_time,
  fingerprint from deduped""")
def dedup_versions(spark, sf):
    return timeline.first_copies(flat_events(spark, sf)).select(
        "event_key", "usgs_id", "origin", "updated_time", "fingerprint")


@query("scd2_timeline", f"""with {FLAT} select event_key, id as usgs_id, version, valid_from,
  valid_to, is_current, mag as magnitude, previous_magnitude,
  round(mag - previous_magnitude, 2) as magnitude_delta, previous_status from timeline""")
def scd2_timeline(spark, sf):
    return events_timeline(spark, sf).select(
        "event_key", "usgs_id", "version", "valid_from", "valid_to", "is_current", "magnitude",
        "previous_magnitude", "magnitude_delta", "previous_status")


@query("current_versions", f"""with {FLAT} select event_key, id as usgs_id, version,
  mag as magnitude from current""")
def current_versions(spark, sf):
    return current_events(spark, sf).select("event_key", "usgs_id", "version", "magnitude")


@query("rank_versions", f"""with {RANKED} select event_id, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, magnitude, version_rank, version_count, version_rank = 1 as is_first,
  version_rank = version_count as is_last, previous_magnitude,
  round(magnitude - previous_magnitude, 2) as magnitude_step, minutes_since_quake
  from ranked""")
def rank_versions(spark, sf):
    return ranked(spark, sf).select(
        "event_id", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "magnitude",
        "version_rank", "version_count", "is_first", "is_last", "previous_magnitude",
        "magnitude_step", "minutes_since_quake")


@query("revision_history", f"""with {FLAT}, ends as (select event_key, count(*) as versions,
  arg_min_null(mag, version) as first_magnitude, arg_max_null(mag, version) as final_magnitude,
  arg_min_null(status, version) as first_status, arg_max_null(status, version) as final_status,
  min(valid_from) as first_seen, max(valid_from) as last_seen
  from timeline group by event_key having count(*) > 1)
select e.event_key, c.place, c.event_time, e.versions, first_magnitude, final_magnitude,
  round(final_magnitude - first_magnitude, 2) as magnitude_shift,
  abs(round(final_magnitude - first_magnitude, 2)) as magnitude_shift_abs, first_status,
  final_status, c.magnitude_type, c.magnitude_family, c.nst as station_count,
  c.gap as azimuthal_gap, c.rms as residual_rms,
  round((epoch_ms(last_seen) // 1000 - epoch_ms(first_seen) // 1000) / 60.0, 1)
    as minutes_to_final
from ends e join current c on e.event_key = c.event_key""")
def revision_history(spark, sf):
    return pairing.revision_history(events_timeline(spark, sf), flat_events(spark, sf))


@query("revised_events", f"""with {FLAT}, k as (select event_key, count(*) as n from timeline
  group by event_key) select count(*) as seismes_distincts,
  count(*) filter (n > 1) as seismes_revises from k""")
def revised_events(spark, sf):
    # Keys and counts need no order: the rows that survive deduplication are enough.
    return timeline.revised_events(timeline.first_copies(flat_events(spark, sf)))


@query("versions_per_cohort", f"""with {V}, k as (select cohort, event_id, count(*) as n from v
  group by all) select cohort, count(*) as seismes, sum(n)::bigint as versions,
  round(avg(n), 2) as versions_par_seisme, max(n) as versions_max from k group by cohort""")
def versions_per_cohort(spark, sf):
    return timeline.versions_per_cohort(versions(spark, sf))


@query("moving_share", f"""with {RANKED}, m as (select event_id,
  max(case when version_rank > 1 and abs(round(magnitude - previous_magnitude, 2)) >= 0.05
  then 1 else 0 end) as moves from ranked group by event_id)
select count(*) as seismes, count(*) filter (moves = 1) as mobiles,
  round(100.0 * count(*) filter (moves = 1) / count(*), 1) as part_pct from m""")
def moving_share(spark, sf):
    return timeline.moving_share(ranked(spark, sf))


# First against final ------------------------------------------------------------------------

PAIR_COLUMNS = ("event_id", "cohort", "version_count", "first_magnitude", "final_magnitude",
                "first_magnitude_type", "final_magnitude_type", "first_review_status",
                "final_review_status", "first_station_count", "final_station_count")
PAIR_SQL = f"with {PAIRED} select {', '.join(PAIR_COLUMNS)} from paired"


@query("first_final_join", PAIR_SQL)
def first_final_join(spark, sf):
    return pairing.pairs_by_join(ranked(spark, sf)).select(*PAIR_COLUMNS)


@query("first_final_agg", PAIR_SQL)
def first_final_agg(spark, sf):
    return pairing.pairs_by_key(versions(spark, sf), VERSION_ORDER,
                                keys_of=version_keys(spark, sf)).select(*PAIR_COLUMNS)


@query("revision_dataset", f"""with {PAIRED} select event_id, cohort, place, event_time,
  version_count, first_magnitude, final_magnitude, shift, shift_abs, moved, direction,
  first_family, final_family, scale_changed, first_saturation,
  first_magnitude >= first_saturation - 1.0 as first_near_saturation, station_growth,
  first_minutes_since_quake, review_delay_minutes from revised""")
def revision_dataset(spark, sf):
    return dataset(spark, sf).select(
        "event_id", "cohort", "place", "event_time", "version_count", "first_magnitude",
        "final_magnitude", "shift", "shift_abs", "moved", "direction", "first_family",
        "final_family", "scale_changed", "first_saturation", "first_near_saturation",
        "station_growth", "first_minutes_since_quake", "review_delay_minutes")


@query("cohort_report", f"""with {PAIRED} select cohort, count(*) as seismes,
  round(avg(moved::int) * 100, 1) as pct_modifie, round(avg(shift), 3) as ecart_moyen,
  round(quantile_disc(shift_abs, 0.5), 2) as ecart_abs_median,
  round(max(shift_abs), 2) as ecart_abs_max from revised group by cohort""")
def cohort_report(spark, sf):
    return pairing.cohort_report(shifts(spark, sf), exact=True)


@query("family_report", f"""with {PAIRED} select first_family, count(*) as seismes,
  round(avg(shift), 3) as ecart_moyen,
  round(avg(scale_changed::int) * 100, 1) as pct_changement_echelle
  from revised group by first_family""")
def family_report(spark, sf):
    return pairing.family_report(shifts(spark, sf))


@query("cohort_comparison", f"""with {PAIRED} select cohort, count(*) as seismes,
  round(avg(moved::int) * 100, 1) as pct_deplace, round(avg(shift), 3) as ecart_moyen,
  round(avg(scale_changed::int) * 100, 1) as pct_changement_echelle
  from revised group by cohort""")
def cohort_comparison(spark, sf):
    return pairing.cohort_comparison(shifts(spark, sf))


@query("family_transitions", f"""with {PAIRED} select first_family, final_family,
  count(*) as seismes, round(avg(shift), 3) as ecart_moyen from revised group by all
  order by seismes desc, first_family, final_family limit 20""")
def family_transitions(spark, sf):
    return pairing.family_transitions(shifts(spark, sf))


@query("overview", f"""with {PAIRED}, {I} select count(*) as apparies,
  count(*) filter (moved) as deplaces, round(avg(shift), 3) as ecart_moyen,
  round(max(shift_abs), 2) as ecart_max, count(*) filter (scale_changed) as changements_echelle,
  round(quantile_disc(shift_abs, 0.5), 2) as ecart_median,
  round(quantile_disc(first_minutes_since_quake, 0.5), 1) as delai_premiere_publication,
  round(quantile_disc(review_delay_minutes, 0.5), 1) as delai_stabilisation,
  (select count(*) from v) as versions_totales,
  (select count(distinct event_id) from v) as seismes_suivis,
  (select count(*) from i) as catalogue,
  (select count(*) from i where ids like '%,usauto%') as identite_changee from revised""")
def overview(spark, sf):
    return pairing.overview(shifts(spark, sf), versions(spark, sf), identity_rows(spark, sf),
                            exact=True)


@query("top_shifts", f"""with {PAIRED} select event_id, cohort, first_magnitude,
  final_magnitude, shift, shift_abs, direction from revised
  order by shift_abs desc, event_id limit 160""")
def top_shifts(spark, sf):
    return pairing.top_shifts(shifts(spark, sf)).select(
        "event_id", "cohort", "first_magnitude", "final_magnitude", "shift", "shift_abs",
        "direction")


@query("featured_timelines", f"""with {PAIRED}, top as (select event_id from revised
  order by shift_abs desc, event_id limit 160)
select event_id, version_rank, published_at, contributor, magnitude, magnitude_type,
  review_status, station_count, azimuthal_gap, minutes_since_quake, depth_km
from ranked where event_id in (select event_id from top)""")
def featured_timelines(spark, sf):
    lines = ranked(spark, sf)
    return pairing.featured_timelines(lines, shifts(spark, sf), (
        "version_rank", "published_at", "contributor", "magnitude", "magnitude_type",
        "review_status", "station_count", "azimuthal_gap", "minutes_since_quake", "depth_km"))


@query("report_bundle")
def report_bundle(spark, sf):
    pairs = shifts(spark, sf)
    lines = pairing.featured_timelines(ranked(spark, sf), pairs, (
        "version_rank", "published_at", "contributor", "magnitude", "magnitude_type"))
    return build_bundle({
        "overview": pairing.overview(pairs, versions(spark, sf)),
        "cohortes": pairing.cohort_comparison(pairs),
        "familles": pairing.family_transitions(pairs),
        "courbe_alerte": thresholds.alert_curve(pairs, thresholds=THRESHOLDS),
        "seismes": pairing.top_shifts(pairs),
        "temoin_humain": reports.witness_report(witness_rows(spark, sf)),
        "modele": None}, lines, "event_id", "version_rank")


# Thresholds ---------------------------------------------------------------------------------

def curve_sql(grid: str, scale: str, tail: str) -> str:
    return f"""with {PAIRED}, t as ({grid}), x as (
  select threshold, first_magnitude{scale} >= threshold as a,
    final_magnitude{scale} >= threshold as d from revised, t),
c as (select threshold, count(*) as seismes, count(*) filter (a and d) as alerte_justifiee,
  count(*) filter (a and not d) as fausse_alerte,
  count(*) filter (not a and d) as alerte_manquee,
  count(*) filter (not a and not d) as silence_justifie from x group by threshold),
curve as (select *, alerte_justifiee + fausse_alerte as alertes_emises,
  case when alerte_justifiee + fausse_alerte > 0 then round(100.0 * fausse_alerte
    / (alerte_justifiee + fausse_alerte), 2) end as taux_fausse_alerte_pct,
  alerte_justifiee + alerte_manquee as meritaient_alerte,
  case when alerte_justifiee + alerte_manquee > 0 then round(100.0 * alerte_manquee
    / (alerte_justifiee + alerte_manquee), 2) end as taux_manque_pct from c) {tail}"""


COARSE = "select cast(unnest(range(5, 50, 5)) as double) as threshold"
FINE = "select round(unnest(range(30, 71)) / 10.0::double, 1)::double as threshold"


@query("alert_curve", curve_sql(COARSE, "", "select * from curve"))
def alert_curve(spark, sf):
    return thresholds.alert_curve(magnitude_pairs(spark, sf), thresholds=THRESHOLDS)


@query("alert_curve_tenths", curve_sql(FINE, " / 5", "select * from curve"))
def alert_curve_tenths(spark, sf):
    scaled = magnitude_pairs(spark, sf).select((F.col("first_magnitude") / 5).alias("announced"),
                                       (F.col("final_magnitude") / 5).alias("confirmed"))
    return thresholds.alert_curve(scaled, "announced", "confirmed")


@query("alert_crossing", curve_sql(COARSE, "", """select
  round(abs(taux_fausse_alerte_pct - taux_manque_pct), 2) as ecart, threshold,
  taux_fausse_alerte_pct, taux_manque_pct from curve order by ecart, threshold limit 1"""))
def alert_crossing(spark, sf):
    return thresholds.crossing(thresholds.alert_curve(magnitude_pairs(spark, sf),
                                                      thresholds=THRESHOLDS))


@query("alert_reliability", f"""with {FLAT}, p as (select arg_min_null(mag, version) as a,
  arg_max_null(mag, version) as c from timeline group by event_key having count(*) > 1),
t as (select unnest([3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0])::double as threshold)
select threshold, count(*) as events_evaluated,
  count(*) filter (a >= threshold) as alerts_raised,
  count(*) filter (a >= threshold and c >= threshold) as alerts_confirmed,
  count(*) filter (a >= threshold and c < threshold) as false_alerts,
  count(*) filter (a < threshold and c >= threshold) as missed_events,
  case when count(*) filter (a >= threshold) > 0 then round(
    count(*) filter (a >= threshold and c < threshold)
    / count(*) filter (a >= threshold), 4) end as false_alert_rate,
  round(count(*) filter (a < threshold and c >= threshold) / count(*), 4) as miss_rate
from p, t where a is not null and c is not null group by threshold""")
def alert_reliability(spark, sf):
    return thresholds.alert_reliability(pairing.revision_history(events_timeline(spark, sf), flat_events(spark, sf)))


# Profiles -----------------------------------------------------------------------------------

@query("magnitude_scales", f"""with {FLAT} select magnitude_family, magnitude_type,
  count(*) as events, round(avg(mag), 3) as magnitude_avg, round(min(mag), 2) as magnitude_min,
  round(max(mag), 2) as magnitude_max, min(saturation_threshold) as saturation_threshold,
  sum((mag >= saturation_threshold)::int)::bigint as saturated from current group by all""")
def magnitude_scales(spark, sf):
    return profiles.magnitude_scales(current_events(spark, sf))


LAG_SQL = f"""with {FLAT}, lagged as (select status as review_status, magnitude_family,
  round((updated_ms // 1000 - time_ms // 1000) / 60.0, 1) as lag from current),
lags as (select review_status, magnitude_family, count(*) as events,
  round(avg(lag), 1) as lag_avg_minutes,
  round(quantile_disc(lag, 0.5), 1) as lag_median_minutes,
  round(quantile_disc(lag, 0.9), 1) as lag_p90_minutes
  from lagged where lag >= 0 group by all)"""


@query("review_lag", LAG_SQL + " select * from lags")
def review_lag(spark, sf):
    return profiles.review_lag(current_events(spark, sf), exact=True)


SKETCHED = {"median_within": ("lag", 0.5), "p90_within": ("lag", 0.9)}


@query("review_lag_sketched", LAG_SQL + """ select review_status, magnitude_family, events as n_lag,
  true as median_within, true as p90_within from lags""")
def review_lag_sketched(spark, sf):
    """Marks from sketches by month of the event, and whether each is within its rank error."""
    lags = profiles.review_lags(current_events(spark, sf), "event_time")
    by_month = materialise(sketches.sketch_by_period(
        lags, profiles.LAG_GROUPS, F.trunc("event_time", "month"), ["lag"]), "sketches")
    marks = materialise(sketches.merged_quantiles(by_month, profiles.LAG_GROUPS, SKETCHED), "marks")
    within = sketches.within_error(lags, marks, profiles.LAG_GROUPS, SKETCHED, sketches.rank_error())
    counts = marks.select(*profiles.LAG_GROUPS, "n_lag")
    # Report sized: one row per group on both sides.
    return within.join(counts, same_keys(within, counts, profiles.LAG_GROUPS)).select(
        *[within[name] for name in within.columns], "n_lag")


@query("lag_units", LAG_SQL + """ select review_status, magnitude_family, lag_median_minutes,
  round(lag_median_minutes / 60, 1) as lag_median_hours,
  round(lag_median_minutes / 1440, 1) as lag_median_days from lags""")
def lag_units(spark, sf):
    return profiles.lag_in_units(profiles.review_lag(current_events(spark, sf), exact=True)) \
        .select("review_status", "magnitude_family", "lag_median_minutes", "lag_median_hours",
                "lag_median_days")


@query("value_counts", f"""with {FLAT} select 'magnitude_family' as colonne,
  magnitude_family as valeur, count(*) as count from deduped group by all union all
  select 'review_status', status, count(*) from deduped group by all union all
  select 'saturated_type', magnitude_type, count(*) from deduped
  where mag >= saturation_threshold group by all""")
def value_counts(spark, sf):
    events = timeline.first_copies(flat_events(spark, sf))

    def counted(frame, column, name):
        return profiles.value_counts(frame, column).select(
            F.lit(name).alias("colonne"), F.col(column).alias("valeur"), "count")

    return (counted(events, "magnitude_family", "magnitude_family")
            .unionByName(counted(events, "review_status", "review_status"))
            .unionByName(counted(events.filter("magnitude_saturated"), "magnitude_type",
                                 "saturated_type")))


# Identity -----------------------------------------------------------------------------------

@query("identity_history", f"""with {FLAT} select event_key, id as usgs_id, all_ids,
  identifier_count, automatic_origin, automatic_origin and not id like 'usauto%'
  as identity_changed, status as review_status, mag as magnitude, magnitude_type, event_time,
  place from current""")
def identity_history(spark, sf):
    rows = identity.identity_history(current_events(spark, sf)).drop("networks",
                                                                    "reporting_network")
    return rows.withColumns({"all_ids": F.array_join("all_ids", ","),
                             "identifier_count": F.col("identifier_count").cast("long")})


@query("identity_loss", f"""with {I}, f as (select ids like '%,usauto%' as traced from i)
select count(*) as catalogue, count(*) filter (traced) as traces,
  count(*) filter (traced) as identite_changee,
  round(100.0 * count(*) filter (traced) / count(*), 1) as part_tracee_pct,
  round(100.0 * count(*) filter (traced) / count(*), 1) as part_changee_pct from f""")
def identity_loss(spark, sf):
    return identity.identity_loss(identity_rows(spark, sf))


@query("alias_histogram", f"""with {I} select len(list_filter(string_split(ids, ','),
  lambda x: x <> ''))::bigint as identifier_count, count(*) as seismes from i group by 1""")
def alias_histogram(spark, sf):
    counts = identity.alias_histogram(identity_rows(spark, sf))
    return counts.withColumn("identifier_count", F.col("identifier_count").cast("long"))


@query("nested_total", f"""with {I} select sum(len(list_filter(string_split(ids, ','),
  lambda x: x <> '')))::bigint as identifiants from i""")
def nested_total(spark, sf):
    return profiles.nested_total(identity_rows(spark, sf), "all_ids", "identifiants")


@query("resolve_identities", f"""with recursive {I}, a as (select usgs_id, unnest(list_filter(
  string_split(ids, ','), lambda x: x <> '')) as alias from i),
shared as (select distinct p.usgs_id as u, q.usgs_id as w from a p join a q
  on p.alias = q.alias where p.usgs_id <> q.usgs_id),
reach as (select usgs_id as u, usgs_id as w from i union
  select r.u, s.w from reach r join shared s on r.w = s.u)
select r.u as usgs_id, min(a.alias) as resolved_key from reach r join a on r.w = a.usgs_id
group by r.u""")
def resolve_identities(spark, sf):
    records = spark_view(spark, sf, identities_sql).select(
        "usgs_id", split_aliases(F.col("ids")).alias("aliases"))
    return identity.resolve_identities(records, "usgs_id", "aliases").drop("aliases")


@query("resolve_identities_increment", ORACLES["resolve_identities"])
def resolve_identities_increment(spark, sf):
    """The records come in three batches, by ranges of their identifier."""
    records = spark_view(spark, sf, identities_sql).select(
        "usgs_id", split_aliases(F.col("ids")).alias("aliases"))
    low, high = F.col("usgs_id") < "us3", F.col("usgs_id") >= "us6"
    known = identity.no_identities(spark)
    for batch in (low, high, ~low & ~high):
        known = identity.extend_identities(known, records.filter(batch), "usgs_id", "aliases")
    return identity.resolved_by(known, records, "usgs_id", "aliases").drop("aliases")


# Witnesses ----------------------------------------------------------------------------------

WITNESS = PAIRED + f""", {H}, w as (select r.event_id, cohort, shift, shift_abs, felt_reports,
  felt_reports >= 5 as has_witness,
  round(community_intensity - instrumental_intensity, 2) as intensity_gap,
  community_intensity - instrumental_intensity > 0 as witness_louder,
  shift >= 0.2 as moved_up, shift <= -0.2 as moved_down
  from revised r join h on r.event_id = h.event_id)"""


@query("witness", f"""with {WITNESS} select event_id, shift, has_witness, intensity_gap,
  witness_louder, moved_up, moved_down from w""")
def witness(spark, sf):
    return witness_rows(spark, sf).select("event_id", "shift", "has_witness", "intensity_gap",
                                          "witness_louder", "moved_up", "moved_down")


@query("witness_report", f"""with {WITNESS} select has_witness, count(*) as seismes,
  round(avg(moved_up::int) * 100, 1) as pct_hausse,
  round(avg(moved_down::int) * 100, 1) as pct_baisse,
  round(avg(shift_abs), 3) as ecart_absolu_moyen from w group by has_witness""")
def witness_report(spark, sf):
    return reports.witness_report(witness_rows(spark, sf))


@query("witness_louder_report", f"""with {WITNESS}, c as (select * from w where has_witness
  and intensity_gap is not null) select witness_louder, count(*) as seismes,
  round(avg(moved_up::int) * 100, 1) as pct_hausse, round(avg(shift), 3) as ecart_moyen,
  round(avg(intensity_gap), 2) as ecart_intensite_moyen from c
  where (select count(*) from c) >= 10 group by witness_louder""")
def witness_louder_report(spark, sf):
    return reports.louder_report(witness_rows(spark, sf))


# Two states of one table --------------------------------------------------------------------

FIRST_STATE, SECOND_STATE = "1998-01-01", "1999-01-01"


def state_at(spark: SparkSession, sf: str, day: str, withdrawn: bool) -> DataFrame:
    """Last version of each event published before ``day``; a withdrawn last version (a closed
    line without scale) takes the event out of the second state."""
    known = versions(spark, sf).filter(F.col("published_at") < F.lit(day).cast("timestamp_ntz"))
    columns = ("place", "event_time", "magnitude", "magnitude_type", "review_status",
               "contributor")
    last = known.groupBy("event_id").agg(
        F.max_by(F.struct(*columns), F.struct(*VERSION_ORDER)).alias("z"))
    state = last.select(F.col("event_id").alias("event_key"), "z.*").withColumnRenamed(
        "contributor", "usgs_id")
    gone = (F.col("magnitude_type") == "ml") & (F.col("review_status") == "reviewed")
    return state.filter(~gone) if withdrawn else state


def difference(spark: SparkSession, sf: str, keep_unchanged: bool = False) -> DataFrame:
    return compare_snapshots(state_at(spark, sf, FIRST_STATE, False),
                             state_at(spark, sf, SECOND_STATE, True),
                             keep_unchanged=keep_unchanged)


def state_sql(name: str, day: str, condition: str) -> str:
    return f"""{name} as (select event_id as event_key, place, event_time, magnitude,
  magnitude_type, review_status, contributor as usgs_id from (select * from v
  where published_at < timestamp '{day}' qualify row_number() over (partition by event_id
  order by {', '.join(f'{c} desc' for c in VERSION_ORDER)}) = 1) {condition})"""


DIFF = f"""{V}, {state_sql('s1', FIRST_STATE, '')},
{state_sql('s2', SECOND_STATE, "where not (magnitude_type = 'ml' and review_status = 'reviewed')")},
d as (select coalesce(s1.event_key, s2.event_key) as event_key, s2.place, s2.event_time,
  s1.magnitude as avant_magnitude, s2.magnitude as apres_magnitude,
  s1.magnitude_type as avant_magnitude_type, s2.magnitude_type as apres_magnitude_type,
  s1.review_status as avant_review_status, s2.review_status as apres_review_status,
  s1.usgs_id as avant_usgs_id, s2.usgs_id as apres_usgs_id,
  case when s1.event_key is null then 'apparu' when s2.event_key is null then 'disparu'
    when s1.magnitude is not distinct from s2.magnitude
      and s1.magnitude_type is not distinct from s2.magnitude_type
      and s1.review_status is not distinct from s2.review_status
      and s1.usgs_id is not distinct from s2.usgs_id then 'inchange' else 'modifie' end
    as statut, round(s2.magnitude - s1.magnitude, 2) as ecart_magnitude
  from s1 full outer join s2 on s1.event_key = s2.event_key)"""


@query("snapshot_diff", f"with {DIFF} select * from d where statut <> 'inchange'")
def snapshot_diff(spark, sf):
    return difference(spark, sf)


@query("snapshot_diff_by_digest", ORACLES["snapshot_diff"])
def snapshot_diff_by_digest(spark, sf):
    """The same from two stored states, of which only unequal buckets are read."""
    before, after = state_at(spark, sf, FIRST_STATE, False), state_at(spark, sf, SECOND_STATE, True)
    buckets = bucket_number(table(spark, sf, "orders").count())
    return compare_states(*[
        store_state(state, new_folder(spark, label), "event_key", COMPARED, buckets)
        for label, state in (("before", before), ("after", after))])


@query("snapshot_diff_summary", f"with {DIFF} select statut, count(*) as count from d group by 1")
def snapshot_diff_summary(spark, sf):
    return diff_summary(difference(spark, sf, keep_unchanged=True))


@query("diff_top_gaps", f"""with {DIFF} select event_key, avant_magnitude, apres_magnitude,
  ecart_magnitude, avant_usgs_id, apres_usgs_id from d where abs(ecart_magnitude) > 0
  order by abs(ecart_magnitude) desc, event_key limit 10""")
def diff_top_gaps(spark, sf):
    return largest_gaps(difference(spark, sf))


# The sections of the bundle are those of other queries, so their sizes are.
BUNDLED = {"overview": "overview", "cohortes": "cohort_comparison", "familles": "family_transitions",
           "seismes": "top_shifts", "temoin_humain": "witness_report", "chronologies": "featured_timelines"}


@query("bundle_sections", " union all ".join(
    f"select '{section}' as section, count(*) as entries from ({ORACLES[name]})" for section, name in BUNDLED.items()))
def bundle_sections(spark, sf):
    """Entries of each section of the export; a line of a timeline has several."""
    return report_bundle(spark, sf).where(F.col("section") != "courbe_alerte").groupBy("section").agg(
        F.sum(F.when(F.col("section") == "chronologies", F.json_array_length("contenu")).otherwise(1)).cast("long")
        .alias("entries"))


# Live records -------------------------------------------------------------------------------

KINDS = E + """, seen as (select *, row_number() over w as pos, lag(magnitude) over w as pm,
  lag(status) over w as ps from e window w as (partition by user_id order by ts, event_id)),
tracked as (select user_id, event_id, ts, magnitude, status,
  case when pos = 1 then 'nouveau' when magnitude is not distinct from pm
    and status is not distinct from ps then 'repete' else 'revise' end as kind, pm, ps
  from seen),
k as (select user_id, event_id, ts, magnitude, status, kind,
  case when kind = 'revise' then pm end as previous_magnitude,
  case when kind = 'revise' then ps end as previous_status from tracked)"""


def tracked(spark: SparkSession, sf: str) -> DataFrame:
    return batch_revisions(spark_view(spark, sf, messages_sql), "user_id", ["ts", "event_id"])


@query("batch_revisions", f"with {KINDS} select * from k")
def batch_revisions_query(spark, sf):
    return tracked(spark, sf)


FEED = KINDS + """, feed as (select user_id, arg_max(event_id, (ts, event_id)) as event_id,
  arg_max(magnitude, (ts, event_id)) as magnitude, count(*) as republications,
  case when bool_or(kind = 'revise') then 'revise' else arg_max(kind, (ts, event_id)) end
    as kind,
  arg_max_null(previous_magnitude, (ts, event_id)) filter (kind = 'revise')
    as previous_magnitude from k group by user_id)"""


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return live.feed_groups(tracked(spark, sf), "user_id", ["ts", "event_id"],
                            ["event_id", "magnitude"], table(spark, sf, "events"))


@query("feed_groups", f"with {FEED} select * from feed")
def feed_groups(spark, sf):
    return feed(spark, sf)


def scored_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in for the model's score, so that SQL can follow the triage."""
    magnitude = F.col("magnitude")
    suspicion = F.when(magnitude.isNotNull(), F.col("event_id") % 100 / 1.0)
    return feed(spark, sf).withColumns({
        "suspicion": suspicion, "suspect": suspicion > 50.0, "in_domain": magnitude >= 1.0,
        "etat": live.domain_state(magnitude, suspicion > 50.0, 1.0)})


SCORED = FEED + """, scored as (select *, (event_id % 100)::double as suspicion,
  event_id % 100 > 50 as suspect, magnitude >= 1 as in_domain,
  case when magnitude < 1 then 'hors_domaine' when event_id % 100 > 50 then 'suspect'
    else 'stable' end as etat,
  case kind when 'revise' then 0 when 'nouveau' then 1 else 2 end as kind_rank from feed)"""


@query("triage_state", f"with {SCORED} select user_id, magnitude, suspicion, etat from scored")
def triage_state(spark, sf):
    return scored_feed(spark, sf).select("user_id", "magnitude", "suspicion", "etat")


@query("triage_order", f"""with {SCORED} select user_id, etat, suspicion, kind,
  row_number() over (order by case when in_domain then suspicion else -1 end desc, kind_rank,
  user_id) as place from scored""")
def triage_order(spark, sf):
    return live.triage_order(scored_feed(spark, sf), "user_id").select(
        "user_id", "etat", "suspicion", "kind", "place")


@query("triage_counts", f"""with {SCORED} select count(*) as scored,
  count(*) filter (in_domain) as in_domain, count(*) filter (in_domain and suspect) as suspects,
  arg_min(user_id, (not in_domain, case when in_domain then -suspicion else 1 end, kind_rank,
  user_id)) as lead from scored""")
def triage_counts(spark, sf):
    return live.triage_counts(scored_feed(spark, sf), "user_id")


@query("latest_events", f"""with {E} select * from e order by ts desc, event_id desc
  limit 400""")
def latest_events(spark, sf):
    return live.latest(spark_view(spark, sf, messages_sql), ["ts", "event_id"])


@query("alarm_flags", f"""with {N} select id, origin, nst < 20 as few_stations,
  gap > 180 as wide_gap, status = 'automatic' as unreviewed from n""")
def alarm_flags(spark, sf):
    flags = live.alarm_flags(F.col("nst"), F.col("gap"), F.col("status"))
    return spark_view(spark, sf, features_sql).select(
        "id", "origin", *[value.alias(name) for name, value in flags.items()])


@query("compact_rings", f"""with {G}, s as (select *, lag(x) over w as px, lag(y) over w as py,
  row_number() over w as pos from g window w as (partition by user_id order by ts, event_id)),
kept as (select *, row_number() over (partition by user_id order by pos) as point,
  count(*) over (partition by user_id) as points from s
  where pos = 1 or x is distinct from px or y is distinct from py)
select user_id, point, x, y, points from kept where points >= 4""")
def compact_rings_query(spark, sf):
    return compact_rings(spark_view(spark, sf, rings_sql), ["user_id"],
                         [F.col("ts"), F.col("event_id")])
