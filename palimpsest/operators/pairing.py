"""First against final: what was announced and what was retained."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.moments import minutes_after
from palimpsest.functions.scales import family_of, saturation_of
from palimpsest.operators.ordered import summarise_keys
from palimpsest.operators.quantiles import approximate, exact_quantiles_of
from palimpsest.operators.skew import ROWS_PER_TASK, same_keys

MOVEMENT_THRESHOLD = 0.05
SATURATION_MARGIN = 1.0
# Event columns, and the version columns kept on each side.
EVENT_COLUMNS = ("cohort", "place", "event_time")
FIRST_COLUMNS = ("magnitude", "magnitude_type", "review_status", "contributor", "station_count",
                 "magnitude_station_count", "azimuthal_gap", "minimum_distance", "phase_count",
                 "standard_error", "horizontal_error", "magnitude_error", "depth_km",
                 "latitude", "longitude", "minutes_since_quake")
FINAL_COLUMNS = ("magnitude", "magnitude_type", "review_status", "contributor",
                 "station_count", "azimuthal_gap", "minutes_since_quake")


def pairs_by_join(ranked: DataFrame, event_columns: Sequence[str] = EVENT_COLUMNS,
                  first: Sequence[str] = FIRST_COLUMNS,
                  final: Sequence[str] = FINAL_COLUMNS) -> DataFrame:
    """Pairs from ranked versions: the flags leave one row per event on either side."""
    left = ranked.filter("is_first").select(
        "event_id", *event_columns, "version_count",
        *[F.col(name).alias(f"first_{name}") for name in first])
    right = ranked.filter("is_last").select(
        "event_id", *[F.col(name).alias(f"final_{name}") for name in final])
    return left.join(right, "event_id")


def pairs_by_key(versions: DataFrame, order: Sequence[str],
                 event_columns: Sequence[str] = EVENT_COLUMNS,
                 first: Sequence[str] = FIRST_COLUMNS,
                 final: Sequence[str] = FINAL_COLUMNS, keys_of: DataFrame | None = None,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The same pairs from unranked versions, in one shuffle. ``keys_of`` may name a frame that
    is cheaper to search for hot keys (see ``order_rows``)."""
    if "minutes_since_quake" not in versions.columns:
        versions = versions.withColumn("minutes_since_quake", minutes_after(
            F.col("published_epoch_ms"), F.col("event_time")))
    ends = summarise_keys(versions, ["event_id"], order, list(dict.fromkeys((*event_columns, *first))),
                          final, {"version_count": F.count(F.lit(1))}, keys_of, rows_per_task)
    return ends.select(
        "event_id", *[F.col(f"_first.{name}").alias(name) for name in event_columns],
        "version_count",
        *[F.col(f"_first.{name}").alias(f"first_{name}") for name in first],
        *[F.col(f"_last.{name}").alias(f"final_{name}") for name in final])


def direction_of(shift: Column, threshold: float = MOVEMENT_THRESHOLD) -> Column:
    return (F.when(shift >= threshold, "hausse").when(shift <= -threshold, "baisse")
            .otherwise("stable"))


def revision_columns(pairs: DataFrame) -> DataFrame:
    """Shift, direction, change of scale and distance to saturation of each pair."""
    column = F.col
    shift = F.round(column("final_magnitude") - column("first_magnitude"), 2)
    moved = pairs.withColumn("shift", shift)
    return moved.withColumns({
        "shift_abs": F.abs("shift"),
        "moved": F.abs("shift") >= MOVEMENT_THRESHOLD,
        "direction": direction_of(column("shift")),
        "first_family": family_of(column("first_magnitude_type")),
        "final_family": family_of(column("final_magnitude_type")),
        "scale_changed": column("first_magnitude_type") != column("final_magnitude_type"),
        "first_saturation": saturation_of(column("first_magnitude_type")),
        "first_near_saturation": column("first_magnitude")
        >= saturation_of(column("first_magnitude_type")) - SATURATION_MARGIN,
        "station_growth": column("final_station_count") - column("first_station_count"),
        "review_delay_minutes": F.round(column("final_minutes_since_quake")
                                        - column("first_minutes_since_quake"), 1)})


def revision_history(timeline: DataFrame, keys_of: DataFrame | None = None) -> DataFrame:
    """Keys with several versions: first, last, extent."""
    ends = summarise_keys(
        timeline, ["event_key"], ["version"], ["magnitude", "review_status"],
        ["magnitude", "review_status", "place", "event_time", "magnitude_type",
         "magnitude_family", "station_count", "azimuthal_gap", "residual_rms"],
        {"versions": F.count(F.lit(1)), "first_seen": F.min("valid_from"),
         "last_seen": F.max("valid_from")}, keys_of)
    ends = ends.withColumnsRenamed({"_first": "a", "_last": "z"})
    shift = F.round(F.col("z.magnitude") - F.col("a.magnitude"), 2)
    return ends.filter("versions > 1").select(
        "event_key", "z.place", "z.event_time", "versions",
        F.col("a.magnitude").alias("first_magnitude"),
        F.col("z.magnitude").alias("final_magnitude"),
        shift.alias("magnitude_shift"), F.abs(shift).alias("magnitude_shift_abs"),
        F.col("a.review_status").alias("first_status"),
        F.col("z.review_status").alias("final_status"),
        "z.magnitude_type", "z.magnitude_family", "z.station_count", "z.azimuthal_gap",
        "z.residual_rms",
        F.round((F.col("last_seen").cast("long") - F.col("first_seen").cast("long"))
                / F.lit(60.0), 1).alias("minutes_to_final"))


def percent(condition: str) -> Column:
    """Share of true among the rows where the flag is known."""
    return F.round(F.avg(F.col(condition).cast("int")) * 100, 1)


def _with_median(frame: DataFrame, groups: Sequence[str], columns: Sequence[Column],
                 medians: dict[str, tuple[str, int]], exact: bool) -> DataFrame:
    """Grouped aggregate plus medians: alias -> (column, digits)."""
    if not exact:
        return frame.groupBy(*groups).agg(*columns, *[
            F.round(approximate(F.col(source), 0.5), digits).alias(name)
            for name, (source, digits) in medians.items()])
    # The rows are read twice, once for the sums and once for the counts of values.
    result = frame.groupBy(*groups).agg(*columns)
    marks = exact_quantiles_of(frame, groups, {
        name: (source, 0.5) for name, (source, _) in medians.items()})
    rounded = marks.select(*groups, *[F.round(name, digits).alias(name)
                                      for name, (_, digits) in medians.items()])
    if groups:
        # Report sized: one row per group on both sides; a null group is a group.
        return result.join(rounded, same_keys(result, rounded, groups), "left").select(
            *[result[name] for name in result.columns], *[rounded[name] for name in medians])
    found = rounded.first()
    return result.withColumns({name: F.lit(found[name]).cast("double") for name in medians})


def cohort_report(dataset: DataFrame, exact: bool = False) -> DataFrame:
    return _with_median(dataset, ["cohort"], [
        F.count(F.lit(1)).alias("seismes"), percent("moved").alias("pct_modifie"),
        F.round(F.avg("shift"), 3).alias("ecart_moyen"),
        F.round(F.max("shift_abs"), 2).alias("ecart_abs_max")],
        {"ecart_abs_median": ("shift_abs", 2)}, exact)


def family_report(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy("first_family").agg(
        F.count(F.lit(1)).alias("seismes"), F.round(F.avg("shift"), 3).alias("ecart_moyen"),
        percent("scale_changed").alias("pct_changement_echelle"))


def cohort_comparison(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("seismes"), percent("moved").alias("pct_deplace"),
        F.round(F.avg("shift"), 3).alias("ecart_moyen"),
        percent("scale_changed").alias("pct_changement_echelle"))


def family_transitions(dataset: DataFrame, top: int = 20) -> DataFrame:
    return (dataset.groupBy("first_family", "final_family").agg(
        F.count(F.lit(1)).alias("seismes"), F.round(F.avg("shift"), 3).alias("ecart_moyen"))
        .orderBy(F.desc("seismes"), "first_family", "final_family").limit(top))


def overview(dataset: DataFrame, versions: DataFrame, identity: DataFrame | None = None,
             exact: bool = False) -> DataFrame:
    """One row: totals of the pairs, of the versions and of the catalogue."""
    totals = _with_median(dataset, [], [
        F.count(F.lit(1)).alias("apparies"), F.count_if("moved").alias("deplaces"),
        F.round(F.avg("shift"), 3).alias("ecart_moyen"),
        F.round(F.max("shift_abs"), 2).alias("ecart_max"),
        F.count_if("scale_changed").alias("changements_echelle")],
        {"ecart_median": ("shift_abs", 2),
         "delai_premiere_publication": ("first_minutes_since_quake", 1),
         "delai_stabilisation": ("review_delay_minutes", 1)}, exact)
    rows = [totals, versions.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.sum("_n").alias("versions_totales"), F.count(F.lit(1)).alias("seismes_suivis"))]
    if identity is not None:
        rows.append(identity.agg(F.count(F.lit(1)).alias("catalogue"),
                                 F.count_if("identity_changed").alias("identite_changee")))
    return one_row(rows)


def one_row(rows: Sequence[DataFrame]) -> DataFrame:
    """Frames of one row each, side by side."""
    names = [name for frame in rows for name in frame.columns]
    stacked = rows[0]
    for frame in rows[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in names])


def top_shifts(dataset: DataFrame, top: int = 160) -> DataFrame:
    """Largest shifts; equal shifts by identifier."""
    return dataset.orderBy(F.desc("shift_abs"), "event_id").limit(top)


def featured_timelines(ranked: DataFrame, dataset: DataFrame, columns: Sequence[str],
                       top: int = 160) -> DataFrame:
    """Versions of the events with the largest shifts, one row each. The broadcast side has
    ``top`` rows by construction."""
    keys = top_shifts(dataset, top).select("event_id")
    return (ranked.join(F.broadcast(keys), "event_id", "left_semi")
            .select("event_id", *columns))
