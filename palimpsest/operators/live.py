"""Live records: flattening, regrouping, domain and alarm states, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.scales import family_of, saturation_of
from palimpsest.operators.ordered import order_rows, summarise_keys

# Fixed values.
TRAINING_MINIMUM = 4.0
FEW_STATIONS, WIDE_GAP, AUTOMATIC = 20, 180, "automatic"
NEW, REVISED, REPEATED = "nouveau", "revise", "repete"
KIND_ORDER = {REVISED: 0, NEW: 1, REPEATED: 2}
NOT_PUBLISHED_LIVE = ("first_magnitude_station_count", "first_phase_count",
                      "first_horizontal_error", "first_magnitude_error")
RING_SIZE = 400


def parse_messages(messages: DataFrame, envelope_schema, value: str = "value") -> DataFrame:
    """Flat live records from envelope text. Text that is no envelope, or carries no
    identifier, is ignored; other columns of the message are kept."""
    kept = [name for name in messages.columns if name != value]
    parsed = messages.select(*kept, F.from_json(value, envelope_schema).alias("e"))
    prop, point = F.col("e.raw.properties"), F.col("e.raw.geometry.coordinates")
    fields = {"place": "place", "magnitude": "mag", "magnitude_type": "magType",
              "status": "status", "time": "time", "updated": "updated", "felt": "felt",
              "tsunami": "tsunami", "network": "net", "station_count": "nst",
              "azimuthal_gap": "gap", "minimum_distance": "dmin", "standard_error": "rms",
              "significance": "sig"}
    identifier = F.coalesce(F.nullif(F.col("e.usgs_id"), F.lit("")), F.col("e.raw.id"))
    return (parsed.select(
        *kept, identifier.alias("id"),
        *[prop[source].alias(name) for name, source in fields.items()],
        *[F.get(point, F.lit(at)).alias(name)
          for at, name in enumerate(("longitude", "latitude", "depth"))])
        .filter("id IS NOT NULL AND id <> ''"))


def live_features(records: DataFrame, now: Column) -> DataFrame:
    """Inputs of the model from live records; what the feed does not publish is null."""
    def word(name: str) -> Column:
        return F.lower(F.coalesce(name, F.lit("")))

    elapsed = F.greatest(F.lit(0.0), (now.cast("double") * 1000 - F.col("time")) / 60000.0)
    return records.select(
        *records.columns,
        F.col("magnitude").alias("first_magnitude"),
        F.col("station_count").alias("first_station_count"),
        F.col("azimuthal_gap").alias("first_azimuthal_gap"),
        F.col("minimum_distance").alias("first_minimum_distance"),
        F.col("standard_error").alias("first_standard_error"),
        F.col("depth").alias("first_depth_km"),
        F.col("latitude").alias("first_latitude"), F.col("longitude").alias("first_longitude"),
        F.when(F.col("time").isNotNull(), elapsed).alias("first_minutes_since_quake"),
        saturation_of(F.col("magnitude_type")).alias("first_saturation"),
        word("magnitude_type").alias("first_magnitude_type"),
        word("status").alias("first_review_status"),
        word("network").alias("first_contributor"),
        family_of(F.col("magnitude_type")).alias("first_family"),
        *[F.lit(None).cast("double").alias(name) for name in NOT_PUBLISHED_LIVE])


def domain_state(magnitude: Column, suspect: Column,
                 minimum: float = TRAINING_MINIMUM) -> Column:
    """Null without magnitude; outside the trained range no verdict is given."""
    return (F.when(magnitude < minimum, "hors_domaine")
            .when(magnitude.isNotNull() & suspect, "suspect")
            .when(magnitude.isNotNull(), "stable"))


def alarm_flags(stations: Column, gap: Column, status: Column) -> dict[str, Column]:
    """An absent value raises no alarm."""
    return {"few_stations": F.coalesce(stations < FEW_STATIONS, F.lit(False)),
            "wide_gap": F.coalesce(gap > WIDE_GAP, F.lit(False)),
            "unreviewed": F.coalesce(status == AUTOMATIC, F.lit(False))}


def search_place(frame: DataFrame, text: str, column: str = "place") -> DataFrame:
    """Case-blind substring search; blank text keeps every row."""
    needle = text.strip().lower()
    if not needle:
        return frame
    return frame.filter(F.lower(F.coalesce(column, F.lit(""))).contains(needle))


def feed_groups(messages: DataFrame, key: str, order: list[str], columns: list[str],
                keys_of: DataFrame | None = None) -> DataFrame:
    """Per identifier: the latest message, how often it came, and whether it was revised.

    The previous magnitude is that of the latest revision.
    """
    change = F.struct(F.struct(*order).alias("at"), F.col("previous_magnitude"))
    grouped = summarise_keys(messages, [key], order, [order[0]], [*columns, "kind"], {
        "republications": F.count(F.lit(1)),
        "change": F.max(F.when(F.col("kind") == REVISED, change))}, keys_of)
    return grouped.select(
        key, *[F.col(f"_last.{name}").alias(name) for name in columns], "republications",
        F.when(F.col("change").isNotNull(), REVISED).otherwise(F.col("_last.kind"))
        .alias("kind"),
        F.col("change.previous_magnitude").alias("previous_magnitude"))


def kind_rank(kind: Column) -> Column:
    table = F.create_map(*[F.lit(item) for pair in KIND_ORDER.items() for item in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit(KIND_ORDER[REPEATED]))


def triage_order(scored: DataFrame, tie_break: str) -> DataFrame:
    """All records with their place: suspicion first, of records the model may judge; then by
    kind. The numbers come from ranges of the order, not from one task."""
    weight = F.when(F.col("in_domain"), F.col("suspicion")).otherwise(F.lit(-1.0))
    keyed = scored.withColumns({"_weight": -weight, "_kind": kind_rank(F.col("kind"))})
    return order_rows(keyed, [], [
        F.col("_weight").isNull(), F.col("_weight"), F.col("_kind"), F.col(tie_break)],
        rank="place").drop("_weight", "_kind")


def triage_counts(scored: DataFrame, tie_break: str) -> DataFrame:
    """Scored, in domain, suspects, and the record to look at first: the most suspicious in
    domain, else any scored one."""
    judged = F.col("suspicion").isNotNull()
    weight = F.when(F.col("in_domain"), F.col("suspicion")).otherwise(F.lit(-1.0))
    first = F.struct(~F.col("in_domain"), -weight, kind_rank(F.col("kind")), F.col(tie_break))
    return scored.filter(judged).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if("in_domain").alias("in_domain"),
        F.count_if(F.col("in_domain") & F.col("suspect")).alias("suspects"),
        F.min_by(F.col(tie_break), first).alias("lead"))


def latest(messages: DataFrame, order: list[str], size: int = RING_SIZE) -> DataFrame:
    """The last ``size`` messages."""
    return messages.orderBy(*[F.desc(name) for name in order]).limit(size)
