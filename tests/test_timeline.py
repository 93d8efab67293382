from datetime import datetime

from row_text import rows
from pyspark.sql import functions as F

from palimpsest.operators.pairing import (cohort_report, pairs_by_key, pairs_by_join, revision_columns,
                                          revision_history)
from palimpsest.operators.timeline import (first_copies, moving_share, rank_versions,
                                           revised_events, version_timeline,
                                           versions_per_cohort)

EVENTS = "event_key string, usgs_id string, updated_time timestamp, origin string, " \
         "magnitude double, review_status string"
CONTENT = ("magnitude", "review_status", "usgs_id")


def at(hour):
    return datetime(2025, 1, 1, hour)


def timeline_of(spark, data, **options):
    return version_timeline(first_copies(spark.createDataFrame(data, EVENTS), CONTENT), **options)


def test_same_content_again_is_not_a_version(spark):
    kept = first_copies(spark.createDataFrame([
        ("a", "us1", at(2), "live", 4.0, "automatic"),
        ("a", "us1", at(1), "catalog", 4.0, "automatic"),
        ("a", "us1", at(1), "live", 4.0, "automatic"),
        ("a", "us1", None, "live", 4.0, "automatic"),
        ("a", "us2", at(3), "live", 4.0, "automatic")], EVENTS), CONTENT)
    assert [(r.usgs_id, r.updated_time, r.origin) for r in kept.orderBy("usgs_id").collect()] == [
        ("us1", at(1), "catalog"), ("us2", at(3), "live")]


def test_copies_are_cut_before_the_shuffle(spark):
    frame = first_copies(spark.createDataFrame([], EVENTS), CONTENT)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_timeline(spark):
    got = timeline_of(spark, [
        ("a", "us1", at(1), "live", 4.0, "automatic"),
        ("a", "us1", at(3), "live", 4.4, "reviewed"),
        ("a", "us1", None, "live", 4.5, "reviewed"),
        ("b", "us9", at(5), "live", None, "automatic")]).orderBy("event_key", "version")
    assert [tuple(r) for r in got.select(
        "event_key", "version", "valid_to", "is_current", "previous_magnitude",
        "magnitude_delta", "previous_status").collect()] == [
        ("a", 1, at(3), False, None, None, None),
        ("a", 2, None, False, 4.0, 0.4, "automatic"),
        ("a", 3, None, True, 4.4, 0.1, "reviewed"),
        ("b", 1, None, True, None, None, None)]


def test_one_current_row_when_all_times_are_null(spark):
    data = [("a", f"us{i}", None, "live", float(i), "automatic") for i in range(40)]
    for limit in (10, 1000):
        timeline = timeline_of(spark, data, rows_per_task=limit)
        assert timeline.filter("is_current").count() == 1
        assert revised_events(timeline).first() == (1, 1)


VERSIONS = "event_id string, cohort string, place string, event_time timestamp, " \
           "published_epoch_ms bigint, contributor_code string, magnitude double, " \
           "magnitude_type string, station_count bigint"
ORDER = ("published_epoch_ms", "contributor_code")


def versions(spark):
    epoch = 1735689600
    return spark.createDataFrame([
        ("one", "traced", "p", datetime(2025, 1, 1), epoch * 1000 + 90500, "a", 5.0, "mb", 10),
        ("two", "traced", "p", datetime(2025, 1, 1), epoch * 1000 + 60000, "a", 5.0, "mb", 10),
        ("two", "traced", "p", datetime(2025, 1, 1), epoch * 1000 + 60000, "b", 5.04, "mb", 12),
        ("two", "traced", "p", datetime(2025, 1, 1), epoch * 1000 + 120000, "a", 5.6, "mww", 40),
        ("six", "control", "p", datetime(2025, 1, 1), epoch * 1000, "a", 6.0, "mww", 4),
        ("six", "control", "p", datetime(2025, 1, 1), epoch * 1000 + 600000, "a", 5.9, "mww",
         None)], VERSIONS)


def test_ranks_and_minutes(spark):
    ranked = rank_versions(versions(spark)).orderBy("event_id", "version_rank")
    assert [tuple(r) for r in ranked.select(
        "event_id", "version_rank", "version_count", "is_first", "is_last", "magnitude_step",
        "minutes_since_quake").collect()] == [
        ("one", 1, 1, True, True, None, 1.51),
        ("six", 1, 2, True, False, None, 0.0), ("six", 2, 2, False, True, -0.1, 10.0),
        ("two", 1, 3, True, False, None, 1.0), ("two", 2, 3, False, False, 0.04, 1.0),
        ("two", 3, 3, False, True, 0.56, 2.0)]
    assert moving_share(ranked).first() == (3, 2, 66.7)
    assert sorted(map(tuple, versions_per_cohort(ranked).collect())) == [
        ("control", 1, 2, 2.0, 2), ("traced", 2, 4, 2.0, 3)]


def test_join_and_aggregate_give_the_same_pairs(spark):
    sides = dict(first=("magnitude", "magnitude_type", "station_count", "minutes_since_quake"),
                 final=("magnitude", "magnitude_type", "station_count", "minutes_since_quake"))
    joined = pairs_by_join(rank_versions(versions(spark)), **sides)
    grouped = pairs_by_key(versions(spark), ORDER, **sides)
    assert rows(joined) == rows(grouped.select(joined.columns))
    revised = {row.event_id: row for row in revision_columns(grouped).collect()}
    assert revised["one"].direction == "stable" and revised["one"]["shift"] == 0.0
    assert revised["two"].direction == "hausse" and revised["two"].scale_changed
    assert revised["six"].direction == "baisse" and revised["six"].station_growth is None
    assert revised["two"].first_saturation == 6.5 and not revised["two"].first_near_saturation
    assert revised["two"].review_delay_minutes == 1.0


def test_pairs_by_key_take_one_shuffle_and_no_sort_aggregate(spark):
    plan = pairs_by_key(versions(spark), ORDER, first=("magnitude",), final=("magnitude",))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "SortAggregate" not in text and text.count("Sort ") == 1


def test_pairs_of_hot_keys_are_the_same(spark):
    sides = dict(first=("magnitude", "magnitude_type"), final=("magnitude", "station_count"))
    cold = pairs_by_key(versions(spark), ORDER, **sides)
    hot = pairs_by_key(versions(spark), ORDER, **sides, rows_per_task=1)
    assert rows(cold) == rows(hot)


def test_history_keeps_null_ends(spark):
    columns = {name: F.lit(None).cast("double") for name in (
        "station_count", "azimuthal_gap", "residual_rms")}
    timeline = timeline_of(spark, [
        ("a", "us1", at(1), "live", None, "automatic"),
        ("a", "us1", at(3), "live", 4.4, "reviewed"),
        ("b", "us1", at(3), "live", 4.4, "reviewed")]).withColumns({
            **columns, "place": F.lit("p"), "event_time": F.lit(at(0)),
            "magnitude_type": F.lit("mb"), "magnitude_family": F.lit("body_wave")})
    row, = revision_history(timeline).collect()
    assert (row.event_key, row.versions, row.first_magnitude, row.final_magnitude,
            row.magnitude_shift, row.minutes_to_final) == ("a", 2, None, 4.4, None, 120.0)


def test_a_null_cohort_has_its_median(spark):
    rows_ = [("a", 1.0), ("a", 2.0), ("a", 3.0), (None, 5.0), (None, 6.0), (None, 7.0)]
    frame = spark.createDataFrame([(c, s, abs(s), True) for c, s in rows_],
                                  "cohort string, shift double, shift_abs double, moved boolean")
    for exact in (True, False):
        got = {r.cohort: (r.seismes, r.ecart_abs_median) for r in cohort_report(frame, exact).collect()}
        assert got == {"a": (3, 2.0), None: (3, 6.0)}
