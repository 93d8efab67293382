import random

import pytest

from palimpsest.operators.thresholds import (CURVE_THRESHOLDS, alert_curve, alert_reliability,
                                             crossing)

SCHEMA = "first_magnitude double, final_magnitude double"


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(3)
    drawn = [(round(rng.uniform(2.5, 7.5), 1), round(rng.uniform(2.5, 7.5), 1))
             for _ in range(500)]
    return drawn + [(None, 5.0), (5.0, None), (None, None)]


def test_curve_against_brute_force(spark, pairs):
    got = alert_curve(spark.createDataFrame(pairs, SCHEMA)).collect()
    assert [row.threshold for row in got] == list(CURVE_THRESHOLDS)
    known = [(a, c) for a, c in pairs if a is not None and c is not None]
    for row in got:
        t = row.threshold
        assert row.seismes == len(pairs)
        assert row.alerte_justifiee == sum(a >= t and c >= t for a, c in known)
        assert row.fausse_alerte == sum(a >= t and c < t for a, c in known)
        assert row.alerte_manquee == sum(a < t and c >= t for a, c in known)
        assert row.silence_justifie == sum(a < t and c < t for a, c in known)


def test_denominators_differ(spark):
    frame = spark.createDataFrame([(3.0, 5.0), (5.0, 5.0), (3.0, 3.0), (3.0, 3.0)], SCHEMA)
    reliable = alert_reliability(frame, thresholds=[4.0]).first()
    curve = alert_curve(frame, thresholds=[4.0]).first()
    assert reliable.miss_rate == 0.25 and curve.taux_manque_pct == 50.0


def test_no_alert_gives_null_and_no_error(spark):
    frame = spark.createDataFrame([(3.0, 3.0)], SCHEMA)
    row = alert_curve(frame, thresholds=[6.0]).first()
    assert row.alertes_emises == 0 and row.taux_fausse_alerte_pct is None
    assert alert_reliability(frame, thresholds=[6.0]).first().false_alert_rate is None
    assert crossing(alert_curve(frame, thresholds=[6.0])).count() == 0


def test_empty_input_gives_an_empty_table(spark):
    assert alert_curve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pairs_are_counted_before_they_are_spread(spark, pairs):
    plan = alert_curve(spark.createDataFrame(pairs, SCHEMA))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Join" not in text and "Cartesian" not in text
    assert text.index("Generate") < text.index("functions=[partial_count(1)")


def test_crossing(spark):
    frame = spark.createDataFrame(
        [(1.0, 10.0, 30.0), (2.0, 18.0, 20.0), (3.0, 22.0, 20.0), (4.0, None, 1.0)],
        "threshold double, taux_fausse_alerte_pct double, taux_manque_pct double")
    assert crossing(frame).first().threshold == 2.0
