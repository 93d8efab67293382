import random

import pytest
from pyspark.sql import functions as F
from row_text import rows

from palimpsest.operators import identity
from palimpsest.operators.identity import identity_history, identity_loss, resolve_identities


def resolved(spark, data, **options):
    frame = spark.createDataFrame(data, "id string, aliases array<string>")
    return {row.id: row.resolved_key
            for row in resolve_identities(frame, "id", "aliases", **options).collect()}


def brute_force(data):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for identifier, aliases in data:
        for alias in [identifier, *(a for a in aliases or [] if a)]:
            low, high = sorted((root(identifier), root(alias)))
            parent[high] = low
    return {identifier: root(identifier) for identifier, _ in data}


def test_chain_of_four_hundred(spark):
    data = [(f"z{at:03}", [f"ch{at:03}", f"ch{at + 1:03}"]) for at in range(400)]
    assert set(resolved(spark, data).values()) == {"ch000"}


def test_one_alias_on_ten_thousand_records(spark):
    data = [(f"id{at:05}", ["shared"]) for at in range(10_000)]
    got = resolved(spark, data, rows_per_task=1000)
    assert len(got) == 10_000 and set(got.values()) == {"id00000"}


@pytest.mark.parametrize("limit", [4, 1_000_000])
def test_random_graphs_against_union_find(spark, limit):
    rng = random.Random(limit)
    data = [(f"r{at:03}", [f"a{rng.randrange(150)}" for _ in range(rng.randrange(3))] or None)
            for at in range(200)]
    data += [("lonely", []), ("holes", [None, "a3"])]
    assert resolved(spark, data, rows_per_task=limit) == brute_force(
        [(i, [x for x in a or [] if x]) for i, a in data])


def test_a_record_without_identifiers_has_no_key(spark):
    frame = spark.createDataFrame([(None, None), (None, [None]), (None, ["b"])], "i string, a array<string>")
    assert [r.resolved_key for r in resolve_identities(frame, "i", "a").collect()] == [None, None, "b"]


def test_growing_alias_set_keeps_one_key(spark):
    """The smallest alias changes between publications; shared aliases still join them."""
    got = resolved(spark, [("us2", ["us2", "nc5"]), ("us2b", ["us2b", "nc5", "ak1"])])
    assert got == {"us2": "ak1", "us2b": "ak1"}


def test_identity_changed_needs_a_replaced_automatic_identifier(spark):
    frame = spark.createDataFrame([
        ("a", "us1", ["us1", "usauto1"]), ("b", "usauto2", ["usauto2"]), ("c", "us3", ["us3"])],
        "event_key string, usgs_id string, all_ids array<string>")
    blank = ("networks", "reporting_network", "review_status", "magnitude", "magnitude_type",
             "event_time", "place")
    history = identity_history(frame.withColumns({n: F.lit(None) for n in blank}))
    got = {r.event_key: (r.identifier_count, r.automatic_origin, r.identity_changed)
           for r in history.collect()}
    assert got == {"a": (2, True, True), "b": (1, True, False), "c": (1, False, False)}
    assert identity_loss(history).first() == (3, 2, 1, 66.7, 33.3)


def increments(spark, batches):
    known = identity.no_identities(spark)
    for batch in batches:
        known = identity.extend_identities(known, spark.createDataFrame(batch, RECORDS), "id", "aliases")
    return known


RECORDS = "id string, aliases array<string>"


def test_batches_give_what_the_whole_gives(spark):
    rng = random.Random(9)
    data = [(f"r{at:03}", rng.choice([None, [], [f"x{rng.randrange(60)}", None, f"x{rng.randrange(60)}"]]))
            for at in range(120)]
    data += [(None, ["x5", "zz"]), (None, None), ("r003", ["x1"]), ("r003", ["x1"])]
    rng.shuffle(data)
    batches = [data[:20], data[20:21], [], data[21:70], data[70:], data[:5]]
    batches = [batch or [(None, None)] for batch in batches]
    whole = spark.createDataFrame(data, RECORDS)
    expected = identity.resolve_identities(whole, "id", "aliases")
    known = increments(spark, batches)
    assert rows(identity.resolved_by(known, whole, "id", "aliases")) == rows(expected)
    assert known.nodes.count() == known.nodes.select("node").distinct().count()
    assert known.moved.count() == known.moved.select("label").distinct().count()


def test_a_batch_walks_its_own_edges(spark, monkeypatch):
    """A long stored chain is one node to the batch that joins it with another."""
    chain = [(f"a{at:03}", [f"a{at + 1:03}"]) for at in range(60)]
    other = [(f"b{at:03}", [f"b{at + 1:03}"]) for at in range(60)]
    known = increments(spark, [chain, other])
    walked = []
    plain = identity._labels
    monkeypatch.setattr(identity, "_labels", lambda pairs, rows: walked.append(pairs.count()) or plain(pairs, rows))
    known = identity.extend_identities(known, spark.createDataFrame([("a030", ["b040", "new"])], RECORDS), "id", "aliases")
    assert walked == [2]
    found = identity.resolved_by(known, spark.createDataFrame([("b059", []), ("new", None), ("a060", None)], RECORDS),
                                 "id", "aliases")
    assert {row.resolved_key for row in found.collect()} == {"a000"}
    assert known.moved.count() == 1
