import os
import random
import shutil

import pytest
from pyspark.sql import functions as F
from row_text import rows

from palimpsest.operators import digests
from palimpsest.operators.digests import compare_states, digest_nodes, digest_rows, store_state, unequal_buckets
from palimpsest.operators.snapshot_diff import COMPARED, compare_snapshots

SCHEMA = "event_key string, place string, event_time long, magnitude double, magnitude_type string, review_status string, usgs_id string"


def state(seed=0, changed=(), gone=(), more=()):
    rng = random.Random(seed)
    data = {f"k{at}": (f"k{at}", "p", at, rng.choice([None, 1.0, 2.5]), rng.choice(["mb", None]), "automatic", f"u{at}")
            for at in range(400)}
    for key in changed:
        data[key] = (*data[key][:3], 9.0, *data[key][4:])
    for key in gone:
        del data[key]
    return [*data.values(), *((key, "p", 0, 1.0, "mb", "x", "u") for key in more)]


def stored(spark, folder, name, data, buckets=64):
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    return store_state(frame, f"{folder}/{name}", "event_key", COMPARED, buckets)


def test_what_differs_is_found_in_few_buckets(spark, tmp_path):
    one, two = state(), state(changed=["k7", "k8"], gone=["k100"], more=["new", None])
    random.Random(1).shuffle(two)
    before, after = stored(spark, tmp_path, "before", one), stored(spark, tmp_path, "after", two)
    whole = compare_snapshots(spark.createDataFrame(one, SCHEMA), spark.createDataFrame(two, SCHEMA))
    found = compare_states(before, after)
    assert rows(found.select(whole.columns)) == rows(whole) and whole.count() == 5
    wanted = unequal_buckets(before, after, fan_out=8)
    assert wanted == unequal_buckets(before, after) and 0 < len(wanted) <= 5
    # Folders of equal buckets are not read: they can be away.
    for name in ("before", "after"):
        for folder in os.listdir(f"{tmp_path}/{name}/rows"):
            if folder.startswith("bucket=") and int(folder[7:]) not in wanted:
                shutil.move(f"{tmp_path}/{name}/rows/{folder}", f"{tmp_path}/away-{name}-{folder}")
    found = compare_states(before, after)
    assert rows(found.select(whole.columns)) == rows(whole)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [bucket") == 2


def test_equal_states_read_nothing(spark, tmp_path):
    before, after = stored(spark, tmp_path, "a", state()), stored(spark, tmp_path, "b", state()[::-1])
    assert unequal_buckets(before, after) == []
    assert compare_states(before, after).collect() == []


def test_empty_states(spark, tmp_path):
    none, some = stored(spark, tmp_path, "none", []), stored(spark, tmp_path, "some", state()[:3])
    assert unequal_buckets(none, none) == []
    assert {r.statut for r in compare_states(none, some).collect()} == {"apparu"}
    with pytest.raises(ValueError):
        unequal_buckets(none, stored(spark, tmp_path, "other", [], buckets=16))


def test_nulls_moved_between_columns_and_repeated_rows_change_a_digest(spark):
    def mark(data):
        return digest_rows(spark.createDataFrame(data, "bucket int, a string, b string"), ["a", "b"]).collect()

    assert mark([(0, "x", None)]) != mark([(0, None, "x")])
    assert mark([(0, "x", "y"), (0, "z", None)]) == mark([(0, "z", None), (0, "x", "y")])
    assert mark([(0, "x", "y")] * 2) != mark([(0, "x", "y")]) != mark([(0, "x", "y")] * 3)
    nodes = digest_nodes(digest_rows(spark.range(300).select(
        (F.col("id") % 100).cast("int").alias("bucket"), "id"), ["id"]), 10)
    assert nodes.count() == 10


def test_buckets_grow_with_the_rows():
    assert [digests.bucket_number(rows) for rows in (0, 10**6, 10**8, 10**12)] == [16, 16, 512, 4096]
