"""From landed files to versioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.normalise import (active_versions, explode_versions,
                                            flatten_features, union_sources)
from palimpsest.operators.timeline import first_copies, rank_versions, version_timeline
from palimpsest.sources.files import read_documents, read_envelopes
from palimpsest.sources.ingest import BatchLanding, EmptyCheck
from palimpsest.sources.schemas import VERSIONS
from palimpsest.sources.snapshots import SnapshotTable


def events_timeline(spark: SparkSession, catalog: str | Sequence[str] | None,
                    live: str | Sequence[str] | None) -> DataFrame:
    """Timeline of every event seen in catalogue documents or live envelopes."""
    frames = [flatten_features(read_documents(spark, catalog), "catalog") if catalog else None,
              flatten_features(read_envelopes(spark, live), "live") if live else None]
    events = union_sources(frames)
    return version_timeline(first_copies(events), keys_of=events)


def store_events(timeline: DataFrame, table: SnapshotTable) -> int:
    return table.merge(timeline, ["event_key", "fingerprint"])


def version_history(landing: BatchLanding) -> DataFrame:
    """Ranked active versions of every event in the version documents of marked batches; raises
    when no batch is marked. Hot keys are looked for among the identifiers of the documents, so
    the property maps are decoded once, before the shuffle."""
    lines = landing.landed()
    if landing.manifest().isEmpty():
        raise EmptyCheck(f"no batch is marked under {landing.root}")
    documents = lines.select(F.from_json("value", VERSIONS).alias("d")).select("d.*")
    keys = lines.select(F.get_json_object("value", "$.event_id").alias("event_id"))
    return rank_versions(active_versions(explode_versions(documents)), keys_of=keys)
