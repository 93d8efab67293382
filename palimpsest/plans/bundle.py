"""One export for readers: report sections and the timelines of featured events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Versions per line of an exported timeline: a long history takes several lines.
PAGE_ROWS = 1000
TIMELINE_COLUMNS = ("version_rank", "published_at", "contributor", "magnitude",
                    "magnitude_type", "review_status", "station_count", "azimuthal_gap",
                    "minutes_since_quake", "depth_km")


def section(frame: DataFrame, name: str) -> DataFrame:
    """Rows of a report as JSON text under a section name."""
    return frame.select(F.lit(name).alias("section"), F.lit(None).cast("string").alias("cle"),
                        F.lit(0).cast("long").alias("page"),
                        F.to_json(F.struct(*frame.columns)).alias("contenu"))


def timeline_section(versions: DataFrame, key: str, rank: str,
                     name: str = "chronologies") -> DataFrame:
    """Timelines as JSON arrays in order, at most PAGE_ROWS versions to a line."""
    entry = F.struct(*[F.col(rank), *[F.col(c) for c in versions.columns if c not in (key, rank)]])
    paged = versions.withColumn("page", F.floor((F.col(rank) - 1) / PAGE_ROWS).cast("long"))
    return (paged.groupBy(key, "page").agg(F.array_sort(F.collect_list(entry)).alias("lines"))
            .select(F.lit(name).alias("section"), F.col(key).cast("string").alias("cle"),
                    "page", F.to_json("lines").alias("contenu")))


def build_bundle(reports: Mapping[str, DataFrame | None], versions: DataFrame, key: str,
                 rank: str) -> DataFrame:
    """All sections as lines of (section, key, page, JSON); absent reports are left out."""
    lines = timeline_section(versions, key, rank)
    for name, frame in reports.items():
        if frame is not None:
            lines = lines.unionByName(section(frame, name))
    return lines


def write_bundle(bundle: DataFrame, path: str, sections: Sequence[str] = ()) -> None:
    chosen = bundle.filter(F.col("section").isin(list(sections))) if sections else bundle
    chosen.write.mode("overwrite").partitionBy("section").json(path)
