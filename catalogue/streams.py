"""Queries on streams. Messages land in slices of time; after each slice the stream runs until
it has read everything, so state and offsets are carried over restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.batch import KINDS, flat_events, messages_sql, spark_view
from catalogue.registry import query, table
from catalogue.views import E, FLAT
from palimpsest.functions.content import fingerprint
from palimpsest.scratch import all_files_there, new_folder
from palimpsest.session import STATE_STORE
from palimpsest.streaming import landing, rates, reorder, revisions, ring, sink
from palimpsest.streaming.sessions import sessions

SLICES = 3
ADMITTED = {"maxFilesPerTrigger": "1000"}


def run_slices(frame: DataFrame, time: str, label: str,
               start: Callable[[DataFrame, str, str], object]) -> str:
    """Land ``frame`` in slices of ``time`` and run the stream after each. ``start`` gets the
    stream, an output folder and a checkpoint folder, and starts a query that ends by itself."""
    spark = frame.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    folder = new_folder(spark, label)
    first, last = frame.agg(F.min(time), F.max(time)).first()
    # Rows without a time land first; a table without any time lands at once.
    cuts = [] if first is None else [first + (last - first) / SLICES * at for at in range(1, SLICES)]
    for at in range(len(cuts) + 1):
        piece = frame.filter(F.col(time) >= F.lit(cuts[at - 1])) if at else frame
        if at < len(cuts):
            early = F.col(time) < F.lit(cuts[at])
            piece = piece.filter(early if at else early | F.col(time).isNull())
        piece.write.mode("append").parquet(f"{folder}/in")
        stream = landing.read_stream(spark, "parquet", ADMITTED, frame.schema, f"{folder}/in")
        start(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/out"


def append_parquet(frame: DataFrame, out: str, checkpoint: str):
    return (frame.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())


@query("stream_to_bronze", """select event_id || '|' || user_id || '|' || event_type || '|'
  || props as value, strftime(ts, '%Y-%m-%d') as ingest_date from events""")
def stream_to_bronze(spark, sf):
    events = table(spark, sf, "events")
    messages = events.select(
        F.concat_ws("|", "event_id", "user_id", "event_type", "props").cast("binary")
        .alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))
    out = run_slices(messages, "timestamp", "bronze", lambda stream, path, checkpoint:
                     landing.land(landing.bronze_rows(stream), path, checkpoint, True))
    return landing.read_landed(spark, out)


_TRACKED: dict[tuple[str, str], DataFrame] = {}


def tracked(spark: SparkSession, sf: str) -> DataFrame:
    """Output of the stream, run once per application and again when its files are gone."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRACKED or not all_files_there(_TRACKED[key]):
        messages = spark_view(spark, sf, messages_sql)
        out = run_slices(messages, "ts", "tracked", lambda stream, path, checkpoint: append_parquet(
            revisions.stream_revisions(stream, "user_id", ["ts", "event_id"]), path, checkpoint))
        _TRACKED[key] = spark.read.parquet(out)
    return _TRACKED[key]


@query("stream_revisions", f"with {KINDS} select * from k")
def stream_revisions(spark, sf):
    return tracked(spark, sf)


@query("stream_counters", f"""with {KINDS} select count(*) as messages_total,
  count(distinct user_id) as seismes_distincts,
  count(*) filter (kind = 'nouveau') as premieres_apparitions,
  count(*) filter (kind = 'revise') as revisions_captees,
  count(*) filter (kind = 'repete') as repetitions from k""")
def stream_counters(spark, sf):
    return revisions.counters(tracked(spark, sf), "user_id")


# Messages come up to five hours late, the streams wait six; a day of silence ends what is known.
LATE = "ts + interval '1' minute * (event_id * 7919 % 300)"
DELAY, QUIET = "6 hours", 24 * 3600
PASSED = "epoch_ms(ts) < (select epoch_ms(max(ts)) from e) - 6 * 3600000"


def late_slices(spark: SparkSession, sf: str, label: str, start) -> str:
    """Messages in slices by the time they come, which is not that of their production."""
    messages = spark_view(spark, sf, messages_sql).withColumn("ts", F.col("ts").cast("timestamp"))
    come = messages.withColumn("comes", F.expr(
        "ts + make_dt_interval(0, 0, cast(event_id * 7919 % 300 as int))"))
    return run_slices(come, "comes", label, lambda stream, path, checkpoint: start(
        stream.drop("comes"), path, checkpoint))


@query("stream_reordered", f"""with {E}, w as (select *, lag(ts) over k as pt, lag(magnitude) over k
  as pm, lag(status) over k as ps from e window k as (partition by user_id order by ts, event_id)),
kinds as (select *, case when pt is null or epoch_us(ts) - epoch_us(pt) >= {QUIET}000000
  then 'nouveau' when magnitude is not distinct from pm and status is not distinct from ps
  then 'repete' else 'revise' end as kind from w)
select user_id, event_id, ts, magnitude, status, kind,
  case when kind = 'revise' then pm end as previous_magnitude,
  case when kind = 'revise' then ps end as previous_status from kinds where {PASSED}""")
def stream_reordered(spark, sf):
    """Late rows are put in order and keys are forgotten; what the watermark passed has come out."""
    out = late_slices(spark, sf, "reordered", lambda stream, path, checkpoint: append_parquet(
        reorder.reordered_revisions(stream, "user_id", "ts", ["event_id"], DELAY, QUIET, revisions.SHARDS),
        path, checkpoint))
    return spark.read.parquet(out)


SESSION_GAP = "4 hours"


@query("stream_sessions", f"""with {E}, marked as (select *, case when epoch_us(ts) - lag(epoch_us(ts))
  over w < 4 * 3600000000 then 0 else 1 end as opens from e window w as (partition by user_id order by ts)),
numbered as (select *, sum(opens) over (partition by user_id order by ts) as session from marked)
select user_id, min(ts) as session_start, max(ts) + interval 4 hours as session_end,
  count(*) as messages, max(magnitude) as strongest from numbered group by user_id, session
  having epoch_ms(max(ts)) + 4 * 3600000 <= (select epoch_ms(max(ts)) from e) - 6 * 3600000""")
def stream_sessions(spark, sf):
    """Sessions of each user whose end the watermark has passed."""
    measures = {"messages": F.count(F.lit(1)), "strongest": F.max("magnitude")}
    out = late_slices(spark, sf, "sessions", lambda stream, path, checkpoint: append_parquet(
        sessions(stream, ["user_id"], "ts", SESSION_GAP, measures, DELAY), path, checkpoint))
    return spark.read.parquet(out)


@query("stream_latest", f"""with {E} select * from e order by ts desc, event_id desc limit 400""")
def stream_latest(spark, sf):
    """The newest messages from rings in the stream's state, one merge over all shards."""
    schema = []

    def start(stream, path, checkpoint):
        rings = ring.newest_by_shard(stream, ["ts", "event_id"])
        schema.append(rings.schema)
        return sink.start(rings, path, checkpoint)

    out = late_slices(spark, sf, "ring", start)
    return ring.merge_rings(sink.newest(spark, out, schema[-1], ["shard"]), ["ts", "event_id"], ["ts"])


@query("stream_live_counters", f"""with {KINDS} select count(*) as messages_total,
  count(distinct user_id) as seismes_distincts,
  count(*) filter (kind = 'nouveau') as premieres_apparitions,
  count(*) filter (kind = 'revise') as revisions_captees,
  count(*) filter (kind = 'repete') as repetitions from k""")
def stream_live_counters(spark, sf):
    """Totals kept by the stream itself, in place of a batch over what it put out."""
    schema = []

    def start(stream, path, checkpoint):
        totals = revisions.running_totals(stream)
        schema.append(totals.schema)
        return sink.start(totals, path, checkpoint)

    out = run_slices(tracked(spark, sf), "ts", "totals", start)
    return revisions.total_counters(sink.newest(spark, out, schema[-1], ["kind"]))


@query("rate_per_minute", f"""with {E}, w as (select ts, time_bucket(interval 60 seconds, ts)
  - interval 60 seconds * unnest(range(0, 5)) as window_start from e)
select window_start, window_start + interval 300 seconds as window_end, count(*) as messages,
  case when count(*) < 2 then 0.0 else round(count(*) * 60.0 / greatest(
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 1.0), 1) end as cadence_par_minute
from w group by window_start""")
def rate_per_minute(spark, sf):
    return rates.rate_per_minute(spark_view(spark, sf, messages_sql).select(
        F.col("ts").cast("timestamp").alias("ts")), "ts")


@query("backfill_window", f"""with {E} select user_id, event_id, ts from e
  where ts >= (select max(ts) from e) - interval 10080 minutes""")
def backfill_window(spark, sf):
    messages = spark_view(spark, sf, messages_sql).select("user_id", "event_id", "ts")
    return landing.backfill(messages, "ts", minutes=7 * 24 * 60)


@query("stream_dedup", f"""with {FLAT} select event_key, id as usgs_id, fingerprint from flat
  group by all""")
def stream_dedup(spark, sf):
    """Copies come an hour later under another origin; they fall within the two hours kept."""
    events = flat_events(spark, sf).select(
        "event_key", "usgs_id", fingerprint().alias("fingerprint"),
        F.coalesce("updated_time", "event_time").alias("produced"))
    out = run_slices(events, "produced", "dedup", lambda stream, path, checkpoint: append_parquet(
        rates.first_within(stream, "produced", "2 hours", ["event_key", "fingerprint"]),
        path, checkpoint))
    return spark.read.parquet(out).drop("produced")
