"""Queries on landed files, batches and versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.batch import nested_features, shifts, versions
from catalogue.registry import query, table
from catalogue.views import FLAT, I, L, PAIRED, V, identities_sql, landed_sql, spark_view
from palimpsest.operators import timeline
from palimpsest.operators.live import live_features, parse_messages
from palimpsest.operators.normalise import (active_versions, explode_versions,
                                            flatten_features, project_products, to_envelopes)
from palimpsest.plans.profile import profile, version_steps
from palimpsest.scratch import new_folder
from palimpsest.sources import ingest
from palimpsest.sources.files import (layer_footprint, load_table, read_completed,
                                      read_documents, read_envelopes, read_versions,
                                      write_table)
from palimpsest.sources.schemas import ENVELOPE
from palimpsest.sources.snapshots import SnapshotTable, read_as_of

PAGE = 1000
FETCHED = "2024-02-01T00:00:00+00:00"


# Scans --------------------------------------------------------------------------------------

def origin_features(spark: SparkSession, sf: str, origin: str) -> DataFrame:
    return nested_features(spark, sf).filter(F.col("origin") == origin).drop("origin")


FLAT_OUT = """event_key, id as usgs_id, updated_time, event_time, mag as magnitude,
  magnitude_type, lon as longitude, depth as depth_km, felt as felt_reports"""
FLAT_COLUMNS = ("event_key", "usgs_id", "updated_time", "event_time", "magnitude",
                "magnitude_type", "longitude", "depth_km", "felt_reports")


@query("scan_envelopes", f"with {FLAT} select {FLAT_OUT} from flat where origin = 'live'")
def scan_envelopes(spark, sf):
    folder = new_folder(spark, "envelopes")
    (to_envelopes(origin_features(spark, sf, "live"), F.lit(FETCHED)).select("value")
     .write.text(f"{folder}/ingest_date=2024-02-01"))
    features = read_envelopes(spark, f"{folder}/ingest_date=*/*.txt")
    return flatten_features(features, "live").select(*FLAT_COLUMNS)


@query("scan_documents", f"with {FLAT} select {FLAT_OUT} from flat where origin = 'catalog'")
def scan_documents(spark, sf):
    """Documents of at most twice PAGE features, by ranges of identifiers."""
    folder = new_folder(spark, "documents")
    features = origin_features(spark, sf, "catalog")
    page = F.floor(F.substring("id", 3, 20).cast("long") / PAGE)
    documents = features.groupBy(page.alias("page")).agg(
        F.collect_list(F.struct(*features.columns)).alias("features"))
    text = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"),
                     {"pretty": "true"})
    documents.select("page", text.alias("value")).write.partitionBy("page").text(folder)
    return flatten_features(read_documents(spark, f"{folder}/page=*"), "catalog").select(
        *FLAT_COLUMNS)


@query("envelope_roundtrip", f"""with {FLAT} select origin, id, id as key, mag as magnitude,
  mag_type as magnitude_type, status, time_ms as time, updated_ms as updated,
  nst as station_count, lat as latitude, depth from flat""")
def envelope_roundtrip(spark, sf):
    frames = []
    for origin in ("catalog", "live"):
        messages = to_envelopes(origin_features(spark, sf, origin), F.lit(FETCHED))
        frames.append(parse_messages(messages, ENVELOPE).select(
            F.lit(origin).alias("origin"), "id", "key", "magnitude", "magnitude_type", "status",
            "time", "updated", "station_count", "latitude", "depth"))
    return frames[0].unionByName(frames[1])


@query("live_features", f"""with {FLAT} select id, origin, mag as first_magnitude,
  nst as first_station_count, lower(mag_type) as first_magnitude_type,
  status as first_review_status, net as first_contributor, magnitude_family as first_family,
  saturation_threshold as first_saturation, depth as first_depth_km,
  round(greatest(0, (1706745600000 - time_ms) / 60000.0::double), 6) as first_minutes_since_quake,
  cast(null as double) as first_phase_count from flat""")
def live_features_query(spark, sf):
    frames = []
    for origin in ("catalog", "live"):
        messages = to_envelopes(origin_features(spark, sf, origin), F.lit(FETCHED))
        frames.append(parse_messages(messages, ENVELOPE).withColumn("origin", F.lit(origin)))
    records = live_features(frames[0].unionByName(frames[1]),
                            F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return records.select(
        "id", "origin", "first_magnitude", "first_station_count", "first_magnitude_type",
        "first_review_status", "first_contributor", "first_family", "first_saturation",
        "first_depth_km",
        F.round("first_minutes_since_quake", 6).alias("first_minutes_since_quake"),
        "first_phase_count")


# Version documents --------------------------------------------------------------------------

KEY = "event_id || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


LINES_PER_FILE = 200_000


def version_documents(spark: SparkSession, sf: str) -> DataFrame:
    """O: one document per order line, with a product that may be dirty or withdrawn, and a
    second one for returned lines. Written as JSON lines and read with the fixed schema."""
    number = F.when(F.col("l_linenumber") % 7 == 0, F.lit("1.5x")).when(
        F.col("l_linenumber") % 5 != 0, F.col("magnitude").cast("string"))
    status = F.when(F.col("l_partkey") % 11 == 0, F.lit(None)).when(
        F.col("l_partkey") % 6 == 0, "DELETE").otherwise("UPDATE")
    named = {"magnitude": number, "depth": F.col("depth_km").cast("string"),
             "magnitude-type": F.concat(F.lit(" "), F.upper("magnitude_type")),
             "review-status": F.col("review_status"),
             "num-stations-used": F.col("station_count").cast("string")}
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value"))
                      for k, v in named.items()])
    properties = F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))

    def product(state, shift):
        return F.struct(F.col("contributor").alias("source"), F.expr(KEY).alias("code"),
                        state.alias("status"),
                        (F.col("published_epoch_ms") + shift).alias("updateTime"),
                        F.lit(1).cast("long").alias("preferredWeight"),
                        properties.alias("properties"))

    main, again = product(status, 0), product(F.lit("Update"), 60000)
    origins = F.when(F.col("magnitude_type") == "ml", F.array(main, again)).otherwise(
        F.array(main))
    document = versions(spark, sf).select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("unix_millis(cast(event_time as timestamp))").alias("event_time"),
        F.col("magnitude").alias("current_magnitude"),
        F.col("magnitude_type").alias("current_magnitude_type"), "place", "cohort",
        F.struct(origins.alias("origin")).alias("products"))).alias("value"))
    folder = new_folder(spark, "versions")
    # A compressed file is read by one task as a whole, so each has a bounded number of lines.
    document.write.option("maxRecordsPerFile", LINES_PER_FILE).text(f"{folder}/batch=0000", compression="gzip")
    return read_versions(spark, f"{folder}/batch=*/*.txt.gz")


O = V + f""", o as (select *, {KEY} as code,
  case when l_linenumber % 7 = 0 or l_linenumber % 5 = 0 then null else magnitude end as m,
  case when l_partkey % 11 = 0 then null when l_partkey % 6 = 0 then 'delete' else 'update' end
    as product_status, published_epoch_ms as at_ms from v
 union all select *, {KEY}, case when l_linenumber % 7 = 0 or l_linenumber % 5 = 0 then null
  else magnitude end, 'update', published_epoch_ms + 60000 from v where magnitude_type = 'ml')"""


@query("explode_origins", f"""with {O} select event_id::varchar as event_id, cohort, place,
  event_time, magnitude as current_magnitude, contributor, code as contributor_code,
  product_status, at_ms as published_epoch_ms, make_timestamp_ms(at_ms) as published_at
  from o""")
def explode_origins(spark, sf):
    return explode_versions(version_documents(spark, sf)).select(
        "event_id", "cohort", "place", "event_time", "current_magnitude", "contributor",
        "contributor_code", "product_status", "published_epoch_ms", "published_at")


@query("map_projection", f"""with {O} select code as contributor_code,
  at_ms as published_epoch_ms, m as magnitude, depth_km, station_count::double as station_count,
  magnitude_type, review_status, cast(null as double) as phase_count from o""")
def map_projection(spark, sf):
    return explode_versions(version_documents(spark, sf)).select(
        "contributor_code", "published_epoch_ms", "magnitude", "depth_km", "station_count",
        "magnitude_type", "review_status", "phase_count")


@query("active_versions", f"""with {O} select cohort, product_status, count(*) as n,
  sum(m) as total from o where m is not null and product_status <> 'delete' group by all""")
def active_versions_query(spark, sf):
    return (active_versions(explode_versions(version_documents(spark, sf)))
            .groupBy("cohort", "product_status")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("magnitude").alias("total")))


@query("stage_profile", f"""with {O}, actives as (select * from o where m is not null
  and product_status <> 'delete')
select 'documents' as step, 1 as place, count(*) as rows, 0::bigint as null_keys from v union all
select 'versions', 2, count(*), 0 from o union all
select 'actives', 3, count(*), 0 from actives union all
select 'classees', 4, count(*), 0 from actives""")
def stage_profile(spark, sf):
    """Rows of each step, observed in the one run that ranks the versions."""
    documents = version_documents(spark, sf)
    keys = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("event_id"))
    return profile(documents, version_steps(("published_epoch_ms", "contributor_code"), keys), "event_id")


@query("project_products", f"""with {V} select event_id::varchar || '-' || l_linenumber || '-'
  || l_partkey || '-' || l_suppkey as event_id, epoch_ms(event_time) as event_time,
  magnitude as current_magnitude, magnitude_type as current_magnitude_type, place,
  case when magnitude_type = 'mb' then 0 else 1 end::bigint as origins,
  'origin' as products from v""")
def project_products_query(spark, sf):
    product = F.struct(F.col("contributor").alias("source"))
    origins = F.when(F.col("magnitude_type") != "mb", F.array(product))
    documents = versions(spark, sf).select(
        F.expr(KEY).alias("id"),
        F.struct(F.expr("unix_millis(cast(event_time as timestamp))").alias("time"),
                 F.col("magnitude").alias("mag"), F.col("magnitude_type").alias("magType"),
                 "place", F.struct(origins.alias("origin"),
                                   F.array(product).alias("shakemap")).alias("products"))
        .alias("properties"))
    kept = project_products(documents)
    return kept.select(
        "event_id", "event_time", "current_magnitude", "current_magnitude_type", "place",
        F.size("products.origin").cast("long").alias("origins"),
        F.lit(",".join(kept.schema["products"].dataType.names)).alias("products"))


# Batches ------------------------------------------------------------------------------------

def months(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, landed_sql)


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, sf, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ingest.month_calendar(bounds, "first", "last")


CALENDAR = """cal as (select strftime(s, '%Y-%m') as period, year(s)::int as year,
  month(s)::int as month, s::date as starts, (s + interval 1 month)::date as ends_before
  from (select unnest(generate_series(date_trunc('month', min(o_orderdate)),
    date_trunc('month', max(o_orderdate)), interval 1 month)) as s from orders))"""
DESCRIBED = L + """, d as (select period, count(*) as events,
  sum(strlen(value) + 1)::bigint as bytes,
  sum(('0x' || substr(sha256(value), 1, 12))::bigint)::varchar as digest from l group by period),
page as (select ceil(avg(events))::bigint as size from d)"""


def page_size(spark: SparkSession, sf: str) -> int:
    """The mean number of events of a month: some months reach it and some do not."""
    sizes = months(spark, sf).groupBy("period").count()
    return sizes.agg(F.ceil(F.avg("count"))).first()[0] or 1


@query("month_calendar", f"with {CALENDAR} select * from cal")
def month_calendar(spark, sf):
    return calendar(spark, sf)


@query("truncated_batches", f"""with {DESCRIBED} select period, events from d, page
  where events >= size""")
def truncated_batches(spark, sf):
    return ingest.truncated_batches(months(spark, sf), page_size(spark, sf))


@query("pending_months", f"""with {DESCRIBED}, {CALENDAR} select period, starts, ends_before
  from cal where period not in (select period from d, page where events < size)""")
def pending_months(spark, sf):
    """Months that were refused stay pending."""
    landing = ingest.BatchLanding(spark, new_folder(spark, "pending"), limit=page_size(spark, sf))
    landing.ingest(months(spark, sf))
    return ingest.pending(calendar(spark, sf), landing.manifest()).select(
        "period", "starts", "ends_before")


@query("ingest_months", f"with {DESCRIBED} select d.*, 'landed' as outcome from d")
def ingest_months(spark, sf):
    landing = ingest.BatchLanding(spark, new_folder(spark, "months"))
    outcome = ingest.require_landed(landing.ingest(months(spark, sf)))
    return outcome.join(landing.manifest(), ["period", "events", "bytes", "digest"]).drop("ingested_at")


@query("ingest_outcomes", f"""with {DESCRIBED} select d.*, case when events < size then 'landed'
  else 'rejected' end as outcome, 1 as run from d, page
  union all select d.*, case when events < size then 'already marked' else 'landed' end, 2
  from d, page""")
def ingest_outcomes(spark, sf):
    """A landing with a limit taken from the data refuses the large months; one without a limit
    over the same folder lands those and finds the others marked."""
    lines, folder = months(spark, sf), new_folder(spark, "outcomes")
    first = ingest.BatchLanding(spark, folder, limit=page_size(spark, sf)).ingest(lines)
    second = ingest.BatchLanding(spark, folder).ingest(lines)
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


@query("completed_batches", f"""with {DESCRIBED} select d.period, events, bytes from d, page
  where events < size""")
def completed_batches(spark, sf):
    """All months have files; only the marked ones are read."""
    folder = new_folder(spark, "batches")
    lines = months(spark, sf).select("period", "value")
    lines.write.partitionBy("period").text(folder)
    manifest = ingest.describe(lines, "period").filter(F.col("events") < page_size(spark, sf))
    landed = spark.read.schema("value string, period string").text(folder)
    return (ingest.describe(read_completed(landed, manifest, "period"), "period")
            .drop("digest"))


REPLAY_DAY = "1998-01"


@query("replay_check", f"""with {DESCRIBED}, s as (
  select 1 as run, count(*) as batches, sum(events)::bigint as events,
    sum(bytes)::bigint as bytes, sum(digest::hugeint)::varchar as digest
    from d where period < '{REPLAY_DAY}'
  union all select unnest([2, 3]), count(*), sum(events)::bigint, sum(bytes)::bigint,
    sum(digest::hugeint)::varchar from d) select * from s""")
def replay_check(spark, sf):
    """A run that was cut after some months, a complete run, and a replay of it."""
    landing = ingest.BatchLanding(spark, new_folder(spark, "replay"))
    lines = months(spark, sf)
    states = []
    for run, seen in enumerate((lines.filter(F.col("period") < REPLAY_DAY), lines, lines), 1):
        landing.ingest(seen)
        states.append(spark.createDataFrame(ingest.replay_state(landing).collect())
                      .withColumn("run", F.lit(run)))
    return states[0].unionByName(states[1]).unionByName(states[2])


COHORTS = I + """, traced as (select distinct usgs_id as event_id from i
  where ids like '%,usauto%'), control as (select usgs_id as event_id from i
  where ids not like '%,usauto%' order by sha256(usgs_id || '|7'), usgs_id limit 1000),
m as (select event_id, 'traced' as cohort from traced union all select event_id, 'control'
  from control),
b as (select event_id, cohort, (row_number() over (order by cohort <> 'traced', event_id) - 1)
  // 100 as batch from m)"""


def members(spark: SparkSession, sf: str) -> DataFrame:
    chosen = ingest.select_cohorts(spark_view(spark, sf, identities_sql), "usgs_id", "ids")
    return ingest.assign_batches(chosen, [F.col("cohort") != "traced", F.col("event_id")])


@query("cohort_sample", f"with {COHORTS} select * from m")
def cohort_sample(spark, sf):
    return ingest.select_cohorts(spark_view(spark, sf, identities_sql), "usgs_id", "ids")


@query("batch_members", f"with {COHORTS} select event_id, cohort, batch from b")
def batch_members(spark, sf):
    return members(spark, sf)


@query("batch_manifest", f"""with {COHORTS}, a as (select 'us' || o_orderkey as event_id,
  'us' || o_orderkey || '|' || o_custkey || '|' || o_orderpriority as value from orders
  where o_orderstatus <> 'F')
select batch, count(*) as requested, count(value) as events,
  count(*) filter (value is null) as failures,
  coalesce(sum(strlen(value) + 1), 0)::bigint as bytes,
  sum(('0x' || substr(sha256(value), 1, 12))::bigint)::varchar as digest
from b left join a on a.event_id = b.event_id group by batch""")
def batch_manifest(spark, sf):
    identifier = F.concat(F.lit("us"), F.col("o_orderkey"))
    answers = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "F").select(
        identifier.alias("event_id"),
        F.concat_ws("|", identifier, "o_custkey", "o_orderpriority").alias("value"))
    return ingest.batch_manifest(members(spark, sf), answers)


LAYERS = {"bronze": ("lineitem", 8), "silver": ("orders", 4), "gold": ("nation", 1)}


@query("layer_footprint", f"""select couche, fichiers, true as plausible from (values
  {", ".join(f"('{layer}', {files})" for layer, (_, files) in LAYERS.items())}) t(couche, fichiers)""")
def layer_footprint_query(spark, sf):
    """Files of each layer, and whether their bytes are plausible: no file is empty, and together
    they have at least a byte for each row."""
    root = new_folder(spark, "layers")
    rows = []
    for layer, (name, files) in LAYERS.items():
        frame = table(spark, sf, name)
        frame.repartition(files).write.parquet(f"{root}/{layer}")
        rows.append(frame.agg(F.lit(layer).alias("of"), F.count(F.lit(1)).alias("lignes")))
    counted = rows[0].unionAll(rows[1]).unionAll(rows[2])
    found = layer_footprint(spark, {layer: f"{root}/{layer}" for layer in LAYERS})
    return found.join(counted, F.col("couche") == F.col("of")).select(
        "couche", F.col("fichiers").cast("int").alias("fichiers"), (F.col("octets") >= F.col("lignes")).alias("plausible"))


# Versioned tables ---------------------------------------------------------------------------

@query("snapshot_write_read", f"""with {V} select cohort, 2 as columns_added,
  count(*) as rows, sum(magnitude) as total from v group by cohort""")
def snapshot_write_read(spark, sf):
    """Create, then overwrite with two more columns."""
    stored = SnapshotTable(spark, new_folder(spark, "snapshots"), ["cohort"])
    frame = versions(spark, sf)
    narrow = frame.select("event_id", "cohort", "magnitude")
    stored.overwrite(narrow)
    stored.overwrite(frame.select("event_id", "cohort", "magnitude", "magnitude_type",
                                  "published_at"))
    after = stored.read()
    added = len(after.columns) - len(stored.as_of(0).columns)
    return after.groupBy("cohort").agg(
        F.lit(added).alias("columns_added"), F.count(F.lit(1)).alias("rows"),
        F.sum("magnitude").alias("total"))


def merged(spark: SparkSession, sf: str) -> SnapshotTable:
    """Catalogue versions first, live versions merged into them."""
    stored = SnapshotTable(spark, new_folder(spark, "merge"), ["origin"])
    for origin in ("catalog", "live"):
        features = flatten_features(origin_features(spark, sf, origin), origin)
        stored.merge(timeline.first_copies(features).select(
            "event_key", "usgs_id", "origin", "updated_time", "magnitude", "fingerprint"),
            ["event_key", "fingerprint"])
    return stored


MERGED = FLAT + """, side as (select event_key, id as usgs_id, origin, updated_time,
  mag as magnitude, fingerprint from flat qualify row_number() over (partition by origin,
  event_key, fingerprint order by updated_ms nulls last) = 1),
fresh as (select * from side where origin = 'live'),
kept as (select * from side s where origin = 'catalog' and not exists (select 1 from fresh f
  where f.event_key = s.event_key and f.fingerprint = s.fingerprint))"""


@query("merge_upsert", f"with {MERGED} select * from kept union all select * from fresh")
def merge_upsert(spark, sf):
    return merged(spark, sf).read()


@query("table_history", f"""with {MERGED}, c as (select (select count(*) from side
  where origin = 'catalog') as before, (select count(*) from fresh) as source,
  (select count(*) from kept) as kept)
select 0::bigint as version, 'WRITE' as operation, before as lignes,
  null::bigint as inserees, null::bigint as mises_a_jour from c union all
select 1, 'MERGE', kept + source, source - (before - kept), before - kept from c""")
def table_history(spark, sf):
    return merged(spark, sf).history().drop("commit_time")


@query("snapshot_as_of", f"with {MERGED} select * from side where origin = 'catalog'")
def snapshot_as_of(spark, sf):
    return read_as_of(spark, merged(spark, sf).root, 0)


@query("gold_roundtrip", f"with {PAIRED} select event_id, shift, direction from revised")
def gold_roundtrip(spark, sf):
    folder = new_folder(spark, "gold")
    write_table(shifts(spark, sf).select("event_id", "shift", "direction"), folder,
                "magnitude_revision")
    return load_table(spark, folder, "magnitude_revision")
