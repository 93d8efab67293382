"""Lloyd's clustering of integer vectors with ns-bounds.

For each vector and centroid the last evaluated distance is kept with the round of its evaluation,
and every round's centroids are kept too. In a later round the bound is that distance, loosened by
the norm of the centroid's total displacement since that round, never by the sum of its drifts
from round to round. Where the upper bound of a vector's centroid stays below the lower bounds of
all others nothing is computed. Otherwise the own distance is evaluated, and then those centroids
that the bounds do not rule out, in exact integers; ties go to the smaller number.

Vectors are written once, packed in blocks and bucketed by block. A round reads them beside the
bounds of the round before, which are bucketed alike, so the join moves no vector; it writes the
new bounds (5 bytes a vector and centroid) and, with each block, the sums of its clusters. Only
sums of all blocks, one row a cluster and component, come to the driver. The assignment of a round
is read from a written table, so a lost executor changes nothing. At the end the vectors' and bounds'
tables are dropped; on the way only the last two bounds exist.

Defined cases. Vectors that are null, of another length, or with null or non-finite components take
no part. Rows that repeat a key are vectors of their own; null keys take part but come last among
the first centroids. Equal hashes are put in order by key and components. With fewer vectors than
centroids there are as many centroids as vectors; without vectors the result is empty. Empty
clusters keep their centroid. Components whose integers are beyond 2**27 are refused, for squared
distances would not fit a long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from palimpsest.llm.registry import query, table
from palimpsest.scratch import materialise, new_folder

SIZE = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
LARGEST = 1 << 27
# Below this, products and their sums are exact in doubles.
EXACT = 1 << 23
BLOCK_ROWS = 4096
BUCKET_ROWS = 1 << 17
BUCKETS = 10_000
# Bounds are kept in single precision, a little looser than computed.
SLACK = 1e-6

BLOCK = "block long, n int, keys binary, vectors binary"
CENTROID = "cluster int, centroid array<long>"
BOUNDS = "block long, own binary, distances binary, rounds binary, evaluated long, sums array<long>, counts array<long>"


class TooLarge(ValueError):
    pass


def usable(frame: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """Keys and integer vectors."""
    component = F.col(vector).cast("array<double>")
    good = F.coalesce((F.size(vector) == size) & F.forall(
        component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = frame.select(F.col(key).alias("key"), component.alias("vector"), good.alias("good")).where("good")
    return rows.select("key", F.transform("vector", lambda x: F.floor(x * float(scale))).alias("vector"))


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors."""
    apart = vectors.astype(np.int64) - centroid
    if not len(apart) or np.abs(apart).max() <= EXACT:
        real = apart.astype(np.float64)
        return np.einsum("ij,ij->i", real, real).astype(np.int64)
    return np.einsum("ij,ij->i", apart, apart)


def displacements(history: np.ndarray) -> np.ndarray:
    """For each past round and centroid, how far the centroid is now from where it was then."""
    apart = (history - history[-1]).astype(np.float64)
    return np.sqrt(np.einsum("rkj,rkj->rk", apart, apart))


def reassign(vectors: np.ndarray, own: np.ndarray, distances: np.ndarray, rounds: np.ndarray,
             history: np.ndarray) -> int:
    """Update assignment and bounds to the last centroids of ``history``; distances evaluated.

    ``distances`` are those last evaluated, in ``rounds``: -1 means never.
    """
    now, (rows, number) = len(history) - 1, distances.shape
    moved = displacements(history)
    each = np.arange(number)
    kept = distances.astype(np.float64)
    loose = np.where(rounds >= 0, moved[rounds, each], np.inf)
    lower, upper = kept * (1 - SLACK) - loose, kept * (1 + SLACK) + loose
    evaluated = 0

    def clear(rows: np.ndarray) -> np.ndarray:
        """Rows whose own centroid is nearer than any other can be."""
        others = lower[rows]
        others[np.arange(len(rows)), own[rows]] = np.inf
        return upper[rows, own[rows]] < others.min(axis=1)

    def evaluate(rows: np.ndarray, centroid: int) -> np.ndarray:
        nonlocal evaluated
        evaluated += len(rows)
        exact = squared(vectors[rows], history[now, centroid])
        root = np.sqrt(exact.astype(np.float64))
        distances[rows, centroid], rounds[rows, centroid] = root, now
        lower[rows, centroid], upper[rows, centroid] = root * (1 - SLACK), root * (1 + SLACK)
        return exact

    left = np.arange(rows)
    left = left[~clear(left)]
    nearest = np.zeros(rows, np.int64)
    for centroid in range(number):
        of_it = left[own[left] == centroid]
        nearest[of_it] = evaluate(of_it, centroid)
    left = left[~clear(left)]
    chosen = own.copy()
    for centroid in range(number):
        # Whoever its lower bound rules out against the nearest so far needs no evaluation.
        near = np.sqrt(nearest[left].astype(np.float64)) * (1 + SLACK)
        asked = left[(own[left] != centroid) & (lower[left, centroid] <= near)]
        exact = evaluate(asked, centroid)
        best = nearest[asked]
        better = (exact < best) | ((exact == best) & (centroid < chosen[asked]))
        chosen[asked[better]], nearest[asked[better]] = centroid, exact[better]
    own[:] = chosen
    return evaluated


class Buckets:
    """Tables bucketed by block in the shared folder; their names last for one clustering."""

    def __init__(self, spark: SparkSession, number: int) -> None:
        self.spark, self.number, self.names = spark, number, []

    def write(self, frame: DataFrame, label: str) -> DataFrame:
        name = f"palimpsest_{label}_{uuid.uuid4().hex}"
        (frame.write.format("parquet").bucketBy(self.number, "block").sortBy("block")
         .option("path", new_folder(self.spark, label)).saveAsTable(name))
        self.names.append(name)
        return self.spark.table(name)

    def drop(self, name: str) -> None:
        """Forget the table and give its files back."""
        location = self.spark.sql(f"describe table extended {name}").where("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"drop table {name}")
        self.names.remove(name)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pack_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most BLOCK_ROWS vectors, numbered by partition."""
    arrow = to_arrow_schema(StructType.fromDDL(BLOCK))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                if len(vectors) and np.abs(vectors).max() > LARGEST:
                    raise TooLarge(f"a component is beyond {LARGEST}")
                sink = pa.BufferOutputStream()
                keys = pa.record_batch([part.column("key")], names=["key"])
                with pa.ipc.new_stream(sink, keys.schema) as stream:
                    stream.write_batch(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part.column("part")[0].as_py() << 32) + number], pa.int64()),
                     pa.array([part.num_rows], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                     pa.array([vectors.astype(np.int32).tobytes()], pa.binary())], schema=arrow)
                number += 1

    return rows.withColumn("part", F.spark_partition_id()).mapInArrow(blocks, BLOCK)


def first_centroids(rows: DataFrame, number: int, seed: int) -> np.ndarray:
    """The vectors whose keys have the smallest hashes."""
    lottery = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    drawn = rows.orderBy(lottery.asc_nulls_last(), "key", "vector").limit(number).collect()
    found = np.array([row["vector"] for row in drawn], np.int64)
    if len(found) and np.abs(found).max() > LARGEST:
        raise TooLarge(f"a component is beyond {LARGEST}")
    return found


def _unpack(value: pa.Scalar, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(value.as_py(), kind).reshape(-1, width)


def next_bounds(blocks: DataFrame, before: DataFrame | None, history: np.ndarray) -> DataFrame:
    """Bounds and assignment of every block against the last centroids, with the sums of its clusters."""
    _, number, size = history.shape
    arrow = to_arrow_schema(StructType.fromDDL(BOUNDS))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                vectors = _unpack(row["vectors"], np.int32, size)
                if "own" in row:
                    own = _unpack(row["own"], np.int16, 1)[:, 0].copy()
                    distances = _unpack(row["distances"], np.float32, number).copy()
                    rounds = _unpack(row["rounds"], np.int8, number).copy()
                else:
                    own = np.zeros(len(vectors), np.int16)
                    distances = np.zeros((len(vectors), number), np.float32)
                    rounds = np.full((len(vectors), number), -1, np.int8)
                evaluated = reassign(vectors, own, distances, rounds, history)
                sums = np.zeros((number, size), np.int64)
                for cluster in range(number):
                    sums[cluster] = vectors[own == cluster].sum(axis=0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(
                    (row["block"].as_py(), own.tobytes(), distances.tobytes(), rounds.tobytes(), evaluated,
                     sums.ravel(), np.bincount(own, minlength=number)), arrow)], schema=arrow)

    if before is None:
        return blocks.select("block", "vectors").mapInArrow(step, BOUNDS)
    return blocks.select("block", "vectors").join(
        before.select("block", "own", "distances", "rounds"), "block").mapInArrow(step, BOUNDS)


def moved_centroids(bounds: DataFrame, last: np.ndarray) -> np.ndarray:
    """Floors of the means; exact, in whole numbers of any size."""
    number, size = last.shape
    cells = bounds.select(F.posexplode(F.concat("sums", "counts")).alias("cell", "value")).groupBy("cell").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect()
    total = {row["cell"]: int(row["value"]) for row in cells}
    moved = last.copy()
    for cluster in range(number):
        count = total[number * size + cluster]
        if count:
            moved[cluster] = [total[cluster * size + at] // count for at in range(size)]
    return moved


def cluster(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", number: int = CENTROIDS,
            rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE, scale: int = SCALE,
            report: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Key, cluster and squared distance of every vector, a written table; and the components of
    each centroid. ``report`` gets, for each assignment, how many distances were evaluated."""
    spark = frame.sparkSession
    if not 0 < rounds < 127 or not 0 < number < 1 << 15:
        raise ValueError("rounds below 127 and centroids below 32768")
    rows = usable(frame, key, vector, size, scale)
    key_field = StructField("key", rows.schema["key"].dataType)
    result = StructType([key_field, *StructType.fromDDL("cluster int, distance long")])
    centroids = first_centroids(rows, number, seed)
    if not len(centroids):
        return spark.createDataFrame([], result).withColumnRenamed("key", key), spark.createDataFrame([], CENTROID)
    total = rows.count()
    wanted = max(-(-total // BUCKET_ROWS), min(spark.sparkContext.defaultParallelism, -(-total // BLOCK_ROWS)))
    store = Buckets(spark, min(wanted, BUCKETS))
    packed = pack_blocks(rows, size)
    blocks = store.write(packed.repartition(store.number, "block"), "vectors")
    history, before = centroids[None], None
    for at in range(rounds + 1):
        bounds = store.write(next_bounds(blocks, before, history), "bounds")
        if report is not None:
            report.append(bounds.agg(F.sum("evaluated")).first()[0])
        if before is not None:
            store.drop(store.names[-2])
        before = bounds
        if at < rounds:
            history = np.concatenate([history, moved_centroids(bounds, history[-1])[None]])
    last = history[-1]
    arrow = to_arrow_schema(result)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                vectors = _unpack(batch.column("vectors")[at], np.int32, size)
                own = _unpack(batch.column("own")[at], np.int16, 1)[:, 0]
                distance = np.zeros(len(own), np.int64)
                for centre in range(len(last)):
                    distance[own == centre] = squared(vectors[own == centre], last[centre])
                keys = pa.ipc.open_stream(batch.column("keys")[at].as_py()).read_all().column(0)
                yield pa.RecordBatch.from_arrays(
                    [keys.combine_chunks().cast(arrow.field("key").type), pa.array(own.astype(np.int32)),
                     pa.array(distance)], schema=arrow)

    found = materialise(blocks.join(before.select("block", "own"), "block").select("vectors", "own", "keys").mapInArrow(
        unpack, result).withColumnRenamed("key", key), "clusters")
    for name in list(store.names):
        store.drop(name)
    return found, spark.createDataFrame([*enumerate(last.tolist())], CENTROID)


def _oracle() -> str:
    """The same rounds, one after the other."""
    steps = [f"""kept as materialized (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings where len(embedding) = {SIZE} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {SIZE}),
c0 as materialized (select row_number() over (order by h, vec_id, v) - 1 as k, v from (
  select sha256('{SEED}:' || vec_id) as h, vec_id, v from kept order by h, vec_id, v limit {CENTROIDS}))"""]
    for at in range(ROUNDS + 1):
        apart = "list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
        steps.append(f"""a{at} as materialized (select vec_id, v, min(d) as distance, arg_min(k, (d, k)) as cluster from (
  select vec_id, kept.v, c.k, {apart} as d from kept cross join c{at} c) group by vec_id, v)""")
        if at < ROUNDS:
            steps.append(f"""c{at + 1} as materialized (select c.k, coalesce(m.v, c.v) as v from c{at} c left join (
  select cluster, list(x order by i) as v from (select cluster, i, floor(sum(x) / count(*))::bigint as x from (
    select cluster, unnest(v) as x, unnest(range({SIZE})) as i from a{at}) group by cluster, i) group by cluster
  ) m on m.cluster = c.k)""")
    return f"""with {", ".join(steps)}
select a.vec_id, a.cluster::int as cluster, a.distance, (sum(a.distance) over (partition by a.cluster))::bigint as cluster_inertia,
  (sum(a.distance) over ())::bigint as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} c on c.k = a.cluster"""


@query("op12_centroid_clustering", _oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    # One row a cluster: a bounded table beside the vectors.
    inertia = {row["cluster"]: row["inertia"] for row in found.groupBy("cluster").agg(
        F.sum("distance").alias("inertia")).collect()}
    facts = [(row["cluster"], inertia[row["cluster"]], sum(inertia.values()),
              hashlib.sha256(",".join(map(str, row["centroid"])).encode()).hexdigest())
             for row in centroids.collect() if row["cluster"] in inertia]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
