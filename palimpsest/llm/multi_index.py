"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Either half of a vector is quantised by its own codebook, so a cell is a pair of centroids. A query
visits cells by falling sum of its halves' products with the centroids, from a heap, until the
visited cells hold the wanted share of all rows; their entries are ranked by the exact product.

Codebooks and the share are fitted on at most about ``FIT_ROWS`` rows: the share is that at which
``TARGET`` of the sample's true neighbours lie in visited cells. Every row is indexed. The index
itself (codebooks, rows per cell) is bounded by ``CENTROIDS`` squared and broadcast. Rows and
queries meet in blocks: a cell with many rows is split, small cells share a block, and queries of a
block are split as well, so a vector that a third of all rows share fills many small tasks.

Defined cases. Vectors that are null, zero, of another length than most, or hold nulls or
non-finite numbers take no part. Rows that repeat an id count once, with the best score: cells are
visited until they hold enough distinct ids, and a block gives its best distinct ids. A query with
fewer candidates gets all. Ties go to the smaller id. A null id takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.llm.registry import query, table

CENTROIDS = 128
FIT_ROWS = 20_000
FIT_QUERIES = 400
TARGET = 0.95
ROUNDS = 12
BLOCK_ROWS = 4096
RESULT = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def quantise(half: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (2 * half @ book.T - (book * book).sum(axis=1)).argmax(axis=1)


def codebook(half: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """k-means from distinct rows; a centroid without rows stays where it is."""
    distinct = np.unique(half, axis=0)
    book = distinct[rng.permutation(len(distinct))[:size]].copy()
    for _ in range(ROUNDS):
        of = quantise(half, book)
        count = np.bincount(of, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, of, half)
        filled = count > 0
        book[filled] = sums[filled] / count[filled, None]
    return book


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray  # rows of each cell
    first_block: np.ndarray
    parts: np.ndarray  # blocks of each cell
    wanted: int  # rows to visit
    homes: np.ndarray  # ids of each cell; an id of several cells counts in the first
    wanted_ids: int

    @property
    def width(self) -> int:
        return len(self.books[1])

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.books[0].shape[1]
        return quantise(vectors[:, :half], self.books[0]) * self.width + quantise(vectors[:, half:], self.books[1])


def visit(products: tuple[np.ndarray, np.ndarray], counts: np.ndarray, wanted: int,
          homes: np.ndarray | None = None, wanted_ids: int = 0) -> list[int]:
    """Cells by falling sum of the two products, until they hold the wanted numbers of rows and of
    distinct ids. The heap has the next cell of each first centroid."""
    first, second = (np.argsort(-x, kind="stable") for x in products)
    a, b = (-products[0][first]).tolist(), (-products[1][second]).tolist()
    rows, columns, width = first.tolist(), second.tolist(), len(b)
    sizes = counts.tolist()
    ids = sizes if homes is None else homes.tolist()
    heap = [(value + b[0], at, 0) for at, value in enumerate(a)]
    heapify(heap)
    cells, seen, known = [], 0, 0
    while heap and (seen < wanted or known < wanted_ids):
        _, row, column = heap[0]
        cell = rows[row] * width + columns[column]
        if sizes[cell]:
            cells.append(cell)
            seen += sizes[cell]
            known += ids[cell]
        if column + 1 < width:
            heapreplace(heap, (a[row] + b[column + 1], row, column + 1))
        else:
            heappop(heap)
    return cells


def share_needed(sample: np.ndarray, books: tuple[np.ndarray, np.ndarray], nearest: int, target: float,
                 queries: int) -> float:
    """The share of rows to visit for ``target`` of the true neighbours, measured on the sample."""
    half = books[0].shape[1]
    of = [quantise(part, book) for part, book in zip((sample[:, :half], sample[:, half:]), books)]
    needed = []
    for at in range(min(queries, len(sample))):
        exact = sample @ sample[at]
        exact[at] = -np.inf
        true = np.argsort(-exact, kind="stable")[:min(nearest, len(sample) - 1)]
        sums = (books[0] @ sample[at, :half])[of[0]] + (books[1] @ sample[at, half:])[of[1]]
        order = np.sort(-sums)
        needed.append(np.searchsorted(order, -sums[true], "right") / len(sample))
    return float(np.quantile(np.concatenate(needed), target)) if needed and len(needed[0]) else 1.0


def fit(vectors: DataFrame, rows: int, nearest: int, seed: int, centroids: int = CENTROIDS,
        fit_rows: int = FIT_ROWS, target: float = TARGET) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """Codebooks and the share to visit. ``vectors``: vec_id, vector."""
    lot = F.pmod(F.xxhash64(F.lit(seed), "vec_id", "vector"), F.lit(1 << 30))
    chosen = vectors.where(lot < int(min(1.0, fit_rows / max(rows, 1)) * (1 << 30))).select("vec_id", "vector").toArrow()
    if not chosen.num_rows:
        chosen = vectors.select("vec_id", "vector").limit(fit_rows).toArrow()
    sample = as_matrix(chosen.column("vector").combine_chunks())
    # Rows repeated in both columns are one neighbour.
    names = np.unique(chosen.column("vec_id").to_numpy(), return_inverse=True)[1]
    sample = sample[np.sort(np.unique(np.column_stack([names, sample]), axis=0, return_index=True)[1])]
    rng = np.random.default_rng(seed)
    sample = sample[rng.permutation(len(sample))]
    half = max(1, sample.shape[1] // 2)
    books = tuple(codebook(part, centroids, rng) for part in (sample[:, :half], sample[:, half:]))
    return books, share_needed(sample, books, nearest, target, FIT_QUERIES)


def _blocks(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell. Cells follow each other; a cell with more rows
    than a block has blocks of its own."""
    parts = np.maximum(1, -(-counts // size))
    first, block, filled = np.zeros(len(counts), np.int64), 0, 0
    for cell, (count, split) in enumerate(zip(counts.tolist(), parts.tolist())):
        if filled and filled + count > size:
            block, filled = block + 1, 0
        first[cell] = block
        if split > 1:
            block, filled = block + split, 0
        else:
            filled += count
    return first, parts


def _cells(index) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Index = index.value
        for batch in batches:
            cells = known.cells(as_matrix(batch.column("vector"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))],
                                             [*batch.schema.names, "cell"])

    return run


def _visits(index) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Index = index.value
        half = known.books[0].shape[1]
        for batch in batches:
            ids, blocks, firsts, bits, at = [], [], [], [], []
            for row, vector in enumerate(as_matrix(batch.column("vector")) if batch.num_rows else []):
                cells = np.sort(np.array(visit((known.books[0] @ vector[:half], known.books[1] @ vector[half:]),
                                               known.counts, known.wanted, known.homes, known.wanted_ids), np.int64))
                block = known.first_block[cells]
                begin = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(cells) else []
                for low, high in zip(begin, [*begin[1:], len(cells)]):
                    mine = cells[low:high]
                    flags = np.zeros(int(mine[-1] - mine[0]) + 1, np.uint8)
                    flags[mine - mine[0]] = 1
                    packed = np.packbits(flags).tobytes()
                    for part in range(int(known.parts[mine[-1]])):
                        at.append(row)
                        blocks.append(int(block[low]) + part)
                        firsts.append(int(mine[0]))
                        bits.append(packed)
            yield pa.RecordBatch.from_arrays(
                [*(column.take(pa.array(at, pa.int64())) for column in batch.columns), pa.array(blocks, pa.int64()),
                 pa.array(firsts, pa.int32()), pa.array(bits, pa.binary())],
                [*batch.schema.names, "block", "first", "bits"])

    return run


def _best(nearest: int):
    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if entries.num_rows and queries.num_rows:
            entries = entries.sort_by("vec_id")
            ids = entries.column("vec_id").to_numpy()
            cells = entries.column("cell").to_numpy()
            known = as_matrix(entries.column("vector").combine_chunks())
            asked = as_matrix(queries.column("vector").combine_chunks())
            names = queries.column("query_id").to_numpy()
            firsts, bits = queries.column("first").to_numpy(), queries.column("bits").to_pylist()
            for row in range(len(names)):
                flags = np.unpackbits(np.frombuffer(bits[row], np.uint8))
                place = cells - firsts[row]
                inside = (place >= 0) & (place < len(flags)) & (ids != names[row])
                inside[inside] = flags[place[inside]] == 1
                found = np.flatnonzero(inside)
                if not len(found):
                    continue
                score = known[found] @ asked[row]
                # Rows are in order of their id, and one id may be there many times.
                begin = np.flatnonzero(np.r_[True, ids[found[1:]] != ids[found[:-1]]])
                found, score = found[begin], np.maximum.reduceat(score, begin)
                if len(found) > nearest:
                    least = np.partition(score, len(score) - nearest)[len(score) - nearest]
                    keep = np.r_[np.flatnonzero(score > least), np.flatnonzero(score == least)[:nearest]]
                    found, score = found[keep], score[keep]
                out.append((np.full(len(found), names[row]), ids[found], score))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.Table.from_arrays([pa.array(x) for x in columns], ["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(frame: DataFrame, queries: Column, nearest: int = 20, vec_id: str = "vec_id",
                       vector: str = "embedding", seed: int = 1, centroids: int = CENTROIDS,
                       fit_rows: int = FIT_ROWS, target: float = TARGET, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. ``queries``: the condition that makes a row a query."""
    spark: SparkSession = frame.sparkSession
    rows = frame.select(F.col(vec_id).cast("long").alias("vec_id"),
                        F.col(vector).cast("array<double>").alias("vector"), queries.alias("asks")).where(
        usable(F.col("vector")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asking"))
    most = sizes.orderBy(F.desc("rows"), F.desc("size")).limit(1).collect()
    if not most:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total, asking = most[0]["rows"], most[0]["asking"]
    rows = rows.where(F.size("vector") == most[0]["size"])
    books, share = fit(rows, total, nearest, seed, centroids, fit_rows, target)
    empty = np.zeros(len(books[0]) * len(books[1]), np.int64)
    plain = spark.sparkContext.broadcast(Index(books, empty, empty, empty, 0, empty, 0))
    entries = rows.mapInArrow(_cells(plain), "vec_id long, vector array<double>, asks boolean, cell int")
    counts = empty.copy()
    for row in entries.groupBy("cell").count().collect():  # centroids squared at most
        counts[row["cell"]] = row["count"]
    homes = empty.copy()
    for row in entries.groupBy("vec_id").agg(F.min("cell").alias("cell")).groupBy("cell").count().collect():
        homes[row["cell"]] = row["count"]
    first, parts = _blocks(counts, block_rows)
    wanted = min(total, max(int(np.ceil(share * total)), nearest + 1))
    index = spark.sparkContext.broadcast(Index(books, counts, first, parts, wanted, homes, nearest + 1))
    chunks = max(1, -(-asking // block_rows))
    places = spark.createDataFrame(pa.table({
        "cell": pa.array(np.flatnonzero(counts).astype(np.int32)), "first": first[counts > 0],
        "parts": parts[counts > 0]}))
    split = F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts"))
    ready = entries.join(F.broadcast(places), "cell").select(
        "vec_id", "vector", "cell", (F.col("first") + split).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    asked = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vector").mapInArrow(
        _visits(index), "query_id long, vector array<double>, block long, first int, bits binary").withColumn(
        "chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    found = ready.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(
        _best(nearest), RESULT)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")


@query("op1_inverted_multi_index")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
