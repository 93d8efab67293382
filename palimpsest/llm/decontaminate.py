"""Benchmark decontamination: documents that hold windows of benchmark items.

The distinct windows of the benchmark are collected in blocks of at most ``block_rows`` pairs of
window and item, and every block is broadcast to one scan of the documents. A benchmark of any
size is handled: more blocks, more scans, the same result; a block's broadcast is removed once its
scan is written, so workers and driver hold one block at a time. A hit by fingerprint is confirmed by
comparing words.

Defined cases. A null or empty text has no words. An item without words has no window; an item
shorter than a window is one window. An item without id marks words as hit and is not counted as
an item; repeated items count once. Repeated document rows each get their row. An empty benchmark
hits nothing. Other columns of the documents are not read by ``find_leaks`` and are kept by
``drop_leaking`` and ``cut_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.registry import LOWERED, query, table
from palimpsest.llm.words import ALPHANUMERIC, Words, cut, gram_starts, grams, slices
from palimpsest.scratch import discard, materialise

WINDOW = 10
# Pairs of window and item in one broadcast: about 100 bytes each.
BLOCK_ROWS = 500_000
FILTER_BITS = 20
HITS = "array<struct<start:long,stop:long>>"


def benchmark_windows(benchmark: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """Distinct rows (item, window): the normalised words of each window, joined by one space."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = cut(piece.column("text"), ALPHANUMERIC, lower=True)
                items, texts = [], []
                for row, item in enumerate(piece.column("item").to_pylist()):
                    low, high = int(words.first[row]), int(words.first[row + 1])
                    for at in range(low, max(high - window, low) + 1 if high > low else low):
                        items.append(item)
                        texts.append(words.joined_text(at, min(at + window, high)).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), pa.array(texts, pa.string())], ["item", "window"])

    return benchmark.select(F.col(id_column).cast("long").alias("item"), F.col(text_column).alias("text")) \
        .mapInArrow(windows, "item long, window string").distinct()


class Lookup:
    """Windows of one block by fingerprint."""

    def __init__(self, pairs: list[tuple[int | None, str]]) -> None:
        self.texts = sorted({text.encode() for _, text in pairs})
        number = {text: at for at, text in enumerate(self.texts)}
        self.items: list[list[int]] = [[] for _ in self.texts]
        for item, text in pairs:
            if item is not None:
                self.items[number[text.encode()]].append(item)
        by_length: dict[int, list[tuple[int, int]]] = {}
        if self.texts:
            words = cut(pa.array([text.decode() for text in self.texts]), ALPHANUMERIC, lower=True)
            for at, (low, high) in enumerate(zip(words.first[:-1], words.first[1:])):
                found = grams(words.hashes[low:high], int(high - low))[0]
                by_length.setdefault(int(high - low), []).append((int(found), at))
        self.lengths = []
        for length, entries in sorted(by_length.items()):
            keys = np.array([key for key, _ in entries], np.uint64)
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[keys & np.uint64((1 << FILTER_BITS) - 1)] = True
            self.lengths.append((length, keys[order], np.array([at for _, at in entries])[order], seen))

    def hits(self, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """(number of a window, its length, positions of its confirmed occurrences)."""
        for length, keys, numbers, seen in self.lengths:
            found = grams(words.hashes, length)
            if not len(found):
                continue
            at = np.flatnonzero(seen[found & np.uint64((1 << FILTER_BITS) - 1)])
            at = at[at + length <= np.repeat(words.first[1:], words.counts)[at]]
            low, high = np.searchsorted(keys, found[at], "left"), np.searchsorted(keys, found[at], "right")
            while len(at := at[low < high]):  # more than once only where fingerprints collide
                low, high = low[low < high], high[low < high]
                order = np.argsort(numbers[low], kind="stable")
                some, number = at[order], numbers[low][order]
                bounds = [*np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(number)]
                for begin, end in zip(bounds[:-1], bounds[1:]):
                    same = confirmed(words, some[begin:end], self.texts[number[begin]].split(b" "))
                    if len(same):
                        yield int(number[begin]), length, same
                low = low + 1


def confirmed(words: Words, at: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """The positions at which exactly the wanted words begin."""
    for step, word in enumerate(wanted):
        begin = words.starts[at + step]
        at = at[words.ends[at + step] - begin == len(word)]
        begin = words.starts[at + step]
        same = (words.data[begin[:, None] + np.arange(len(word))]
                == np.frombuffer(word, np.uint8)).all(axis=1)
        at = at[same]
    return at



def _scan(docs: DataFrame, lookup) -> DataFrame:
    """id, key of the text, n_words, merged spans of hit words, items."""
    schema = f"doc_id long, text_key long, n_words long, spans {HITS}, items array<long>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lookup.value
        for batch in batches:
            for piece in slices(batch, "text"):
                words = cut(piece.column("text"), ALPHANUMERIC, lower=True)
                total, rows = int(words.first[-1]), words.rows()
                change = np.zeros(total + 1, np.int64)
                items: dict[int, set[int]] = {}
                for number, length, at in known.hits(words):
                    np.add.at(change, at, 1)
                    np.add.at(change, at + length, -1)
                    for row in np.unique(rows[at]):
                        items.setdefault(int(row), set()).update(known.items[number])
                hit = np.cumsum(change[:-1]) > 0
                spans: dict[int, list[dict[str, int]]] = {}
                if items or hit.any():
                    same = np.r_[False, hit[1:] & hit[:-1] & (rows[1:] == rows[:-1])]
                    begins = np.flatnonzero(hit & ~same)
                    ends = np.flatnonzero(hit & ~np.r_[same[1:], False]) + 1
                    for low, high in zip(begins, ends):
                        row = int(rows[low])
                        base = words.first[row]
                        spans.setdefault(row, []).append({"start": int(low - base), "stop": int(high - base)})
                number_of_rows = range(piece.num_rows)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("text_key"), pa.array(words.counts, pa.int64()),
                    pa.array([spans.get(row, []) for row in number_of_rows],
                             pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array([sorted(items.get(row, ())) for row in number_of_rows], pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "n_words", "spans", "items"])

    return docs.mapInArrow(scan, schema)


def _lookups(benchmark: DataFrame, window: int, block_rows: int, item_id: str,
             item_text: str) -> tuple[int, Iterator[Broadcast]]:
    """How many blocks the benchmark's windows take, and their broadcasts, each made when it is asked
    for. The windows are written once and read for each block."""
    pairs = materialise(benchmark_windows(benchmark, window, item_id, item_text), "windows")
    blocks = max(1, -(-pairs.count() // block_rows))
    block = F.pmod(F.xxhash64("item", "window"), F.lit(blocks))
    context = benchmark.sparkSession.sparkContext

    def one(number: int) -> Broadcast:  # about block_rows rows at most
        rows = pairs.where(block == number).toArrow()
        return context.broadcast(Lookup(list(zip(rows.column("item").to_pylist(), rows.column("window").to_pylist()))))

    return blocks, map(one, range(blocks))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_rows: int = BLOCK_ROWS,
               doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """One row per document row: doc_id, text_key, n_words, spans of hit words (of one block each;
    they may overlap), items with an occurring window."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                         F.col(text).alias("text"))
    blocks, lookups = _lookups(benchmark, window, block_rows, item_id, item_text)
    if blocks == 1:
        return _scan(narrow, next(lookups))
    hits = []
    for lookup in lookups:
        hits.append(materialise(_scan(narrow, lookup).where(F.size("spans") > 0).select(
            "doc_id", "text_key", "spans", "items"), "hits"))
        lookup.destroy()  # what it found is written
    found = reduce(DataFrame.unionAll, hits)
    found = found.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).agg(
        F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("text_key").eqNullSafe(F.col("hit_key"))
    counted = _scan(narrow, docs.sparkSession.sparkContext.broadcast(Lookup([])))
    return counted.select("doc_id", "text_key", "n_words").join(found, same, "left").select(
        "doc_id", "text_key", "n_words",
        F.coalesce("spans", F.array().cast(HITS)).alias("spans"),
        F.array_distinct(F.coalesce("items", F.array().cast("array<long>"))).alias("items"))


def leak_report(leaks: DataFrame) -> DataFrame:
    positions = F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["stop"] - 1)))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return leaks.select(
        "doc_id", "n_words", F.size(F.array_distinct(positions)).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_rows: int = BLOCK_ROWS,
                 text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any hit, in their own columns: one scan for each block, each written
    before the next but for the last."""
    schema = docs.schema

    def without_hits(lookup) -> callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, text):
                    words = cut(piece.column(text), ALPHANUMERIC, lower=True)
                    rows, clean = words.rows(), np.ones(piece.num_rows, bool)
                    for _, _, at in lookup.value.hits(words):
                        clean[rows[at]] = False
                    yield piece.filter(pa.array(clean))

        return run

    blocks, lookups = _lookups(benchmark, window, block_rows, item_id, item_text)
    for number, lookup in enumerate(lookups, 1):
        kept = docs.mapInArrow(without_hits(lookup), schema)
        if number < blocks:
            kept = materialise(kept, "clean")
            lookup.destroy()
            if number > 1:
                discard(docs)
        docs = kept
    return docs


def cut_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in their own columns, their hit words cut out with what stands between words
    of one span. Options are those of ``find_leaks``."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    leaks = find_leaks(docs, benchmark, **options).where(F.size("spans") > 0).groupBy(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.first("spans").alias("__spans"))
    same = docs[doc_id].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text]) == F.col("__key"))
    schema = docs.schema
    marked = docs.join(leaks, same, "left").drop("__id", "__key")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                words = cut(piece.column(text), ALPHANUMERIC, lower=True)
                texts = piece.column(text).to_pylist()
                begin = np.cumsum([0, *(len((x or "").encode()) for x in texts)])
                for row, spans in enumerate(piece.column("__spans").to_pylist()):
                    raw, base = (texts[row] or "").encode(), int(words.first[row])
                    kept, at = [], 0
                    for span in sorted(spans or [], key=lambda x: x["start"]):
                        low = int(words.starts[base + span["start"]] - begin[row])
                        high = int(words.ends[base + span["stop"] - 1] - begin[row])
                        kept.append(raw[at:max(low, at)])
                        at = max(at, high)
                    if spans:
                        texts[row] = b"".join([*kept, raw[at:]]).decode()
                columns = [pa.array(texts, piece.schema.field(name).type) if name == text else piece.column(name)
                           for name in schema.names]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return marked.mapInArrow(clean, schema)


WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(LOWERED)

OP5_SQL = f"""
with d as (select doc_id, {WORDS} w from documents),
b as (select item_id, {WORDS} w from benchmark),
bw as (select distinct item_id, len(w) as n, w as win from b where len(w) between 1 and 9
       union select distinct item_id, 10, w[i:i + 9] from (
           select item_id, w, unnest(range(1, len(w) - 8)) i from b where len(w) >= 10)),
dw as (select doc_id, n, i, w[i:i + n - 1] win from (
           select doc_id, n, w, unnest(range(1, len(w) - n + 2)) i
           from d, (select distinct n from bw) where len(w) >= n)),
hits as (select doc_id, n, i, item_id from dw join bw using (n, win)),
words_hit as (select doc_id, count(distinct p) as n_hit from (
    select doc_id, unnest(range(i, i + n)) p from (select distinct doc_id, n, i from hits)) group by 1),
items as (select doc_id, count(distinct item_id) as n_items,
                 string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
          from hits group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join words_hit using (doc_id) left join items using (doc_id)
"""


@query("op5_benchmark_decontamination", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
