"""Substring deduplication on the de Bruijn graph of word windows.

An edge is a window of ``window`` consecutive words. Neighbouring windows whose smallest gram of
``SEED`` words is the same occurrence form a run, which is an unbranched stretch of the text; equal
runs hold equal windows, so most edges are compared by the run and not one by one.

1. Each task cuts its documents into runs, keyed by the smallest gram. Within a batch only the
   first occurrence of a run goes on, later ones are already known as repeats. A gram with several
   runs in the batch is a branch: its windows go on one by one, again once each, and a mark. So a
   text that a third of all documents share sends one row a batch, not one a document.
2. One exchange by the gram finds runs that start earlier elsewhere, and further branches.
3. The windows of branching runs are cut from the texts (a join by source coordinates) and compared
   one by one.
4. Repeated pieces that follow each other in a document and in the source are compacted to paths.
5. A join by source coordinates confirms each path: digests of the words at both places are equal.

Defined cases. A null or empty text, or one shorter than a window, has no windows. A null doc_id
takes no part and its text stays. doc_id names a text; rows that repeat a document are all treated
alike and do not count as earlier. Other columns are not read by ``repeated_paths``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.llm.membership import divide
from palimpsest.llm.registry import query, table
from palimpsest.llm.words import NOT_SPACE, cut, gram_starts, grams, joined, slices
from palimpsest.scratch import materialise

WINDOW = 20
SEED = 8
RUN, MARK, REPEAT, EDGE = 0, 1, 2, 3
ROW = ("key", "kind", "run", "doc_id", "pos", "count", "source", "source_pos")
ROW_SCHEMA = ("key long, kind int, run long, doc_id long, pos int, count int, source long, "
              "source_pos int")
_KINDS = dict(zip(ROW, (np.int64, np.int32, np.int64, np.int64, np.int32, np.int32, np.int64, np.int32)))


def _batch(columns: dict) -> pa.RecordBatch:
    size = len(columns["key"])
    return pa.RecordBatch.from_arrays([
        pa.array(np.broadcast_to(columns.get(name, 0), size).astype(kind, copy=False))
        for name, kind in _KINDS.items()], list(ROW))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    return np.minimum(out[:len(values) - width + 1], out[width - have:][:len(values) - width + 1])


def runs_of(words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Smallest gram, run fingerprint, first window (as a word's number) and windows of each run;
    and the fingerprints of all windows."""
    edges = grams(words.hashes, window)
    at = gram_starts(words, window)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), at, at, edges
    small = grams(words.hashes, SEED)
    width = window - SEED + 1
    least = _sliding_min(small, width)[at]
    place = at.copy()
    for step in range(width - 1, -1, -1):
        place = np.where(small[at + step] == least, at + step, place)
    new = np.r_[True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]
    begin = np.flatnonzero(new)
    count = np.diff(np.r_[begin, len(at)])
    first = at[begin]
    run = joined(edges[first], edges[first + count - 1] + count.astype(np.uint64))
    return least[begin], run, first, count, edges


def settle(key, run, doc, pos):
    """Order by key, run and place. For each row in that order: where its run begins, whether it
    begins it, whether it is later than the first, and whether its key has several runs."""
    order = np.lexsort((pos, doc, run, key))
    key, run, doc, pos = key[order], run[order], doc[order], pos[order]
    new_key = np.r_[True, key[1:] != key[:-1]]
    new_run = new_key | np.r_[True, run[1:] != run[:-1]]
    begin = np.maximum.accumulate(np.where(new_run, np.arange(len(key)), 0))
    later = (doc != doc[begin]) | (pos != pos[begin])
    number = np.cumsum(new_key) - 1
    return order, begin, new_run, later, (np.bincount(number, new_run) > 1)[number], number


def _cut_runs(window: int):
    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, all_edges, base = [], [], 0
            for piece in slices(batch, "text"):
                words = cut(piece.column("text"), NOT_SPACE, lower=False)
                seed, run, first, count, edges = runs_of(words, window)
                rows = np.searchsorted(words.first, first, "right") - 1
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
                parts.append((seed.view(np.int64), run.view(np.int64), ids[rows],
                              first - words.first[rows], count, first + base))
                all_edges.append(edges)
                base += len(edges)
            if not parts or not sum(len(part[0]) for part in parts):
                continue
            seed, run, doc, pos, count, place = (np.concatenate(x) for x in zip(*parts))
            edges = np.concatenate(all_edges).view(np.int64)
            del parts, all_edges
            order, begin, first, later, several, _ = settle(seed, run, doc, pos)
            seed, run, doc, pos, count, place = (x[order] for x in (seed, run, doc, pos, count, place))
            yield _batch({"key": run[later] ^ doc[later], "kind": REPEAT, "doc_id": doc[later], "pos": pos[later],
                          "count": count[later], "source": doc[begin[later]], "source_pos": pos[begin[later]]})
            plain = first & ~several
            yield _batch({"key": seed[plain], "kind": RUN, "run": run[plain], "doc_id": doc[plain],
                          "pos": pos[plain], "count": count[plain]})
            branch = first & several
            if branch.any():
                marks = np.unique(seed[branch])
                yield _batch({"key": marks, "kind": MARK})
                yield from _edges(seed[branch], doc[branch], pos[branch], count[branch], place[branch], edges)

    return cut_batches


def _edges(seed, doc, pos, count, place, edges) -> Iterator[pa.RecordBatch]:
    """The windows of some runs, the first of each kind as an edge, later ones as repeats."""
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    seed, doc, pos = np.repeat(seed, count), np.repeat(doc, count), np.repeat(pos, count) + step
    edge = edges[np.repeat(place, count) + step]
    order, begin, first, later, _, _ = settle(edge, seed, doc, pos)
    edge, seed, doc, pos = (x[order] for x in (edge, seed, doc, pos))
    yield _batch({"key": edge[first], "kind": EDGE, "run": seed[first], "doc_id": doc[first],
                  "pos": pos[first], "count": 1})
    yield _batch({"key": edge[later] ^ doc[later], "kind": REPEAT, "doc_id": doc[later], "pos": pos[later],
                  "count": 1, "source": doc[begin[later]], "source_pos": pos[begin[later]]})


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their key; rows of one key may span batches. Leaves repeats, edges, and
    the first runs of branching keys."""
    def done(rows: dict) -> Iterator[pa.RecordBatch]:
        ready = (rows["kind"] == REPEAT) | (rows["kind"] == EDGE)
        yield _batch({name: column[ready] for name, column in rows.items()})
        rows = {name: column[~ready] for name, column in rows.items()}
        if not len(rows["key"]):
            return
        marked = rows["kind"] == MARK
        order, begin, first, later, several, number = settle(
            rows["key"], np.where(marked, 0, rows["run"]), rows["doc_id"], rows["pos"])
        rows = {name: column[order] for name, column in rows.items()}
        marked = marked[order]
        branch = several | (np.bincount(number, marked) > 0)[number]
        # A mark and a run that is 0 by chance would share a run; then the run is only cut finer.
        repeat = later & ~marked & ~marked[begin]
        yield _batch({**{name: rows[name][repeat] for name in ("key", "doc_id", "pos", "count")},
                      "kind": REPEAT, "source": rows["doc_id"][begin[repeat]],
                      "source_pos": rows["pos"][begin[repeat]]})
        wanted = branch & ~marked & ~repeat
        yield _batch({**{name: column[wanted] for name, column in rows.items()}, "kind": RUN})

    held = None
    for batch in batches:
        rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ROW}
        if held is not None:
            rows = {name: np.concatenate([held[name], rows[name]]) for name in ROW}
        if not len(rows["key"]):
            continue
        keys = rows["key"]
        low = int(np.searchsorted(keys, keys[-1], "left"))
        if low:
            yield from done({name: column[:low] for name, column in rows.items()})
        held = {name: column[low:] for name, column in rows.items()}
    if held is not None:
        yield from done(held)


def _cut_edges(window: int):
    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = cut(piece.column("text"), NOT_SPACE, lower=False)
                edges = grams(words.hashes, window).view(np.int64)
                wanted = piece.column("wanted")
                size = np.diff(wanted.offsets.to_numpy())
                flat = wanted.flatten()
                seed, pos, count = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                doc = np.repeat(piece.column("doc_id").to_numpy(zero_copy_only=False), size)
                place = np.repeat(words.first[:-1], size) + pos
                inside = pos + count + window - 1 <= np.repeat(words.counts, size)
                if inside.any():
                    yield from _edges(*(x[inside] for x in (seed, doc, pos, count.astype(np.int64), place)), edges)

    return cut_batches


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = (row["text"] or "").encode().split()
            spans = row["wanted"]
            yield pa.RecordBatch.from_arrays([
                pa.array([row["doc_id"]] * len(spans), pa.int64()),
                pa.array([x["start"] for x in spans], pa.int32()), pa.array([x["stop"] for x in spans], pa.int32()),
                pa.array([hashlib.sha256(b" ".join(words[x["start"]:x["stop"]])).digest() for x in spans],
                         pa.binary())], ["doc_id", "start", "stop", "digest"])


def _joined_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts with the list of what is wanted from them: ``wanted`` has doc_id and the wanted struct.
    A document's list is bounded by its own length, for the wanted places are distinct."""
    lists = wanted.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("wanted").alias("wanted"))
    texts, _ = divide(texts, "doc_id", wanted.select("doc_id"))
    return texts.join(lists, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "wanted")


def repeated_pieces(texts: DataFrame, window: int) -> DataFrame:
    """doc_id, pos, count (windows), source, source_pos: windows that also start earlier."""
    cut_runs = texts.mapInArrow(_cut_runs(window), ROW_SCHEMA)
    compared = materialise(
        cut_runs.repartition("key").sortWithinPartitions("key").mapInArrow(_compare, ROW_SCHEMA), "edges")
    wanted = compared.where(F.col("kind") == RUN).select(
        "doc_id", F.struct(F.col("key").alias("seed"), "pos", "count").alias("wanted"))
    branches = _joined_texts(texts, wanted).mapInArrow(_cut_edges(window), ROW_SCHEMA)
    edges = compared.where(F.col("kind") == EDGE).unionAll(branches.where(F.col("kind") == EDGE))
    place = F.struct("doc_id", "pos")
    earliest = edges.withColumn("least", F.min(place).over(Window.partitionBy("key", "run"))).where(
        place > F.col("least"))
    parts = ("doc_id", "pos", "count", "source", "source_pos")
    return compared.where(F.col("kind") == REPEAT).select(*parts).unionAll(
        branches.where(F.col("kind") == REPEAT).select(*parts)).unionAll(
        earliest.select("doc_id", "pos", "count", "least.doc_id", "least.pos"))


def repeated_paths(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, stop (words), source, source_start: maximal spans that repeat an earlier
    place, confirmed word by word through digests of both places."""
    if window < SEED:
        raise ValueError(f"a window has at least {SEED} words")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(
        F.col("doc_id").isNotNull())
    pieces = repeated_pieces(texts, window).distinct()
    by_place = Window.partitionBy("doc_id").orderBy("pos", "source", "source_pos", "count")
    shift = F.col("source_pos") - F.col("pos")
    follows = (F.lag("source").over(by_place) == F.col("source")) & (F.lag(shift).over(by_place) == shift) & (
        F.lag(F.col("pos") + F.col("count")).over(by_place) >= F.col("pos"))
    paths = materialise(
        pieces.withColumn("new", F.when(follows, 0).otherwise(1))
        .withColumn("path", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "path").agg(
            F.min("pos").alias("start"), (F.max(F.col("pos") + F.col("count")) + (window - 1)).alias("stop"),
            F.min("source").alias("source"), F.min("source_pos").alias("source_start")).drop("path"), "paths")
    source_stop = F.col("source_start") + F.col("stop") - F.col("start")
    wanted = paths.select("doc_id", "start", "stop").unionAll(
        paths.select("source", "source_start", source_stop)).select(
        "doc_id", F.struct("start", "stop").alias("wanted"))
    digests = materialise(_joined_texts(texts, wanted).mapInArrow(
        _digests, "doc_id long, start int, stop int, digest binary"), "digests")
    own = digests.toDF("doc_id", "start", "stop", "own")
    theirs = digests.toDF("source", "source_start", "source_stop", "theirs")
    return paths.withColumn("source_stop", source_stop).join(own, ["doc_id", "start", "stop"]).join(
        theirs, ["source", "source_start", "source_stop"]).where(F.col("own") == F.col("theirs")).select(
        "doc_id", "start", "stop", "source", "source_start").distinct()


def _kept(batches: Iterator[pa.RecordBatch], report: bool, text: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, text, 4 << 20):
            counts, removed, digests, texts = [], [], [], []
            for value, spans in zip(piece.column(text).to_pylist(), piece.column("__spans").to_pylist()):
                words = (value or "").encode().split()
                total = len(words)
                if spans:
                    keep = np.ones(total, bool)
                    for span in spans:
                        keep[span["start"]:span["stop"]] = False
                    words = [words[at] for at in np.flatnonzero(keep)]
                counts.append(total)
                removed.append(total - len(words))
                if report:
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                else:
                    texts.append(b" ".join(words).decode() if spans else value)
            if report:
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([
                    pa.array(texts, pa.string()) if name == text else piece.column(name) for name in names], names)


def _marked(docs: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """The documents with their spans; those without any are not sent anywhere."""
    paths = materialise(repeated_paths(docs, window, doc_id, text).select("doc_id", "start", "stop"), "spans")
    spans = paths.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("start", "stop")).alias("__spans"))
    may, rest = divide(docs, doc_id, paths.select("doc_id"))
    found = may.join(spans, may[doc_id].cast("long") == F.col("__id"), "left").drop("__id")
    return found.unionAll(rest.withColumn("__spans", F.lit(None).cast(found.schema["__spans"].dataType)))


def removal_report(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, digest of the kept words."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _marked(narrow, window, "doc_id", "text").mapInArrow(
        lambda batches: _kept(batches, True, "text", []),
        "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in their own columns; texts that lose words are their kept words joined by one
    space, other texts stay as they are."""
    names = docs.columns
    return _marked(docs, window, doc_id, text).mapInArrow(
        lambda batches: _kept(batches, False, text, names), docs.schema)


OP7_SQL = """
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents),
win as (select doc_id, i, sha256(array_to_string(w[i:i + 19], ' ')) h from (
    select doc_id, w, unnest(range(1, len(w) - 18)) i from d where len(w) >= 20)),
later as (select doc_id, i from win qualify row_number() over (partition by h order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) p from later),
word as (select doc_id, w[p] x, p from (select doc_id, w, unnest(range(1, len(w) + 1)) p from d)),
kept as (select doc_id, string_agg(x, ' ' order by p) t, count(*) n
         from word anti join gone using (doc_id, p) group by 1)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""


@query("op7_substring_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))
