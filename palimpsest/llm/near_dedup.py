"""MinHash near-duplicate detection with an LSH forest.

A document's set is its distinct shingles of five words. ``TREES`` orders of the documents are
sorted, each by a signature of ``DEPTH`` minima. In a sorted order, documents with the longest
common prefix are neighbours. How deep a prefix must be depends on the region: it is the shallowest
depth, from ``LEAST_DEPTH`` on, at which at most ``REGION`` documents share it. Where even the
whole signature is shared by more, sorted neighbours are compared. In a region that is denser at
``LEAST_DEPTH``, every member is also compared with the leaders at the end of its heaviest path.
Candidates are confirmed on the full sets, read from the texts again; links make connected
components. What a dense region still holds beside its largest component is compared with the
documents that are central in most orders: many copies of one text, each changed elsewhere, are
alike to the text and not to each other. What still stands apart from the largest component of one
of its dense regions goes an exact way: a prefix filter on its rarest shingles against all documents
of such regions. So every pair that shares ``LEAST_DEPTH`` minima in one order is compared, or is
in one component already.

Copies: within a batch only the first document of equal sets enters the orders, the others are
linked to it at once, so a group of copies sends one row a batch. Sorted orders are dealt out by
ranges of (signature, set, doc_id), which splits any region.

Defined cases. A null or empty text, or one without words, has the empty set and links with
nothing; fewer than five words are one shingle. Rows that share a doc_id are one node. A null
doc_id links with nothing and is kept, its component is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.llm.components import components, joined_components
from palimpsest.llm.registry import LOWERED, query, table
from palimpsest.llm.words import NOT_SPACE, Words, cut, grams, mix, slices
from palimpsest.scratch import materialise

SHINGLE = 5
TREES = 16
DEPTH = 8
LEAST_DEPTH = 2
REGION = 8
LEADERS = 1
CENTRAL_DOCS = 32
STRAYS = 256
SHINGLES_HELD = 1 << 20
SIMILARITY = 75  # per cent
RARITY_BUCKETS = 1 << 20
_SETS = "doc_id long, n_shingles long, lead long, set_a long, set_b long, signature binary"


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    odd, add = np.split((seeds >> np.uint64(32)).astype(np.uint32), 2)
    return (odd | np.uint32(1))[:, None], add[:, None]


def shingle_sets(words: Words) -> list[np.ndarray]:
    """The sorted distinct shingle fingerprints of each text."""
    all_grams, out = grams(words.hashes, SHINGLE), []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= SHINGLE:
            found = np.sort(all_grams[low:high - SHINGLE + 1])
            out.append(found[np.r_[True, found[1:] != found[:-1]]])
        else:
            out.append(grams(words.hashes[low:high], high - low) if high > low else np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(odd), np.uint32(0xFFFFFFFF))
    for low in range(0, len(folded), 2048):
        out = np.minimum(out, (folded[None, low:low + 2048] * odd + add).min(axis=1))
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    odd, add = _multipliers()
    for batch in batches:
        leads: dict[tuple[int, int, int], int] = {}
        for piece in slices(batch, "text"):
            rows = []
            words = cut(piece.column("text"), NOT_SPACE, lower=True)
            for doc, shingles in zip(piece.column("doc_id").to_pylist(), shingle_sets(words)):
                size = len(shingles)
                if not size or doc is None:
                    rows.append((doc, size, None, 0, 0, None))
                    continue
                one = int(mix(shingles).sum(dtype=np.uint64).view(np.int64))
                two = int(mix(shingles ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64))
                lead = leads.setdefault((one, two, size), doc)
                sign = None
                if lead == doc:
                    sign = signature(shingles, odd, add).astype(">u4").tobytes()
                rows.append((doc, size, lead, one, two, sign))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, [pa.int64()] * 5 + [pa.binary()])],
                ["doc_id", "n_shingles", "lead", "set_a", "set_b", "signature"])


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tree: its number and signature as one sortable key."""
    width = 4 * DEPTH
    for batch in batches:
        docs, sizes = batch.column("doc_id").to_numpy(), batch.column("n_shingles").to_numpy()
        sets = batch.column("set_a").to_numpy()
        signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(-1, TREES, width)
        for tree in range(TREES):
            key = np.empty((len(docs), width + 1), np.uint8)
            key[:, 0], key[:, 1:] = tree, signs[:, tree]
            keys = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(width + 1), len(docs), [None, pa.py_buffer(key.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(sets), pa.array(docs), pa.array(sizes)],
                                             ["key", "set_a", "doc_id", "n_shingles"])


def region_pairs(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of neighbours in a sorted order. ``keys``: tree and minima as rows of numbers.
    Only pairs whose later part is at or after ``fresh`` are returned. Also each row's common prefix
    with the row before it."""
    size = len(keys)
    if size < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.full(size, -1)
    differ = keys[1:] != keys[:-1]
    # Common prefix of each row with the one before it, in minima; -1: another tree.
    prefix = np.r_[-1, np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1]) - 1]
    wanted = np.full(size, DEPTH + 1)
    for depth in range(DEPTH, LEAST_DEPTH - 1, -1):
        number = np.cumsum(prefix < depth) - 1
        wanted = np.where(np.bincount(number)[number] <= REGION, depth, wanted)
    left, right, common = [], [], prefix
    for step in range(1, min(REGION, size)):
        common = np.minimum(common[:size - step], prefix[step:]) if step > 1 else prefix[1:]
        at = np.arange(size - step)
        near = common >= (LEAST_DEPTH if step == 1 else np.minimum(wanted[at], wanted[at + step]))
        at = at[near & (at + step >= fresh)]
        left.append(at)
        right.append(at + step)
    return np.concatenate(left), np.concatenate(right), prefix


def leader_pairs(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In each region of ``LEAST_DEPTH`` that is too large to be compared whole, its leaders and
    every member. Leaders are the first rows on the heaviest path down the prefix tree: they have
    the minima that most members have, so they are close to what the members were copied from.
    Also whether a row is in such a region, and whether it is at the end of its heaviest path."""
    begin = np.flatnonzero(prefix < LEAST_DEPTH)
    end = np.r_[begin[1:], len(prefix)]
    heads, members = [], []
    dense, central = np.zeros(len(prefix), bool), np.zeros(len(prefix), bool)
    for low, high in zip(begin[end - begin > REGION].tolist(), end[end - begin > REGION].tolist()):
        paths = [(low, high)]
        for depth in range(LEAST_DEPTH + 1, DEPTH + 1):
            first, last = paths[-1]
            cuts = np.r_[first, first + 1 + np.flatnonzero(prefix[first + 1:last] < depth), last]
            heaviest = int(np.argmax(np.diff(cuts)))
            paths.append((int(cuts[heaviest]), int(cuts[heaviest + 1])))
        dense[low:high] = True
        central[paths[-1][0]:paths[-1][1]] = True
        chosen: list[int] = []
        for first, last in reversed(paths):
            chosen += [at for at in range(first, min(last, first + 2 * LEADERS)) if at not in chosen]
            if len(chosen) >= LEADERS:
                break
        for head in chosen[:LEADERS]:
            others = np.arange(low, high)
            others = others[others != head]
            heads.append(np.full(len(others), head))
            members.append(others)
    if not heads:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), dense, central
    return np.concatenate(heads), np.concatenate(members), dense, central


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = np.frombuffer(b"".join(batch.column("key").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        keys = np.concatenate([raw[:, :1].astype(np.int64),
                               np.ascontiguousarray(raw[:, 1:]).view(">u4").astype(np.int64)], axis=1)
        sets, docs, sizes = (batch.column(name).to_numpy() for name in ("set_a", "doc_id", "n_shingles"))
        fresh = 0
        if held is not None:
            keys, sets, docs, sizes = (np.concatenate(x) for x in zip(held, (keys, sets, docs, sizes)))
            fresh = len(held[1])
        same = np.r_[False, (sets[1:] == sets[:-1]) & (keys[1:] == keys[:-1]).all(axis=1)]
        fresh -= int(same[:fresh].sum())
        keys, sets, docs, sizes = keys[~same], sets[~same], docs[~same], sizes[~same]
        left, right, prefix = region_pairs(keys, fresh)
        heads, members, dense, central = leader_pairs(prefix)
        new = np.maximum(heads, members) >= fresh
        left, right = np.concatenate([left, heads[new]]), np.concatenate([right, members[new]])
        low, high = np.minimum(docs[left], docs[right]), np.maximum(docs[left], docs[right])
        may = (low != high) & may_be_alike(sizes[left], sizes[right])
        yield _rows(low[may], high[may], PAIR, np.zeros(int(may.sum()), np.int64))
        # The first and the last region may go on in another batch or task.
        own = keys[fresh:, :LEAST_DEPTH + 1]
        open_ = np.r_[np.zeros(fresh, bool), (own == own[:1]).all(axis=1) | (own == own[-1:]).all(axis=1)]
        at = np.flatnonzero((dense | open_) & (np.arange(len(keys)) >= fresh))
        region = mix(mix(keys[at, 0].astype(np.uint64) << np.uint64(32) ^ keys[at, 1].astype(np.uint64))
                     ^ keys[at, 2].astype(np.uint64)).view(np.int64)
        yield _rows(docs[at], region, np.where(central[at], CENTRAL, MEMBER), sizes[at])
        held = (keys[-REGION:], sets[-REGION:], docs[-REGION:], sizes[-REGION:])


# Kinds of rows that a scan of an order gives: lo and hi are two documents, or one and its region.
PAIR, MEMBER, CENTRAL = 0, 1, 2


def _rows(low: np.ndarray, high: np.ndarray, kind: int | np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    kinds = np.broadcast_to(np.asarray(kind, np.int32), len(low))
    return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(kinds), pa.array(sizes)],
                                      ["lo", "hi", "kind", "size"])


def may_be_alike(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can have enough in common."""
    return np.minimum(one, other) * 100 >= SIMILARITY * np.maximum(one, other)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets, as sorted distinct fingerprints, have enough in common."""
    if not len(a) or not may_be_alike(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= SIMILARITY * (len(a) + len(b) - common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text_lo"):
            ours, theirs = (shingle_sets(cut(piece.column(name), NOT_SPACE, lower=True))
                            for name in ("text_lo", "text_hi"))
            keep = [alike(a, b) for a, b in zip(ours, theirs)]
            kept = piece.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("lo"), kept.column("hi")], ["lo", "hi"])


def scan_orders(sets: DataFrame) -> DataFrame:
    """What the sorted orders show, each row once: candidate pairs, members of dense regions."""
    orders = sets.where("signature is not null").select("doc_id", "set_a", "n_shingles", "signature").mapInArrow(
        _orders, "key binary, set_a long, doc_id long, n_shingles long")
    sorted_orders = orders.repartitionByRange("key", "set_a", "doc_id").sortWithinPartitions("key", "set_a", "doc_id")
    return sorted_orders.mapInArrow(_neighbours, "lo long, hi long, kind int, size long").groupBy(
        "lo", "hi", "kind").agg(F.max("size").alias("size"))


def confirmed_links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    ours = texts.select(F.col("doc_id").alias("lo"), F.col("text").alias("text_lo"))
    theirs = texts.select(F.col("doc_id").alias("hi"), F.col("text").alias("text_hi"))
    return materialise(
        pairs.join(ours, "lo").join(theirs, "hi").select("lo", "hi", "text_lo", "text_hi").mapInArrow(
            _confirm, "lo long, hi long"), "confirmed")


def _regions(seen: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents of dense regions with their components; the largest component of each region,
    and whether it is the only one."""
    region = seen.where(F.col("kind") != PAIR).join(found, F.col("lo") == F.col("node"), "left").select(
        F.col("lo").alias("doc"), F.col("hi").alias("region"), "kind", "size",
        F.coalesce("component", "lo").alias("own"))
    largest = region.groupBy("region", "own").agg(F.count(F.lit(1)).alias("size")).groupBy("region").agg(
        F.max_by("own", F.struct("size", -F.col("own"))).alias("whole"), (F.count(F.lit(1)) == 1).alias("only"))
    return region, largest


def central_links(texts: DataFrame, seen: DataFrame, found: DataFrame) -> DataFrame:
    """Links of documents that a dense region holds beside its largest component: each meets the
    ``CENTRAL_DOCS`` most central documents of that component, those that end the heaviest paths of
    most orders. A group is some of a component's strays, at most STRAYS or SHINGLES_HELD shingles
    of several, beside all its central documents, so a stray's text is sent once and not once for
    each of them."""
    region, largest = _regions(seen, found)
    votes = region.where(F.col("kind") == CENTRAL).groupBy("own", "doc").agg(F.count(F.lit(1)).alias("votes"))
    best = Window.partitionBy("own").orderBy(F.desc("votes"), "doc")
    heads = votes.withColumn("place", F.row_number().over(best)).where(F.col("place") <= CENTRAL_DOCS).select(
        F.col("own").alias("whole"), "doc")
    strays = materialise(region.join(largest, "region").where("own <> whole").groupBy("doc", "whole").agg(
        F.max("size").alias("size")), "strays")
    parts = strays.groupBy("whole").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / STRAYS), F.ceil(F.sum("size") / SHINGLES_HELD)).cast("int").alias("parts"))
    held = texts.select("doc_id", "text")
    ours = strays.join(parts, "whole").withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")).join(
        held, F.col("doc") == F.col("doc_id")).select("whole", "part", "doc", "text")
    theirs = heads.join(parts, "whole").join(held, F.col("doc") == F.col("doc_id")).select(
        F.col("whole").alias("whole_of"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part_of"),
        F.col("doc").alias("head"), F.col("text").alias("head_text"))
    return materialise(ours.groupBy("whole", "part").cogroup(theirs.groupBy("whole_of", "part_of")).applyInArrow(
        _meet, "lo long, hi long"), "central")


def _meet(strays: pa.Table, heads: pa.Table) -> pa.Table:
    low, high = [], []
    sides = []
    for side, doc, text in ((strays, "doc", "text"), (heads, "head", "head_text")):
        docs = side.column(doc).to_pylist()
        sets = [found for batch in side.to_batches() for piece in slices(batch, text)
                for found in shingle_sets(cut(piece.column(text), NOT_SPACE, lower=True))]
        sides.append(list(zip(docs, sets)))
    for doc, mine in sides[0]:
        for head, theirs in sides[1]:
            if doc != head and alike(mine, theirs):
                low.append(min(doc, head))
                high.append(max(doc, head))
    return pa.table({"lo": pa.array(low, pa.int64()), "hi": pa.array(high, pa.int64())})


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(RARITY_BUCKETS)).astype(np.int64)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of shingles that a batch holds more than once, and how often."""
    for batch in batches:
        total = np.zeros(RARITY_BUCKETS, np.int64)
        for piece in slices(batch, "text"):
            for shingles in shingle_sets(cut(piece.column("text"), NOT_SPACE, lower=True)):
                np.add.at(total, _buckets(shingles), 1)
        bucket = np.flatnonzero(total > 1)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], ["bucket", "n"])


def rarest(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The first shingles by (weight, fingerprint), so many that two alike sets share one of them."""
    size = len(shingles)
    order = np.lexsort((shingles, weights[_buckets(shingles)]))
    return shingles[order[:size + (-SIMILARITY * size // 100) + 1]]


def _rare(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                parts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [
                    np.zeros(0, np.int64)], [np.zeros(0, bool)]
                sets = shingle_sets(cut(piece.column("text"), NOT_SPACE, lower=True))
                for doc, stray, shingles in zip(piece.column("doc_id").to_pylist(),
                                                piece.column("stray").to_pylist(), sets):
                    if not len(shingles):
                        continue
                    first = rarest(shingles, weights.value)
                    for part, values in zip(parts, (
                            first, np.full(len(first), doc), len(shingles) - np.arange(len(first)),
                            np.full(len(first), len(shingles)), np.full(len(first), stray))):
                        part.append(values)
                shingle, *rest = (np.concatenate(part) for part in parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), *map(pa.array, rest)], ["shingle", "doc", "rest", "size", "stray"])

    return run


def rare_pairs(texts: DataFrame, seen: DataFrame, found: DataFrame) -> DataFrame:
    """Every pair that can be alike of a document that stands apart from the largest component of a
    dense region with another document of such regions. A prefix filter: in one order of all
    shingles, two alike sets have one of their first quarters in common. Frequent shingles come last
    in the order; how well frequencies are known decides the number of pairs only."""
    region, largest = _regions(seen, found)
    inside = materialise(region.join(largest.where("not only"), "region").groupBy("doc").agg(
        F.max(F.col("own") != F.col("whole")).alias("stray")), "apart")
    if inside.isEmpty():
        return inside.select(F.col("doc").alias("lo"), F.col("doc").alias("hi"))
    spark = texts.sparkSession
    held = texts.join(inside, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "stray")
    rows = held.mapInArrow(_frequent, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    weights = np.zeros(RARITY_BUCKETS, np.int64)
    weights[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    rare = materialise(held.mapInArrow(
        _rare(spark.sparkContext.broadcast(weights)),
        "shingle long, doc long, rest long, size long, stray boolean"), "rare")
    one = rare.where("stray").select("shingle", *(F.col(name).alias(f"my_{name}") for name in ("doc", "rest", "size")))
    # What both sets have from their first common shingle on must be enough, so the pair's first
    # common shingle always passes.
    may = ((F.col("my_doc") != F.col("doc")) & (~F.col("stray") | (F.col("my_doc") < F.col("doc")))
           & ((100 + SIMILARITY) * F.least("my_rest", "rest") >= SIMILARITY * (F.col("my_size") + F.col("size"))))
    return one.join(rare.withColumnRenamed("shingle", "theirs"), (F.col("shingle") == F.col("theirs")) & may).select(
        F.least("my_doc", "doc").alias("lo"), F.greatest("my_doc", "doc").alias("hi")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = materialise(texts.mapInArrow(_sets, _SETS), "sets")
    known = texts.where(F.col("doc_id").isNotNull())
    copies = sets.where("lead <> doc_id").select(F.col("lead").alias("lo"), F.col("doc_id").alias("hi"))
    leads = sets.where("signature is not null").select("doc_id", "set_a", "set_b", "n_shingles")
    firsts = leads.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("lo"))
    equal = leads.join(firsts, ["set_a", "set_b", "n_shingles"]).where("lo <> doc_id").select(
        "lo", F.col("doc_id").alias("hi"))
    seen = materialise(scan_orders(sets), "orders")
    links = confirmed_links(known, seen.where(F.col("kind") == PAIR).select("lo", "hi"))
    found = components(links.unionAll(copies).unionAll(equal))
    central = central_links(known, seen, found)
    if not central.isEmpty():
        found = materialise(joined_components(found, central), "joined")
    apart = materialise(rare_pairs(known, seen, found), "apart")
    if not apart.isEmpty():
        found = joined_components(found, confirmed_links(known, apart))
    return sets.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, in their own columns, without those that a smaller doc_id of their component
    stands for. Rows that repeat one kept doc_id all stay."""
    gone = near_duplicates(docs, doc_id, text).where(~F.col("kept")).select(
        F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[doc_id].cast("long") == F.col("__gone"), "left_anti")


OP3_SQL = f"""
with recursive d as (
    select doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') w from documents),
sh as (select distinct doc_id, s from (
    select doc_id, array_to_string(w[i:i + 4], ' ') s from (
        select doc_id, w, unnest(range(1, len(w) - 3)) i from d where len(w) >= 5)
    union all select doc_id, array_to_string(w, ' ') from d where len(w) between 1 and 4)),
n as (select doc_id, count(*) as n from sh group by 1),
link as (select a.doc_id as a, b.doc_id as b
         from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id
         join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
         group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join link l on l.a = r.b),
comp as (select a as doc_id, min(b) as component_id from reach group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, component_id = doc_id as kept
from comp left join n using (doc_id)
"""


@query("op3_minhash_near_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
