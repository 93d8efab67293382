"""Brown class-based n-grams: exchange clustering, class transitions, word emissions.

Counts come from all training documents, and every word of theirs has a class by exchange. The
``CLUSTERED`` most frequent words begin, one at a time on the driver, on their bigram counts (at
most units squared, whatever the corpus); until then the others stand in ``ENDINGS`` classes by
their last two bytes. Then, ``ROUNDS`` times at most, words choose in tasks the class that raises
the likelihood most, on the classes before and after them. The first round gives every word its
class; a later one that does not raise the likelihood is not taken and ends the exchange. How often
a word has which classes beside it is counted while the text is cut, against the broadcast classes of
frequent words. Words are dealt into buckets by their fingerprints; a task sends one row a bucket and
slice, and a bucket is added up part by part. Only words beside a rarer one go by the bucket of that one
first, where its class is. The end of a text has a class of its own; words that training does not have, and
only these, belong to the ending classes. A text's probability is the product, over its tokens, of the
probability of the class after the class before, and of the word in its class. Words are known by
64-bit fingerprints.

The counts and classes of at most ``HEAD`` frequent words are broadcast; pairs with other words meet
theirs in their buckets or in joins. So the broadcast is bounded and no word or document is left out. A
broadcast is given back as soon as what was made with it is written.

Defined cases. A null or empty text is its end token alone. Rows that repeat a document are scored
and counted each. A null doc_id counts as the empty id for the fold. Without training documents
all counts are zero. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.lookup import Lookup
from palimpsest.llm.registry import query, table
from palimpsest.llm.words import NOT_SPACE, Words, cut, joined, mix, release_memory, runs, slices
from palimpsest.scratch import discard, materialise

HEAD = 1 << 20
CLUSTERED = 1024
CLASSES = 64
ENDINGS = 32
SWEEPS = 4
ROUNDS = 2
CONTEXT_SLICE = 2 << 20
HELD_ROWS = 4096
HELD_KEYS = 1 << 18
MOVED_ROWS = 4096
ADDED = 0.1
STEPS = 16  # frequency steps in a factor of two, to find the head
END = mix(np.array([0x656E64], np.uint64))[0]


def endings(words: Words) -> np.ndarray:
    last = words.data[words.ends - 1].astype(np.uint64)
    before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    return (mix(last * np.uint64(256) + before) % np.uint64(ENDINGS)).astype(np.int32)


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, endings and texts of all tokens, the end of each text included."""
    texts = len(words.first) - 1
    place = words.first[1:]
    return (np.insert(words.hashes, place, END), np.insert(endings(words), place, ENDINGS),
            np.repeat(np.arange(texts), words.counts + 1))


def token_words(words: Words) -> np.ndarray:
    """Fingerprints of all tokens."""
    return np.insert(words.hashes, words.first[1:], END)


def _added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, first, np.bincount(place, counts).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for piece in slices(batch, "text"):
            words, ending, _ = tokens(cut(piece.column("text"), NOT_SPACE, lower=True))
            found, first, count = _added_up(words, np.ones(len(words)))
            parts.append((found, ending[first], count))
        if parts:
            words, ending, count = (np.concatenate(x) for x in zip(*parts))
            found, first, count = _added_up(words, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(ending[first]), pa.array(count)], ["word", "ending", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """word, ending, n."""
    return texts.mapInArrow(_count_words, "word long, ending int, n long").groupBy("word").agg(
        F.first("ending").alias("ending"), F.sum("n").alias("n"))


@dataclass
class Model:
    """What scoring needs beside the counts and classes of rare words. Its size is bounded by the
    parameters."""

    total: int
    distinct: int
    head: Lookup
    head_counts: np.ndarray
    head_class: np.ndarray
    log_transition: np.ndarray
    class_size: np.ndarray
    classes: int

    def base_size(self) -> float:
        return self.total + ADDED * (self.distinct + 1)


def _head(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, classes and counts of at most ``size`` words: all those from a frequency on."""
    step = F.floor(F.log2("n") * STEPS).cast("int")
    steps = sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    least, found = None, 0
    for row in steps:
        found += row["words"]
        if found > size:
            break
        least = row["step"]
    chosen = counts.where(step >= least) if least is not None else counts.limit(0)
    rows = chosen.select("word", "class", "n").toArrow()
    word = rows.column("word").to_numpy().view(np.uint64)
    return word, rows.column("class").to_numpy(), rows.column("n").to_numpy()


def _units(words: np.ndarray, ending: np.ndarray, unit: Lookup, clustered: int) -> np.ndarray:
    """Clustered words by their number, then the endings, then the end of a text."""
    found = unit.get(words)
    return np.where(ending == ENDINGS, clustered + ENDINGS, np.where(found >= 0, found, clustered + ending))


def _before(units: np.ndarray, end: int) -> np.ndarray:
    """The unit before each token; a text begins after an end."""
    return np.r_[end, units[:-1]] if len(units) else units


def unit_bigrams(texts: DataFrame, unit, clustered: int) -> DataFrame:
    """pair (unit before times units plus unit), n."""
    units = clustered + ENDINGS + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unit.value
        for batch in batches:
            total = np.zeros(units * units, np.int64)
            for piece in slices(batch, "text"):
                words, ending, _ = tokens(cut(piece.column("text"), NOT_SPACE, lower=True))
                here = _units(words, ending, known, clustered).astype(np.int64)
                total += np.bincount(_before(here, units - 1) * units + here, minlength=units * units)
            pair = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    return texts.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, clustered: int, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit. Words move, one at a time, to the class that raises the likelihood of
    the class bigrams most; units from ``clustered`` on keep classes of their own. Begins with the
    words dealt out in turn; ends when no word moves, or after ``sweeps``."""
    units = len(bigrams)
    of = np.r_[np.arange(clustered) % classes, classes + np.arange(units - clustered)].astype(np.int64)
    number = classes + units - clustered
    table_ = np.zeros((number, number))
    np.add.at(table_, (of[:, None], of[None, :]), bigrams)
    for _ in range(sweeps):
        moved = 0
        for word in range(clustered):
            own = of[word]
            self_count = bigrams[word, word]
            after = np.bincount(of, bigrams[word], number)
            before = np.bincount(of, bigrams[:, word], number)
            after[own] -= self_count
            before[own] -= self_count
            table_[own, :] -= after
            table_[:, own] -= before
            table_[own, own] -= self_count
            # Bigrams with the word count for their other side wherever the word goes.
            rows, columns = (table_.sum(axis=1) + before)[:classes], (table_.sum(axis=0) + after)[:classes]
            out, into = table_[:classes, :], table_[:, :classes].T
            at = np.arange(classes)
            gain = (_xlogx(out + after) - _xlogx(out)).sum(axis=1) + (_xlogx(into + before) - _xlogx(into)).sum(axis=1)
            middle = out[at, at]
            gain -= (_xlogx(middle + after[:classes]) - _xlogx(middle)) + (
                _xlogx(middle + before[:classes]) - _xlogx(middle))
            gain += _xlogx(middle + after[:classes] + before[:classes] + self_count) - _xlogx(middle)
            gain -= _xlogx(rows + after.sum() + self_count) - _xlogx(rows)
            gain -= _xlogx(columns + before.sum() + self_count) - _xlogx(columns)
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = int(own)
            of[word] = best
            moved += best != own
            table_[best, :] += after
            table_[:, best] += before
            table_[best, best] += self_count
        if not moved:
            break
    return of


@dataclass
class Beside:
    """Classes of frequent words, for counting what stands beside every word. ``hot``: the first
    words of the head, whose counts a task adds up to its end."""

    head: Lookup
    words: np.ndarray
    classes: np.ndarray
    end_class: int
    number: int
    hot: int

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the head and classes, -1 where the head does not have the word."""
        place = self.head.get(words).astype(np.int64)
        own = np.where(place >= 0, self.classes[place] if len(self.classes) else 0, -1)
        own[words == END] = self.end_class
        return place, own


def _beside(known: DataFrame, number: int, end_class: int, head_size: int, hot: int) -> Beside:
    word, own, n = _head(known, head_size)
    order = np.lexsort((word, -n))
    # After the hot words in the order of their fingerprints, as blocks need them.
    order = np.r_[order[:hot], order[hot:][np.argsort(word[order[hot:]])]]
    word, own = word[order], own[order].astype(np.int64)
    return Beside(Lookup(word, np.arange(len(word), dtype=np.int32)), word, own, end_class, number, min(hot, len(word)))


# A block: of words of one bucket, in order, how many places each has, these and their counts; or, where
# ``sizes`` is null, words of unknown class, the sides they stand on and the words they stand beside.
BLOCK = ("bucket", "words", "sizes", "at", "times")
BLOCK_SCHEMA = "bucket int, words binary, sizes binary, at binary, times binary"
FACTS = ["word", "ending", "n", "class", "hot"]
WORD_SCHEMA = "word long, ending int, n long, class int, hot boolean"


def _binary(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """The numbers begin[0] to begin[1] - 1, begin[1] to begin[2] - 1 and so on as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(begin) - 1, [
        None, pa.py_buffer((begin * values.itemsize).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _all_bytes(values: pa.Array, kind: str) -> np.ndarray:
    """What all values hold, one after the other; a null holds nothing."""
    if not len(values):
        return np.zeros(0, kind)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]].view(kind) if at[-1] > at[0] else np.zeros(0, kind)


def _bucket_bits(words: int) -> int:
    """So many first bits of a fingerprint name its bucket that one has about 8,192 words at most."""
    return min(20, max(8, (words >> 13).bit_length()))


def _cut_up(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of words in order, and where each begins."""
    bucket = (words >> np.uint64(64 - bits)).astype(np.int32)
    first = runs(bucket)
    return bucket[first], np.r_[first, len(words)].astype(np.int64)


def _packed(keys: np.ndarray, times: np.ndarray, names: np.ndarray, bits: int) -> pa.RecordBatch:
    """Blocks from sorted distinct keys (number of a word, in order, times 256 plus place) and their counts."""
    number = keys >> 8
    first = runs(number)
    begin = np.r_[first, len(keys)].astype(np.int64)
    words = names[number[first]]
    bucket, cuts = _cut_up(words, bits)
    kind = next(kind for kind in ("<u1", "<u2", "<u4", "<u8") if times.max(initial=0) <= np.iinfo(kind).max)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), _binary(words, cuts), _binary(np.diff(begin).astype("<u2"), cuts),
         _binary((keys & 255).astype(np.uint8), begin[cuts]), _binary(times.astype(kind), begin[cuts])], list(BLOCK))


def _opened(blocks: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, how many places each has, the places, and their counts, of some blocks."""
    words, sizes, at = (_all_bytes(blocks.column(name), kind) for name, kind in (
        ("words", "<u8"), ("sizes", "<u2"), ("at", "u1")))
    places = pc.binary_length(blocks.column("at")).to_numpy()
    wide = pc.binary_length(blocks.column("times")).to_numpy() // places  # bytes of a count
    times = np.zeros(len(at), np.int64)
    width = np.repeat(wide, places)
    for kind in np.unique(wide):
        times[width == kind] = _all_bytes(blocks.column("times").filter(pa.array(wide == kind)), f"<u{kind}")
    return words, sizes, at, times


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(times, first)


def _added_blocks(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_opened`` gave several times, as one: words in order, places of a word once."""
    words, sizes, at, times = (np.concatenate(x) for x in zip(*parts))
    names, number = np.unique(words, return_inverse=True)
    keys, times = _summed((np.repeat(number, sizes) << 8) + at, times)
    return names, np.bincount(keys >> 8, minlength=len(names)), (keys & 255).astype(np.uint8), times


def _bucket_by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple[pa.RecordBatch, pa.RecordBatch]]]:
    """For each bucket the facts and the blocks of it, part by part, from rows in the order of their buckets."""
    def parts():
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            first = runs(bucket)
            for low, high in zip(first, [*first[1:], len(bucket)]):
                part = batch.slice(low, high - low)
                fact = pc.is_valid(part.column("word"))
                yield bucket[low], (part.filter(fact).select(FACTS), part.filter(pc.invert(fact)).select(BLOCK))

    for _, found in groupby(parts(), itemgetter(0)):
        yield (part for _, part in found)


def _count_beside(beside, bits: int) -> callable:
    """Blocks of words with the classes beside them, and of words of unknown class with what they stand beside."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Beside = beside.value
        cells = np.zeros(known.hot << 8, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for piece in slices(batch, "text", CONTEXT_SLICE):
                words = token_words(cut(piece.column("text"), NOT_SPACE, lower=True))
                place, own = known.find(words)
                others, first = np.unique(words[place < 0], return_inverse=True)
                place[place < 0] = len(known.words) + first
                end = np.flatnonzero(words == END)[:1]
                before = np.r_[place[end], place[:-1]]
                before_own = np.r_[own[end], own[:-1]]
                word = np.concatenate([place, before])
                side = np.concatenate([before_own, own])
                key = (word << 8) + side
                key[len(place):] += known.number
                sure = side >= 0
                hot = sure & (word < known.hot)
                cells += np.bincount(key[hot], minlength=len(cells))
                keys, times = np.unique(key[sure & ~hot], return_counts=True)
                rare = int(np.searchsorted(keys, len(known.words) << 8))
                yield _packed(keys[rare:] - (len(known.words) << 8), times[rare:], others, bits)
                # Words of the head are added up over slices, as far as that is bounded.
                held.append((keys[:rare], times[:rare]))
                far = np.flatnonzero(~sure)
                other = np.concatenate([np.r_[words[end], words[:-1]], words])[far]
                far, other = far[order := np.argsort(other)], other[order]
                of = np.concatenate([words, np.r_[words[end], words[:-1]]])[far]
                bucket, cuts = _cut_up(other, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), _binary(other, cuts), pa.nulls(len(bucket), pa.binary()),
                     _binary((far >= len(place)).astype(np.uint8), cuts), _binary(of, cuts)], list(BLOCK))
                del words, place, own, before, before_own, word, side, key, sure, hot, keys, times, first, far, other, of
                if sum(len(part) for part, _ in held) > 2 * HELD_KEYS:
                    held = [_summed(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > HELD_KEYS:
                        yield _packed(*held.pop(), known.words, bits)
                release_memory()
        if held:
            yield _packed(*_summed(*map(np.concatenate, zip(*held))), known.words, bits)
        order = np.argsort(known.words[:known.hot])
        cells = cells.reshape(known.hot, 256)[order].ravel()
        keys = np.flatnonzero(cells)
        yield _packed(keys, cells[keys], known.words[order], bits)

    return count


def _count_far(number: int, bits: int) -> callable:
    """Blocks of words with the classes beside them, from the facts and the blocks of words of unknown class;
    the facts of a bucket come before its blocks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for bucket in _bucket_by_bucket(batches):
            facts, word = [], None
            for fact, blocks in bucket:
                facts.append(fact)
                if not blocks.num_rows:
                    continue
                if word is None:
                    word, own = (np.concatenate([part.column(name).to_numpy() for part in facts]) for name in ("word", "class"))
                    order = np.argsort(word := word.view(np.uint64))
                beside, side, of = (_all_bytes(blocks.column(name), kind) for name, kind in (
                    ("words", "<u8"), ("at", "u1"), ("times", "<u8")))
                place = own[order[np.searchsorted(word, beside, sorter=order)]] + side.astype(np.int64) * number
                once = np.ones(len(of), np.int64)
                held.append((of, once, place, once))
                if sum(len(part[2]) for part in held) > HELD_KEYS:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        names, sizes, at, times = _added_blocks(held)
        return _packed((np.repeat(np.arange(len(names)), sizes) << 8) + at, times, names, bits)

    return count


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their buckets: one row a word, from its facts and all blocks with it."""
    return _merge_seen(_rows_of_words(batches))


def _rows_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word a row of its counts and one of its facts, side by side."""
    for bucket in _bucket_by_bucket(batches):
        facts, held, most = [], [], 2 * HELD_KEYS
        for fact, blocks in bucket:
            facts.append(fact)
            held.append(_opened(blocks))
            if sum(len(part[2]) for part in held) > most:  # words that are everywhere
                held = [_added_blocks(held)]
                most = 2 * max(HELD_KEYS, len(held[0][2]))
        names, sizes, at, times = _added_blocks(held)
        begin = np.r_[0, np.cumsum(sizes)]
        counts = pa.table({"word": names.view(np.int64), "at": _binary(at, begin), "times": _binary(times.astype("<u8"), begin)})
        rows = pa.concat_tables([counts, pa.Table.from_batches(facts)], promote_options="default")
        order = np.argsort(rows.column("word").to_numpy())
        yield rows.take(pa.array(order)).combine_chunks().to_batches()[0]


def _merge_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their words: one row a word, from its facts and all counts of it."""
    names = FACTS
    held: pa.Table | None = None

    def merged(rows: pa.Table) -> pa.RecordBatch:
        word = rows.column("word").to_numpy()
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        number = np.cumsum(np.r_[True, word[1:] != word[:-1]]) - 1
        at, times = (rows.column(name).combine_chunks() for name in ("at", "times"))
        sizes = pc.fill_null(pc.binary_length(at), 0).to_numpy()
        key = (np.repeat(number, sizes) << 8) + _all_bytes(at, "u1")
        keys, sums = _summed(key, _all_bytes(times, "<u8").astype(np.int64))
        begin = np.searchsorted(keys, np.arange(len(first) + 1) << 8)
        facts = rows.filter(rows.column("n").is_valid()).select(names).combine_chunks()
        packed = [_binary(values, begin) for values in ((keys & 255).astype(np.uint8), sums.astype("<u8"))]
        # Every word of the texts has one row of facts; a word without counts cannot be.
        return pa.RecordBatch.from_arrays(
            [*(facts.column(name).combine_chunks() for name in names), *packed], [*names, "at", "times"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if rows.num_rows:
            word = rows.column("word").to_numpy()
            last = int(np.flatnonzero(np.r_[True, word[1:] != word[:-1]])[-1])
            if last:
                yield merged(rows.slice(0, last))
            held = rows.slice(last)
            if held.num_rows > HELD_ROWS:  # a word that is everywhere: what is known of it so far is added up
                held = _added_rows(held)
    if held is not None and held.num_rows:
        yield merged(held)


def _added_rows(rows: pa.Table) -> pa.Table:
    """The rows of one word as two: its counts, and its facts if they have come."""
    at = np.frombuffer(b"".join(rows.column("at").drop_null().to_pylist()), np.uint8)
    times = np.frombuffer(b"".join(rows.column("times").drop_null().to_pylist()), "<u8")
    sums = np.bincount(at, times, 256).astype("<u8")
    place = np.flatnonzero(sums)
    one = rows.slice(0, 1).to_pylist()[0] | {
        "ending": None, "n": None, "class": None, "hot": None, "at": place.astype(np.uint8).tobytes(),
        "times": sums[place].tobytes()}
    return pa.concat_tables([pa.Table.from_pylist([one], rows.schema), rows.filter(rows.column("n").is_valid())])


def contexts(texts: DataFrame, known: DataFrame, number: int, end_class: int, head_size: int, hot: int,
             bits: int = 8) -> DataFrame:
    """``known`` with ``at`` and ``times``, a written table: how often each class is before (its number)
    and after a word (``number`` and its number). A text begins after an end."""
    spark = texts.sparkSession
    beside = spark.sparkContext.broadcast(_beside(known, number, end_class, head_size, hot))
    counted = materialise(texts.mapInArrow(_count_beside(beside, bits), BLOCK_SCHEMA), "beside")
    kinds = dict(part.split() for part in WORD_SCHEMA.split(", "))
    facts = known.select(F.shiftrightunsigned("word", 64 - bits).cast("int").alias("bucket"),
                         *[F.lit(None).cast("binary").alias(name) for name in BLOCK[1:]], *FACTS)

    def by_bucket(blocks: DataFrame) -> DataFrame:
        blocks = blocks.select(*BLOCK, *[F.lit(None).cast(kinds[name]).alias(name) for name in FACTS])
        return blocks.unionAll(facts).repartition("bucket").sortWithinPartitions("bucket", F.col("word").isNull())

    far = by_bucket(counted.where("sizes is null")).mapInArrow(_count_far(number, bits), BLOCK_SCHEMA)
    seen = materialise(by_bucket(counted.where("sizes is not null").unionAll(far)).mapInArrow(
        _merge_blocks, WORD_SCHEMA + ", at binary, times binary"), "contexts")
    discard(counted)
    beside.destroy()  # each executor and the driver hold it in a file
    return seen


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and count of each entry."""
    sizes = pc.binary_length(batch.column("at")).to_numpy()
    at, times = _all_bytes(batch.column("at"), "u1"), _all_bytes(batch.column("times"), "<u8")
    return np.repeat(np.arange(batch.num_rows), sizes), at.astype(np.int64), times.astype(np.int64)


def class_bigrams(seen: DataFrame, number: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(number * number, np.int64)
        for batch in batches:
            rows, at, times = _entries(batch)
            own = batch.column("class").to_numpy().astype(np.int64)[rows]
            before = at < number
            total += np.bincount(at[before] * number + own[before], times[before], number * number).astype(np.int64)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    rows = seen.select("class", "at", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(number * number)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(number, number)


def text_bigrams(texts: DataFrame, known: DataFrame, number: int, end_class: int, head_size: int) -> np.ndarray:
    """The same as ``class_bigrams`` of ``contexts``, where no word moves any more: what stands beside
    each word is not kept."""
    names = ["before", "before_class", "word", "class", "far", "n"]
    beside = texts.sparkSession.sparkContext.broadcast(_beside(known, number, end_class, head_size, 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: Beside = beside.value
        total = np.zeros(number * number, np.int64)
        for batch in batches:
            for piece in slices(batch, "text", CONTEXT_SLICE):
                words = token_words(cut(piece.column("text"), NOT_SPACE, lower=True))
                _, own = head.find(words)
                before, before_own = _before(words, END), _before(own, end_class)
                sure = (own >= 0) & (before_own >= 0)
                total += np.bincount(before_own[sure] * number + own[sure], minlength=number * number)
                left = np.flatnonzero(~sure)
                # far: 1 the class before, 2 the class is not known yet.
                far = 1 * (before_own[left] < 0) + 2 * (own[left] < 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before[left].view(np.int64)), pa.array(before_own[left].astype(np.int32)),
                     pa.array(words[left].view(np.int64)), pa.array(own[left].astype(np.int32)),
                     pa.array(far.astype(np.int32)), pa.array(np.ones(len(left), np.int64))], names)
        pair = np.flatnonzero(total)
        nothing = [pa.nulls(len(pair), pa.int64())] * 2
        yield pa.RecordBatch.from_arrays(
            [nothing[0], pa.array((pair // number).astype(np.int32)), nothing[1], pa.array((pair % number).astype(np.int32)),
             pa.array(np.zeros(len(pair), np.int32)), pa.array(total[pair])], names)

    counted = materialise(texts.mapInArrow(
        count, "before long, before_class int, word long, class int, far int, n long"), "between")
    rows = _look_up(_look_up(counted, known, 1, "before", "before_class"), known, 2, "word", "class").groupBy(
        "before_class", "class").agg(F.sum("n").alias("n")).toArrow()
    discard(counted)
    beside.destroy()
    out = np.zeros((number, number))
    out[rows.column("before_class").to_numpy(), rows.column("class").to_numpy()] = rows.column("n").to_numpy()
    return out


def _likelihood(table_: np.ndarray) -> float:
    return float(_xlogx(table_).sum() - _xlogx(table_.sum(axis=0)).sum() - _xlogx(table_.sum(axis=1)).sum())


def best_classes(own: np.ndarray, n: np.ndarray, rows: np.ndarray, at: np.ndarray, times: np.ndarray,
                 table_: np.ndarray, classes: int) -> np.ndarray:
    """The class of each word that raises the likelihood of the class bigrams most, if only this word
    moved and its neighbours kept the cells apart. ``rows``, ``at``, ``times``: entries in order."""
    # A line for each place: the cells of a class beside the word with every class of the word.
    lines = np.concatenate([table_[:, :classes], table_.T[:, :classes]])
    gain = np.zeros((len(own), classes))
    moved = np.flatnonzero(own < classes)
    if len(rows):
        # Most entries are alike, so gains are found once for each place and count.
        kinds, like = np.unique((times << 8) + at, return_inverse=True)
        cells, many = lines[kinds & 255], (kinds >> 8)[:, None]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        gain[rows[first]] = np.add.reduceat(
            (_xlogx(cells + many) - _xlogx(cells))[like], first, axis=0)
        inside = np.flatnonzero(own[rows] < classes)
        cells = np.maximum(lines[at[inside], own[rows[inside]]] - times[inside], 0)
        stays = np.bincount(rows[inside], _xlogx(cells + times[inside]) - _xlogx(cells), len(own))
        gain[moved, own[moved]] = stays[moved]
    counts, like = np.unique(n, return_inverse=True)
    for sums in (table_.sum(axis=1)[:classes], table_.sum(axis=0)[:classes]):
        lost = (_xlogx(sums + counts[:, None]) - _xlogx(sums))[like]
        rest = sums[own[moved]] - n[moved]
        lost[moved, own[moved]] = _xlogx(rest + n[moved]) - _xlogx(rest)
        gain -= lost
    best = gain.argmax(axis=1)
    stay = moved[gain[moved, best[moved]] <= gain[moved, own[moved]] + 1e-9]
    best[stay] = own[stay]
    return best


def _move(table_, classes: int, clustered_too: bool):
    names = FACTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, MOVED_ROWS):
                piece = batch.slice(low, MOVED_ROWS)
                own, n = piece.column("class").to_numpy().astype(np.int64), piece.column("n").to_numpy()
                best = best_classes(own, n, *_entries(piece), table_.value, classes)
                fixed = own == classes + ENDINGS if clustered_too else (own < classes) | (own == classes + ENDINGS)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(name) for name in names[:3]),
                     pa.array(np.where(fixed, own, best).astype(np.int32)), piece.column("hot")], names)

    return run


def fit(texts: DataFrame, counts: DataFrame, head_size: int = HEAD, clustered: int = CLUSTERED,
        classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """The model, and word, ending, n, class of all words."""
    spark: SparkSession = texts.sparkSession
    if 2 * (classes + ENDINGS + 1) > 256:
        raise ValueError("classes before and after a word are numbered in one byte")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    first = counts.where(F.col("ending") < ENDINGS).orderBy(F.desc("n"), "word").limit(clustered).select(
        "word").toArrow().column("word").to_numpy()
    clustered = len(first)
    unit = Lookup(first.view(np.uint64), np.arange(clustered))
    units, number = clustered + ENDINGS + 1, classes + ENDINGS + 1
    sent = spark.sparkContext.broadcast(unit)
    rows = unit_bigrams(texts, sent, clustered).toArrow()
    sent.destroy()
    bigrams = np.zeros(units * units)
    bigrams[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    of = exchange(bigrams.reshape(units, units), clustered, classes)
    begun = F.broadcast(spark.createDataFrame(
        [(int(word), int(own)) for word, own in zip(first, of)], "word long, first int"))
    known = materialise(counts.join(begun, "word", "left").select(
        "word", "ending", "n", F.coalesce("first", F.col("ending") + classes).alias("class"),
        (F.col("first").isNotNull() | (F.col("ending") == ENDINGS)).alias("hot")), "classes")
    end_class = classes + ENDINGS
    bits = _bucket_bits(sums["words"])
    seen = contexts(texts, known, number, end_class, head_size, clustered, bits)
    # Units are words and endings, so their bigrams add up to those of the classes they begin with.
    between = np.zeros((number, number))
    np.add.at(between, (of[:, None], of[None, :]), bigrams.reshape(units, units))
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(between)
        moved = materialise(seen.mapInArrow(_move(sent, classes, turn > 0), WORD_SCHEMA), "classes")
        sent.destroy()
        discard(seen)
        if turn + 1 < ROUNDS:
            seen = contexts(texts, moved, number, end_class, head_size, clustered, bits)
            after = class_bigrams(seen, number)
        else:
            after = text_bigrams(texts, moved, number, end_class, head_size)
        if turn and _likelihood(after) <= _likelihood(between):
            discard(moved)
            break
        discard(known)
        known, between = moved, after
    # After a word that training does not have, classes are as frequent as anywhere.
    after = between.copy()
    after[classes:classes + ENDINGS] = between.sum(axis=0)
    transition = (after + ADDED) / (after.sum(axis=1, keepdims=True) + ADDED * number)
    word, own, n = _head(known, head_size)
    return Model(sums["n"] or 0, sums["words"], Lookup(word, np.arange(len(word))), n, own, np.log10(transition),
                 between.sum(axis=0), classes), known


def _score(model) -> callable:
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "before", "before_class", "word",
             "class", "far", "n"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        next_row = TaskContext.get().partitionId() << 40
        some = len(known.head_counts) > 0
        for batch in batches:
            for piece in slices(batch, "text"):
                size = piece.num_rows
                words, ending, text = tokens(cut(piece.column("text"), NOT_SPACE, lower=True))
                place = known.head.get(words)
                found = place >= 0
                count = np.where(found, known.head_counts[place] if some else 0, 0)
                # Of a word that is not in the head, the ending class, and a row to look further.
                of = np.where(found, known.head_class[place] if some else 0, known.classes + ending).astype(np.int64)
                base = np.where(found, np.log10((count + ADDED) / known.base_size()), 0.0)
                logs = np.zeros(len(words))
                logs[found] = np.log10(count[found] / known.class_size[of[found]])
                # A text begins after an end, whose class is known without a count.
                before, before_of = _before(words, END), _before(of, known.classes + ENDINGS)
                before_found = _before(found, True)
                before_found = before_found | (before == END)
                near = (found | (words == END)) & before_found
                logs[near] += known.log_transition[before_of[near], of[near]]
                add = [np.bincount(text, weights, size) for weights in (found, base, logs)]
                row = next_row + np.arange(size)
                next_row += size
                nulls = [pa.nulls(size, kind) for kind in (
                    pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row), piece.column("doc_id"), piece.column("held_out"),
                    pa.array(np.bincount(text, minlength=size)), pa.array(add[0].astype(np.int64)), pa.array(add[1]),
                    pa.array(add[2]), *nulls], names)
                left = np.flatnonzero(~near | ~found)
                key = mix(joined(before[left], words[left]) ^ mix(text[left].astype(np.uint64)))
                _, first, n = _added_up(key, np.ones(len(left)))  # a pair of one text
                left = left[first]
                # far: 1 the word before, 2 the word, 4 the transition is not counted yet.
                far = 1 * ~before_found[left] + 2 * ~found[left] + 4 * ~near[left]
                nothing = [pa.nulls(len(left), kind) for kind in (
                    pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row[text[left]]), *nothing, pa.array(before[left].view(np.int64)),
                    pa.array(before_of[left].astype(np.int32)), pa.array(words[left].view(np.int64)),
                    pa.array(of[left].astype(np.int32)), pa.array(far.astype(np.int32)), pa.array(n)], names)

    return score


def _look_up(rows: DataFrame, known: DataFrame, bit: int, word: str, own: str, count: str | None = None) -> DataFrame:
    """Rows whose ``far`` has the bit get the class, and the count, of the word."""
    far = F.col("far").bitwiseAND(F.lit(bit)) > 0
    of = known.select(F.col("word").alias("__of"), F.col("class").alias("__class"), F.col("n").alias("__n"))
    found = rows.where(far).join(of, F.col(word) == F.col("__of"), "left").withColumn(
        own, F.coalesce("__class", own))
    if count:
        found, rows = found.withColumn(count, F.coalesce("__n", F.lit(0))), rows.withColumn(
            count, F.lit(0).cast("long"))
    return found.select(rows.columns).unionAll(rows.where(~far))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", head_size: int = HEAD,
                clustered: int = CLUSTERED, classes: int = CLASSES) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10) and perplexity."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       (fold(F.col(doc_id), 10) == 0).alias("held_out"))
    training = rows.where(~F.col("held_out")).select("text")
    counts = materialise(word_counts(training), "counts")
    model, known = fit(training, counts, head_size, clustered, classes)
    sent = spark.sparkContext.broadcast(model)
    scored = materialise(rows.mapInArrow(
        _score(sent),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "before long, before_class int, word long, class int, far int, n long"), "scored")
    sent.destroy()
    number = len(model.log_transition)
    place = np.arange(number * number)
    between = F.broadcast(spark.createDataFrame(pa.table({
        "from": pa.array((place // number).astype(np.int32)), "to": pa.array((place % number).astype(np.int32)),
        "transition": model.log_transition.ravel(), "size": model.class_size[place % number]})))
    pairs = scored.where("word is not null").select(
        F.col("row").alias("of"), "before", "before_class", "word", "class", "far", "n")
    pairs = _look_up(_look_up(pairs, known, 1, "before", "before_class"), known, 2, "word", "class", "count")
    new, rare_ = F.col("far").bitwiseAND(F.lit(4)) > 0, F.col("far").bitwiseAND(F.lit(2)) > 0
    count = F.col("count") + ADDED
    # A word that training does not have is all of its ending class.
    emission = F.when(rare_ & (F.col("count") > 0), F.log10(F.col("count") / F.col("size"))).otherwise(0.0)
    rare = pairs.join(between, (F.col("before_class") == F.col("from")) & (F.col("class") == F.col("to"))).groupBy(
        "of").agg(
        F.sum(F.when(rare_ & (F.col("count") > 0), F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.when(rare_, F.col("n") * F.log10(count / F.lit(model.base_size()))).otherwise(0.0)).alias("rare_base"),
        F.sum(F.col("n") * (F.when(new, F.col("transition")).otherwise(0.0) + emission)).alias("rare_score"))

    def both(ours: str, more: str) -> Column:
        return F.col(ours) + F.coalesce(F.col(more), F.lit(0))

    return scored.where("word is null").join(rare, F.col("row") == F.col("of"), "left").select(
        "doc_id", "held_out", "n_tokens", both("n_known", "rare_known").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), both("base", "rare_base").alias("base_score"),
        both("score", "rare_score").alias("score")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


@query("op9_class_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
