"""Alignment of two tokenizers' tokens on the same texts, by divide and conquer at shared cuts.

Both token sequences of a text spell the same bytes. The byte offsets where a token of each ends
are shared cuts. An interval of tokens is divided at the shared cut nearest to its middle token,
which is found by bisecting the other side's ends, and both halves are divided again; an interval
without a cut inside is a group. All texts of a slice are divided at once, level by level.

Inside groups, tokens whose byte ranges overlap are linked. How often each pair of ids is linked
corpus-wide is counted in two steps: distinct pairs of a slice of texts are counted in its task,
and only these rows are exchanged and summed, so a pair that stands everywhere brings one row a
slice. Back come, for each slice, the sums of its pairs, in one group whose size the slice bounds.
Slices are written before they are counted, so a lost executor does not renumber them.

Texts are split for encoding, not for alignment: neither vocabulary joins anything across a single
space after a visible ASCII character, so each distinct stretch of a slice is encoded once.

Defined cases. Texts that are null, empty, or not spelt the same by both sides (such as those with
a literal U+2581) have no tokens: counts of zero and an empty digest. Rows are documents, whether
or not keys are null or repeated, and each counts. Ties for a pair's highest count all are best. A
very long text is a slice of its own. Special tokens' strings are plain text. An empty table gives
an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from palimpsest.llm.registry import query, table
from palimpsest.llm.words import bytes_of, slices
from palimpsest.scratch import materialise

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
SLICE = 4 << 20
# Tokens beside the middle that are tried one by one before the whole interval is looked through.
PROBES = 6
SPACE = 0x20
KNOWN_STRETCHES = 1 << 19


def stored_bytes() -> dict[str, int]:
    """What each character of a byte-level vocabulary stands for: printable Latin-1 bytes stand for
    themselves, all others for the characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {**{chr(byte): byte for byte in shown}, **{chr(256 + at): byte for at, byte in enumerate(hidden)}}


@dataclass(frozen=True)
class Side:
    """One tokenizer: how it encodes stretches that follow a space, and its tokens' bytes."""

    encode: object
    spelling: pa.Array
    lengths: np.ndarray


@lru_cache(maxsize=2)
def byte_level_side(path: str) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    stands_for = stored_bytes()
    size = max(model.get_vocab().values()) + 1
    spelling = pa.array([bytes(stands_for[c] for c in model.id_to_token(at) or "") for at in range(size)], pa.large_binary())

    def encode(stretches: list[str]) -> list[list[int]]:
        found = model.encode_batch_fast([" " + stretch for stretch in stretches], add_special_tokens=False)
        return [encoding.ids for encoding in found]

    return Side(encode, spelling, np.diff(spelling_begins(spelling)))


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(at) for at in range(model.vocab_size())]
    if any("▁" in name.lstrip("▁") for name in names):
        raise ValueError("a piece holds a space after another character")
    spelling = pa.array([bytes([int(name[3:5], 16)]) if model.is_byte(at) else name.replace("▁", " ").encode()
                         for at, name in enumerate(names)], pa.large_binary())

    def encode(stretches: list[str]) -> list[list[int]]:
        return model.encode(stretches, num_threads=1)

    return Side(encode, spelling, np.diff(spelling_begins(spelling)))


def spelling_begins(spelling: pa.Array) -> np.ndarray:
    return np.frombuffer(spelling.buffers()[1], np.int64)[:len(spelling) + 1]


def expanded(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """begin[0] to end[0] - 1, begin[1] to end[1] - 1, and so on."""
    sizes = end - begin
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)


def cut_stretches(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Stretches of all texts without the space before them, and where each text's begin."""
    data, begin = bytes_of(texts)
    space = data == SPACE
    after = np.zeros(len(data), bool)
    after[1:] = (data[:-1] > SPACE) & (data[:-1] < 0x7F)
    full = begin[:-1] < begin[1:]
    after[begin[:-1][full]] = False
    space[begin[1:][full] - 1] = False  # a space that ends a text is no stretch
    at = np.flatnonzero(space & after)
    starts = np.sort(np.concatenate([begin[:-1][full], at + 1]))
    first = np.searchsorted(starts, begin)
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    last = first[1:][full] - 1
    ends[last] = begin[1:][full]
    # Without the space between stretches, what is left is one buffer of strings.
    kept = np.ones(len(data), bool)
    kept[at] = False
    marks = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=marks[1:])
    cut = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(marks), pa.py_buffer(data[kept])])
    return cut.dictionary_encode(), first


def encode_distinct(side: Side, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the distinct stretches, where each begins, and which are spelt as they stand."""
    ids = side.encode(distinct.to_pylist())
    begin = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([*map(len, ids)], out=begin[1:])
    values = np.fromiter(chain.from_iterable(ids), np.int32, begin[-1])
    spelt = side.spelling.take(pa.array(values))
    marks = spelling_begins(spelt)[begin] if len(values) else np.zeros(len(begin), np.int64)
    wanted, at = bytes_of(distinct)
    raw = np.frombuffer(spelt.buffers()[2] or b"", np.uint8)
    same = np.diff(marks) == np.diff(at) + 1
    long = np.flatnonzero(same)
    ours, theirs = marks[:-1][long], at[:-1][long]
    same[long] &= raw[ours] == SPACE
    sizes = np.diff(at)[long]
    differ = raw[expanded(ours + 1, ours + 1 + sizes)] != wanted[expanded(theirs, theirs + sizes)]
    if differ.any():
        same[np.repeat(long, sizes)[differ]] = False
    return values, begin, same


class Stretches:
    """What both sides make of stretches. The first KNOWN_STRETCHES that a worker meets are
    remembered; others are encoded again when they return."""

    def __init__(self, sides: tuple[Side, Side]) -> None:
        self.sides = sides
        self.known = pa.array([], pa.large_string())
        self.encoded = [(np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)) for _ in sides]

    def encode(self, distinct: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Numbers of the stretches, and by side all ids, where each number's begin, and which
        numbers are spelt as they stand."""
        place = pc.index_in(distinct, self.known)
        new = distinct.filter(place.is_null())
        which = place.fill_null(-1).to_numpy().astype(np.int64)
        which[which < 0] = len(self.known) + np.arange(len(new))
        both = []
        for side, (ids, begin, same) in zip(self.sides, self.encoded):
            new_ids, new_begin, new_same = encode_distinct(side, new)
            both.append((np.r_[ids, new_ids], np.r_[begin, new_begin[1:] + begin[-1]], np.r_[same, new_same]))
        if len(self.known) + len(new) <= KNOWN_STRETCHES:
            self.known, self.encoded = pa.concat_arrays([self.known, new]), both
        return which, both


@lru_cache(maxsize=2)
def stretches_of(byte_level: str, pieces: str) -> Stretches:
    return Stretches((byte_level_side(byte_level), piece_side(pieces)))


def is_cut(ends: np.ndarray, others: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a token of the other side ends where these tokens do, by bisecting."""
    place = np.searchsorted(others, ends[at])
    return others[np.minimum(place, len(others) - 1)] == ends[at]


def near_middle(low: np.ndarray, high: np.ndarray, ends: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each interval of tokens, the one nearest its middle that ends at a shared cut inside it,
    or -1."""
    found = np.full(len(low), -1)
    middle = (low + high - 1) // 2
    open_ = np.flatnonzero(high - low > 1)
    for step in range(2 * PROBES):
        probe = middle[open_] + (-1) ** step * ((step + 1) // 2)
        inside = (probe >= low[open_]) & (probe < high[open_] - 1)
        hit = np.zeros(len(open_), bool)
        hit[inside] = is_cut(ends, others, probe[inside])
        found[open_[hit]] = probe[hit]
        open_ = open_[~hit]
    open_ = open_[high[open_] - low[open_] > 2 * PROBES - 1]
    if len(open_):
        probe = expanded(low[open_], high[open_] - 1)
        owner = np.repeat(open_, high[open_] - 1 - low[open_])
        hit = is_cut(ends, others, probe)
        probe, owner = probe[hit], owner[hit]
        order = np.lexsort((np.abs(probe - middle[owner]), owner))
        first = order[np.flatnonzero(np.r_[True, owner[order][1:] != owner[order][:-1]])] if len(order) else order
        found[owner[first]] = probe[first]
    return found


def divide(low: np.ndarray, high: np.ndarray, ends: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The last token of every group of the intervals low to high - 1, in order."""
    leaves = []
    keep = low < high
    low, high = low[keep], high[keep]
    while len(low):
        cut = near_middle(low, high, ends, others)
        leaf = cut < 0
        leaves.append(high[leaf] - 1)
        low, high, cut = low[~leaf], high[~leaf], cut[~leaf]
        # Halves stay in order, so that bisecting meets its neighbours' memory.
        low, high = np.stack([low, cut + 1], 1).ravel(), np.stack([cut + 1, high], 1).ravel()
    return np.sort(np.concatenate(leaves)) if leaves else np.zeros(0, np.int64)


def linked(begins: np.ndarray, ends: np.ndarray, other_begins: np.ndarray, other_ends: np.ndarray) -> tuple:
    """All pairs of token numbers whose byte ranges overlap."""
    first = np.searchsorted(other_ends, begins, "right")
    last = np.searchsorted(other_begins, ends, "left")
    return np.repeat(np.arange(len(begins)), last - first), expanded(first, last)


@dataclass
class Aligned:
    """The tokens of a slice of texts: ids by side, where each text's begin, the last token of each
    group by side, and the linked pairs of token numbers."""

    ids: tuple[np.ndarray, np.ndarray]
    first: tuple[np.ndarray, np.ndarray]
    groups: tuple[np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]


def align_texts(texts: pa.Array, known: Stretches) -> Aligned:
    stretches, first = cut_stretches(texts)
    numbers, encoded = known.encode(stretches.dictionary)
    which, rows = numbers[stretches.indices.to_numpy()], len(texts)
    row = np.repeat(np.arange(rows), np.diff(first))
    spelt = (encoded[0][2] & encoded[1][2])[which]
    good = np.bincount(row[~spelt], minlength=rows) == 0
    which, row = which[good[row]], row[good[row]]
    ids, begins, ends = [], [], []
    for side, (values, begin, _) in zip(known.sides, encoded):
        ids.append(values[expanded(begin[which], begin[which + 1])].astype(np.int64))
        ends.append(np.cumsum(side.lengths[ids[-1]]))
        begins.append(ends[-1] - side.lengths[ids[-1]])
    stretch_rows = np.searchsorted(row, np.arange(rows + 1))
    starts = [np.r_[0, np.cumsum(np.diff(begin)[which])][stretch_rows] for _, begin, _ in encoded]
    last = divide(starts[0][:-1], starts[0][1:], ends[0], ends[1])
    return Aligned((ids[0], ids[1]), (starts[0], starts[1]),
                   (last, np.searchsorted(ends[1], ends[0][last])), linked(begins[0], ends[0], begins[1], ends[1]))


@lru_cache(maxsize=2)
def _group_texts(sizes: tuple[int, int]) -> pa.Array:
    """Every id followed by what may stand after it: inside and at the end of a group's side."""
    return pa.array([f"{at}{mark}" for size, marks in zip(sizes, (",|", ",;")) for mark in marks for at in range(size)],
                    pa.large_string())


def group_digests(found: Aligned, sizes: tuple[int, int]) -> list[str]:
    """SHA-256 of each text's groups, as ids of both sides; empty for texts without tokens."""
    a, b = found.ids
    last_a, last_b = found.groups
    size_a = np.diff(np.r_[-1, last_a])
    size_b = np.diff(np.r_[-1, last_b])
    spot_a = np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)
    spot_b = np.arange(len(b)) + np.repeat(last_a + 1, size_b)
    codes = np.empty(len(a) + len(b), np.int64)
    code_a, code_b = a.copy(), b + 2 * sizes[0]
    code_a[last_a] += sizes[0]
    code_b[last_b] += sizes[1]
    codes[spot_a], codes[spot_b] = code_a, code_b
    if not len(codes):
        return [""] * (len(found.first[0]) - 1)
    texts = _group_texts(sizes).take(pa.array(codes))
    marks = spelling_begins(texts)[found.first[0] + found.first[1]]
    raw = memoryview(texts.buffers()[2])
    return [hashlib.sha256(raw[low:high - 1]).hexdigest() if high > low else "" for low, high in zip(marks, marks[1:])]


SLICE_COLUMNS = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link_pairs binary, "
                 "link_counts binary, slice long, pairs array<struct<a: int, b: int, n: long>>")
LINKED_COLUMNS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, key: str = "doc_id",
          text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two written tables: a row a document with its counts, group digest and links, and a row a
    pair of ids with its number of links and whether it is the highest of its second id."""
    paths = (byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES))
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.spark_partition_id().alias("part"))
    key_field = StructField(key, narrow.schema["key"].dataType)
    schema = StructType([key_field, *StructType.fromDDL(SLICE_COLUMNS)])
    arrow = to_arrow_schema(schema)
    pair_type = arrow.field("pairs").type

    def align_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield _slice_rows(part, stretches_of(*paths), number, arrow, pair_type)
                number += 1

    written = materialise(narrow.mapInArrow(align_slices, schema), "aligned")
    pairs = written.where("pairs is not null").select("slice", F.posexplode("pairs").alias("place", "pair")).select(
        "slice", "place", "pair.a", "pair.b", "pair.n")
    # A second id has as many rows here as the first vocabulary has ids, at most.
    highest = F.max("links").over(Window.partitionBy("b"))
    counts = materialise(pairs.groupBy("a", "b").agg(F.sum("n").alias("links")).withColumn(
        "best", F.col("links") == highest), "pairs")
    result = StructType([key_field, *StructType.fromDDL(LINKED_COLUMNS)])
    out = to_arrow_schema(result)

    def total(docs: pa.Table, sums: pa.Table) -> pa.Table:
        count = np.zeros(sums.num_rows, np.int64)
        best = np.zeros(sums.num_rows, np.int64)
        place = sums.column("place").to_numpy()
        count[place], best[place] = sums.column("links").to_numpy(), sums.column("best").to_numpy()
        n_best, count_sum = [], []
        for at, times in zip(docs.column("link_pairs"), docs.column("link_counts")):
            at, times = (np.frombuffer(x.as_py(), np.int32) for x in (at, times))
            n_best.append(int(best[at] @ times.astype(np.int64)))
            count_sum.append(int(count[at] @ times.astype(np.int64)))
        columns = {name: docs.column(name) for name in out.names if name in docs.column_names}
        columns |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([columns[name] for name in out.names], schema=out)

    by_slice = pairs.select("slice", "place", "a", "b").join(counts, ["a", "b"]).select(
        F.col("slice").alias("of_slice"), "place", "links", "best")
    documents = written.where("pairs is null").drop("pairs").groupBy("slice").cogroup(
        by_slice.groupBy("of_slice")).applyInArrow(total, result)
    return documents, counts


def _slice_rows(part: pa.RecordBatch, known: Stretches, number: int, arrow: pa.Schema,
                pair_type: pa.DataType) -> pa.RecordBatch:
    """A row a document, and one more with the slice's distinct pairs."""
    rows = part.num_rows
    found, sides = align_texts(part.column("text"), known), known.sides
    (a, b), (link_a, link_b) = found.ids, found.links
    wide = len(sides[1].lengths)
    pairs, local, times = np.unique(a[link_a] * wide + b[link_b], return_inverse=True, return_counts=True)
    owner = np.searchsorted(found.first[0], link_a, "right") - 1
    each, n = np.unique(owner * max(len(pairs), 1) + local, return_counts=True)
    begin = np.searchsorted(each, np.arange(rows + 1) * max(len(pairs), 1))
    at = (each % max(len(pairs), 1)).astype(np.int32)

    def packed(values: np.ndarray) -> pa.Array:
        return pa.array([values[low:high].tobytes() for low, high in zip(begin[:-1], begin[1:])] + [None], pa.binary())

    def counted(values: np.ndarray) -> pa.Array:
        return pa.array([*values.tolist(), None], pa.int64())

    groups = np.diff(np.searchsorted(found.groups[0], found.first[0]))
    listed = pa.ListArray.from_arrays(pa.array([0] * (rows + 1) + [len(pairs)], pa.int32()), pa.StructArray.from_arrays(
        [pa.array(pairs // wide, pa.int32()), pa.array(pairs % wide, pa.int32()), pa.array(times, pa.int64())],
        fields=list(pair_type.value_type)), mask=pa.array([True] * rows + [False]))
    key = pa.concat_arrays([part.column("key"), pa.nulls(1, part.column("key").type)])
    slice_number = (part.column("part")[0].as_py() << 32) + number
    columns = [key, counted(np.diff(found.first[0])), counted(np.diff(found.first[1])), counted(groups),
               counted(np.bincount(owner, minlength=rows)),
               pa.array([*group_digests(found, (len(sides[0].lengths), wide)), None], pa.string()),
               packed(at), packed(n.astype(np.int32)), pa.array([slice_number] * (rows + 1), pa.int64()), listed]
    return pa.RecordBatch.from_arrays([column.cast(field.type) for column, field in zip(columns, arrow)], schema=arrow)


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))[0]
