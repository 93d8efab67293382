"""Bounded-space online packing of tokenised documents into sequences of a fixed length.

Each partition keeps ``open_windows`` windows open and places its documents one after the other:
whole into the window that they fill best; where none has room, the fullest is topped up with the
front of the document, emitted, and replaced by an empty one. What stands in windows that are still
open at the end of a partition is merged: the leftovers of ``MERGED`` partitions meet in one task
(at most ``MERGED`` * ``open_windows`` * ``length`` ids, whatever the size of the table), are
packed again in falling length, and what then is left is laid end to end. The last rest of such a
task goes out in sequences whose lengths are powers of two.

No piece is cut to fewer than ``least_cut`` ids, so a sequence other than these is short of
``length`` by less than 2 * ``least_cut``. The pieces are written before leftovers are looked for,
so a lost executor repeats them and no sequence gets two versions.

Defined cases. A null or empty text has the end id only. Rows are documents, whether or not their
keys are null or repeated. A document longer than a window fills whole windows with its front; a
text without white space is one word and encoded whole. Order inside a partition decides ties. An
empty table gives an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from palimpsest.llm.registry import query, table
from palimpsest.llm.words import slices
from palimpsest.scratch import materialise

VOCABULARY = "word_bpe_49k.json"
END = 1
LENGTH = 2048
OPEN_WINDOWS = 32
LEAST_CUT = 16
MERGED = 64
SLICE = 8 << 20
PIECES_OUT = 2048
# Sequences of merged leftovers are numbered from here, beyond those of any partition.
MERGED_FROM = 1 << 62

PIECE = "start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"


# A word that ends in a letter and ASCII signs is cut between them, as the vocabulary does; words of
# letters alone need no rules but lower case. Letters are those of ASCII and Latin-1.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIGNS_AFTER = rf"^(?P<stem>[^<]*[{LETTERS}])(?P<signs>[!-&(-/:;=-@\[-`{{-~]+)$"
STEM = f"^[{LETTERS}]+$"
JOINED = 200
KNOWN_STEMS = 1 << 20


def expanded(which: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Positions begin[w] to begin[w + 1] - 1 for each w of ``which``, one after the other."""
    sizes = begin[which + 1] - begin[which]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[which] - ends + sizes, sizes)


def flat_ids(model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text's begin."""
    lists = [encoding.ids for encoding in model.encode_batch_fast(texts, add_special_tokens=False)]
    begin = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([*map(len, lists)], out=begin[1:])
    return np.fromiter(chain.from_iterable(lists), np.int32, begin[-1]), begin


class Encoder:
    """The tokenizer of a file for whole words, and for lower-case stems, many at once. It remembers
    the first KNOWN_STEMS stems that its worker meets; others are encoded again when they return."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.whole, self.stems = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.stems.normalizer = normalizers.Sequence([])
        self.stems.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.stems.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[at for name, at in vocabulary.items() if name.endswith("</w>")]] = True
        self.known = pa.array([], pa.large_string())
        self.ids, self.begin = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def new_stems(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        listed = stems.to_pylist()
        ids, _ = flat_ids(self.stems, [" ".join(listed[at:at + JOINED]) for at in range(0, len(listed), JOINED)])
        begin = np.r_[0, np.flatnonzero(self.last[ids]) + 1]
        if len(begin) != len(listed) + 1:
            raise ValueError("the vocabulary does not mark the ends of words")
        return ids, begin

    def encode_stems(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stems in lower case, and where each one's begin."""
        place = pc.index_in(stems, self.known)
        new = stems.filter(place.is_null())
        new_ids, new_begin = self.new_stems(new)
        which = place.fill_null(-1).to_numpy().astype(np.int64)
        which[which < 0] = len(self.known) + np.arange(len(new))
        ids, begin = np.r_[self.ids, new_ids], np.r_[self.begin, new_begin[1:] + self.begin[-1]]
        if len(begin) <= KNOWN_STEMS:
            self.known, self.ids, self.begin = pa.concat_arrays([self.known, new]), ids, begin
        return ids[expanded(which, begin)], np.r_[0, np.cumsum(np.diff(begin)[which])]

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and where each word's begin."""
        cut = pc.extract_regex(words, SIGNS_AFTER)
        halves = [pc.coalesce(pc.struct_field(cut, "stem"), words), pc.coalesce(pc.struct_field(cut, "signs"), "")]
        parts = pa.concat_arrays([half.cast(pa.large_string()) for half in halves]).dictionary_encode()
        is_stem = pc.match_substring_regex(parts.dictionary, STEM)
        stems = pc.utf8_lower(parts.dictionary.filter(is_stem)).dictionary_encode()
        ids, begin = self.encode_stems(stems.dictionary)
        more_ids, more_begin = flat_ids(self.whole, parts.dictionary.filter(pc.invert(is_stem)).to_pylist())
        is_stem = is_stem.to_numpy(zero_copy_only=False)
        place = np.empty(len(is_stem), np.int64)
        place[is_stem] = stems.indices.to_numpy()
        place[~is_stem] = len(begin) - 1 + np.arange(len(more_begin) - 1)
        begin = np.r_[begin, more_begin[1:] + begin[-1]]
        which = place[parts.indices.to_numpy()].reshape(2, -1).T.ravel()
        marks = np.r_[0, np.cumsum(np.diff(begin)[which])]
        return np.r_[ids, more_ids][expanded(which, begin)], marks[::2]


load = lru_cache(maxsize=4)(Encoder)


def encode_words(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end``, and where each text's begin.

    The vocabulary drops white space and joins nothing across it, so every distinct word of the
    texts is encoded once.
    """
    words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = words.flatten().dictionary_encode()
    values, begin = load(path).encode(split.dictionary)
    values, begin = np.append(values, np.int32(end)), np.append(begin, begin[-1] + 1)
    firsts = words.offsets.to_numpy() - words.offsets[0].as_py()
    which = np.insert(split.indices.to_numpy(), firsts[1:], len(begin) - 2)
    marks = np.r_[0, np.cumsum(np.diff(begin)[which])]
    return values[expanded(which, begin)], marks[firsts + np.arange(len(firsts))]


class Windows:
    """Open windows of one task. ``emit`` gets a window's number and its pieces when it closes; a
    piece is (key, start, ids, doc_tokens)."""

    def __init__(self, length: int, open_windows: int, least_cut: int, emit: Callable) -> None:
        self.length, self.least_cut, self.emit = length, least_cut, emit
        self.number = open_windows
        self.pieces: dict[int, list] = {at: [] for at in range(open_windows)}
        self.rooms = [(length, at) for at in range(open_windows)]

    def fresh(self) -> int:
        self.number += 1
        return self.number - 1

    def add(self, key, ids: np.ndarray, start: int, doc_tokens: int) -> None:
        while len(ids) >= self.length:
            self.emit(self.fresh(), [(key, start, ids[:self.length], doc_tokens)])
            ids, start = ids[self.length:], start + self.length
        while len(ids):
            at = bisect_left(self.rooms, (len(ids), -1))
            best = at < len(self.rooms)
            room, window = self.rooms.pop(at if best else 0)
            taken = len(ids) if best else min(room, len(ids) - self.least_cut)
            if best or taken >= self.least_cut:
                self.pieces[window].append((key, start, ids[:taken].copy(), doc_tokens))
                ids, start, room = ids[taken:], start + taken, room - taken
            if room and best:
                insort(self.rooms, (room, window))
                continue
            self.emit(window, self.pieces.pop(window))
            window = self.fresh()
            self.pieces[window] = []
            insort(self.rooms, (self.length, window))

    def left(self) -> list[tuple[int, list]]:
        """Windows that are still open and not empty, fullest first."""
        return [(window, self.pieces[window]) for _, window in self.rooms if self.pieces[window]]


class Pieces:
    """Collects pieces of closed windows and gives them out as Arrow batches."""

    def __init__(self, schema: pa.Schema, first: int) -> None:
        self.schema, self.first, self.rows = schema, first, []

    def emit(self, window: int, pieces: list, leftover: bool = False) -> None:
        offset = 0
        for key, start, ids, doc_tokens in pieces:
            self.rows.append((key, start, len(ids), ids, doc_tokens, self.first + window, offset, leftover))
            offset += len(ids)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) < least or not self.rows:
            return
        columns = list(zip(*self.rows))
        ids = columns[3]
        begin = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) for x in ids], out=begin[1:])
        columns[3] = pa.ListArray.from_arrays(pa.array(begin), pa.array(np.concatenate(ids), pa.int32()))
        self.rows = []
        yield pa.RecordBatch.from_arrays(
            [column if isinstance(column, pa.Array) else pa.array(column, field.type)
             for column, field in zip(columns, self.schema)], names=self.schema.names)


def end_to_end(pieces: list, length: int) -> Iterator[list]:
    """Pieces cut into sequences of ``length``; the rest into lengths that are powers of two."""
    rest, filled = [], 0
    left = sum(len(ids) for _, _, ids, _ in pieces)

    def room() -> int:
        return length if left >= length else 1 << max(left.bit_length() - 1, 0)

    target = room()
    for key, start, ids, doc_tokens in pieces:
        while len(ids):
            taken = min(len(ids), target - filled)
            rest.append((key, start, ids[:taken], doc_tokens))
            ids, start, filled = ids[taken:], start + taken, filled + taken
            if filled == target:
                yield rest
                left -= target
                rest, filled, target = [], 0, room()


def pack(docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text",
         length: int = LENGTH, end: int = END, open_windows: int = OPEN_WINDOWS,
         least_cut: int = LEAST_CUT) -> DataFrame:
    """One row a piece: the key, the ids and where they stand in their document and sequence.

    ``vocabulary`` is the file of a tokenizer that splits at white space and drops it.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.spark_partition_id().alias("part"))
    key_field = StructField(key, narrow.schema["key"].dataType)
    result = StructType([key_field, *StructType.fromDDL(PIECE)])
    written = StructType([*result, *StructType.fromDDL("leftover boolean")])
    arrow = to_arrow_schema(written)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = windows = None
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                if out is None:
                    out = Pieces(arrow, part.column("part")[0].as_py() << 32)
                    windows = Windows(length, open_windows, least_cut, out.emit)
                ids, marks = encode_words(part.column("text"), path, end)
                for row, this in enumerate(part.column("key").to_pylist()):
                    windows.add(this, ids[marks[row]:marks[row + 1]], 0, int(marks[row + 1] - marks[row]))
                    yield from out.batches(PIECES_OUT)
        if out is not None:
            for window, pieces in windows.left():
                out.emit(window, pieces, True)
            yield from out.batches(1)

    def merge(group: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        found = found.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        keys, lists = found.column(key).to_pylist(), found.column("ids").combine_chunks()
        begin, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        starts, totals = found.column("start").to_pylist(), found.column("doc_tokens").to_pylist()
        out = Pieces(arrow, MERGED_FROM + (group[0].as_py() << 32))
        windows = Windows(length, open_windows, least_cut, out.emit)
        for row in sorted(range(len(keys)), key=lambda at: begin[at] - begin[at + 1]):
            windows.add(keys[row], ids[begin[row]:begin[row + 1]], starts[row], totals[row])
        for sequence in end_to_end([piece for _, pieces in windows.left() for piece in pieces], length):
            out.emit(windows.fresh(), sequence)
        return pa.Table.from_batches(out.batches(1), arrow)

    placed = materialise(narrow.mapInArrow(place, written), "pieces")
    task = F.shiftright("sequence_id", 32)
    merged = placed.where("leftover").withColumn("task", F.floor(task / MERGED)).groupBy("task").applyInArrow(
        merge, written)
    return placed.where("not leftover").unionByName(merged).drop("leftover")


def padding(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """Sequences, their ids, and how many pads they take: none where their ids are a power of two."""
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    short = F.when(F.bit_count("tokens") == 1, 0).otherwise(length - F.col("tokens"))
    return filled.agg(F.count(F.lit(1)).alias("sequences"), F.sum("tokens").alias("tokens"),
                      F.sum(short).alias("pads"))


def with_checksum(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """CRC-32 of each piece's ids as little-endian unsigned 32-bit numbers, in place of the ids."""
    schema = StructType([field for field in packed.schema if field.name != "ids"])
    schema.add("ids_crc32", LongType())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            begin = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * low:4 * high]) for low, high in zip(begin[:-1], begin[1:])]
            rest = [batch.column(name) for name in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sums, pa.int64())], names=schema.names)

    return packed.mapInArrow(sums, schema)


@query("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_checksum(pack(table(spark, sf_dir, "documents")))
