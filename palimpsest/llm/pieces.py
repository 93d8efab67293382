"""Sampled segmentation of texts into the pieces of a SentencePiece vocabulary, and decoding.

The pieces of a text form a lattice. Its weights are the pieces' probabilities by a Zipf law over
their rank in the vocabulary, raised to ``alpha``. Forward filtering sums the weights of all ways
to each position; backward sampling draws one way, each segmentation with its exact probability.
The draws are hashes of (seed, row key, place), so a row is cut alike in every run and partition.

No piece holds a space after another character, or a line feed, so the lattice falls apart there
and each distinct stretch of a batch is filtered once. Spaces are pieces' own; other characters
without a piece of their own are spelt by byte pieces, a literal U+2581 too, so decoding gives back
every text exactly.

Defined cases. A null text has null pieces, an empty text none; both decode to themselves. A null
key is a key like others. Rows that repeat a key and text are cut alike. A very long stretch
without a space is one lattice. Other columns are not read by ``encode``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.lookup import Lookup
from palimpsest.llm.registry import query, table
from palimpsest.llm.words import _hashes, bytes_of, mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
SEED = 1
BYTE_WEIGHT = -16.0  # log weight of a byte piece, before alpha
BITS = 40
SPACE, LINE_FEED = 0x20, 0x0A
SLICE = 1 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces as bytes, with a space for the mark U+2581; byte pieces by value."""

    pieces: tuple[tuple[int, bytes], ...]
    byte_ids: tuple[int, ...]
    size: int


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read on the driver; workers get the pieces with the task."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [-1] * 256
    for number in range(model.vocab_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            byte_ids[int(piece[3:5], 16)] = number
        elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
            pieces.append((number, piece.replace("▁", " ").encode()))
    if min(byte_ids) < 0:
        raise ValueError("a vocabulary without byte pieces cannot spell every text")
    if any(b" " in piece.lstrip(b" ") or b"\n" in piece for _, piece in pieces):
        raise ValueError("a piece goes over a space or a line feed")
    return Vocabulary(tuple(pieces), tuple(byte_ids), model.vocab_size())


def _step_key(node: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix(((node << 8) | byte).astype(np.uint64))


class Trie:
    """Pieces by their bytes, as one table of steps; 0 is the root and no step."""

    def __init__(self, vocabulary: Vocabulary, alpha: float) -> None:
        steps: list[dict[int, int]] = [{}]
        ids = [-1]
        for number, piece in vocabulary.pieces:
            node = 0
            for byte in piece:
                following = steps[node].get(byte)
                if following is None:
                    following = steps[node][byte] = len(steps)
                    steps.append({})
                    ids.append(-1)
                node = following
            ids[node] = number
        self.steps = Lookup(
            _step_key(np.array([node for node, step in enumerate(steps) for _ in step], np.int64),
                      np.array([byte for step in steps for byte in step], np.uint8)),
            np.array([following for step in steps for following in step.values()], np.int32), missing=0)
        self.ids = np.array(ids, np.int32)
        self.weight = np.full(vocabulary.size, alpha * BYTE_WEIGHT)
        numbers = np.array([number for number, _ in vocabulary.pieces])
        self.weight[numbers] = -alpha * np.log(np.arange(len(numbers)) + 2.0)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)


@lru_cache(maxsize=2)
def trie_of(vocabulary: Vocabulary, alpha: float) -> Trie:
    return Trie(vocabulary, alpha)


@dataclass
class Lattice:
    """Arcs by the node they end in, with thresholds for sampling. Nodes are byte positions of the
    stretches, one more than a stretch has bytes."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of the arcs into each node
    threshold: np.ndarray
    start: np.ndarray
    piece: np.ndarray


def lattice(data: np.ndarray, offsets: np.ndarray, trie: Trie) -> Lattice:
    """The lattices of some stretches, whose bytes follow each other in ``data``."""
    sizes = np.diff(offsets)
    stretch = np.repeat(np.arange(len(sizes)), sizes)
    stop = np.repeat(offsets[1:], sizes)
    lead = (data & 0xC0) != 0x80
    length = 1 + (data >= 0xC0).astype(np.int64) + (data >= 0xE0) + (data >= 0xF0)
    at = np.flatnonzero(lead)
    node, place = np.zeros(len(at), np.int64), at
    own = np.zeros(len(data), bool)
    starts, ends, pieces = [], [], []
    while len(at):
        node = trie.steps.get(_step_key(node, data[place])).astype(np.int64)
        alive = node > 0
        at, node, place = at[alive], node[alive], place[alive] + 1
        number = trie.ids[node]
        done = number >= 0
        starts.append(at[done])
        ends.append(place[done])
        pieces.append(number[done])
        own[at[done][place[done] - at[done] == length[at[done]]]] = True
        more = place < stop[at]
        at, node, place = at[more], node[more], place[more]
    spelt = np.flatnonzero(~own[np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0))])
    starts, ends = np.concatenate([*starts, spelt]), np.concatenate([*ends, spelt + 1])
    pieces = np.concatenate([*pieces, trie.byte_ids[data[spelt]]])
    # By end; of one end the longest first, which is the likeliest as a rule.
    longest = int((ends - starts).max(initial=0)) + 1
    order = np.argsort(ends * longest + (longest - 1 - (ends - starts)))
    starts, ends, pieces = starts[order], ends[order], pieces[order]
    of = stretch[starts]
    start_node, end_node = starts + of, ends + of
    first = np.r_[True, end_node[1:] != end_node[:-1]] if len(ends) else np.zeros(0, bool)
    chance = _chances(start_node, end_node, ends - offsets[of], trie.weight[pieces],
                      offsets[:-1] + np.arange(len(sizes)), len(data) + len(sizes))
    later = np.flatnonzero(~first)
    ranked = later
    while len(ranked):  # running sums, one arc of each node a step
        here = ranked[first[ranked - 1]]
        chance[here] += chance[here - 1]
        first[here] = True
        ranked = ranked[~first[ranked]]
    last = np.ones(len(first), bool)
    last[later - 1] = False
    threshold = (chance * (1 << BITS)).astype(np.int64)
    threshold[last] = 1 << BITS
    shift = np.arange(len(sizes))
    arcs = np.bincount(end_node, minlength=len(data) + len(sizes))
    return Lattice(offsets[:-1] + shift, offsets[1:] + shift, np.cumsum(arcs) - arcs, threshold, start_node, pieces)


def _chances(start_node: np.ndarray, end_node: np.ndarray, depth: np.ndarray, weight: np.ndarray,
             roots: np.ndarray, nodes: int) -> np.ndarray:
    """Forward filtering: for each arc, its share of all ways that end in the same node."""
    small = depth.astype(np.int16 if depth.max(initial=0) < 1 << 15 else np.int64)
    order = np.argsort(small, kind="stable")  # arcs of one node stay together
    begin, end, weight = start_node[order], end_node[order], weight[order]
    first = np.r_[True, end[1:] != end[:-1]] if len(end) else np.zeros(0, bool)
    total, share = np.full(nodes, -np.inf), np.empty(len(weight))
    total[roots] = 0.0
    bounds = np.searchsorted(small[order], np.arange(1, int(depth.max(initial=0)) + 2))
    for low, high in zip(bounds[:-1], bounds[1:]):
        if low == high:
            continue
        value = total[begin[low:high]] + weight[low:high]
        group = np.flatnonzero(first[low:high])
        top = np.maximum.reduceat(value, group)
        size = np.diff(np.r_[group, high - low])
        value = np.exp(value - np.repeat(top, size))
        whole = np.add.reduceat(value, group)
        total[end[low:high][group]] = top + np.log(whole)
        share[low:high] = value / np.repeat(whole, size)
    out = np.empty(len(share))
    out[order] = share
    return out


def sample(found: Lattice, stretch: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backward sampling of each occurrence of a stretch. Pieces of all occurrences, in order, and
    the number of pieces of each."""
    node, begin = found.end[stretch].copy(), found.begin[stretch]
    at, step, rounds = np.arange(len(stretch)), 0, []
    counts = np.zeros(len(stretch), np.int64)
    while len(at):
        draw = (mix(key[at] + np.uint64(step)) >> np.uint64(64 - BITS)).astype(np.int64)
        arc = found.first[node[at]]
        over = np.flatnonzero(found.threshold[arc] <= draw)
        while len(over):  # the last threshold of a node is above every draw
            arc[over] += 1
            over = over[found.threshold[arc[over]] <= draw[over]]
        rounds.append((at, found.piece[arc]))
        counts[at] += 1
        node[at] = found.start[arc]
        at = at[node[at] > begin[at]]
        step += 1
    last = np.cumsum(counts) - 1
    out = np.empty(int(counts.sum()), np.int32)
    for step, (at, piece) in enumerate(rounds):
        out[last[at] - step] = piece
    return out, counts


def stretches(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where stretches start: at a text, at a space after another byte, and around a line feed."""
    if not len(data):
        return np.zeros(0, np.int64)
    space, feed = data == SPACE, data == LINE_FEED
    start = np.zeros(len(data), bool)
    start[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    start[begin[:-1][np.diff(begin) > 0]] = True
    return np.flatnonzero(start)


def encode_texts(texts: pa.Array, keys: np.ndarray, trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts, and where each text's pieces begin."""
    raw, old = bytes_of(texts)
    filled = np.diff(old) > 0
    begin = old + np.r_[0, np.cumsum(filled)]
    data = np.full(int(begin[-1]), SPACE, np.uint8)  # a space before each text, as the vocabulary expects
    data[np.arange(len(raw)) + np.repeat(np.cumsum(filled), np.diff(old))] = raw
    start = stretches(data, begin)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    stop = np.r_[start[1:], len(data)]
    _, first, which = np.unique(_hashes(data, start, stop), return_index=True, return_inverse=True)
    sizes = (stop - start)[first]
    offsets = np.r_[0, np.cumsum(sizes)]
    place = np.arange(offsets[-1]) + np.repeat(start[first] - offsets[:-1], sizes)
    text = np.searchsorted(begin, start, "right") - 1
    number = np.arange(len(start)) - np.searchsorted(start, begin[:-1])[text]
    key = mix(keys[text] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    pieces, counts = sample(lattice(data[place], offsets, trie), which, key)
    return pieces, np.r_[0, np.cumsum(np.bincount(text, counts, len(texts)))].astype(np.int64)


def encode(docs: DataFrame, path: str = MODEL, seed: int = SEED, alpha: float = ALPHA, doc_id: str = "doc_id",
           text: str = "text", decode_again: bool = False) -> DataFrame:
    """One row per document row: doc_id, text_key (hash of the text), pieces. With ``decode_again``
    also lossless: whether the pieces, decoded, are the text."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    names = ["doc_id", "text_key", "pieces", *(["lossless"] if decode_again else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(vocabulary.value, alpha)
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                texts = piece.column("text")
                keys = piece.column("__key").to_numpy().view(np.uint64)
                pieces, begin = encode_texts(texts, keys, trie)
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(pieces),
                                                 mask=texts.is_null() if texts.null_count else None)
                columns = [piece.column("doc_id"), piece.column("text_key"), lists]
                if decode_again:
                    decoded = decode_pieces(lists, vocabulary.value).cast(texts.type)
                    same = pc.fill_null(pc.equal(decoded, texts), False)
                    columns.append(pc.or_(same, pc.and_(pc.is_null(decoded), pc.is_null(texts))))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _text_key(F.col(text)).alias("text_key"),
        F.xxhash64(F.lit(seed), F.col(doc_id)).alias("__key")).mapInArrow(
        run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, text_key long, pieces array<int>"
        + (", lossless boolean" if decode_again else ""))


def _text_key(text: Column) -> Column:
    return F.when(text.isNotNull(), F.xxhash64(text))


@lru_cache(maxsize=2)
def _spellings(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    spelt = [b""] * vocabulary.size
    for number, piece in vocabulary.pieces:
        spelt[number] = piece
    for byte, number in enumerate(vocabulary.byte_ids):
        spelt[number] = bytes([byte])
    begin = np.cumsum([0, *map(len, spelt)])
    return np.frombuffer(b"".join(spelt), np.uint8), begin


def decode_pieces(lists: pa.ListArray, vocabulary: Vocabulary) -> pa.Array:
    spelt, begin = _spellings(vocabulary)
    begins = lists.offsets.to_numpy().astype(np.int64)
    pieces = lists.values.to_numpy(zero_copy_only=False)[begins[0]:begins[-1]]
    begins = begins - begins[0]
    sizes = begin[pieces + 1] - begin[pieces]
    out = np.r_[0, np.cumsum(sizes)]
    data = spelt[np.arange(out[-1]) + np.repeat(begin[pieces] - out[:-1], sizes)]
    ends = out[begins]
    keep = np.ones(len(data), bool)
    keep[ends[:-1][np.diff(ends) > 0]] = False  # the space before each text
    ends = ends - np.r_[0, np.cumsum(np.diff(ends) > 0)]
    missing = lists.is_null()
    valid = None
    if lists.null_count:
        valid = pa.py_buffer(np.packbits(~missing.to_numpy(zero_copy_only=False), bitorder="little").tobytes())
    texts = pa.Array.from_buffers(pa.large_string(), len(lists), [
        valid, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data[keep].tobytes())])
    texts.validate(full=True)
    return texts


def decode(frame: DataFrame, pieces: str = "pieces", path: str = MODEL, to: str = "decoded") -> DataFrame:
    """Add the text that the pieces spell, and drop the pieces' column."""
    vocabulary = frame.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    others = [field for field in frame.schema if field.name not in (pieces, to)]
    names = [field.name for field in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                lists = part.column(pieces)
                # Slices keep the whole array below; take makes it their own.
                texts = decode_pieces(lists.take(pa.array(np.arange(len(lists)))), vocabulary.value)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in names), texts.cast(pa.string())], [*names, to])

    schema = ", ".join([*(f"`{field.name}` {field.dataType.simpleString()}" for field in others), f"`{to}` string"])
    return frame.mapInArrow(run, schema)


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), decode_again=True).select(
        "doc_id", F.size("pieces").alias("n_pieces"), "pieces", "lossless")
