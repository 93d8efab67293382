"""Boosted trees from histograms of packed rows, as Spark's own models of boosted trees.

The rounds are those of Spark's estimator: trees of regression by variance on the negative gradient
of the loss, the first one on the labels, thresholds from a sample of rows, rows drawn anew for each
tree. What differs is how a level of a tree is counted. Spark goes over every slot of every vector
one by one. Here slots are put in bins once, slots of one word become one number, and several of
these numbers one code, so a row is a few codes of 2 bytes; tasks count codes, and what a single
slot has is the sum of the joint counts over the others, which is exact. Rows lie packed in a written
table, beside their label and the sum of the trees up to some round; trees since then are added while
a block is read, and after every few trees the table is written anew. Only sums by node and bin come
to the driver.

Splits whose gains differ in the last digits alone count as equal: the first slot wins. Refused are
labels and numbers that are null or not finite, labels of a classifier other than 0 and 1, and rows
with two words in slots that are said to be of one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.scratch import discard, new_folder
from palimpsest.session import ship_package

# Key of the vector column's metadata: source column of each slot.
SOURCES = "sources"
# Rows that thresholds are taken from, as Spark does.
SAMPLED = 10_000
# Values of one code, and rows counted at once: both fit the caches of a core.
CODE_VALUES = 1024
CHUNK = 1 << 15
BLOCK_ROWS = 1 << 17
# Trees that are added while blocks are read, before their sum is written.
PENDING = 4
# Bytes of blocks that a task reads at most, and how many are worth a task of their own.
TASK_BYTES = 64 << 20
FEWEST_BYTES = 2 << 20
# A row's place among the ends of a tree is a byte.
DEEPEST = 8
# Gains that differ by less than this share of the mean square are equal.
TIE = 1e-12
BLOCK = "block long, label binary, margin binary, codes binary"
SUMS = "part int, sums binary"
REFUSED = ("weightCol", "validationIndicatorCol")


class Unfit(ValueError):
    """Rows that cannot be learned from."""


# Slots, fields and codes -----------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """A number with its thresholds, or the slots of one word: state 0 has none of them set."""

    slot: int
    width: int
    thresholds: np.ndarray | None

    @property
    def states(self) -> int:
        return self.width + 1 if self.thresholds is None else len(self.thresholds) + 1

    @property
    def candidates(self) -> int:
        return self.width if self.thresholds is None else len(self.thresholds)


@dataclass(frozen=True)
class Layout:
    size: int
    fields: tuple[Field, ...]
    codes: tuple[tuple[int, ...], ...] = field(init=False)

    def __post_init__(self) -> None:
        codes: list[list[int]] = []
        for at in sorted(range(len(self.fields)), key=lambda at: -self.fields[at].states):
            states = self.fields[at].states
            if states == 1:
                continue
            for code in codes:
                if states * np.prod(self._shape(code)) <= CODE_VALUES:
                    code.append(at)
                    break
            else:
                codes.append([at])
        object.__setattr__(self, "codes", tuple(map(tuple, codes)))

    def _shape(self, code) -> tuple[int, ...]:
        return tuple(self.fields[at].states for at in code)

    @property
    def shapes(self) -> list[tuple[int, ...]]:
        return [self._shape(code) for code in self.codes]

    @property
    def dtype(self):
        largest = max((int(np.prod(shape)) for shape in self.shapes), default=1)
        return np.uint16 if largest <= 1 << 16 else np.uint32

    def lookup(self, at: int, left: np.ndarray) -> tuple[int, np.ndarray]:
        """The code that a field is part of, and of each of its values 255 if it goes left, else 0."""
        number = next(n for n, code in enumerate(self.codes) if at in code)
        shape = self.shapes[number]
        axes = [1] * len(shape)
        axes[self.codes[number].index(at)] = -1
        bits = np.where(left, 255, 0).astype(np.uint8)
        return number, np.broadcast_to(bits.reshape(axes), shape).ravel()

    def by_field(self, counted: list[np.ndarray]) -> np.ndarray:
        """Sums by state of each field, one field behind the other, from those by code. The leading
        axes stay."""
        parts: list = [None] * len(self.fields)
        for code, shape, sums in zip(self.codes, self.shapes, counted, strict=True):
            lead = sums.shape[:-1]
            joint = sums.reshape(*lead, *shape)
            for axis, at in enumerate(code):
                others = tuple(len(lead) + i for i in range(len(shape)) if i != axis)
                parts[at] = joint.sum(axis=others)
        return np.concatenate([part for part in parts if part is not None], axis=-1)


def find_thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between values so that the bins hold about as many rows each; all midpoints where
    they are few enough."""
    known, counts = np.unique(values, return_counts=True)
    middle = (known[:-1] + known[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    stride = len(values) / bins
    reached, wanted, chosen = np.cumsum(counts), stride, []
    for at in range(1, len(known)):
        if abs(reached[at - 1] - wanted) < abs(reached[at] - wanted):
            chosen.append(middle[at - 1])
            wanted += stride
    return np.array(chosen)


def find_layout(vectors: DataFrame, sample: DataFrame, bins: int) -> Layout:
    """Fields by the metadata of the vectors, thresholds by the sampled ones."""
    found = [row["features"] for row in sample.select("features").collect()]
    if not found:
        raise Unfit("no rows to learn from")
    size = found[0].size
    metadata = vectors.schema["features"].metadata
    attributes = metadata.get("ml_attr", {}).get("attrs", {})
    if "nominal" in attributes:
        raise Unfit("slots with more than two categories")
    binary = {int(attribute["idx"]) for attribute in attributes.get("binary", [])}
    sources = metadata.get(SOURCES) or list(range(size))
    numbers = [slot for slot in range(size) if slot not in binary]
    chosen = np.array(numbers, np.int64)
    columns = np.stack([vector.toArray()[chosen] for vector in found])
    if not np.isfinite(columns).all():
        raise Unfit("numbers that are not finite")
    number_of = {slot: n for n, slot in enumerate(numbers)}
    fields: list[Field] = []
    slot = 0
    while slot < size:
        end = slot + 1
        if slot in binary:
            while end < size and end in binary and sources[end] == sources[slot]:
                end += 1
            fields.append(Field(slot, end - slot, None))
        else:
            fields.append(Field(slot, 1, find_thresholds(columns[:, number_of[slot]], bins)))
        slot = end
    return Layout(size, tuple(fields))


def _entries(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of what is not zero in a column of vectors, sparse or dense."""
    if vectors.null_count:
        raise Unfit("rows without a vector")
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    lists = vectors.field("values")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    slots = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    if not sparse.all():
        every = np.empty(len(values), np.int64)
        from_sparse = sparse[rows]
        every[from_sparse], every[~from_sparse] = slots, np.tile(np.arange(size), int((~sparse).sum()))
        slots = every
    there = values != 0
    return (rows, slots, values) if there.all() else (rows[there], slots[there], values[there])


def _encode(layout: Layout, vectors: pa.Array) -> np.ndarray:
    """Codes of a batch of vectors, a line per code."""
    rows, slots, values = _entries(vectors, layout.size)
    if not np.isfinite(values).all():
        raise Unfit("numbers that are not finite")
    n = len(vectors)
    owner, state = np.empty(layout.size, np.int64), np.zeros(layout.size)
    words = [at for at, known in enumerate(layout.fields) if known.thresholds is None]
    for at, known in enumerate(layout.fields):
        owner[known.slot:known.slot + known.width] = at
        if known.thresholds is None:
            state[known.slot:known.slot + known.width] = np.arange(known.width) + 1
    set_to = state.take(slots)
    is_word = set_to > 0
    if (values[is_word] != 1).any():
        raise Unfit("slots of words that are not 0 or 1")
    numbers = np.zeros((len(layout.fields), n))
    numbers.reshape(-1)[owner.take(slots) * n + rows] = np.where(is_word, set_to, values)
    if np.count_nonzero(numbers[words]) < np.count_nonzero(is_word):
        raise Unfit("two words in the slots of one")
    codes = np.empty((len(layout.codes), n), layout.dtype)
    for line, code in zip(codes, layout.codes, strict=True):
        joint = 0
        for at in code:
            known = layout.fields[at]
            joint = joint * known.states + (numbers[at].astype(np.int64) if known.thresholds is None
                                            else np.searchsorted(known.thresholds, numbers[at]))
        line[:] = joint
    return codes


def pack(layout: Layout, label: str, signed: bool) -> Callable:
    """Vectors and labels to blocks. ``signed``: labels 0 and 1 become -1 and 1."""
    def block(number: int, labels: list, codes: list) -> pa.RecordBatch:
        values = np.concatenate(labels)
        return pa.RecordBatch.from_pylist([{
            "block": number, "label": values.tobytes(), "margin": np.zeros(len(values)).tobytes(),
            "codes": np.concatenate(codes, axis=1).tobytes()}], pa.schema([
                ("block", pa.int64()), ("label", pa.binary()), ("margin", pa.binary()), ("codes", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, labels, codes, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column(label).cast(pa.float64())
            values = known.to_numpy(zero_copy_only=False)
            if known.null_count or not np.isfinite(values).all():
                raise Unfit("labels that are null or not finite")
            if signed:
                if not np.isin(values, (0.0, 1.0)).all():
                    raise Unfit("labels other than 0 and 1")
                values = values * 2 - 1
            vectors = batch.column("features")
            labels.append(values)
            codes.append(_encode(layout, vectors.storage if isinstance(vectors, pa.ExtensionArray) else vectors))
            held += len(values)
            if held >= BLOCK_ROWS:
                yield block(number, labels, codes)
                number, labels, codes, held = number + 1, [], [], 0
        if held:
            yield block(number, labels, codes)

    return run


# Trees ------------------------------------------------------------------------------------------

@dataclass
class Node:
    """A node while its tree grows: rows, sum and sum of squares of what the tree is fitted to."""

    rows: float = 0.0
    total: float = 0.0
    squares: float = 0.0
    gain: float = 0.0
    split: tuple | None = None
    lookup: tuple[int, np.ndarray] | None = None
    left: Node | None = None
    right: Node | None = None

    @property
    def value(self) -> float:
        return self.total / self.rows if self.rows else 0.0

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.rows) / self.rows if self.rows else 0.0

    def ends(self) -> list[Node]:
        return [self] if self.lookup is None else self.left.ends() + self.right.ends()

    def branch(self, number: Callable[[Node], int]):
        """Nested (code, goes left, left branch, right branch) with a number at each end: the little
        that tasks need."""
        if self.lookup is None:
            return number(self)
        return (*self.lookup, self.left.branch(number), self.right.branch(number))

    def voting(self, weight: float) -> tuple:
        """Branches down to the place of each end, and what the ends answer."""
        ends = self.ends()
        places = {id(node): at for at, node in enumerate(ends)}
        return self.branch(lambda node: places[id(node)]), np.array([weight * node.value for node in ends])

    def pruned(self) -> Node:
        """Without splits whose two leaves answer the same."""
        if self.left is not None:
            self.left, self.right = self.left.pruned(), self.right.pruned()
            if self.left.left is None and self.right.left is None and self.left.value == self.right.value:
                self.left = self.right = self.split = self.lookup = None
        return self


def walk(branch, codes: np.ndarray) -> np.ndarray:
    """The number at the end of each row's way through a tree: a byte, chosen by bits that are all
    set where a row goes left."""
    if not isinstance(branch, tuple):
        return np.uint8(branch)
    code, goes_left, left, right = branch
    left, right = walk(left, codes), walk(right, codes)
    return right ^ ((left ^ right) & goes_left.take(codes[code], mode="clip"))


def margins(margin: np.ndarray, trees: list, codes: np.ndarray) -> np.ndarray:
    for branch, votes in trees:
        margin = margin + votes.take(walk(branch, codes), mode="clip")
    return margin


def negative_gradient(loss: str, label: np.ndarray, margin: np.ndarray) -> np.ndarray:
    if loss == "logistic":
        with np.errstate(over="ignore"):
            return 4.0 * label / (1.0 + np.exp(2.0 * label * margin))
    if loss == "absolute":
        return np.where(label < margin, -1.0, 1.0)
    return 2.0 * (label - margin)


@dataclass(frozen=True)
class Pass:
    """Some nodes of one level of one tree, as tasks see them. ``kinds``: rows and sums, or squares too."""

    layout: Layout
    trees: list
    branch: object
    nodes: int
    loss: str | None
    kinds: int
    share: float
    seed: tuple[int, ...]


def _blocks(batches: Iterator[pa.RecordBatch], dtype) -> Iterator[tuple]:
    for batch in batches:
        for number, *parts in zip(*batch.columns, strict=True):
            label, margin, codes = [part.as_buffer() for part in parts]
            label = np.frombuffer(label)
            yield (number.as_py(), label, np.frombuffer(margin),
                   np.frombuffer(codes, dtype).reshape(-1, len(label)))


def add_up(level: Pass) -> Callable:
    """Rows, sums and squares by node, and behind them by kind, node and state, of the blocks of a
    task. Only rows that are drawn and in one of the nodes are looked at closely."""
    layout, nodes, kinds = level.layout, level.nodes, level.kinds
    sizes = [int(np.prod(shape)) for shape in layout.shapes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((kinds, nodes * size)) for size in sizes]
        totals = np.zeros((3, nodes))
        for number, labels, margin, packed in _blocks(batches, layout.dtype):
            drawn = np.random.Generator(np.random.SFC64([*level.seed, number]))
            for start in range(0, len(labels), CHUNK):
                chunk = slice(start, start + CHUNK)
                lines, wanted = packed[:, chunk], labels[chunk]
                node = np.broadcast_to(walk(level.branch, lines), wanted.shape)
                kept = node < nodes
                if level.share < 1:
                    kept &= drawn.random(len(wanted), np.float32) < level.share
                kept = np.flatnonzero(kept)
                lines, wanted = [line.take(kept) for line in lines], wanted.take(kept)
                if level.loss is not None:
                    wanted = negative_gradient(
                        level.loss, wanted, margins(margin[chunk].take(kept), level.trees, lines))
                node = node.take(kept).astype(np.intp)
                weights = (None, wanted, wanted * wanted)
                for total, weight in zip(totals, weights, strict=True):
                    total += np.bincount(node, weight, nodes)
                for size, line, found in zip(sizes, lines, sums, strict=True):
                    at = node * size + line if nodes > 1 else line.astype(np.intp)
                    for total, weight in zip(found, weights, strict=False):
                        total += np.bincount(at, weight, nodes * size)
        by_code = [found.reshape(kinds, nodes, size) for found, size in zip(sums, sizes, strict=True)]
        flat = [totals.ravel()] + ([layout.by_field(by_code).ravel()] if by_code else [])
        yield pa.RecordBatch.from_pylist(
            [{"part": TaskContext.get().partitionId(), "sums": np.concatenate(flat).tobytes()}],
            pa.schema([("part", pa.int32()), ("sums", pa.binary())]))

    return run


def advance(layout: Layout, trees: list) -> Callable:
    """Blocks with the sum of more trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = []
            for _, labels, margin, packed in _blocks(iter([batch]), layout.dtype):
                parts = [margins(margin[start:start + CHUNK], trees, packed[:, start:start + CHUNK])
                         for start in range(0, len(labels), CHUNK)]
                after.append(np.concatenate(parts).tobytes())
            yield batch.set_column(2, "margin", pa.array(after, pa.binary()))

    return run


def choose_split(layout: Layout, node: Node, sums: np.ndarray, fewest: int, least: float) -> tuple | None:
    """The best split of a node by its sums by state: gain, rows, sum and squares on its left, the
    field, which of its states go left, and slot, threshold and category. None where no split gains."""
    tie = TIE * node.squares / node.rows if node.rows else 0.0
    if node.impurity <= tie:
        return None
    left, at = [], 0
    places: list[tuple[int, int]] = []
    for number, known in enumerate(layout.fields):
        if known.states > 1:
            part = sums[:, at:at + known.states]
            at += known.states
            left.append(part[:, 1:] if known.thresholds is None else np.cumsum(part, axis=1)[:, :-1])
            places += [(number, i) for i in range(known.candidates)]
    if not places:
        return None
    left = np.concatenate(left, axis=1)
    n, s = left[0], left[1]
    valid = (n >= fewest) & (node.rows - n >= fewest)
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = (s * s / n + (node.total - s) ** 2 / (node.rows - n) - node.total * node.total / node.rows) / node.rows
    gains = np.where(valid, gains, -np.inf)
    if gains.max() <= tie or gains.max() < least:
        return None
    best = int(np.argmax(gains >= gains.max() - tie))
    number, i = places[best]
    known, side = layout.fields[number], left[:, best]
    if known.thresholds is not None:
        return gains[best], side, number, np.arange(known.states) <= i, (known.slot, known.thresholds[i], None)
    goes_left, category = np.arange(known.states) == i + 1, 1
    rest = np.array([node.rows, node.total, node.squares]) - side
    if rest[1] / rest[0] <= side[1] / side[0]:
        goes_left, category, side = ~goes_left, 0, rest
    return gains[best], side, number, goes_left, (known.slot + i, None, category)


class Blocks:
    """The packed rows as a written table, read by a session of its own settings."""

    def __init__(self, spark: SparkSession, layout: Layout) -> None:
        self.spark, self.layout, self.frame = spark, layout, None
        self.reader = spark.newSession()
        self.reader.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def write(self, frame: DataFrame) -> None:
        """The table anew, to be read by as many tasks as fill the cores about evenly, fewer where
        there is little to read: Spark would pack files up to 128 MB, which are few tasks, and count
        4 MB for the opening of each."""
        path, before = new_folder(self.spark, "blocks"), self.frame
        frame.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
        self.frame = self.reader.read.schema(BLOCK).parquet(path)
        files = max(len(self.frame.inputFiles()), 1)
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        size = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
        cores = self.spark.sparkContext.defaultParallelism
        tasks = max(min(cores * -(-size // (TASK_BYTES * cores)), size // FEWEST_BYTES), 1)
        together = int(-(-files // tasks) * size / files * 1.05) + 1
        for name, value in (("openCostInBytes", 0), ("minPartitionNum", 1), ("maxPartitionBytes", together)):
            self.reader.conf.set(f"spark.sql.files.{name}", str(value))
        if before is not None:
            discard(before)

    def add(self, trees: list) -> None:
        self.write(self.frame.mapInArrow(advance(self.layout, trees), BLOCK))

    def count(self, level: Pass) -> tuple[np.ndarray, np.ndarray]:
        """Rows, sums and squares by node, and by kind, node and state. Where squares were not
        counted each is one, so they are the rows."""
        found = sorted(self.frame.mapInArrow(add_up(level), SUMS).collect())
        added = np.sum([np.frombuffer(row["sums"]) for row in found], axis=0)
        totals = added[:3 * level.nodes].reshape(3, level.nodes)
        sums = added[3 * level.nodes:].reshape(level.kinds, level.nodes, -1)
        return totals, sums if level.kinds == 3 else np.concatenate([sums, sums[:1]])

    def close(self) -> None:
        if self.frame is not None:
            discard(self.frame)


@dataclass
class BoostedTrees:
    """Fits what an estimator of Spark's says. ``sample``: vectors to take thresholds from; without
    it some of those that are fitted."""

    trees: GBTClassifier | GBTRegressor
    sample: DataFrame | None = None

    def parameter(self, name: str):
        return self.trees.getOrDefault(name)

    def fit(self, vectors: DataFrame) -> GBTClassificationModel | GBTRegressionModel:
        refused = [name for name in REFUSED if self.trees.hasParam(name) and self.trees.isSet(name)]
        if refused:
            raise ValueError(f"not known here: {', '.join(refused)}")
        if not 0 < self.parameter("maxDepth") <= DEEPEST:
            raise ValueError(f"trees are 1 to {DEEPEST} levels deep here")
        ship_package(vectors.sparkSession)
        sample = self.sample
        if sample is None:
            sample = vectors.sample(sample_share(vectors.count()), self.parameter("seed"))
        layout = find_layout(vectors, sample, self.parameter("maxBins"))
        label, signed = self.parameter("labelCol"), isinstance(self.trees, GBTClassifier)
        blocks = Blocks(vectors.sparkSession, layout)
        try:
            blocks.write(vectors.mapInArrow(pack(layout, label, signed), BLOCK))
            grown = self.boost(blocks)
        finally:
            blocks.close()
        return self.model(vectors.sparkSession, layout, grown)

    def boost(self, blocks: Blocks) -> list[Node]:
        grown, pending = [], []
        rounds = self.parameter("maxIter")
        for number in range(rounds):
            tree = self.grow(blocks, number, pending)
            grown.append(tree)
            pending.append(tree.voting(1.0 if number == 0 else self.parameter("stepSize")))
            if len(pending) == PENDING and number + 1 < rounds:
                blocks.add(pending)
                pending = []
        return grown

    def grow(self, blocks: Blocks, number: int, pending: list) -> Node:
        """One tree. Of two children only the one with fewer rows is counted; the other has the rest
        of what their parent has."""
        loss = "logistic" if isinstance(self.trees, GBTClassifier) else self.parameter("lossType")
        root = Node()
        level: list[tuple] = [(root, None, None)]
        for _ in range(self.parameter("maxDepth")):
            order = {id(fewer): at for at, (fewer, _, _) in enumerate(level)}
            totals, sums = blocks.count(Pass(
                blocks.layout, pending, root.branch(lambda node: order.get(id(node), len(order))), len(level),
                loss if number else None, 2 if number and loss == "absolute" else 3,
                self.parameter("subsamplingRate"), (self.parameter("seed") & (1 << 64) - 1, number)))
            below = []
            for at, (fewer, more, parent) in enumerate(level):
                if more is None:
                    fewer.rows, fewer.total, fewer.squares = map(float, totals[:, at])
                below += self.divide(blocks.layout, fewer, sums[:, at])
                if more is not None:
                    below += self.divide(blocks.layout, more, parent - sums[:, at])
            level = below
            if not level:
                break
        return root.pruned()

    def divide(self, layout: Layout, node: Node, sums: np.ndarray) -> list[tuple]:
        """The children of a node, if a split gains: the one with fewer rows, the other, and the
        node's sums."""
        found = choose_split(layout, node, sums, self.parameter("minInstancesPerNode"), self.parameter("minInfoGain"))
        if found is None:
            return []
        node.gain, side, number, goes_left, node.split = found
        node.lookup = layout.lookup(number, goes_left)
        node.left, node.right = Node(), Node()
        whole = np.array([node.rows, node.total, node.squares])
        for child, of in ((node.left, side), (node.right, whole - side)):
            child.rows, child.total, child.squares = map(float, of)
        return [(*sorted((node.left, node.right), key=lambda child: child.rows), sums)]

    def model(self, spark: SparkSession, layout: Layout, grown: list[Node]):
        """Spark's own model of these trees, as its estimator would return it."""
        gateway = spark.sparkContext._gateway
        ml = spark.sparkContext._jvm.org.apache.spark.ml
        # Each name is looked up in the JVM.
        number, inner, leaf = gateway.jvm.double, ml.tree.InternalNode, ml.tree.LeafNode
        continuous, categorical = ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
        variance = gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

        def doubles(values):
            array = gateway.new_array(number, len(values))
            for at, value in enumerate(values):
                array[at] = float(value)
            return array

        def node_of(node: Node):
            stats = variance(doubles([node.rows, node.total, node.squares]), int(node.rows))
            if node.split is None:
                return leaf(node.value, node.impurity, stats)
            slot, threshold, category = node.split
            split = (continuous(slot, float(threshold)) if category is None
                     else categorical(slot, doubles([category]), 2))
            return inner(node.value, node.impurity, float(node.gain), node_of(node.left), node_of(node.right),
                         split, stats)

        one = ml.regression.DecisionTreeRegressionModel
        forest = gateway.new_array(one, len(grown))
        for at, tree in enumerate(grown):
            forest[at] = one(node_of(tree), layout.size)
        weights = doubles([1.0] + [self.parameter("stepSize")] * (len(grown) - 1))
        if isinstance(self.trees, GBTClassifier):
            made = GBTClassificationModel(ml.classification.GBTClassificationModel(
                self.trees.uid, forest, weights, layout.size, 2))
        else:
            made = GBTRegressionModel(ml.regression.GBTRegressionModel(self.trees.uid, forest, weights, layout.size))
        return self.trees._copyValues(made)


def sample_share(rows: int) -> float:
    return min(1.0, SAMPLED / max(rows, 1))


def with_sources(vectors: DataFrame, sources: list[str]) -> DataFrame:
    """The vectors with the source column of each slot in their metadata."""
    metadata = {**vectors.schema["features"].metadata, SOURCES: sources}
    return vectors.withColumn("features", F.col("features").alias("features", metadata=metadata))
