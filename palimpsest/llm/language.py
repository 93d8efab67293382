"""Language identification of words, spans and documents.

A word is a run of letters. The script of its first letter narrows the candidate languages to
those whose training text uses that script; a word's score for a language is the sum of log
probabilities of its letter trigrams and of the word itself, hashed to at most ``BUCKETS`` numbers.
Viterbi over the words of a text, with a penalty for each change of language, labels spans. The
language of a document is the one with most letters; its score is their share of all letters.

The model is fitted on at most about ``FIT_DOCS`` documents of each language, chosen by a hash of
their id. Every language is learned. Its size is at most ``CELLS`` scores: many languages share the
numbers out, down to ``LEAST_BUCKETS`` for each; beyond 8,192 languages it grows with them.

Defined cases. A null text, or one without letters, is ``und`` with score 0 and no spans; so is
every text where no language was learned. Ties go to the first name. A word of a script that no
learned language uses favours none. Repeated rows are labelled each. Documents without language
are not learned from. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.class_lm import fold
from palimpsest.llm.registry import query, table
from palimpsest.llm.words import mix, slices

UNKNOWN = "und"
BUCKETS = 1 << 17
FIT_DOCS = 4000
CELLS = 1 << 25
LEAST_BUCKETS = 1 << 12
# Languages whose counts a task holds at once.
COUNTED = 128
PENALTY = 12.0
SMOOTHING = 0.05
# A language uses a script if it has at least this share of the language's letters.
SCRIPT_SHARE = 0.01
# Scores held at once: words times languages.
HELD = 1 << 22

# First and last code point of the scripts' main ranges.
SCRIPTS = {
    "Latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "Armenian": ((0x530, 0x58F),),
    "Hebrew": ((0x590, 0x5FF),),
    "Arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "Devanagari": ((0x900, 0x97F),),
    "Bengali": ((0x980, 0x9FF),),
    "Gurmukhi": ((0xA00, 0xA7F),),
    "Gujarati": ((0xA80, 0xAFF),),
    "Tamil": ((0xB80, 0xBFF),),
    "Telugu": ((0xC00, 0xC7F),),
    "Kannada": ((0xC80, 0xCFF),),
    "Malayalam": ((0xD00, 0xD7F),),
    "Sinhala": ((0xD80, 0xDFF),),
    "Thai": ((0xE00, 0xE7F),),
    "Lao": ((0xE80, 0xEFF),),
    "Tibetan": ((0xF00, 0xFFF),),
    "Burmese": ((0x1000, 0x109F),),
    "Georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "Ethiopic": ((0x1200, 0x139F),),
    "Khmer": ((0x1780, 0x17FF),),
    "Mongolian": ((0x1800, 0x18AF),),
    "Kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "Hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "Han": ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, whether it is a letter, and the number of its script (0: another)."""
    letter = np.fromiter((chr(at).isalpha() for at in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            script[low:high + 1] = number
    return letter, script


@dataclass
class LetterWords:
    """Words of some texts: character ranges inside their text, script, text, and their features."""

    starts: np.ndarray
    stops: np.ndarray
    script: np.ndarray
    text: np.ndarray
    trigrams: np.ndarray
    letters: np.ndarray
    whole: np.ndarray


def letter_words(texts: pa.Array) -> LetterWords:
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    is_letter, scripts = _characters()
    begin = np.cumsum(np.r_[0, size])
    inside = is_letter[points]
    before, after = np.zeros(len(points), bool), np.zeros(len(points), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = begin[(begin > 0) & (begin < len(points))]
    before[edges], after[edges - 1] = False, False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    places = np.flatnonzero(inside)
    wide = points.astype(np.uint64)
    left = np.where(before[places], wide[np.maximum(places - 1, 0)], 0)
    right = np.where(after[places], wide[np.minimum(places + 1, max(len(points) - 1, 0))], 0)
    trigrams = mix((left << np.uint64(42)) | (wide[places] << np.uint64(21)) | right)
    lengths = stops - starts
    text = np.searchsorted(begin, starts, "right") - 1
    # The word itself: the sum of its trigrams' fingerprints, each turned by its place.
    turned = trigrams * (np.uint64(2) * (places - np.repeat(starts, lengths)).astype(np.uint64) + np.uint64(1))
    whole = mix(np.add.reduceat(turned, np.cumsum(lengths) - lengths)) if len(starts) else turned[:0]
    buckets = np.uint64(BUCKETS)
    return LetterWords(starts - begin[text], stops - begin[text], scripts[points[starts]], text,
                       (trigrams % buckets).astype(np.int64), lengths, (whole % buckets).astype(np.int64))


@dataclass
class Model:
    names: list[str]
    scores: np.ndarray
    candidates: np.ndarray


def buckets_for(languages: int) -> int:
    """Numbers for each language, a power of two."""
    buckets = BUCKETS
    while buckets > LEAST_BUCKETS and buckets * languages > CELLS:
        buckets >>= 1
    return buckets


def _given(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, total in totals.items():
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(bucket), pa.string()), pa.array(bucket.astype(np.int32)),
             pa.array(total[bucket])], ["lang", "bucket", "n"])
    totals.clear()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scripts = len(SCRIPTS) + 1
    for batch in batches:
        totals: dict[str, np.ndarray] = {}
        for piece in slices(batch, "text"):
            words = letter_words(piece.column("text"))
            langs = piece.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(name) for name in langs])[words.text]
            of_letter = np.repeat(number, words.letters)
            for at, name in enumerate(names):
                total = totals.setdefault(name, np.zeros(BUCKETS + scripts, np.int64))
                total += np.bincount(words.trigrams[of_letter == at], minlength=BUCKETS + scripts)
                total += np.bincount(words.whole[number == at], minlength=BUCKETS + scripts)
                total[BUCKETS:] += np.bincount(words.script[number == at], words.letters[number == at],
                                               scripts).astype(np.int64)
                if len(totals) >= COUNTED:
                    yield from _given(totals)
        yield from _given(totals)


def fit(texts: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """``texts``: doc_id, text, lang of the documents to learn from."""
    spark: SparkSession = texts.sparkSession
    known = texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).collect()
    share = spark.createDataFrame(
        [(row["lang"], min(1.0, fit_docs / row["docs"])) for row in sizes], "lang string, share double")
    lot = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.join(F.broadcast(share), "lang").where(lot < F.col("share")).select("text", "lang")
    buckets = buckets_for(len(sizes))
    # Scripts stand after the numbers.
    place = F.when(F.col("bucket") < BUCKETS, F.col("bucket") % buckets).otherwise(
        F.col("bucket") - (BUCKETS - buckets)).alias("bucket")
    counts = chosen.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", place).agg(
        F.sum("n").alias("n")).toArrow()
    lang, bucket, n = (counts.column(name).to_numpy() for name in ("lang", "bucket", "n"))
    names = sorted(set(lang.tolist()))
    total = np.zeros((buckets + len(SCRIPTS) + 1, len(names)))
    if names:
        total[bucket, np.searchsorted(np.array(names, dtype=object), lang)] = n
    letters = total[buckets:]
    features = total[:buckets] + SMOOTHING
    # What a word adds is relative to the mean of the languages, so unseen features favour none.
    scores = np.log(features / np.maximum(features.sum(axis=0, keepdims=True), 1))
    if names:
        scores -= scores.mean(axis=1, keepdims=True)
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0, keepdims=True), 1)
    return Model(names, scores.astype(np.float32), uses)


def word_scores(words: LetterWords, model: Model) -> np.ndarray:
    if not len(words.starts) or not model.names:
        return np.zeros((len(words.starts), len(model.names)))
    begin = np.cumsum(words.letters) - words.letters
    buckets = len(model.scores)
    out = np.add.reduceat(model.scores[words.trigrams % buckets], begin, axis=0) + model.scores[words.whole % buckets]
    able = model.candidates[words.script]
    odd = np.flatnonzero(~able.all(axis=1))
    out[odd] = np.where(able[odd], out[odd], out[odd].min(axis=1, keepdims=True) - np.float32(PENALTY))
    out[~able.any(axis=1)] = 0.0
    return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best label of each word. ``scores``: the words of all texts, one after the other;
    ``lengths``: words of each text. All texts advance together, one word a step."""
    labels = np.zeros(len(scores), np.int64)
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    first = (np.cumsum(lengths) - lengths)[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")  # texts with more words than the step
    stays = np.zeros(scores.shape, bool)
    came = np.zeros(len(scores), np.int32)
    value = np.zeros((len(size), scores.shape[1]), np.float64)
    for step in range(steps):
        at = first[:active[step]] + step
        now = value[:active[step]]
        if step:
            best = now.argmax(axis=1)
            change = now[np.arange(len(at)), best][:, None] - penalty
            stay = now >= change
            stays[at], came[at] = stay, best
            now = np.where(stay, now, change)
        value[:active[step]] = now + scores[at]
    label = value.argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        at = first[:active[step]] + step
        here = label[:active[step]]
        labels[at] = here
        if step:
            label[:active[step]] = np.where(stays[at, here], here, came[at])
    return labels


SPANS = "array<struct<start:int,stop:int,lang:string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def _labelled(piece: pa.RecordBatch, words: LetterWords, scores: np.ndarray, model: Model) -> pa.RecordBatch:
    size, count = piece.num_rows, max(1, len(model.names))
    labels = viterbi(scores, np.bincount(words.text, minlength=size)) if model.names else np.zeros(0, np.int64)
    text = words.text if model.names else words.text[:0]
    names = np.array([*model.names, UNKNOWN], dtype=object)
    letters = np.bincount(text * count + labels, words.letters[:len(text)], size * count).reshape(size, count)
    total = letters.sum(axis=1)
    best = np.where(total > 0, letters.argmax(axis=1), len(names) - 1)
    share = letters.max(axis=1) / np.maximum(total, 1)
    new = np.r_[True, (text[1:] != text[:-1]) | (labels[1:] != labels[:-1])] if len(text) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(text)][:len(begin)] - 1
    offsets = np.r_[0, np.cumsum(np.bincount(text[begin], minlength=size))].astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(words.starts[begin].astype(np.int32)), pa.array(words.stops[end].astype(np.int32)),
         pa.array(names[labels[begin]], pa.string())], ["start", "stop", "lang"]))
    return pa.RecordBatch.from_arrays(
        [piece.column(0), pa.array(names[best], pa.string()), pa.array(share), spans.cast(_SPAN)],
        ["doc_id", "lang_pred", "score", "spans"])


def _label(model, column: str, keep_rows: bool = False):
    """Labels of each row; or, with ``keep_rows``, the rows themselves in which a language is found."""
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        width = max(1, len(known.names))
        for batch in batches:
            # Texts advance together, so as many as memory allows: scores are 8 bytes a word and language.
            for held in slices(batch, column, max(1 << 13, 6 * HELD // width)):
                parts = []
                for piece in slices(held, column, max(1 << 11, (3 << 20) // width)):
                    words = letter_words(piece.column(column))
                    parts.append((words, word_scores(words, known), piece.num_rows))
                base = np.cumsum([0, *(rows for _, _, rows in parts)])
                words = LetterWords(*(np.concatenate([getattr(part[0], name) for part in parts]) for name in (
                    "starts", "stops", "script")),
                    np.concatenate([part[0].text + low for part, low in zip(parts, base)]),
                    np.zeros(0, np.int64), np.concatenate([part[0].letters for part in parts]), np.zeros(0, np.int64))
                labels = _labelled(held, words, np.concatenate([part[1] for part in parts]), known)
                yield labels if not keep_rows else held.filter(
                    pc.not_equal(labels.column("lang_pred"), UNKNOWN))

    return label


def label_languages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, lang_pred, score, spans (characters of the text)."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _label(docs.sparkSession.sparkContext.broadcast(model), "text"),
        f"doc_id long, lang_pred string, score double, spans {SPANS}")


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents in which a learned language is found, in their own columns."""
    return docs.mapInArrow(_label(docs.sparkSession.sparkContext.broadcast(model), text, keep_rows=True), docs.schema)


def training_part(docs: DataFrame, parts: int = 5) -> DataFrame:
    """The labelled documents outside the held-out fold."""
    return docs.where(fold(F.col("doc_id"), parts) != 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label_languages(docs, fit(training_part(docs))).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"))
