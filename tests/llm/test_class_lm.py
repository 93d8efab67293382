import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from palimpsest.llm import class_lm
from palimpsest.llm.class_lm import (ENDINGS, _entries, _likelihood, _merge_seen, best_classes, class_bigrams, contexts,
                                     exchange, fit, score_texts, text_bigrams, word_counts)
from palimpsest.llm.words import NOT_SPACE, cut

from llm_samples import ODD_ROWS, words

END = "\0end"


def tokens(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*"".join(" " if c in " \t\n\r\x0b\x0c" else c for c in lowered).split(" "), END]


def held_out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


def brute(docs):
    docs = [(doc, [x for x in tokens(text) if x]) for doc, text in docs]
    counts = Counter(x for doc, found in docs if not held_out(doc) for x in found)
    total, distinct = sum(counts.values()), len(counts)
    return sorted(((doc, held_out(doc), len(found), sum(counts[x] > 0 for x in found), total,
                    round(sum(math.log10((counts[x] + .1) / (total + .1 * (distinct + 1))) for x in found), 6))
                   for doc, found in docs), key=str)


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_base_equals_brute_force_for_any_head(make_docs, head):
    docs = ODD_ROWS + [(at, " ".join(words(at, 60))) for at in range(30, 90)] + [(95, " ".join(words(95, 9000)))]
    got = score_texts(make_docs(docs), head_size=head, clustered=20, classes=4).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in got), key=str) == brute(docs)
    assert all(r.score < 0 and r.perplexity > 1 for r in got)


def test_the_head_changes_no_score(make_docs):
    docs = [(at, " ".join(words(at, 80))) for at in range(60)]
    one, two = ({r.doc_id: r.score for r in score_texts(make_docs(docs), head_size=size, clustered=16, classes=4).collect()}
                for size in (1 << 18, 200))
    # The clustered words come from the head; with 200 of 460 words it still holds the same 16.
    assert all(abs(one[x] - two[x]) < 1e-6 * abs(one[x]) for x in one)


def test_classes_help_on_text_that_has_them(make_docs):
    rng = np.random.default_rng(1)
    def text(size):
        return " ".join(f"{'ab'[at % 2]}{rng.integers(30)}x" for at in range(size))
    docs = [(at, text(100)) for at in range(80)]
    got = score_texts(make_docs(docs), clustered=60, classes=2).collect()
    ours, base = (sum(getattr(r, name) for r in got if r.held_out) for name in ("score", "base_score"))
    assert ours > base + 0.2 * sum(r.n_tokens for r in got if r.held_out)


def test_words_beyond_the_first_have_classes_by_exchange(make_docs):
    rng = np.random.default_rng(4)
    def text(size):
        return " ".join(f"{'ab'[at % 2]}{rng.integers(200)}x" for at in range(size))
    docs = [(at, text(100)) for at in range(120)]
    got = score_texts(make_docs(docs), clustered=20, classes=2).collect()
    ours, base = (sum(getattr(r, name) for r in got if r.held_out) for name in ("score", "base_score"))
    assert ours > base + 0.2 * sum(r.n_tokens for r in got if r.held_out)


def test_exchange_finds_the_classes():
    rng = np.random.default_rng(2)
    true = rng.permutation(np.arange(40) % 2)
    bigrams = rng.poisson(np.where(true[:, None] != true[None, :], 20.0, 1.0)).astype(float)
    of = exchange(bigrams, 40, 2)
    assert (of == true).all() or (of != true).all()


def likelihood(bigrams, of):
    number = of.max() + 1
    table = np.zeros((number, number))
    np.add.at(table, (of[:, None], of[None, :]), bigrams)
    return sum((x * np.log(np.maximum(x, 1))).sum() * sign for x, sign in (
        (table, 1), (table.sum(axis=0), -1), (table.sum(axis=1), -1)))


def test_no_single_move_raises_the_likelihood():
    rng = np.random.default_rng(6)
    bigrams = rng.poisson(3.0, (14, 14)).astype(float)
    of = exchange(bigrams, 12, 3, sweeps=50)
    assert of[12:].tolist() == [3, 4]
    best = likelihood(bigrams, of)
    for word in range(12):
        for to in range(3):
            moved = of.copy()
            moved[word] = to
            assert likelihood(bigrams, moved) <= best + 1e-6


def test_scores_are_probabilities(make_docs):
    # Over one word after the start: all known words and one unseen in each ending sum up to about one.
    docs = [(at, x) for at, x in enumerate(["aa bb", "aa cc", "bb aa dd"] * 6)]
    known = ["aa", "bb", "cc", "dd", ""]
    probe = [(1000 + at, x) for at, x in enumerate(known)]
    got = {r.doc_id: r.score for r in score_texts(make_docs(docs + probe), clustered=2, classes=2).collect()}
    assert sum(10 ** got[1000 + at] for at in range(len(known))) < 1


def test_nothing_to_learn_from(make_docs):
    assert score_texts(make_docs([])).collect() == []
    only = next(at for at in range(1000) if held_out(at))
    row, = score_texts(make_docs([(only, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and abs(row.base_score) < 1e-9


def token_rows(texts):
    """Fingerprints and endings of each text's tokens, one text at a time."""
    import pyarrow as pa
    return [tuple(x.tolist() for x in class_lm.tokens(cut(pa.array([text or ""]), NOT_SPACE, lower=True))[:2]) for text in texts]


def signed(word):
    return word - (1 << 64) if word >= 1 << 63 else word


def training_frame(spark, size=60):
    texts = [" ".join(words(at % 9, 30 + at % 5) + words(at, 6)) for at in range(size)] + [None, "", "one", "one one"]
    return texts, spark.createDataFrame([(text,) for text in texts], "text string").repartition(3)


@pytest.mark.parametrize("head", [1 << 20, 25])
def test_classes_beside_words_against_brute_force(spark, head):
    texts, frame = training_frame(spark)
    counts = word_counts(frame)
    known = counts.select("word", "ending", "n", F.pmod("word", F.lit(5)).cast("int").alias("class"), F.lit(False).alias("hot"))
    own = {row["word"]: row["class"] for row in known.collect()}
    end = signed(int(class_lm.END))
    want = Counter()
    for found, _ in token_rows(texts):
        found = [signed(word) for word in found]
        for before, word in zip([end, *found[:-1]], found):
            want[word, own[before]] += 1
            want[before, 20 + own[word]] += 1
    seen = contexts(frame, known, 20, own[end], head, 10)
    rows = seen.toArrow().combine_chunks().to_batches()[0]
    at = _entries(rows)
    word = rows.column("word").to_pylist()
    got = Counter({(word[row], int(place)): int(times) for row, place, times in zip(*at)})
    assert got == want and len(word) == len(set(word)) == len(own)
    between = class_bigrams(seen, 20)
    assert between.sum() == sum(len(found) for found, _ in token_rows(texts))
    assert (text_bigrams(frame, known, 20, own[end], head) == between).all()


def test_rows_of_a_word_that_is_everywhere_are_added_up(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(class_lm, "HELD_ROWS", 5)
    schema = pa.schema([("word", pa.int64()), ("at", pa.binary()), ("times", pa.binary()), ("ending", pa.int32()),
                        ("n", pa.int64()), ("class", pa.int32()), ("hot", pa.bool_())])
    one = {"word": 7, "at": bytes([3, 9]), "times": np.array([1, 300], "<u8").tobytes(), "ending": None, "n": None,
           "class": None, "hot": None}
    fact = {"word": 7, "at": None, "times": None, "ending": 1, "n": 5, "class": 2, "hot": True}
    other = {**one, "word": 8}, {**fact, "word": 8}
    batches = [pa.RecordBatch.from_pylist(part, schema) for part in (
        [one] * 4 + [fact], [one] * 6, [], [one, *other])]
    out = pa.Table.from_batches(_merge_seen(iter(batches)))
    assert out.column("word").to_pylist() == [7, 8]
    assert np.frombuffer(out.column("times")[0].as_py(), "<u8").tolist() == [11, 3300]
    assert out.column("at")[0].as_py() == bytes([3, 9]) and out.column("n").to_pylist() == [5, 5]


def test_best_class_of_one_word_against_the_likelihood_of_every_move():
    """A word beside fixed classes only, so that a move changes no cell of its neighbours."""
    rng = np.random.default_rng(3)
    classes, number, moves = 4, 6, set()
    for _ in range(60):
        bigrams = rng.integers(0, 9, (9, 9)) * (rng.random((9, 9)) < 0.7)
        of = np.r_[rng.integers(0, classes, 7), classes, classes + 1]
        word = int(rng.integers(0, 7))
        bigrams[word], bigrams[:, word] = 0, 0
        after, before = rng.integers(1, 9, 2)
        bigrams[word, 7:], bigrams[7:, word] = (after, before), (before, after)

        def table_of(of):
            out = np.zeros((number, number))
            np.add.at(out, (of[:, None], of[None, :]), bigrams)
            return out

        at = np.array([classes, classes + 1, number + classes, number + classes + 1])
        best = best_classes(of[[word]].copy(), np.array([after + before]), np.zeros(4, np.int64), at,
                            np.array([before, after, after, before]), table_of(of), classes)
        every = [_likelihood(table_of(np.r_[of[:word], own, of[word + 1:]])) for own in range(classes)]
        assert every[int(best[0])] >= max(every) - 1e-6
        moves.add(int(best[0]) == of[word])
    assert moves == {True, False}


def test_a_word_without_a_class_takes_the_smallest_of_equal_ones():
    found = best_classes(np.array([2]), np.array([2]), np.zeros(2, np.int64), np.array([2, 5]), np.array([2, 2]),
                         np.full((3, 3), 4.0), 2)
    assert found.tolist() == [0]


def test_gains_found_once_for_like_entries_choose_as_entry_by_entry():
    rng = np.random.default_rng(5)
    classes, number, size = 6, 9, 500
    table_ = rng.integers(0, 3000, (number, number)).astype(float)
    rows = np.repeat(np.arange(size), rng.integers(1, 7, size))
    at, times = rng.integers(0, 2 * number, len(rows)), rng.integers(1, 400, len(rows)) ** (rng.random(len(rows)) < 0.5)
    own, n = rng.integers(0, number, size), np.bincount(rows, times, size).astype(np.int64)
    xlogx = class_lm._xlogx
    for word, best in enumerate(best_classes(own, n, rows, at, times, table_, classes)):
        gains = []
        for to in range(classes):
            gain = 0.0
            for place, count in zip(at[rows == word], times[rows == word]):
                cell = table_[place, to] if place < number else table_[to, place - number]
                cell = max(cell - count, 0) if own[word] == to else cell
                gain += xlogx(cell + count) - xlogx(cell)
            for total in (table_.sum(axis=1)[to], table_.sum(axis=0)[to]):
                total -= n[word] if own[word] == to else 0
                gain -= xlogx(total + n[word]) - xlogx(total)
            gains.append(gain)
        assert gains[best] >= max(gains) - 1e-6


@pytest.mark.parametrize("head", [1 << 20, 25])
def test_scores_against_brute_force(spark, make_docs, head):
    texts = [(at, " ".join(words(at % 9, 30) + words(at, 6)).title()) for at in range(60)] + [
        (90, None), (91, "never seen words here"), (92, "")]
    docs = make_docs(texts)
    rows = {row.doc_id: row for row in score_texts(docs, head_size=head, clustered=30, classes=8).collect()}
    training = spark.createDataFrame([(text,) for key, text in texts if zlib.crc32(str(key).encode()) % 10], "text string")
    model, known = fit(training, word_counts(training).cache(), head, 30, 8)
    facts = {row["word"]: (row["class"], row["n"]) for row in known.collect()}
    size, end = model.class_size, 8 + ENDINGS
    for (key, text), (found, ending) in zip(texts, token_rows(text for _, text in texts)):
        before, score = end, 0.0
        for word, last in zip(found, ending):
            own, n = facts.get(signed(word), (8 + last, 0))
            score += model.log_transition[before, own] + (math.log10(n / size[own]) if n else 0.0)
            before = own
        assert math.isclose(rows[key].score, score, abs_tol=1e-6)


def test_a_slice_sends_a_row_a_bucket_and_not_a_row_a_word(spark, monkeypatch):
    rows, write = [], class_lm.materialise

    def counting(frame, label):
        out = write(frame, label)
        if label == "beside":
            rows.append(out.count())
        return out

    monkeypatch.setattr(class_lm, "materialise", counting)
    texts = spark.createDataFrame([(" ".join(f"w{word}" for word in range(6000)),)], "text string").coalesce(1)
    known = word_counts(texts).selectExpr("word", "ending", "n", "3 as class", "false as hot")
    seen = contexts(texts, known, 20, 3, 1 << 20, 10)
    assert seen.count() == 6001
    assert 0 < rows[0] <= 3 * 256


def test_broadcasts_are_given_back(spark, make_docs):
    import os
    folder = spark.sparkContext._temp_dir
    docs = make_docs([(at, " ".join(words(at, 30))) for at in range(20)])
    there = set(os.listdir(folder))
    assert score_texts(docs, clustered=8, classes=4).count() == 20
    assert set(os.listdir(folder)) <= there


def entries_of(parts):
    out = Counter()
    for names, sizes, at, times in parts:
        for word, place, count in zip(np.repeat(names, sizes).tolist(), at.tolist(), times.tolist()):
            out[word, place] += count
    return out


def test_blocks_hold_counts_of_any_size():
    import pyarrow as pa
    rng = np.random.default_rng(8)
    names = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2))
    want, blocks = Counter(), []
    for most in (200, 60_000, 1 << 30, 1 << 40):
        keys = np.unique((rng.integers(0, len(names), 900) << 8) + rng.integers(0, 194, 900))
        times = rng.integers(1, most, len(keys))
        want.update({(int(names[key >> 8]), int(key & 255)): int(n) for key, n in zip(keys, times)})
        blocks.append(class_lm._packed(keys, times, names, 3))
        assert blocks[-1].num_rows == 8
    blocks = pa.Table.from_batches(blocks).combine_chunks().to_batches()[0]
    opened = class_lm._opened(blocks)
    assert entries_of([opened]) == want
    added = class_lm._added_blocks([opened, class_lm._opened(blocks.slice(8, 8))])
    again = Counter(want)
    again.update(entries_of([class_lm._opened(blocks.slice(8, 8))]))
    assert entries_of([added]) == again and (np.diff(added[0].astype(float)) > 0).all()
    assert entries_of([class_lm._opened(blocks.slice(0, 0))]) == {}


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_words_that_are_everywhere_are_added_up_as_they_come(monkeypatch, held):
    """Counted slice by slice and given out early, then merged in parts: the same counts."""
    import pyarrow as pa
    from types import SimpleNamespace
    monkeypatch.setattr(class_lm, "HELD_KEYS", held)
    monkeypatch.setattr(class_lm, "CONTEXT_SLICE", 300)
    texts = [" ".join(words(at % 9, 30) + words(at, 6)) for at in range(40)]
    found = [np.array(token, np.uint64) for token, _ in token_rows(texts)]
    distinct, n = np.unique(np.concatenate(found), return_counts=True)
    own = (distinct % np.uint64(5)).astype(np.int64)
    end = int(own[distinct == class_lm.END][0])
    of = dict(zip(distinct.tolist(), own.tolist()))
    beside = class_lm.Beside(class_lm.Lookup(distinct, np.arange(len(distinct), dtype=np.int32)), distinct, own, end, 20, 4)
    blocks = list(class_lm._count_beside(SimpleNamespace(value=beside), 2)(
        iter([pa.RecordBatch.from_pydict({"text": texts[:25]}), pa.RecordBatch.from_pydict({"text": texts[25:]})])))
    want = Counter()
    for token in found:
        token = token.tolist()
        for before, word in zip([int(class_lm.END), *token[:-1]], token):
            want[word, of[before]] += 1
            want[before, 20 + of[word]] += 1
    rows = pa.concat_tables([pa.Table.from_batches(blocks), pa.table({
        "bucket": (distinct >> np.uint64(62)).astype(np.int32), "word": distinct.view(np.int64),
        "ending": np.zeros(len(n), np.int32), "n": n, "class": own.astype(np.int32), "hot": np.zeros(len(n), bool)})],
        promote_options="default").sort_by("bucket")
    seen = pa.Table.from_batches(class_lm._merge_blocks(iter(rows.to_batches(max_chunksize=7)))).combine_chunks().to_batches()[0]
    word = seen.column("word").to_numpy().view(np.uint64)
    got = Counter({(int(word[row]), int(place)): int(times) for row, place, times in zip(*_entries(seen))})
    assert got == want and sorted(word.tolist()) == distinct.tolist()
    assert dict(zip(word.tolist(), seen.column("n").to_pylist())) == dict(zip(distinct.tolist(), n.tolist()))


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_words_beside_a_rarer_one_are_counted_part_by_part(monkeypatch, held):
    import pyarrow as pa
    monkeypatch.setattr(class_lm, "HELD_KEYS", held)
    rng = np.random.default_rng(9)
    names = np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2))
    own = rng.integers(0, 20, len(names)).astype(np.int32)
    beside, of, side = (rng.integers(0, size, 500) for size in (len(names), len(names), 2))
    begin = np.arange(0, 501, 5)
    beside.sort()
    bucket = (names >> np.uint64(62)).astype(np.int32)
    same = bucket[beside[begin[:-1]]] == bucket[beside[begin[1:] - 1]]  # a block is of one bucket
    kept = np.repeat(same, 5)
    blocks = pa.table({"bucket": bucket[beside[begin[:-1]]], "words": class_lm._binary(names[beside], begin),
                       "at": class_lm._binary(side.astype(np.uint8), begin), "times": class_lm._binary(names[of], begin)})
    facts = pa.table({"bucket": bucket, "word": names.view(np.int64), "class": own})
    nulls = pa.table({name: pa.array([], kind) for name, kind in (
        ("sizes", pa.binary()), ("ending", pa.int32()), ("n", pa.int64()), ("hot", pa.bool_()))})
    rows = pa.concat_tables([facts, blocks.filter(pa.array(same)), nulls], promote_options="default")
    rows = rows.take(pa.array(np.argsort(rows.column("bucket").to_numpy(), kind="stable")))
    found = list(class_lm._count_far(20, 2)(iter(rows.to_batches(max_chunksize=3))))
    want = Counter((int(names[word]), int(own[other]) + 20 * int(at))
                   for other, word, at in zip(beside[kept], of[kept], side[kept]))
    assert entries_of([class_lm._opened(part) for part in found]) == want
    assert len(found) == 1 or held == 1
