import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palimpsest.llm.language import fit, keep_identified, label_languages, letter_words, training_part, viterbi

SOUNDS = {"en": "the an ing er th on", "fr": "é eau ou le aux çon", "ru": "по не ст ов ра ка"}


def prose(lang, seed, count):
    rng, sounds = random.Random(f"{lang}{seed}"), SOUNDS[lang].split()
    return " ".join("".join(rng.choice(sounds) for _ in range(rng.randrange(1, 4))) for _ in range(count))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(at * 3 + k, prose(lang, at, 40), lang) for at in range(40) for k, lang in enumerate(SOUNDS)]
    return fit(training_part(spark.createDataFrame(rows + [(None, "x", "en"), (1, None, "fr"), (2, "y", None)],
                                                   "doc_id long, text string, lang string")))


def labelled(make_docs, model, rows):
    frame = make_docs(rows)
    return {(r.doc_id, r.lang_pred, round(r.score, 3), tuple(map(tuple, r.spans)))
            for r in label_languages(frame, model).collect()}


def test_odd_texts(make_docs, model):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (None, prose("fr", 900, 9)), (5, "漢字"), (5, "漢字")]
    got = {x[0]: x[1:] for x in labelled(make_docs, model, rows)}
    assert got[1] == got[2] == got[3] == ("und", 0.0, ())
    assert got[None][0] == "fr" and got[5][0] in SOUNDS
    kept = keep_identified(make_docs(rows), model)
    assert kept.columns == make_docs(rows).columns and [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 5, 5]


def test_mixed_text_is_cut_into_spans(make_docs, model):
    parts = [prose("en", 901, 30), prose("fr", 902, 50), prose("ru", 903, 10)]
    (_, lang, _, spans), = labelled(make_docs, model, [(1, ". ".join(parts))])
    assert lang == "fr" and [x[2] for x in spans] == ["en", "fr", "ru"]
    text = ". ".join(parts)
    # The first words of a part may be words of either language.
    assert abs(spans[1][0] - len(parts[0])) < 25 and text[spans[2][0]:spans[2][1]] == parts[2]


def test_every_language_is_learned(spark, make_docs):
    def text(lang, seed):
        rng = random.Random(seed)
        return " ".join("".join(chr(97 + int(x)) for x in f"{lang:04}") + rng.choice("xyz") for _ in range(30))
    rows = [(at, text(at % 300, at), f"l{at % 300:03}") for at in range(600)]
    many = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(many.names) == 300 and many.scores.size <= 1 << 25
    got = {x[0]: x[1] for x in labelled(make_docs, many, [(at, text(at, 5000 + at)) for at in range(300)])}
    assert sum(got[at] == f"l{at:03}" for at in range(300)) >= 295


def test_script_alone_decides(make_docs, model):
    assert {x[1] for x in labelled(make_docs, model, [(1, "щъ"), (2, "ЖЮЫ")])} == {"ru"}


def test_held_out_texts_and_a_very_long_one(make_docs, model):
    rows = [(at, prose(lang, 500 + at, 12)) for at, lang in enumerate(list(SOUNDS) * 10)]
    rows += [(100, prose("en", 999, 60_000))]
    got = {x[0]: x[1] for x in labelled(make_docs, model, rows)}
    assert got.pop(100) == "en"
    assert np.mean([got[at] == lang for at, lang in enumerate(list(SOUNDS) * 10)]) > 0.95


def test_nothing_learned(spark, make_docs):
    empty = fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert labelled(make_docs, empty, [(1, "text"), (2, None)]) == {(1, "und", 0.0, ()), (2, "und", 0.0, ())}
    assert label_languages(make_docs([]), empty).collect() == []


def brute_viterbi(scores, penalty):
    best = None
    for path in np.ndindex(*([scores.shape[1]] * len(scores))):
        value = sum(scores[at, x] for at, x in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        best = max(best or (value, path), (value, path), key=lambda x: x[0])
    return best


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 0, 6, 1, 5])
    scores = rng.normal(size=(lengths.sum(), 3))
    labels = viterbi(scores, lengths, 0.8)
    begin = np.cumsum(lengths) - lengths
    for low, size in zip(begin, lengths):
        if size:
            assert tuple(labels[low:low + size]) == brute_viterbi(scores[low:low + size], 0.8)[1]


def test_words_are_runs_of_letters():
    words = letter_words(pa.array(["Été 1st", None, "x—y", ""]))
    assert words.text.tolist() == [0, 0, 2, 2]
    assert words.starts.tolist() == [0, 5, 0, 2] and words.stops.tolist() == [3, 7, 1, 3]
