import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm.lookup import Lookup
from palimpsest.llm.words import ALPHANUMERIC, NOT_SPACE, cut, gram_starts, grams, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBz9 .\n\té漢\x00", max_size=30)), max_size=8)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    for table, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = cut(pa.array(texts, pa.string()), table, lower=True)
        got = [[words.text(at).decode() for at in range(low, high)]
               for low, high in zip(words.first[:-1], words.first[1:])]
        assert got == [re.findall(pattern, lowered(text)) for text in texts]


@settings(max_examples=40, deadline=None)
@given(TEXTS, st.integers(1, 21))
def test_grams_are_equal_where_words_are(texts, size):
    words = cut(pa.array([*texts, "a b c d " * 12], pa.string()), NOT_SPACE, lower=False)
    all_words = [words.text(at) for at in range(len(words.hashes))]
    found = grams(words.hashes, size)
    seen = {}
    for at in gram_starts(words, size):
        key = tuple(all_words[at:at + size])
        assert seen.setdefault(key, found[at]) == found[at]
    assert len(set(seen.values())) == len(seen)


def test_a_word_has_one_fingerprint_wherever_it_stands():
    words = cut(pa.array(["x" * 700_000 + " tail", "tail " * 90_000]), NOT_SPACE, lower=False)
    assert len(set(words.hashes[1:].tolist())) == 1 and words.hashes[0] != words.hashes[1]


def test_slices_keep_all_rows_of_sliced_batches():
    batch = pa.record_batch({"text": ["a" * 50, None, "", "b" * 500, "c"]}).slice(1)
    parts = list(slices(batch, "text", 60))
    assert [x for part in parts for x in part.column("text").to_pylist()] == [None, "", "b" * 500, "c"]
    assert len(parts) > 1


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(7))  # low bits collide
    table = Lookup(keys, np.arange(len(keys)))
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert (table.get(keys + np.uint64(1)) == -1).all()
    assert (Lookup(keys[:0], np.zeros(0, np.int64)).get(keys) == -1).all()
