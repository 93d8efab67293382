import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from palimpsest.llm.packing import Windows, end_to_end, pack, padding, with_checksum
from palimpsest.llm.queries import QUERIES


MODEL = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain_ids(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, length):
    """Every id of every document stands in one piece, and every sequence is gapless."""
    docs, sequences = {}, {}
    for row in rows:
        docs.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append(row)
    assert docs.keys() == texts.keys()
    for key, pieces in docs.items():
        pieces.sort(key=lambda row: row.start)
        want = plain_ids(texts[key])
        assert [x for row in pieces for x in row.ids] == want
        assert all(row.doc_tokens == len(want) and row.length == len(row.ids) for row in pieces)
        assert [row.start for row in pieces] == [0, *np.cumsum([row.length for row in pieces])[:-1]]
    pads = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda row: row.offset)
        total = sum(row.length for row in pieces)
        assert [row.offset for row in pieces] == [0, *np.cumsum([row.length for row in pieces])[:-1]]
        assert total <= length
        pads += 0 if total.bit_count() == 1 else length - total
    return pads, len(sequences)


TEXTS = ["a b", "", None, "  \t\n ", "x" * 3000, "Ünïcode 漢字 ﬁ é <|endoftext|> it's", "word " * 5000,
         "a<|endoftext|>. don't! x's. ab<c>, ÿŸ. µ. 1a; re've... ÉÀß", "ΑΣ ὈΔΥΣΣΕΎΣ x y\u0085z᠎ w\x1cq"]


@pytest.mark.parametrize("length,windows,least", [(2048, 32, 16), (64, 4, 8), (16, 1, 1)])
def test_ids_are_those_of_the_tokenizer_and_pads_are_few(make_docs, length, windows, least):
    rng = random.Random(length)
    words = [f"{rng.choice('abcdef')}{rng.randrange(40)}" for _ in range(300)]
    texts = dict(enumerate(TEXTS + [" ".join(rng.choices(words, k=rng.randrange(1, 90))) for _ in range(120)]))
    packed = pack(make_docs(list(texts.items()), 5), length=length, open_windows=windows, least_cut=least)
    rows = packed.collect()
    pads, sequences = check(rows, texts, length)
    assert pads <= 2 * least * sequences
    measured = padding(packed, length).first()
    assert (measured.pads, measured.sequences) == (pads, sequences)
    assert measured.tokens == sum(len(plain_ids(text)) for text in texts.values())


def test_best_fit_then_fullest(spark):
    closed = []
    windows = Windows(10, 2, 2, lambda number, pieces: closed.append([(key, len(ids)) for key, _, ids, _ in pieces]))
    for key, size in enumerate([6, 7, 3, 3, 5]):
        windows.add(key, np.zeros(size, np.int32), 0, size)
    # 6 | 7; 3 fills the window of 7; 3 joins 6; 5 goes into an empty window.
    assert closed == [[(1, 7), (2, 3)]]
    assert [[(key, len(ids)) for key, _, ids, _ in pieces] for _, pieces in windows.left()] == [[(0, 6), (3, 3)], [(4, 5)]]
    windows.add(5, np.zeros(8, np.int32), 0, 8)  # no room; the fullest has too little for a cut
    assert closed[1:] == [[(0, 6), (3, 3)]]


def test_rest_is_cut_to_powers_of_two():
    pieces = [(0, 0, np.arange(13), 13), (1, 4, np.arange(10), 14)]
    cut = list(end_to_end(pieces, 8))
    assert [sum(len(ids) for _, _, ids, _ in sequence) for sequence in cut] == [8, 8, 4, 2, 1]
    assert [(key, start) for sequence in cut for key, start, _, _ in sequence] == [
        (0, 0), (0, 8), (1, 4), (1, 7), (1, 11), (1, 13)]
    assert list(end_to_end([], 8)) == []


def test_repeated_keys_nulls_and_no_rows(make_docs, spark):
    assert pack(make_docs([])).collect() == []
    rows = pack(make_docs([(None, "a b c"), (None, "a b c"), (3, None)]), length=4, open_windows=2, least_cut=1).collect()
    assert sum(row.length for row in rows if row.doc_id is None) == 8
    assert [(row.ids, row.doc_tokens) for row in rows if row.doc_id == 3] == [([1], 1)]


def test_query_on_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    pads, sequences = check(pack(docs).collect(), texts, 2048)
    assert pads < 0.01 * 2048 * sequences
    rows = QUERIES["op11_packing"](spark, sf).collect()
    assert {row.doc_id for row in rows} == texts.keys()
    for row in rows:
        ids = plain_ids(texts[row.doc_id])[row.start:row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
