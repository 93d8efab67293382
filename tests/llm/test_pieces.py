import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm.pieces import Trie, decode, decode_pieces, encode, encode_texts, lattice, load_vocabulary, sample

from llm_samples import ODD_ROWS, words

VOCABULARY = load_vocabulary()
TRIE = Trie(VOCABULARY, 0.5)


def pieces_of(texts, seed=0):
    keys = np.arange(len(texts)).astype(np.uint64) + np.uint64(seed)
    return encode_texts(pa.array(texts, pa.string()), keys, TRIE)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet=" \n\t▁aé漢\U0001f600", max_size=20)),
                max_size=6), st.integers(0, 5))
def test_decoding_gives_every_text_back(texts, seed):
    pieces, begin = pieces_of(texts, seed)
    lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(pieces))
    assert decode_pieces(lists, VOCABULARY).to_pylist() == [text or "" for text in texts]


def all_ways(text):
    known = {piece: number for number, piece in VOCABULARY.pieces}
    ends = [at for at in range(len(text) + 1) if at == len(text) or text[at] & 0xC0 != 0x80]
    ways = {0: [((), 1.0)]}
    for high in ends[1:]:
        ways[high] = [(way + (known[text[low:high]],), weight * np.exp(TRIE.weight[known[text[low:high]]]))
                      for low in ends if low < high and text[low:high] in known for way, weight in ways[low]]
    return dict(ways[len(text)])


def test_samples_follow_the_lattice():
    text = b" then"
    ways = all_ways(text)
    total = sum(ways.values())
    found = lattice(np.frombuffer(text, np.uint8), np.array([0, len(text)]), TRIE)
    size = 40_000
    pieces, counts = sample(found, np.zeros(size, np.int64), np.arange(size).astype(np.uint64) * np.uint64(0x9E3779B9))
    ends = np.cumsum(counts)
    drawn = {}
    for low, high in zip(ends - counts, ends):
        drawn[tuple(pieces[low:high].tolist())] = drawn.get(tuple(pieces[low:high].tolist()), 0) + 1
    assert set(drawn) <= set(ways)
    for way, weight in ways.items():
        expected = size * weight / total
        assert abs(drawn.get(way, 0) - expected) < 6 * np.sqrt(expected) + 3


def test_batches_do_not_matter():
    texts = [" ".join(words(at, 50)) for at in range(20)]
    keys = np.arange(20).astype(np.uint64)
    whole, begin = encode_texts(pa.array(texts), keys, TRIE)
    for at in range(20):
        alone, _ = encode_texts(pa.array([texts[at]]), keys[at:at + 1], TRIE)
        assert alone.tolist() == whole[begin[at]:begin[at + 1]].tolist()


def test_one_very_long_stretch():
    text = "abcé" * 20_000
    pieces, begin = pieces_of([text])
    assert decode_pieces(pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(pieces)),
                         VOCABULARY).to_pylist() == [text]


def test_rows(make_docs):
    docs = ODD_ROWS + [(at, "then another international government " * 4) for at in range(10, 30)]
    frame = make_docs(docs)
    first, again = ({(r.doc_id, r.text_key, tuple(r.pieces or ["null"])) for r in encode(x).collect()}
                    for x in (frame, make_docs(docs, 1)))
    assert first == again
    other = {(r.doc_id, r.text_key, tuple(r.pieces or ["null"])) for r in encode(frame, seed=2).collect()}
    assert len(first & other) < len(first) - 15
    back = decode(encode(frame).withColumn("extra", F.lit("x")))
    assert back.columns == ["doc_id", "text_key", "extra", "decoded"]
    assert sorted(((r.doc_id, r.decoded) for r in back.collect()), key=str) == sorted(docs, key=str)
    checked = encode(frame, decode_again=True).collect()
    assert all(r.lossless for r in checked) and {(r.doc_id, r.text_key, tuple(r.pieces or ["null"])) for r in checked} == first
    assert encode(make_docs([])).collect() == [] and decode(encode(make_docs([]))).collect() == []


def test_a_vocabulary_that_cannot_spell_is_refused(monkeypatch):
    class Small:
        def __init__(self, model_file):
            pass
        vocab_size = staticmethod(lambda: 2)
        id_to_piece = staticmethod(lambda at: "ab"[at])
        is_byte = is_control = is_unknown = is_unused = staticmethod(lambda at: False)
    monkeypatch.setattr("sentencepiece.SentencePieceProcessor", Small)
    with pytest.raises(ValueError):
        load_vocabulary("none")


