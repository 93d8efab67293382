import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from palimpsest.llm import alignment
from palimpsest.llm.alignment import BYTE_LEVEL, PIECES, align, align_texts, divide, stored_bytes, stretches_of
from palimpsest.llm.queries import QUERIES

A = Tokenizer.from_file(public_tokenizers.path(BYTE_LEVEL))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
STANDS_FOR = stored_bytes()


def plain(text):
    """Tokens of both sides with their byte ranges, found without any splitting of the text."""
    if not text:
        return [], []
    a = [(x, bytes(STANDS_FOR[c] for c in A.id_to_token(x))) for x in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(x, bytes([int(B.id_to_piece(x)[3:5], 16)]) if B.is_byte(x) else B.id_to_piece(x).replace("▁", " ").encode())
         for x in B.encode(text)]
    if any(b"".join(spelt for _, spelt in side) != (" " + text).encode() for side in (a, b)):
        return [], []
    out = []
    for side in (a, b):
        ends = np.cumsum([len(spelt) for _, spelt in side])
        out.append([(x, int(end) - len(spelt), int(end)) for (x, spelt), end in zip(side, ends)])
    return out[0], out[1]


def plain_rows(texts):
    found = [(key, *plain(text)) for key, text in texts]
    links = [[(x, y) for x, low, high in a for y, begin, end in b if low < end and begin < high] for _, a, b in found]
    counts = Counter(pair for one in links for pair in one)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    rows = []
    for (key, a, b), one in zip(found, links):
        cuts = sorted({end for *_, end in a} & {end for *_, end in b})
        groups = [(",".join(str(x) for x, _, end in a if low < end <= high) + "|"
                   + ",".join(str(y) for y, _, end in b if low < end <= high)) for low, high in zip([0, *cuts], cuts)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((key, len(a), len(b), len(groups), len(one), sum(counts[pair] == best[pair[1]] for pair in one),
                     sum(counts[pair] for pair in one), digest))
    return rows


NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
ODD = ["", None, " ", "  ", " a", "a ", "a  b", "a b ", "x▁y plain", "<|endoftext|> </s> <0x41>", "tab\there \n\n new  \n line",
       "naïve café über 漢字かな 🙂🙂   　 é", "it's we'll DON'T 'S", "a\u0085 b   c  d", "z" * 3000,
       "\x00 nul \x01\x7f b", "é ñ ​ x", "1234567 89.0 -- !!! ??", "漢字" * 400, "!" * 700 + " a" * 50]


def sorted_rows(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def test_odd_texts_against_brute_force(make_docs):
    rng = random.Random(7)
    letters = "abc  \n'sé漢\t.1▁🙂"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "a b c"), (3, "a b c"), (3, "a b c")]
    documents, counts = align(make_docs(rows, 4))
    assert sorted_rows(documents.select(NAMES).collect()) == sorted_rows(plain_rows(rows))
    assert documents.columns == NAMES
    total = sum(row.links for row in counts.collect())
    assert total == sum(row[4] for row in plain_rows(rows))


def test_pairs_of_several_slices_are_counted_together(make_docs, monkeypatch):
    rows = [(at, f"the common word {at % 7} stands here") for at in range(40)]
    documents, counts = align(make_docs(rows, 6))
    assert sorted_rows(documents.collect()) == sorted_rows(plain_rows(rows))
    assert counts.count() == counts.select("a", "b").distinct().count()


def test_no_documents(make_docs):
    documents, counts = align(make_docs([]))
    assert documents.collect() == [] and counts.collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_divide_finds_all_shared_cuts(seed):
    """Also where cuts are so rare that whole intervals must be looked through."""
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 400))
    ends = np.unique(np.r_[rng.integers(1, 4000, size), 4000])
    others = np.unique(np.r_[rng.integers(1, 4000, size), rng.choice(ends, min(len(ends), 5)), 4000])
    middle = int(rng.choice(np.intersect1d(ends, others)))
    at = int(np.searchsorted(ends, middle)) + 1
    last = divide(np.array([0, at]), np.array([at, len(ends)]), ends, others)
    assert ends[last].tolist() == np.intersect1d(ends, others).tolist()


def test_intervals_without_cuts_are_groups():
    found = align_texts(pa.array(["漢字 naïve"]), stretches_of(
        public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)))
    a, b = plain("漢字 naïve")
    assert (found.ids[0].tolist(), found.ids[1].tolist()) == ([x for x, *_ in a], [y for y, *_ in b])


def test_query_on_all_documents(spark, sf):
    texts = [(row.doc_id, row.text) for row in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    # The plain links compare all pairs of a text, so long texts are kept whole but compared by sweep.
    rows = {row[0]: row for row in fast_rows(texts)}
    got = QUERIES["op13_tokenizer_alignment"](spark, sf).select(NAMES).collect()
    assert sorted_rows(got) == sorted_rows(rows.values())
    assert alignment.SLICE == 4 << 20


def fast_rows(texts):
    """``plain_rows`` with links from one sweep over both sides."""
    found = [(key, *plain(text)) for key, text in texts]
    links = []
    for _, a, b in found:
        one, at = [], 0
        for x, low, high in a:
            while b[at][2] <= low:
                at += 1
            ahead = at
            while ahead < len(b) and b[ahead][1] < high:
                one.append((x, b[ahead][0]))
                ahead += 1
        links.append(one)
    counts = Counter(pair for one in links for pair in one)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    for (key, a, b), one in zip(found, links):
        cut = {end for *_, end in a} & {end for *_, end in b}
        texts_a, texts_b = [], []
        for tokens, out in ((a, texts_a), (b, texts_b)):
            group = []
            for x, _, end in tokens:
                group.append(str(x))
                if end in cut:
                    out.append(",".join(group))
                    group = []
        digest = hashlib.sha256(";".join(f"{x}|{y}" for x, y in zip(texts_a, texts_b)).encode()).hexdigest() if texts_a else ""
        yield (key, len(a), len(b), len(texts_a), len(one), sum(counts[pair] == best[pair[1]] for pair in one),
               sum(counts[pair] for pair in one), digest)
