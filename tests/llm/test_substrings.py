import hashlib
import re

import pytest

from palimpsest.llm.substrings import remove_repeats, removal_report, repeated_paths

from llm_samples import ODD_ROWS, words


def brute(docs, window):
    tokens = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in docs]
    first = {}
    for doc, found in tokens:
        if doc is not None:
            for at in range(len(found) - window + 1):
                key = tuple(found[at:at + window])
                first[key] = min(first.get(key, (doc, at)), (doc, at))
    out, kept_texts = [], []
    for (doc, text), (_, found) in zip(docs, tokens):
        gone = set()
        if doc is not None:
            for at in range(len(found) - window + 1):
                if (doc, at) > first[tuple(found[at:at + window])]:
                    gone.update(range(at, at + window))
        kept = " ".join(x for at, x in enumerate(found) if at not in gone)
        out.append((doc, len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        kept_texts.append((doc, kept if gone else text))
    return sorted(out, key=str), sorted(kept_texts, key=str)


def sample():
    passage, other = words(1, 70), words(2, 33)
    docs = [(at, " ".join(words(10 + at, 80))) for at in range(12)]
    docs += [(30 + at, " ".join([*words(50 + at, 15 + at), *passage[at:60 + at % 7], *words(90 + at, 12)]))
             for at in range(8)]
    docs += [(50, " ".join(other * 4)), (51, " ".join(other)), (49, " ".join(other[5:] + other[:9])),
             (60, "a b c " * 60), (61, "a b c " * 25), (62, "b c a " * 25), (63, "same " * 45),
             (70, " ".join(words(10, 80))), (71, " ".join(words(10, 80)) + "\n"), (80, " ".join(words(77, 9000))),
             (81, " ".join(words(78, 3) + words(77, 9000)[4000:8000])), (5, " ".join(words(15, 80)))]
    return docs + ODD_ROWS


@pytest.mark.parametrize("window", [20, 8, 27])
def test_report_equals_brute_force(make_docs, window):
    docs = sample()
    got = removal_report(make_docs(docs, 4), window).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, window)[0]


def test_texts(make_docs):
    docs = sample()
    frame = make_docs(docs)
    got = remove_repeats(frame)
    assert got.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute(docs, 20)[1]


def test_paths_are_maximal_and_equal_at_both_places(make_docs):
    docs = [(1, " ".join(words(1, 300))), (2, " ".join([*words(2, 10), *words(1, 300)[50:250], *words(3, 10)]))]
    path, = repeated_paths(make_docs(docs, 1)).collect()
    assert (path.doc_id, path.start, path.stop, path.source, path.source_start) == (2, 10, 210, 1, 50)


def test_no_document_or_none_long_enough(make_docs):
    assert removal_report(make_docs([])).collect() == []
    assert [r.n_removed for r in removal_report(make_docs([(1, "a b"), (2, "a b")])).collect()] == [0, 0]
    with pytest.raises(ValueError):
        repeated_paths(make_docs([(1, "a")]), 5)
