import random
import re

import numpy as np
import pytest

from palimpsest.llm.components import components, joined_components
from palimpsest.llm.near_dedup import (DEPTH, RARITY_BUCKETS, REGION, keep_one_of_each, near_duplicates, rarest,
                                       region_pairs)

from llm_samples import ODD_ROWS, words


def brute(docs):
    def shingles(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        if not found:
            return frozenset()
        return frozenset(tuple(found[at:at + 5]) for at in range(max(len(found) - 4, 1)))
    sets = {}
    for doc, text in docs:
        sets.setdefault(doc, []).append(shingles(text))
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    known = [(doc, s) for doc, many in sets.items() if doc is not None for s in many if s]
    for at, (a, x) in enumerate(known):
        for b, y in known[at + 1:]:
            if 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(((doc, len(shingles(text)), None if doc is None else find(doc), doc is None or find(doc) == doc)
                   for doc, text in docs), key=str)


def near_copy(base, changes, seed):
    rng, out = random.Random(seed), list(base)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"x{seed}_{at}"
    return " ".join(out)


def sample():
    docs = [(at, " ".join(words(at, 60 + at))) for at in range(10, 40)]
    base = words(1, 150)
    docs += [(100 + at, near_copy(base, at % 4, at)) for at in range(30)]
    docs += [(200 + at, " ".join(words(3, 30)).upper()) for at in range(20)]
    docs += [(300, " ".join(words(9, 40_000))), (299, " ".join([*words(9, 40_000), "end"])), (10, "another text")]
    return docs + ODD_ROWS + [(6, "one"), (7, "ONE  "), (8, "two words"), (9, "two words")]


def test_equals_brute_force(make_docs):
    docs = sample()
    assert sorted(map(tuple, near_duplicates(make_docs(docs)).collect()), key=str) == brute(docs)


def test_many_copies_that_are_alike_only_to_their_source(make_docs):
    base = words(77, 60)
    docs = [(0, " ".join(base))] + [(at, near_copy(base, 1 + at % 2, at)) for at in range(1, 120)]
    docs += [(500 + at, " ".join(words(at, 40))) for at in range(40)]
    got = sorted(map(tuple, near_duplicates(make_docs(docs)).collect()), key=str)
    assert got == brute(docs)


def test_pairs_inside_a_dense_region(make_docs):
    """Documents that share most of a text, not enough to be alike; some have one other like them."""
    common, docs = words(5, 204), []
    for at in range(360):
        own = words(1000 + at, 43)
        docs.append((at, " ".join(common + own)))
        if at % 3 == 0:
            docs.append((1000 + at, " ".join(common + own[:11] + words(5000 + at, 32))))
    got = sorted(map(tuple, near_duplicates(make_docs(docs)).collect()), key=str)
    assert got == brute(docs)
    assert sum(not kept for *_, kept in got) == 120


def test_rarest_shingles_of_alike_sets_meet():
    rng = np.random.default_rng(6)
    weights = rng.integers(0, 3, RARITY_BUCKETS)
    for size in (1, 2, 3, 4, 7, 50, 101):
        one = rng.integers(0, 1 << 62, size).astype(np.uint64)
        for gone in range(size // 4 + 1):
            other = one[rng.permutation(size)][gone:]
            if 100 * len(other) >= 75 * size:
                assert set(rarest(one, weights).tolist()) & set(rarest(other, weights).tolist())


def test_one_of_each_stays(make_docs):
    docs = sample()
    frame = make_docs(docs)
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    stay = {doc for doc, _, _, keep in brute(docs) if keep}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (doc for doc, _ in docs if doc in stay), key=str)


def test_links_at_the_very_threshold(make_docs):
    # 7 words are 3 shingles; 3 of 4 in common is 75 per cent, 2 of 4 is less.
    docs = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "q a b c d e f g h i j k l")]
    assert [tuple(r) for r in near_duplicates(make_docs(docs)).orderBy("doc_id").collect()] == brute(docs)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).collect() == []


@pytest.mark.parametrize("copies", [3, 50])
def test_regions_are_bounded_and_complete(copies):
    rng = np.random.default_rng(copies)
    keys = np.sort(rng.integers(0, 2, (200, 1 + DEPTH)), axis=0)
    keys = keys[np.lexsort(keys.T[::-1])]
    left, right, _ = region_pairs(keys, 0)
    assert len(set(zip(left.tolist(), right.tolist()))) == len(left) <= REGION * len(keys)
    prefix = [(keys[a] != keys[b]).argmax() - 1 if (keys[a] != keys[b]).any() else DEPTH for a, b in zip(left, right)]
    assert min(prefix, default=2) >= 2
    for depth in range(2, DEPTH + 1):  # a small region is compared whole
        _, number, count = np.unique(keys[:, :depth + 1], axis=0, return_inverse=True, return_counts=True)
        pairs = set(zip(left.tolist(), right.tolist()))
        for region in np.flatnonzero(count <= REGION):
            members = np.flatnonzero(number == region)
            assert all((a, b) in pairs for at, a in enumerate(members) for b in members[at + 1:])


def test_components_of_a_chain_and_a_star(spark):
    links = [(at, at + 1) for at in range(60)] + [(100, at) for at in range(101, 160)] + [(7, 7), (159, 158)]
    random.Random(4).shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{at: 0 for at in range(61)}, **{at: 100 for at in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_more_links_join_components(spark):
    found = components(spark.createDataFrame([(1, 2), (2, 3), (10, 11), (20, 21)], "a long, b long"))
    more = spark.createDataFrame([(3, 11), (21, 30), (40, 41), (1, 2), (50, 50)], "lo long, hi long")
    got = dict(map(tuple, joined_components(found, more).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 20: 20, 21: 20, 30: 20, 40: 40, 41: 40}
