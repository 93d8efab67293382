import hashlib
import re

from palimpsest.llm.decontaminate import cut_leaks, drop_leaking, find_leaks, leak_report

from llm_samples import ODD_ROWS, words

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(docs, bench):
    def tokens(text):
        return PATTERN.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    windows = {}
    for item, text in bench:
        found = tokens(text)
        for at in range(max(len(found) - 10, 0) + 1 if found else 0):
            windows.setdefault(tuple(found[at:at + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        found, hit, ids = tokens(text), set(), set()
        for window, owners in windows.items():
            for at in range(len(found) - len(window) + 1):
                if tuple(found[at:at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    ids |= owners
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((doc, len(found), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


def sample():
    bench = [(1, " ".join(words(1, 25))), (2, " ".join(words(2, 10))), (10, "short one"), (11, "SHORT, one!"),
             (3, None), (4, ""), (5, "..."), (None, "nobody owns this"), (2, " ".join(words(2, 10)))]
    docs = [(at, " ".join(words(100 + at, 40))) for at in range(12)]
    docs += [(20, " ".join(words(5, 8) + words(1, 25)[3:17] + words(6, 9))),
             (21, "Before. " + " - ".join(words(2, 10)).upper() + " after"), (22, "a short one, a Short: one"),
             (23, "nobody owns this"), (24, " ".join(words(1, 25)[:9])), (25, " ".join(words(7, 30_000))),
             (21, "the other text of an id")]
    return docs + ODD_ROWS, bench


def test_report_equals_brute_force_in_one_block_or_many(spark, make_docs):
    docs, bench = sample()
    for rows in (500_000, 7):
        got = leak_report(find_leaks(make_docs(docs), items(spark, bench), block_rows=rows)).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, bench)


def test_dropping_keeps_clean_rows_as_they_are(spark, make_docs):
    docs, bench = sample()
    dirty = {x[0] for x in brute(docs, bench) if x[5]} - {21}
    for rows in (500_000, 7):
        frame = make_docs(docs)
        kept = drop_leaking(frame, items(spark, bench), block_rows=rows)
        assert kept.columns == frame.columns
        expected = [x for x in docs if x[0] not in dirty and not (x[0] == 21 and "Before" in x[1])]
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_cutting_removes_only_hit_words(spark, make_docs):
    docs, bench = sample()
    frame = make_docs(docs)
    for rows in (500_000, 7):
        got = cut_leaks(frame, items(spark, bench), block_rows=rows)
        assert got.columns == frame.columns and got.count() == len(docs)
        text = {r.doc_id: r.text for r in got.collect() if r.doc_id in (20, 22, 23)}
        assert text[20] == " ".join(words(5, 8)) + "  " + " ".join(words(6, 9))
        assert text[22] == "a , a " and text[23] == ""
        assert brute([(1, text[20])], bench)[0][2] == 0


def test_empty_tables(spark, make_docs):
    docs, bench = sample()
    assert leak_report(find_leaks(make_docs([]), items(spark, bench))).collect() == []
    assert not any(r.contaminated for r in leak_report(find_leaks(make_docs(docs), items(spark, []))).collect())
    assert drop_leaking(make_docs(docs), items(spark, [])).count() == len(docs)


def test_one_block_is_held_at_a_time(spark, make_docs, monkeypatch):
    from pyspark import Broadcast
    from palimpsest.llm.decontaminate import Lookup
    held, most = [], []

    def broadcast(value):
        made = plain(value)
        if isinstance(value, Lookup) and value.texts:
            held.append(made)
            most.append(len(held))
        return made

    def destroy(self, blocking=False):
        held.remove(self)
        return plain_destroy(self, blocking)

    plain, plain_destroy = spark.sparkContext.broadcast, Broadcast.destroy
    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    items = [(at, " ".join(words(500 + at, 14))) for at in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(at, " ".join(words(at, 20) + (words(500 + at, 14) if at % 3 == 0 else []))) for at in range(12)])
    whole = sorted(map(tuple, leak_report(find_leaks(docs, benchmark)).collect()))
    assert len(held) == 1
    held.clear(), most.clear()
    assert sorted(map(tuple, leak_report(find_leaks(docs, benchmark, block_rows=7)).collect())) == whole
    assert len(most) > 5 and max(most) == 1 and not held
    most.clear()
    assert {row.doc_id for row in drop_leaking(docs, benchmark, block_rows=7).collect()} == {
        at for at in range(12) if at % 3}
    assert max(most) == 1 and len(held) == 1
