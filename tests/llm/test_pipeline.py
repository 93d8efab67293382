import pytest

import corpus_pipeline
from palimpsest.llm.pieces import decode

from llm_samples import ODD_ROWS, words
from test_decontaminate import brute as leaks
from test_near_dedup import brute as near
from test_near_dedup import near_copy
from test_substrings import brute as substrings

BENCH = [(1, " ".join(words(900, 25))), (2, "tiny item"), (3, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample():
    base, passage = words(1, 90), words(2, 60)
    docs = [(at, " ".join(words(at, 50 + at))) for at in range(10, 25)]
    docs += [(100 + at, near_copy(base, at % 3, at)) for at in range(8)]
    docs += [(200 + at, " ".join([*words(60 + at, 20), *passage, *words(80 + at, 15)])) for at in range(4)]
    docs += [(300, " ".join([*words(40, 15), *words(900, 25)[5:18], *words(41, 12)])), (301, "a Tiny, item here"),
             (302, " ".join(passage)), (303, "12 345 --- 6")]
    return docs + ODD_ROWS


def expected(docs):
    docs = [(key, text) for key, text in docs if any(c.isalpha() for c in text or "")]
    yield docs
    stay = {(key, keep) for key, _, _, keep in near(docs)}
    docs = [(key, text) for key, text in docs if (key, True) in stay]
    yield docs
    docs = [(key, text) for key, text in substrings(docs, 20)[1] if text]
    yield docs
    dirty = {row[0] for row in leaks(docs, BENCH) if row[5]}
    yield [(key, text) for key, text in docs if key not in dirty]


@pytest.fixture()
def tables(spark, tmp_path):
    rows = [(key, text, "en", "s", None if text is None else len(text)) for key, text in sample()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_and_run_equal_brute_force(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "repeated_spans", "decontamination", "pieces"]
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, expected(sample())):
        stage(spark, docs, tables).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        rows = docs.collect()
        assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(wanted, key=str), name
        assert all(r.n_chars == len(r.text) and r.lang == "en" for r in rows)
    decoded = decode(corpus_pipeline.run(spark, tables))
    assert sorted(((r.doc_id, r.decoded) for r in decoded.collect()), key=str) == sorted(wanted, key=str)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_columns_with_clashing_names_pass_through(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").selectExpr(
        "*", "1 as kept", "'x' as lang_pred", "array(1) as spans", "2 as component_id", "3 as n_words")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns
        assert stage(spark, docs, tables).where("spans = array(1) and component_id = 2 and n_words = 3").count() > 10
