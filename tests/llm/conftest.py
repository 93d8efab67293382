import pytest

from palimpsest.llm.registry import ship_package


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use for results."""
    def make(rows, slices=3):
        frame = spark.createDataFrame(
            [(key, text, "en", "s", 7, True, 1, [1]) for key, text in rows],
            "doc_id long, text string, lang string, source string, kept long, held_out boolean, "
            "component_id long, spans array<int>")
        return frame.repartition(slices) if rows else frame
    return make
