import os
import shutil

import pytest
from pyspark.sql import functions as F
from row_text import rows

from palimpsest.operators.live import search_place
from palimpsest.operators.postings import build_index, grams_of, matching_texts, search

PLACES = ["12 km S of Purén, Chile", "Purification Bay", "near Tonga", "TONGA region", None, "", "ab", "a", "Ab initio",
          "northern Ñandú", "purple purple", "rup", "100% p_r"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    data = [(at, PLACES[at % len(PLACES)], at % 3) for at in range(200)] + [(1000 + at, "hot place", 0) for at in range(300)]
    frame = spark.createDataFrame(data, "id int, place string, folder_of int").repartition(3)
    return frame, build_index(frame, "place", f"{tmp_path_factory.mktemp('places')}/index", 32, 8)


@pytest.mark.parametrize("text", ["pur", "  PUR ", "tonga", "ñan", "", "   ", "a", "ab", "purx", "purple p", "hot place", "% p_", "é"])
def test_equals_a_scan(index, text):
    frame, made = index
    found = search(made, text)
    assert found.columns == frame.columns and rows(found) == rows(search_place(frame, text))


def test_only_folders_of_matching_texts_are_read(index, tmp_path):
    frame, made = index
    expected = rows(search_place(frame, "tonga"))
    wanted = {row.folder for row in matching_texts(made, "tonga").collect()}
    assert 0 < len(wanted) <= 2
    for kind, keep in (("rows", {f"folder={at}" for at in wanted}), ("postings", None)):
        if keep is not None:
            for name in os.listdir(f"{made.path}/{kind}"):
                if name.startswith("folder=") and name not in keep:
                    shutil.move(f"{made.path}/{kind}/{name}", f"{tmp_path}/{name}")
    try:
        found = search(made, "tonga")
        assert rows(found) == expected
        assert "PartitionFilters: [folder" in found._jdf.queryExecution().executedPlan().toString().replace(
            "isnotnull(folder", "folder")
    finally:
        for name in os.listdir(tmp_path):
            shutil.move(f"{tmp_path}/{name}", f"{made.path}/rows/{name}")


def test_one_posting_a_text_and_trigram(index):
    frame, made = index
    hot = made.postings.where("text = 'hot place'")
    assert hot.count() == len(grams_of("hot place")) == hot.select("gram").distinct().count()
    assert made.postings.where(F.length("gram") != 3).count() == 0


def test_no_rows(spark, tmp_path):
    made = build_index(spark.createDataFrame([], "place string"), "place", f"{tmp_path}/index", 4, 4)
    assert search(made, "pur").collect() == [] and search(made, "").collect() == []
