"""Substring search by posting lists of trigrams.

Rows are stored in folders by a hash of their text. A posting says that a text of some folder holds a
trigram; there is one for each distinct text, not for each row, so a text that a third of all rows
share has few. A search reads the shelves of its own trigrams, keeps the texts that have all of them
and truly hold the searched text, and reads the rows of their folders alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

GRAM = 3
FOLDERS, SHELVES = 1024, 256
FOLDER, SHELF = "folder", "shelf"


@dataclass(frozen=True)
class SearchIndex:
    """Where rows and postings lie."""

    spark: SparkSession
    path: str
    column: str
    schema: StructType
    folders: int
    shelves: int

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields]).add(FOLDER, IntegerType())).parquet(f"{self.path}/rows")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.schema(f"gram string, text string, folder int, {SHELF} int").parquet(f"{self.path}/postings")

    def number(self, value, of: int):
        return F.pmod(F.xxhash64(value), F.lit(of)).cast("int")


def build_index(frame: DataFrame, column: str, path: str, folders: int = FOLDERS, shelves: int = SHELVES) -> SearchIndex:
    """Write rows by folder and postings by shelf. Rows without text are kept, and found by a blank
    search only."""
    index = SearchIndex(frame.sparkSession, path, column, frame.schema, folders, shelves)
    text = F.lower(F.coalesce(column, F.lit("")))
    # Rows of one text may fill several files of their folder: nothing is gathered by it.
    frame.withColumn(FOLDER, index.number(text, folders)).write.partitionBy(FOLDER).parquet(f"{path}/rows")
    texts = frame.select(text.alias("text")).distinct().where(F.length("text") >= GRAM)
    grams = F.transform(F.sequence(F.lit(1), F.length("text") - (GRAM - 1)), lambda at: F.substring("text", at, F.lit(GRAM)))
    postings = texts.select(F.explode(F.array_distinct(grams)).alias("gram"), "text",
                            index.number(F.col("text"), folders).alias(FOLDER)).withColumn(
        SHELF, index.number(F.col("gram"), shelves))
    postings.repartition(SHELF, F.pmod(F.xxhash64("text"), F.lit(8))).write.partitionBy(SHELF).parquet(f"{path}/postings")
    return index


def grams_of(needle: str) -> list[str]:
    return sorted({needle[at:at + GRAM] for at in range(len(needle) - GRAM + 1)})


def matching_texts(index: SearchIndex, needle: str) -> DataFrame:
    """Distinct texts that hold ``needle``, with their folder."""
    grams = grams_of(needle)
    shelves = [index.number(F.lit(gram), index.shelves) for gram in grams]
    numbers = set(index.spark.range(1).select(*[shelf.alias(f"s{at}") for at, shelf in enumerate(shelves)]).first())
    read = index.postings.where(F.col(SHELF).isin(*numbers) & F.col("gram").isin(*grams))
    return read.groupBy("text", FOLDER).agg(F.count(F.lit(1)).alias("held")).where(
        (F.col("held") == len(grams)) & F.col("text").contains(needle)).select("text", FOLDER)


def search(index: SearchIndex, text: str) -> DataFrame:
    """Rows whose text holds ``text``, whatever its case; blank text keeps every row, and text shorter
    than a trigram is looked for in all of them."""
    needle = text.strip().lower()
    rows = index.rows
    if len(needle) >= GRAM:
        folders: Sequence[int] = [row[0] for row in matching_texts(index, needle).select(FOLDER).distinct().collect()]
        rows = rows.where(F.col(FOLDER).isin(*folders))
    if needle:
        rows = rows.where(F.lower(F.coalesce(index.column, F.lit(""))).contains(needle))
    return rows.drop(FOLDER)
