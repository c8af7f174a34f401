"""Survey code books as data: one table of (year, column, code, value) instead of a module a year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns decoded by lookup, and how the rest is read, by survey year (representative subset; rows can be added as data).
MODES = {"walk": "walk", "rbike": "rbike", "ebike25": "ebike25", "ebike45": "ebike45", "anybike": "anybike", "car": "car", "train": "transit", "bus": "transit", "tram": "transit"}
BOOKS: dict[int, dict[str, dict[int, str | None]]] = {
    1994: {"mode": {1: "walk", 2: "rbike", 3: "car", 4: "train", 5: "bus", 9: None}, "purpose": {1: "work", 2: "education", 3: "shopping", 4: "leisure", 8: None}},
    2000: {"mode": {1: "walk", 2: "rbike", 3: "car", 4: "train", 5: "tram"}, "purpose": {1: "work", 2: "education", 3: "shopping", 4: "leisure"}},
    2005: {"mode": {1: "walk", 2: "rbike", 3: "car", 4: "train", 5: "tram", 6: "bus"}, "purpose": {1: "work", 2: "education", 3: "shopping", 4: "leisure", 5: "transfer"}},
    2010: {"mode": {1: "walk", 2: "anybike", 3: "car", 4: "train", 5: "tram", 6: "bus"}, "purpose": {1: "transfer", 2: "work", 3: "education", 4: "shopping", 8: "leisure"}},
    2015: {"mode": {1: "walk", 2: "rbike", 3: "ebike25", 4: "ebike45", 5: "car", 9: "train", 10: "bus"}, "purpose": {1: "transfer", 2: "work", 3: "education", 4: "shopping", 8: "leisure"}},
    2021: {"mode": {1: "walk", 2: "rbike", 20: "ebike25", 21: "ebike45", 5: "car", 9: "train", 10: "bus"}, "purpose": {1: "transfer", 2: "work", 3: "education", 4: "shopping", 8: "leisure"}},
}


def code_table(spark: SparkSession, books: dict[int, dict[str, dict[int, str | None]]] = BOOKS) -> DataFrame:
    rows = [(year, column, code, value) for year, columns in books.items() for column, codes in columns.items() for code, value in codes.items()]
    return spark.createDataFrame(rows, "year int, column string, code int, value string")


def decode(raw: DataFrame, books: DataFrame, columns: list[str]) -> DataFrame:
    """raw (year, columns of codes) with each column's category; negative codes and codes listed without a value are null."""
    out = raw
    for c in columns:
        book = books.where(F.col("column") == c).select(F.col("year").alias("_y"), F.col("code").alias("_c"), F.col("value").alias(f"{c}_cat"))
        out = out.join(book, (F.col("year") == F.col("_y")) & (F.col(c) == F.col("_c")), "left").drop("_y", "_c")
    return out


def unlisted(raw: DataFrame, books: DataFrame, column: str) -> DataFrame:
    """Codes that aren't negative and that the year's book doesn't list, with their number."""
    book = books.where(F.col("column") == column).select("year", F.col("code").alias(column))
    return raw.where(F.col(column) >= 0).join(book, ["year", column], "left_anti").groupBy("year", column).agg(F.count("*").alias("n"))
