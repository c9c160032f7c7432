"""Small tables held by the driver as plans without Python, and the word pattern of the SQL side."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word separator or more, and one word; the texts' words are the runs between separators.
GAP, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of the given rows as one literal; for tables whose size does not follow the data."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(text))


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{GAP}|{GAP}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP, -1))).cast("long")
