"""Chunks of texts, by a fold over the lines of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_CHARS = 1800


def lines(text: Column | str) -> Column:
    """Non-blank lines with single spaces, trimmed."""
    cut = F.transform(F.split(text, r"\r\n|[\n\r\f]"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.filter(cut, lambda x: x != "")


def packed(text: Column | str, most: int = MOST_CHARS) -> Column:
    """Lines packed in order, joined by blank lines; a chunk ends before the line with which it would pass ``most`` characters."""
    start = F.struct(F.array().cast("array<string>").alias("c"), F.lit(0).alias("n"))

    def add(a: Column, x: Column) -> Column:
        size = F.length(x) + 1
        fresh = (F.size(a["c"]) == 0) | (a["n"] + size > most)
        longer = F.concat(F.slice(a["c"], 1, F.size(a["c"]) - 1), F.array(F.concat_ws("\n\n", F.element_at(a["c"], -1), x)))
        return F.struct(F.when(fresh, F.concat(a["c"], F.array(x))).otherwise(longer).alias("c"), F.when(fresh, size).otherwise(a["n"] + size).alias("n"))

    return F.aggregate(lines(text), start, add, lambda a: a["c"])


def paragraph_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_CHARS) -> DataFrame:
    """``key, chunk_index, chunk`` of every text; null and blank texts have no chunks."""
    chunks = docs.select(key, F.posexplode(packed(F.coalesce(F.col(text), F.lit("")), most)).alias("chunk_index", "chunk"))
    return chunks.withColumn("chunk_index", F.col("chunk_index").cast("long"))
