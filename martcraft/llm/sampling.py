"""Bounded samples of labelled documents for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, learn: str, max_docs: int, id_col: str,
             text_col: str, max_chars: int = 100_000) -> list[Row]:
    """(text, y) of at most ``max_docs`` labelled rows.

    ``learn`` is a SQL condition on ``id``.  The rows with the lowest hashes of their
    ids are chosen from the labels alone; only their texts (at most ``max_chars``
    characters each) reach the driver.  The chosen ids are bounded by ``max_docs``,
    so they may be broadcast."""
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where(learn).where("y is not null").orderBy(F.xxhash64("id"), "id").limit(max_docs))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        f"length(text) <= {max_chars}")
    rows = texts.join(F.broadcast(chosen), "id").select("id", "text", "y").collect()
    return sorted(rows, key=lambda r: (r["id"], r["text"]))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text leaves ``remainder``."""
    return F.crc32(F.col(id_col).cast("string")) % modulus == remainder
