"""Names of rows by their id and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The two halves of a key.
KEY = ["_key", "_more"]


def row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """128 bits of id and text, as two longs; a null is not taken for an empty text, nor an id for a text."""
    own, words = (doc_id.isNull(), doc_id.cast("string")), (text.isNull(), text.cast("string"))
    return F.xxhash64(*own, *words), F.xxhash64(F.lit("more"), *words, *own)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, the key and the text (as _text) of each row."""
    key, more = row_key(F.col(doc_id), F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), key.alias("_key"), more.alias("_more"), F.col(text).cast("string").alias("_text"))
