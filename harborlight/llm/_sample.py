"""Bounded samples of labelled rows and reproducible folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo folds; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def smallest(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The `rows` rows whose key has the smallest hash: a uniform sample of fixed size that reruns repeat."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)
