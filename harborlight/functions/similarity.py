"""Scores and decisions for matching places to spots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from harborlight.functions.text import match_phone
from harborlight.session import ship

W_TEL, W_NAME, W_ADDRESS, W_DISTANCE = 0.5, 0.3, 0.15, 0.05
MATCHED, PENDING = 0.85, 0.65
STRONG_NAME, GAP, RADIUS = 0.95, 0.08, 200.0


def name_similarity(left: str, right: str) -> float:
    """Jaro similarity with a bonus of a tenth per common first character (at most four), given at any similarity (SIM-1).

    Out-of-order matches count half each, unrounded. Equal texts, also empty ones, give 1.
    """
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    reach = max(len(left), len(right)) // 2 - 1
    taken: set[int] = set()
    ours = []
    for i, ch in enumerate(left):
        at = next((j for j in range(max(0, i - reach), min(len(right), i + reach + 1)) if j not in taken and right[j] == ch), None)
        if at is not None:
            taken.add(at)
            ours.append(ch)
    m = len(ours)
    if not m:
        return 0.0
    swapped = sum(a != right[j] for a, j in zip(ours, sorted(taken), strict=True))
    jaro = (m / len(left) + m / len(right) + (m - swapped / 2) / m) / 3.0
    common = 0
    while common < min(4, len(left), len(right)) and left[common] == right[common]:
        common += 1
    return min(1.0, jaro + common * 0.1 * (1 - jaro))


def similarity_udf(spark: SparkSession):
    """name_similarity for columns: Arrow batches, each distinct pair computed once per batch; nulls count as ''."""
    ship(spark)

    @F.pandas_udf("double")
    def similarity(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in parts:
            pairs = pd.MultiIndex.from_arrays([left.fillna(""), right.fillna("")])
            codes, distinct = pairs.factorize()
            scores = pd.Series([name_similarity(a, b) for a, b in distinct], dtype="float64")
            yield scores.take(codes).reset_index(drop=True)

    return similarity


def distance_score(metres: Column, radius: float = RADIUS) -> Column:
    """1 at the place, 0 from the radius on; null distance gives 0 (SIM-2)."""
    return F.coalesce(F.greatest(F.lit(0.0), 1 - metres / radius), F.lit(0.0))


def phone_score(left: Column, right: Column) -> Column:
    """1 if numbers of 7 digits or more are equal, or their last 8 digits are, else 0 (SIM-3)."""
    a, b = match_phone(left), match_phone(right)
    long = (F.length(a) >= 8) & (F.length(b) >= 8)
    hit = (F.length(a) >= 7) & (F.length(b) >= 7) & ((a == b) | (long & (F.right(a, F.lit(8)) == F.right(b, F.lit(8)))))
    return F.when(hit, 1.0).otherwise(0.0)


def phone_key(c: Column) -> Column:
    """What two numbers have in common that phone_score takes for one: the last 8 digits, or all 7; null for shorter ones."""
    digits = match_phone(c)
    return F.when(F.length(digits) >= 8, F.right(digits, F.lit(8))).when(F.length(digits) == 7, digits)


def match_score(tel: Column, name: Column, address: Column, distance: Column) -> Column:
    """Weighted sum to three places (SIM-4)."""
    return F.bround(tel * W_TEL + name * W_NAME + address * W_ADDRESS + distance * W_DISTANCE, 3)


def strong_evidence(tel: Column, name: Column) -> Column:
    """Telephone hit or nearly equal names (SIM-5)."""
    return (tel > 0) | (name >= STRONG_NAME)


def status_of(score: Column) -> Column:
    """Status by score alone (SIM-6)."""
    return F.when(score >= MATCHED, "matched").when(score >= PENDING, "pending").otherwise("separate")


def lower_if_ambiguous(status: Column, best: Column, second: Column) -> Column:
    """One step down where the second score is near (SIM-7)."""
    near = second.isNotNull() & ~(best - second >= GAP)
    return F.when(near & (status == "matched"), "pending").when(near & (status == "pending"), "separate").otherwise(status)


def final_status(score: Column, second: Column, tel: Column, name: Column) -> Column:
    """Status by score, then evidence, then ambiguity (SIM-8)."""
    first = status_of(score)
    checked = F.when((first == "matched") & ~strong_evidence(tel, name), "pending").otherwise(first)
    return lower_if_ambiguous(checked, score, second)
