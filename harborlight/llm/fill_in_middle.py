"""Fill-in-middle transformation: texts cut at two ranks of units and rearranged around sentinels, and rebuilt from them.

A text's units stand in an indexable skip list. Its express lanes link ever fewer units, and each link carries two widths: the
units and the code points it passes. A search walks the highest lane while the accumulated units stay within the rank,
descends, and ends at the rank itself with the code points before it. Which units rise into which lane follows from a fixed
hash of their rank, so reruns agree.

Units are code points, or the matches of a pattern, left to right; what lies between two matches belongs to the later one, and
what follows the last match to it.

The ranks come from the SHA-256 of `seed:id`: its first four groups of eight hexadecimal digits h1 to h4. The prefix ends after the smaller
of h1 and h2 modulo (units + 1) units, the middle after the larger. h3 % 100 from PLAIN on leaves a text plain, as do an empty
text and one that holds a sentinel; otherwise h4 % 100 below SUFFIX_FIRST gives suffix, prefix, middle, else prefix, suffix, middle.

Defined results: a null text counts as empty (plain, 0 units, output empty); a null id as `seed:`; equal rows are cut alike;
columns of the input with names of new ones are replaced; a text without any match of the pattern is one unit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.llm._arrow import add_columns

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent from which a text stays plain, and below which the suffix comes first.
PLAIN, SUFFIX_FIRST = 90, 20
#: One unit in 2 ** RISE of a lane rises into the next.
RISE = 3
FIELDS = [
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
]


class Towers:
    """Ranks that rise into each express lane, for lists of any length; grown as longer texts come, up to KEPT units."""

    KEPT = 1 << 20

    def __init__(self) -> None:
        self.length, self.lanes = 0, []

    def below(self, n: int) -> list[np.ndarray]:
        """Of each lane above the lowest that is not empty: the ranks under n that stand in it; the head stands in all."""
        lanes = self.lanes
        if n > self.length:
            size = max(1024, 1 << (n - 1).bit_length())
            rank = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (rank ^ (rank >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            mixed[0] = 0
            lanes, step = [], RISE
            while len(at := np.flatnonzero(mixed & np.uint64((1 << step) - 1) == 0)) > 1:
                lanes.append(at)
                step += RISE
            if size <= self.KEPT:
                self.length, self.lanes = size, lanes
        cut = [at[: np.searchsorted(at, n)] for at in lanes]
        return [at for at in cut if len(at) > 1]


class SkipList:
    """Units of a text by rank: `points` are the code points of each unit, the links of the lowest lane, which pass one unit each."""

    def __init__(self, points: np.ndarray, towers: Towers):
        self.size, self.points = len(points), points
        #: Per express lane from the lowest: units and code points that each link passes, and where its node stands in the lane below.
        self.lanes = []
        ranks, widths = None, points
        for at in towers.below(self.size):
            down = at if ranks is None else np.searchsorted(ranks, at)
            widths = np.add.reduceat(widths, down, dtype=np.int64)
            self.lanes.append((np.diff(at, append=self.size), widths, down))
            ranks = at

    def points_before(self, rank: int) -> int:
        """Code points before the unit of that rank, 0 to size."""
        node = units = points = 0
        for step, width, down in reversed(self.lanes):
            while node < len(step) and units + step[node] <= rank:
                units += int(step[node])
                points += int(width[node])
                node += 1
            if units == rank:
                return points
            node = int(down[node])
        while units < rank:
            points += int(self.points[units])
            units += 1
        return points


def unit_points(text: str, pattern: regex.Pattern | None) -> np.ndarray:
    """Code points of each unit of a text."""
    if pattern is None or not text:
        return np.broadcast_to(np.int32(1), len(text))
    ends = np.fromiter((m.end() for m in pattern.finditer(text) if m.end() > m.start()), np.int64)
    if not len(ends):
        return np.array([len(text)], np.int64)
    ends[-1] = len(text)
    return np.diff(ends, prepend=0)


def draws(seed: str, doc_id: object) -> list[int]:
    """h1 to h4."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(text: str, h: list[int], towers: Towers, pattern: regex.Pattern | None = None, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(units, form, prefix_chars, middle_chars, output) of one text."""
    points = unit_points(text, pattern)
    n = len(points)
    if not text or h[2] % 100 >= plain or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(points, towers)
    a, b = sorted(units.points_before(x % (n + 1)) for x in h[:2])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: str = "1", unit: str | None = None, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points, null if plain) and output.

    unit: pattern of a unit (of the `regex` module); code points if None. Nothing is shuffled.
    """
    towers: list[Towers] = []  # one a task

    def run(texts: pa.Array, ids: pa.Array) -> list[pa.Array]:
        if not towers:
            towers.append(Towers())
        pattern = regex.compile(unit) if unit else None
        rows = [rearrange(t.as_py() or "", draws(seed, i.as_py()), towers[0], pattern, plain, suffix_first) for t, i in zip(texts, ids, strict=True)]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)]

    return add_columns(docs, text, FIELDS, run, (doc_id,))


def restore(output: Column, form: Column) -> Column:
    """The text before the transformation; a sentinel stands once in an output that is not plain, since the text held none."""

    def between(first: str, last: str | None) -> Column:
        start = F.instr(output, first) + len(first)
        length = F.instr(output, last) - start if last else F.length(output)
        return F.substring(output, start, length)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
