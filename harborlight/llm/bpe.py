"""Byte-level BPE by merge replay over a corpus of words: encoding to ids, and decoding.

Texts are split by the pattern; the distinct words of a share of the corpus lie side by side as one array of tokens, one
per byte at first. An inverted index names, for each pair of neighbouring tokens that some rank merges, the positions where it
stands. Ranks are replayed in order: the lowest rank that waits is taken from a heap, its pairs are merged at all their
positions at once (left to right where they overlap), and only the neighbours of merged positions enter the index anew. A
word that is itself a token has that id. Each task replays the words of its own texts, a slice of SLICE bytes at a time, and keeps what it knows of
words, up to WORDS words and WORD_BYTES bytes; occurrences of words never leave their task, so nothing is shuffled.

Defined results: a null or empty text has no ids; ids that are null, or hold a null or an id without a token, decode to null;
a column of the input that has the name of a new one is replaced; repeated rows are encoded alike. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections import defaultdict
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harborlight.llm._arrow import add_columns

#: Bytes of text that are split and looked up together, at most, but for a longer single text.
SLICE = 4 << 20
#: White space before a space, and where a stretch ends: before a space after something else.
SPACES, CUT = regex.compile(r"\s "), regex.compile(r"(?V1)(?<=\S)(?= )")
#: Words, and bytes of their ids, that a task remembers before it starts anew.
WORDS, WORD_BYTES = 200_000, 8 << 20
#: Tokens that are gathered at a time.
BLOCK = 1 << 20


@dataclass
class Vocabulary:
    """Ranks of byte strings, and every pair of tokens that some rank merges: sorted keys and the ranks they give."""

    ranks: dict[bytes, int]
    pairs: np.ndarray
    merged: np.ndarray
    width: int

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Vocabulary:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes, the first is {missing[0]}")
        width = max(ranks.values()) + 1
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * width + right] = rank
        keys = np.array(sorted(found), np.int64)
        return cls(ranks, keys, np.array([found[k] for k in keys.tolist()], np.int64), width)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a file of lines `base64 rank`, read on the driver."""
        with open(path, "rb") as lines:
            return cls.of({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of tokens: the number of each in `pairs`, and which of them merge at all."""
        keys = left * self.width + right
        number = np.minimum(np.searchsorted(self.pairs, keys), max(len(self.pairs) - 1, 0))
        return number, self.pairs[number] == keys if len(self.pairs) else np.zeros(len(keys), bool)


def leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of sorted positions of pairs, those merged when none may share a token: every second one of a touching run."""
    touching = after[at[:-1]] == at[1:]
    if not touching.any():
        return at
    starts = np.concatenate(([True], ~touching))
    number = np.arange(len(at))
    return at[(number - np.maximum.accumulate(np.where(starts, number, 0))) % 2 == 0]


def replay(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, how many each word has); no word is empty."""
    single = np.array([vocabulary.ranks[bytes([b])] for b in range(256)], np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    none = int(lengths.sum())  # the place after the last token stands for "no neighbour"
    tokens = np.append(single[np.frombuffer(b"".join(words), np.uint8)], -1)
    after, before = np.arange(1, none + 2), np.arange(-1, none)
    after[ends - 1] = none
    before[ends - lengths] = none
    waiting: dict[int, dict[int, list[np.ndarray]]] = {}
    due: list[int] = []

    def enter(left: np.ndarray) -> None:
        """Put the pairs that start at these positions into the index."""
        number, merges = vocabulary.look_up(tokens[left], tokens[after[left]])
        left, number = left[merges], number[merges]
        if not len(left):
            return
        order = np.argsort(number, kind="stable")
        left, number = left[order], number[order]
        cuts = np.flatnonzero(np.diff(number)) + 1
        for pair, places in zip(number[np.concatenate(([0], cuts))].tolist(), np.split(left, cuts), strict=True):
            rank = int(vocabulary.merged[pair])
            if rank not in waiting:
                waiting[rank] = {}
                heapq.heappush(due, rank)
            waiting[rank].setdefault(pair, []).append(places)

    enter(np.flatnonzero(after[:none] < none))
    while due:
        rank = heapq.heappop(due)
        still = []
        for pair, places in waiting.pop(rank).items():
            at = np.concatenate(places)
            left, right = divmod(int(vocabulary.pairs[pair]), vocabulary.width)
            still.append(at[(tokens[at] == left) & (tokens[after[at]] == right)])
        at = np.sort(np.concatenate(still))
        if not len(at):
            continue
        at = leftmost(at, after)
        gone = after[at]
        tokens[at], tokens[gone] = rank, -1
        after[at] = after[gone]
        before[after[at]] = at
        left = before[at]
        apart = np.concatenate(([True], left[1:] != at[:-1]))  # else the left neighbour is itself a merged position
        enter(np.concatenate((left[apart & (left < none)], at[after[at] < none])))
    live = tokens[:none] >= 0
    return tokens[:none][live], np.add.reduceat(live.astype(np.int64), ends - lengths)


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[start:start + count] of each, one after the other, a block at a time."""
    parts = [values[:0]]
    for i in range(0, len(starts), BLOCK):
        s, n = starts[i : i + BLOCK], counts[i : i + BLOCK]
        parts.append(values[np.repeat(s - np.cumsum(n) + n, n) + np.arange(n.sum())])
    return np.concatenate(parts)


def summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of `sizes` values."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def stretches(text: str) -> list[str]:
    """The text cut before each space that follows something other than white space."""
    if SPACES.search(text):
        return CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


class Known:
    """Keys met so far, numbered in that order, and the ids of each."""

    def __init__(self) -> None:
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.ids = np.zeros(0, np.int32)
        self.counts = self.starts = np.zeros(0, np.int64)
        self.bytes = 0

    def new(self) -> list[str]:
        """Keys numbered since ids were last added."""
        return list(itertools.islice(self.number, len(self.counts), None))

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.append(self.starts, np.cumsum(counts) - counts + len(self.ids))
        self.ids, self.counts = np.append(self.ids, ids.astype(np.int32)), np.append(self.counts, counts)

    def full(self) -> bool:
        return len(self.number) > WORDS or 4 * len(self.ids) > WORD_BYTES

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the keys of these numbers, one after the other."""
        return gather(self.ids, self.starts[numbers], self.counts[numbers])


class Encoder:
    """Words met so far with their ids, and stretches of text between spaces with theirs; new words of a slice are replayed together."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, cut_at_spaces: bool = False):
        self.vocabulary, self.pattern, self.cut_at_spaces = vocabulary, regex.compile(pattern), cut_at_spaces
        self.words, self.stretches = Known(), Known()

    def learn(self) -> None:
        """Ids of words that were numbered and have none yet."""
        spelled = [w.encode() for w in self.words.new()]
        whole = [self.vocabulary.ranks.get(w) for w in spelled]
        rest = [w for w, rank in zip(spelled, whole, strict=True) if rank is None]
        ids, some = replay(rest, self.vocabulary) if rest else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        direct = np.array([rank is not None for rank in whole], bool)
        counts = np.ones(len(spelled), np.int64)
        counts[~direct] = some
        flat = np.empty(int(counts.sum()), np.int64)
        inside = np.repeat(direct, counts)
        flat[inside], flat[~inside] = [rank for rank in whole if rank is not None], ids
        self.words.add(flat, counts)

    def spell(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all texts, how many each has)."""
        look = self.words.number.__getitem__
        if len(texts) == 1:  # maybe a long one, whose words are not listed
            numbers = np.fromiter(map(look, map(itemgetter(0), self.pattern.finditer(texts[0]))), np.int64)
            return numbers, np.array([len(numbers)], np.int64)
        listed = [self.pattern.findall(t) for t in texts]
        return np.fromiter(map(look, itertools.chain.from_iterable(listed)), np.int64), np.array([len(x) for x in listed], np.int64)

    def encode_slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has): texts of SLICE bytes together, or one longer text."""
        for known in (self.words, self.stretches):
            if known.full():
                known.__init__()
        if not self.cut_at_spaces:
            numbers, sizes = self.spell(texts)
            self.learn()
            return self.words.of(numbers), summed(self.words.counts[numbers], sizes)
        cut = [stretches(t) for t in texts]
        numbers = np.fromiter(map(self.stretches.number.__getitem__, itertools.chain.from_iterable(cut)), np.int64)
        fresh = self.stretches.new()
        if fresh:
            words, sizes = self.spell(fresh)
            self.learn()
            self.stretches.add(self.words.of(words), summed(self.words.counts[words], sizes))
        return self.stretches.of(numbers), summed(self.stretches.counts[numbers], np.array([len(x) for x in cut], np.int64))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        slices, size = [[]], 0
        for t in texts:
            t = t or ""
            if slices[-1] and size + len(t) > SLICE:
                slices.append([])
                size = 0
            slices[-1].append(t)
            size += len(t)
        found = [self.encode_slice(x) for x in slices]
        return np.concatenate([ids for ids, _ in found]), np.concatenate([sizes for _, sizes in found])


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", ids: str = "ids", cut_at_spaces: bool = False) -> DataFrame:
    """docs with the ids of each text, as array<int>; the vocabulary is broadcast, its size does not grow with the data.

    cut_at_spaces says that no match of the pattern has a space behind something else, nor looks beyond one: then the
    ids of whole stretches from one space to the next are remembered, and the pattern runs once for each distinct stretch.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    own: list[Encoder] = []  # one a task

    def run(texts: pa.Array) -> list[pa.Array]:
        if not own:
            own.append(Encoder(shared.value, pattern, cut_at_spaces))
        flat, sizes = own[0].encode(texts.to_pylist())
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

    return add_columns(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], run)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encoded with the bytes that its ids stand for."""
    spelled = {rank: token for token, rank in vocabulary.ranks.items()}
    tokens = [spelled.get(i, b"") for i in range(vocabulary.width)]
    sizes = np.array([len(t) for t in tokens], np.int64)
    shared = encoded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes))

    def run(lists: pa.Array) -> list[pa.Array]:
        data, starts, sizes = shared.value
        rows = []
        for x in lists:
            n = x.values.to_numpy(zero_copy_only=False) if x.is_valid else None
            known = n is not None and not (x.values.null_count or len(n) and (n.min() < 0 or n.max() >= len(sizes) or not sizes[n].all()))
            rows.append(gather(data, starts[n], sizes[n]).tobytes() if known else None)
        return [pa.array(rows, pa.binary())]

    return add_columns(encoded, ids, [T.StructField(decoded, T.BinaryType())], run)
