"""Secret scan: fixed patterns, and a character convolutional network over every candidate and its context.

Base findings come from the patterns `assign`, `access` and `hex`; a fast search picks the texts that can hold any. Every
run of 12 or more characters of [A-Za-z0-9+/_.=-] in every text is a candidate: overlapping frames of `LENGTH` bytes, one every
`STRIDE` bytes, from `BEFORE` bytes of context before it to as many after it go through one-hot convolutions, maximum and mean
over places, and a logistic unit, in numpy; a candidate scores as its best frame. The network is trained on all labelled findings
of all documents, a distinct frame of each, against all distinct frames of all other candidates. Frames are dealt to shards of about
`SHARD` by their hash; in each of `EPOCHS` rounds every shard trains the same network on its frames, in turns of `ROUND` or more so that
each frame has its turn, and the shards' weights and Adam moments are averaged, in whole numbers, so that reruns agree. A label of
few frames is dealt to several shards, so that each holds `LEAST_SHARD` of it or all.

So that it learns what a secret is and not what the patterns are, findings are also shown in other shapes: drawn anew from the
`ALPHABETS`, with a prefix or without, and in the context of other candidates. The other candidates are unlabelled, not clean:
a first network is trained with spies (findings hidden among them), and only those that score below nearly all spies
(`SPIES_BELOW`) count as clean in the second. To these come `BENIGN` frames of each of the harmless `SHAPES`: dates, telephone and other numbers,
words in capitals and the like, drawn anew, so that they are known where the corpus holds none. Findings and others are split before variants are drawn; on the held-out part
probabilities are calibrated (Platt, with a prior at slope 1) and the threshold is the highest that keeps `RECALL` of its
findings, in their own and in other shapes; both from counts of all its logits by steps of 1/`GRID`. Candidates above it that base findings don't cover wholly are added as kind
`model`; base findings always stay.

Defined results: null and empty texts have no findings and the SHA-256 of ''; without any labelled finding, or without any
other candidate, there is nothing to learn and only base findings are returned; equal rows get equal results; an empty table
gives an empty result.
Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.llm import _text
from harborlight.llm._arrow import add_columns, spare
from harborlight.session import counted, ship, stored

KINDS = ("assign", "access", "hex", "model")
#: Fixed patterns of the base findings.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: Any text with a base finding matches this.
ANY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""

LEAST_RUN, SHORTEST = 12, 16
LENGTH, BEFORE, STRIDE = 48, 12, 24
TAPS, FILTERS, EMBED = 5, 16, 10
EPOCHS, VARIANTS = 10, 4
#: Step size.
RATE = 0.01
#: Frames of a shard, about; frames of each label that it holds at least, if there are as many; frames of each label in a shard's turn, at least.
SHARD, LEAST_SHARD, ROUND = 32768, 256, 4096
#: Steps of a logit in counts, the bound of counted logits, and steps of averaged weights.
GRID, BOUND, WHOLE = 1024, 64, 2.0**36
RECALL = 0.99
SPIES_BELOW = 0.02
#: Findings below which each part is held out in turn, and the number of parts.
LEAST, FOLDS = 20, 4
#: Frames that few findings are shown in.
SHOWN = 1000
#: Training frames of each harmless shape, in a shard.
BENIGN = 500
#: Alphabets of findings in other shapes.
ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)

_RUN = np.zeros(256, bool)
_RUN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def join_spans(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def candidates(chunk: _text.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first and last byte of every run of at least LEAST_RUN candidate characters."""
    mask = _RUN[chunk.data]
    if not len(mask):
        none = np.zeros(0, np.int64)
        return none, none, none
    opens, closes = mask.copy(), mask.copy()
    opens[1:] &= ~mask[:-1]
    closes[:-1] &= ~mask[1:]
    edges = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < len(mask))]
    opens[edges] = mask[edges]
    closes[edges - 1] = mask[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    keep = end - start >= LEAST_RUN
    start, end = start[keep], end[keep]
    return np.searchsorted(chunk.offsets, start, "right") - 1, start, end


def slide(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate number and first byte of every frame: each STRIDE bytes, from BEFORE bytes before the candidate until one reaches BEFORE bytes past its end."""
    count = 1 + np.maximum(0, -(-(end - start + 2 * BEFORE - LENGTH) // STRIDE))
    which = np.repeat(np.arange(len(start)), count)
    first = np.cumsum(count) - count
    return which, start[which] - BEFORE + STRIDE * (np.arange(len(which)) - first[which])


def frames(chunk: _text.Chunk, owner: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The LENGTH bytes from each place on (0 outside its text), with 256 added inside the candidate."""
    at = place[:, None] + np.arange(LENGTH)
    inside = (at >= chunk.offsets[owner][:, None]) & (at < chunk.offsets[owner + 1][:, None])
    codes = np.where(inside, chunk.data[np.clip(at, 0, len(chunk.data) - 1)], 0).astype(np.int16)
    return codes + 256 * ((at >= start[:, None]) & (at < end[:, None])).astype(np.int16)


@dataclass
class Network:
    """Embedding, convolution, pooled logistic unit; Platt calibration and threshold."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    moments: tuple[dict[str, np.ndarray], dict[str, np.ndarray]] = ({}, {})
    steps: int = 0
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0

    def begin(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.weights = {
            "embed": rng.normal(0, 0.3, (512, EMBED)).astype(np.float32),
            "conv": rng.normal(0, 0.2, (TAPS * EMBED, FILTERS)).astype(np.float32),
            "shift": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, 0.2, 2 * FILTERS).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }
        self.moments = tuple({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        self.steps = 0

    def state(self) -> np.ndarray:
        """Weights, first moments, roots of second moments and steps."""
        parts = [*self.weights.values(), *self.moments[0].values(), *[np.sqrt(v) for v in self.moments[1].values()], np.array([self.steps])]
        return np.concatenate([p.ravel().astype(float) for p in parts])

    def resumed(self, state: np.ndarray) -> Network:
        """A network of this form in that state."""
        sizes = np.cumsum([v.size for _ in range(3) for v in self.weights.values()])
        parts = iter(np.split(state[:-1], sizes[:-1]))
        first, second, third = ({k: next(parts).reshape(v.shape).astype(np.float32) for k, v in self.weights.items()} for _ in range(3))
        return Network(first, (second, {k: v * v for k, v in third.items()}), round(state[-1]))

    def forward(self, codes: np.ndarray) -> tuple:
        w = self.weights
        embedded = w["embed"][codes]
        places = LENGTH - TAPS + 1
        patches = np.concatenate([embedded[:, k : k + places] for k in range(TAPS)], 2)
        before = patches @ w["conv"] + w["shift"]
        active = np.maximum(before, 0)
        top = active.argmax(1)
        pooled = np.concatenate([active.max(1), active.mean(1)], 1)
        return patches, active, top, pooled, pooled @ w["out"] + w["bias"][0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(codes[i : i + 2048])[4] for i in range(0, len(codes), 2048)] or [np.zeros(0, np.float32)])

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(codes) + self.offset, -35, 35)))

    def gradients(self, codes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        patches, active, top, pooled, logit = self.forward(codes)
        d = ((1 / (1 + np.exp(-np.clip(logit, -35, 35))) - label) * weight / weight.sum()).astype(np.float32)
        d_pooled = d[:, None] * w["out"]
        places = active.shape[1]
        d_active = np.repeat(d_pooled[:, None, FILTERS:] / places, places, 1)
        rows, filters = np.arange(len(codes))[:, None], np.arange(FILTERS)
        d_active[rows, top, filters] += d_pooled[:, :FILTERS]
        d_active *= active > 0
        flat = d_active.reshape(-1, FILTERS)
        d_patches = d_active @ w["conv"].T
        flat_codes = np.concatenate([codes[:, k : k + places].ravel() for k in range(TAPS)])
        by_code = np.concatenate([d_patches[:, :, k * EMBED : (k + 1) * EMBED].reshape(-1, EMBED) for k in range(TAPS)])
        d_embed = np.stack([np.bincount(flat_codes, weights=by_code[:, j], minlength=len(w["embed"])) for j in range(EMBED)], 1).astype(w["embed"].dtype)
        return {"embed": d_embed, "conv": patches.reshape(-1, TAPS * EMBED).T @ flat, "shift": flat.sum(0), "out": pooled.T @ d, "bias": d.sum(keepdims=True)}


def descend(net: Network, x: np.ndarray, y: np.ndarray, rate: float, rng: np.random.Generator) -> None:
    """Once through the rows by Adam on the logistic loss; both labels weigh the same."""
    weight = np.where(y == 1, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max(len(y) - y.sum(), 1))).astype(np.float32)
    first, second = net.moments
    order = rng.permutation(len(x))
    for i in range(0, len(order), 128):
        part = order[i : i + 128]
        net.steps += 1
        for k, g in net.gradients(x[part], y[part], weight[part]).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.weights[k] -= rate * (first[k] / (1 - 0.9**net.steps)) / (np.sqrt(second[k] / (1 - 0.999**net.steps)) + 1e-8)


def _split(positive: np.ndarray, negative: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(held out findings, held out others) as masks: a quarter, or each of FOLDS parts in turn where there are fewer than LEAST findings."""
    folds = 4 if len(positive) >= LEAST else max(1, min(FOLDS, len(positive)))
    parts = [np.arange(len(x)) * n // max(len(x), 1) for x, n in ((positive, folds), (negative, FOLDS))]
    return [(parts[0] == i, parts[1] == i) for i in range(1 if len(positive) >= LEAST else folds)]


@dataclass
class View:
    """Frames of a shard for one network: to learn from, and held out; with which of the held-out findings are counted here, and how often each is redrawn there."""

    own: np.ndarray
    other: np.ndarray
    held_own: np.ndarray
    held_other: np.ndarray
    counted: np.ndarray
    redrawn: int
    hidden: np.ndarray

    @property
    def others(self) -> np.ndarray:
        return np.concatenate([self.other, self.held_other]) if self.held_other is not self.other else self.other


@dataclass
class Shard:
    """Distinct findings and other frames; which findings are no copies of another shard's; numbers of both in all shards."""

    number: int
    own: np.ndarray
    other: np.ndarray
    original: np.ndarray
    n_own: int
    n_other: int

    def views(self) -> list[View]:
        """A view for each held-out part, and one of everything where there are several.

        Frames that every shard holds are split by rank, others by their hash, so that copies fall into the same part.
        """
        out = []
        all_own, all_other = len(self.own) == self.n_own, len(self.other) == self.n_other
        splits = _split(self.own, self.other)
        for held, off in splits:
            held = held if all_own else frame_hash(self.own) % np.uint64(4) == 0
            off = off if all_other else frame_hash(self.other) % np.uint64(4) == 0
            own = self.own if self.n_own == 1 else self.own[~held]
            few = self.n_other < LEAST
            other, held_other = (self.other, self.other) if few else (self.other[~off], self.other[off])
            redrawn = max(1, -(-SHOWN // 2 // max(int(held.sum()) if all_own else self.n_own // 4, 1)))
            out.append(View(own, other, self.own[held], held_other, self.original[held], redrawn, self._hidden(own, all_own)))
        if len(splits) > 1:
            out.append(View(self.own, self.other, self.own, self.other, self.original, 0, self._hidden(self.own, all_own)))
        return out

    def _hidden(self, own: np.ndarray, all_own: bool) -> np.ndarray:
        """Which findings are spies: an eighth."""
        return np.arange(len(own)) < max(1, len(own) // 8) if all_own else frame_hash(own) // np.uint64(4) % np.uint64(8) == 0


#: Sums of numbers by key, over all shards.
Sums = tuple[np.ndarray, np.ndarray]


def _sums(parts: list[Sums]) -> Sums:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    values = np.zeros(len(keys), np.int64)
    np.add.at(values, at, np.concatenate([v for _, v in parts]))
    return keys, values


def _turn(codes: np.ndarray, turn: int, turns: int) -> np.ndarray:
    """The frames whose turn it is: ROUND or more, each at least once in all turns."""
    size = min(len(codes), max(ROUND, -(-len(codes) // turns)))
    return codes[(turn * size + np.arange(size)) % max(len(codes), 1)]


def _steps(net: Network, codes: np.ndarray) -> np.ndarray:
    """Logits in steps of 1 / GRID."""
    return np.floor(np.clip(net.logits(codes), -BOUND, BOUND - 1) * GRID).astype(np.int64)


def _shown(own: np.ndarray, other: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Findings, in their own shape and VARIANTS other ones, few findings in more (SHOWN in all)."""
    return np.concatenate([own, reshape(np.tile(own, (max(VARIANTS, SHOWN // max(len(own), 1)), 1)), other, rng)])


def _spies(shard: Shard, view: View, seed: int) -> np.ndarray:
    """Spies in their own and other shapes, the same each time."""
    rng, hidden = np.random.default_rng([seed, shard.number]), view.own[view.hidden]
    return np.concatenate([hidden, reshape(np.tile(hidden, (VARIANTS, 1)), view.others, rng)])


@dataclass
class Spying:
    """First networks: findings against all others, among whom spies are hidden."""

    seed: int

    def begin(self, n: int, turn: int) -> None:
        """Nothing differs between turns."""

    def rows(self, shard: Shard, view: View, which: int, turn: int, turns: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        other = _turn(view.others, turn, turns)
        own = view.own if view.hidden.all() else view.own[~view.hidden]
        return _shown(_turn(own, turn, turns), other, rng), np.concatenate([other, _spies(shard, view, self.seed)])

    def count(self, shard: Shard, view: View, net: Network, which: int) -> list[np.ndarray]:
        return [_steps(net, x) for x in (_spies(shard, view, self.seed), view.other, view.held_other)]


@dataclass
class Learning:
    """Second networks: findings against clean others, those whose first network's logit is below the step, and harmless shapes."""

    seed: int
    sieves: list[tuple[Network, int] | None]
    pool: np.ndarray = field(default_factory=lambda: np.zeros((0, LENGTH - BEFORE), np.int16))

    def begin(self, n: int, turn: int) -> None:
        """Harmless shapes, drawn anew for each turn and for the counts."""
        self.pool = shapes(n, np.random.default_rng([self.seed, turn]))

    def clean(self, other: np.ndarray, which: int) -> np.ndarray:
        sieve = self.sieves[which]
        return other if sieve is None else other[_steps(sieve[0], other) < sieve[1]]

    def rows(self, shard: Shard, view: View, which: int, turn: int, turns: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        other = _turn(view.other, turn, turns)
        clean = self.clean(other, which)
        context = clean if len(clean) else other
        return _shown(_turn(view.own, turn, turns), context, rng), np.concatenate([clean, benign(self.pool, context, rng)])

    def count(self, shard: Shard, view: View, net: Network, which: int) -> list[np.ndarray]:
        rng = np.random.default_rng([self.seed, shard.number, which])
        clean, held = self.clean(view.held_other, which), view.held_own[view.counted]
        context = clean if len(clean) else view.held_other
        shown = reshape(np.tile(held, (view.redrawn, 1)), context, rng)
        return [_steps(net, x) for x in (held, shown, np.concatenate([clean, benign(self.pool, context, rng)]))]


def _trained(total: Callable[[Callable[[Shard], Sums]], Sums], task: Spying | Learning, n: int, turns: int, seed: int) -> list[Network]:
    """The task's n networks, after every shard had its turns."""
    nets = [Network() for _ in range(n)]
    for net in nets:
        net.begin(seed)
    for turn in range(turns):
        task.begin(BENIGN * len(SHAPES), turn)

        def run(shard: Shard, nets=nets, turn=turn) -> Sums:
            states = []
            for i, view in enumerate(shard.views()):
                net, rng = nets[i].resumed(nets[i].state()), np.random.default_rng([seed, shard.number, i, turn])
                own, other = task.rows(shard, view, i, turn, turns, rng)
                descend(net, np.concatenate([own, other]), np.concatenate([np.ones(len(own)), np.zeros(len(other))]).astype(np.float32), RATE, rng)
                states.append(net.state())
            values = np.rint(np.concatenate([*states, [1.0]]) * WHOLE).astype(np.int64)
            return np.arange(len(values)), values

        values = total(run)[1] / WHOLE
        nets = [net.resumed(state) for net, state in zip(nets, (values[:-1] / values[-1]).reshape(n, -1), strict=True)]
    return nets


def _counts(total: Callable[[Callable[[Shard], Sums]], Sums], task: Spying | Learning, nets: list[Network]) -> list[list[Sums]]:
    """For each network, the task's three counts of logits by step."""
    span = 2 * BOUND * GRID

    def run(shard: Shard) -> Sums:
        found = [_x for i, (view, net) in enumerate(zip(shard.views(), nets, strict=True)) for _x in task.count(shard, view, net, i)]
        keys = np.concatenate([k * span + BOUND * GRID + x for k, x in enumerate(found)])
        return _sums([(keys, np.ones(len(keys), np.int64))])

    keys, values = total(run)
    parts = np.searchsorted(keys, np.arange(3 * len(nets) + 1) * span)
    each = [(keys[a:b] - k * span - BOUND * GRID, values[a:b]) for k, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True))]
    return [each[i : i + 3] for i in range(0, len(each), 3)]


def _ranked(steps: np.ndarray, counts: np.ndarray, share: float) -> int:
    """The step at that share of the counted logits."""
    return int(steps[np.searchsorted(np.cumsum(counts), np.floor(share * counts.sum()), "right")])


def _learn(total: Callable[[Callable[[Shard], Sums]], Sums], n_own: int, epochs: int, seed: int) -> Network:
    """The network for the shards that `total` sums over.

    A quarter of the findings, and of the others, is held out for calibration and threshold. Of fewer than LEAST findings each part is held out in turn from
    a network of its own (cross-fitting), and the network itself learns from all; a single finding is held out in other shapes of it only. Of fewer than
    LEAST others all serve for both.
    """
    parts = 1 if n_own >= LEAST else min(FOLDS, n_own)
    n = parts + (parts > 1)
    spying = Spying(seed)
    firsts = _trained(total, spying, n, max(1, epochs // 2), seed)
    sieves: list[tuple[Network, int] | None] = []
    for net, (spies, *others) in zip(firsts, _counts(total, spying, firsts), strict=True):
        below = _ranked(*spies, SPIES_BELOW)
        sieves.append((net, below) if all((steps < below).any() for steps, _ in others) else None)
    task = Learning(seed, sieves)
    nets = _trained(total, task, n, epochs, seed)
    task.begin(BENIGN // 4 * len(SHAPES), epochs)
    found = _counts(total, task, nets)[:parts]
    net = nets[-1]
    own, shown, other = (_sums([f[k] for f in found]) for k in range(3))
    own = shown if n_own == 1 else own
    every = _sums([own, shown])
    ones, zeros = every[1].sum(), other[1].sum()
    target = np.concatenate([np.full(len(every[0]), (ones + 1) / (ones + 2)), np.full(len(other[0]), 1 / (zeros + 2))])
    net.slope, net.offset = _platt((np.concatenate([every[0], other[0]]) + 0.5) / GRID, target, np.concatenate([every[1], other[1]]))
    # the recall holds for the findings as they are, and for those and their other shapes together
    for part in (own, every):
        least = np.clip(net.slope * _ranked(*part, 1 - RECALL) / GRID + net.offset, -35, 35)
        net.threshold = min(net.threshold, float(1 / (1 + np.exp(-least))))
    return net


def _wordless(codes: np.ndarray) -> np.ndarray:
    """Which frames hold digits alone of their candidate."""
    return ~((codes >= 256) & ((codes < 256 + ord("0")) | (codes > 256 + ord("9")))).any(1)


def fit(positive: np.ndarray, negative: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """The network for one shard of these frames.

    Findings of digits alone, such as card numbers, are left to the patterns, which report them all, if there are others to learn from: they would
    make a secret of every number.
    """
    if not len(positive) or not len(negative):
        return None
    rng = np.random.default_rng(seed)
    wordless = _wordless(positive)
    positive = positive if wordless.all() else positive[~wordless]
    positive, negative = positive[rng.permutation(len(positive))], negative[rng.permutation(len(negative))]
    shard = Shard(0, positive, negative, np.ones(len(positive), bool), len(positive), len(negative))
    return _learn(lambda run: run(shard), len(positive), epochs, seed)


def _platt(z: np.ndarray, target: np.ndarray, count: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, each logit counted as often as told, by Newton steps that are halved until the loss falls.

    A normal prior of deviation 1 around slope 1 bounds the slope where the held-out part is separable.
    """

    def loss(slope: float, offset: float) -> float:
        x = slope * z + offset
        return float((count * (np.logaddexp(0, x) - target * x)).sum() + (slope - 1) ** 2 / 2)

    slope, offset = 1.0, 0.0
    now = loss(slope, offset)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -35, 35)))
        g, h = count * (p - target), count * p * (1 - p)
        a, b, c = (h * z * z).sum() + 1, (h * z).sum(), h.sum() + 1e-9
        u, v = (g * z).sum() + slope - 1, g.sum()
        det = a * c - b * b
        if abs(u) + abs(v) < 1e-6 or det <= 0:
            break
        step = 1.0
        while step > 1e-10 and (new := loss(slope - step * (c * u - b * v) / det, offset - step * (a * v - b * u) / det)) >= now:
            step /= 2
        if step <= 1e-10:
            break
        slope, offset, now = slope - step * (c * u - b * v) / det, offset - step * (a * v - b * u) / det, new
    return slope, offset


_LETTERS = [np.frombuffer(s.encode(), np.uint8).astype(np.int16) + 256 for s in ALPHABETS]
_PREFIX = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8).astype(np.int16) + 256
_SEPARATORS = np.frombuffer(b"_-", np.uint8).astype(np.int16) + 256


def _pick(rng: np.random.Generator, letters: str, n: int) -> str:
    return "".join([letters[i] for i in rng.integers(0, len(letters), n).tolist()])


def _digits(rng: np.random.Generator, n: int) -> str:
    return _pick(rng, "0123456789", n)


def _phone(rng: np.random.Generator) -> str:
    parts = [_digits(rng, int(rng.integers(2, 4))), _digits(rng, int(rng.integers(3, 5))), _digits(rng, int(rng.integers(4, 6)))]
    return ("+" + _digits(rng, int(rng.integers(1, 3))) + "-" if rng.random() < 0.5 else "") + "-.="[int(rng.random() < 0.2)].join(parts)


def _date(rng: np.random.Generator) -> str:
    day = [f"{rng.integers(1900, 2100)}", f"{rng.integers(1, 13):02}", f"{rng.integers(1, 29):02}"]
    text = "-/."[rng.integers(3)].join(day if rng.random() < 0.7 else day[::-1])
    return text + ("T" if rng.random() < 0.7 else "_") + f"{rng.integers(24):02}" + (f".{rng.integers(60):02}.{rng.integers(60):02}" if rng.random() < 0.4 else "")


def _isbn(rng: np.random.Generator) -> str:
    return "-".join(["978" if rng.random() < 0.7 else "979", _digits(rng, int(rng.integers(1, 3))), _digits(rng, int(rng.integers(2, 5))), _digits(rng, int(rng.integers(4, 7))), _digits(rng, 1)])


def _uuid(rng: np.random.Generator) -> str:
    letters = _pick(rng, "0123456789abcdef" if rng.random() < 0.7 else "0123456789ABCDEF", 32)
    return "-".join([letters[:8], letters[8:12], letters[12:16], letters[16:20], letters[20:]])


def _word(rng: np.random.Generator, least: int) -> str:
    """A word that can be spoken: vowels after one or two consonants."""
    text = ""
    while len(text) < least:
        text += _pick(rng, "bcdfghklmnprstvz", int(rng.integers(1, 3))) + _pick(rng, "aeiou", 1 + int(rng.random() < 0.2))
        text += ("", "", "n", "r", "s", "t", "tion", "ing", "al", "ed")[rng.integers(10)]
    return text


#: Harmless shapes that a corpus may hold few or none of, each drawn anew.
SHAPES = {
    "date": _date,
    "telephone": _phone,
    "isbn": _isbn,
    "uuid": _uuid,
    "number": lambda rng: _digits(rng, int(rng.integers(12, 21))),
    "capitals": lambda rng: _word(rng, 12).upper(),
    "constant": lambda rng: "_".join(_word(rng, int(rng.integers(3, 9))) for _ in range(int(rng.integers(2, 5)))).upper(),
    "counter": lambda rng: _word(rng, int(rng.integers(2, 9))) + "=" + _digits(rng, int(rng.integers(6, 15))),
    "camel": lambda rng: "".join(_word(rng, int(rng.integers(2, 9))).capitalize() for _ in range(int(rng.integers(2, 5)))),
    "path": lambda rng: "/" * int(rng.random() < 0.5) + "/".join(_word(rng, int(rng.integers(2, 9))).title() if rng.random() < 0.3 else _word(rng, int(rng.integers(2, 9))) for _ in range(int(rng.integers(2, 5)))),
    "identifier": lambda rng: "_-."[rng.integers(3)].join(_word(rng, int(rng.integers(2, 9))) + (_digits(rng, int(rng.integers(1, 4))) if rng.random() < 0.3 else "") for _ in range(int(rng.integers(2, 5)))),
}


def shapes(n: int, rng: np.random.Generator) -> np.ndarray:
    """n harmless shapes in turn, the one nearest to secrets (uuid) three times as often, as codes with 0 behind them."""
    kinds = [*SHAPES.values(), _uuid, _uuid]
    out = np.zeros((n, LENGTH - BEFORE), np.int16)
    for i in range(n):
        text = kinds[i % len(kinds)](rng)
        text += _digits(rng, max(0, LEAST_RUN - len(text)))
        part = np.frombuffer(text.encode(), np.uint8)[: LENGTH - BEFORE].astype(np.int16) + 256
        out[i, : len(part)] = part
    return out


def benign(pool: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The harmless shapes, each in the context of another candidate, and a fifth as many other candidates in capitals."""
    context = others[rng.integers(0, len(others), len(pool))]
    out = np.where(context >= 256, 32, context).astype(np.int16)
    edge = np.zeros(out.shape, bool)
    edge[:, BEFORE - 1] = True
    edge[:, BEFORE:] = np.diff((pool == 0).astype(np.int8), axis=1, prepend=0) == 1
    out[edge & _RUN[out & 255]] = 32  # nothing of the context adjoins the shape
    out[:, BEFORE:][pool > 0] = pool[pool > 0]
    loud = others[rng.integers(0, len(others), len(pool) // 5)].copy()
    loud[(loud >= 256 + ord("a")) & (loud <= 256 + ord("z"))] -= 32
    return np.concatenate([out, loud])


def reshape(codes: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Findings in other shapes: the candidate drawn anew from one alphabet each, a third with a prefix, half cut to SHORTEST bytes or more, half in the context of another candidate."""
    out, inside = codes.copy(), codes >= 256
    n = len(codes)
    which = rng.integers(0, len(_LETTERS), n)
    for k, letters in enumerate(_LETTERS):
        mask = inside & (which == k)[:, None]
        out[mask] = rng.choice(letters, int(mask.sum()))
    place = np.cumsum(inside, 1) - 1
    length = np.where(rng.random(n) < 1 / 3, rng.integers(2, 6, n), -1)[:, None]
    begins = ~inside[:, :1] | (place[:, :1] < 0)  # the frame shows where its candidate begins
    prefix = inside & (place < length) & begins
    out[prefix] = rng.choice(_PREFIX, int(prefix.sum()))
    mark = inside & (place == length) & begins
    out[mark] = rng.choice(_SEPARATORS, int(mark.sum()))
    whole = inside.sum(1)
    keeps = np.where(rng.random(n) < 0.5, SHORTEST + np.floor(rng.random(n) * np.maximum(whole - SHORTEST, 0)), whole)[:, None]
    cut = inside & (place >= keeps)
    out[cut] = 32
    inside = inside & ~cut
    if len(others):
        context = others[rng.integers(0, len(others), n)]
        swap = ~inside & (rng.random(n) < 0.5)[:, None] & ~(cut & (place == keeps))  # a cut candidate ends before a space
        out[swap] = np.where(context >= 256, 32, context)[swap]
    return out


def frame_hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each frame."""
    out = np.full(len(codes), 0x9E3779B97F4A7C15, np.uint64)
    for word in np.ascontiguousarray(codes).view(np.uint64).T:
        out = _text.mix(out ^ word)
    return out


def _parts(which: np.ndarray, size: int = 8192) -> Iterator[tuple[int, int]]:
    """Ranges of about `size` frames; a candidate with more is cut over several, one with fewer is not."""
    lo = 0
    while lo < len(which):
        hi = min(lo + size, len(which))
        if hi < len(which):
            cut = int(np.searchsorted(which, which[hi]))
            hi = cut if cut > lo else hi
        yield lo, hi
        lo = hi


def _joined(spans: list[tuple[int, int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the spans, with those that overlap or adjoin as one."""
    out: list[list[int]] = []
    for a, b in sorted((a, b) for a, b, _ in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    both = np.array(out, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _touching(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int, str]]) -> np.ndarray:
    """Which of the ranges share a place with any span."""
    lo, hi = _joined(spans)
    at = np.searchsorted(hi, start, "right")
    return np.append(lo, np.iinfo(np.int64).max)[at] < end


def _held(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int, str]]) -> np.ndarray:
    """How many places each of the ranges shares with the spans together."""
    lo, hi = _joined(spans)
    places = np.column_stack([lo, hi]).ravel()
    total = np.column_stack([np.cumsum(hi - lo) - (hi - lo), np.cumsum(hi - lo)]).ravel()
    return np.interp(end, places, total) - np.interp(start, places, total)


def _covered(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int, str]]) -> np.ndarray:
    """Which of the ranges the spans cover wholly, together."""
    lo, hi = _joined(spans)
    at = np.searchsorted(lo, start, "right")
    return np.append(-1, hi)[at] >= end


def _scan(column: pa.Array):
    """Per chunk: chunk, base findings per text (by number), candidates with code-point spans."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    suspicious = pc.fill_null(pc.match_substring_regex(column, ANY), False)
    for chunk in _text.chunks(column):
        flagged = np.flatnonzero(suspicious.slice(chunk.lo, chunk.hi - chunk.lo).to_numpy(zero_copy_only=False))
        base = {int(i): base_findings(chunk.text(i).decode()) for i in flagged}
        owner, start, end = candidates(chunk)
        points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80, dtype=np.int64)])
        origin = points[chunk.offsets[owner]]
        yield chunk, base, owner, start, end, points[start] - origin, points[end] - origin


def _labelled(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Label and frame: of labelled candidates, the frame that holds most of findings, as a candidate scores as its best frame; of others, every frame."""
    for chunk, base, owner, start, end, a, b in _scan(column):
        label = np.zeros(len(owner), np.int32)
        for i, spans in base.items():
            mine = slice(*np.searchsorted(owner, [i, i + 1]))
            label[mine] = _touching(a[mine], b[mine], spans)
        which, place = slide(start, end)
        for lo, hi in _parts(which):
            w, p = which[lo:hi], place[lo:hi]
            codes = frames(chunk, owner[w], start[w], end[w], p)
            # Bytes of a candidate are ASCII, so that its code points run along with them.
            x = a[w] + np.maximum(p - start[w], 0)
            y = a[w] + np.minimum(p + LENGTH, end[w]) - start[w]
            held = np.zeros(len(w))
            for i in np.unique(owner[w[label[w] == 1]]):
                mine = slice(*np.searchsorted(owner[w], [i, i + 1]))
                held[mine] = _held(x[mine], y[mine], base[int(i)])
            order = np.lexsort((frame_hash(codes), -held, w))
            one = order[np.unique(w[order], return_index=True)[1]]
            one = np.concatenate([one[label[w[one]] == 1], np.flatnonzero(label[w] == 0)])
            yield label[w[one]], codes[one]


def sample_order(codes: np.ndarray) -> np.ndarray:
    """A hash of each frame that is independent of the one its candidate was asked by."""
    return _text.mix(frame_hash(codes) ^ np.uint64(0xD1342543DE82EF95)).view(np.int64)


def _first(codes: np.ndarray, rows: int) -> np.ndarray:
    """The `rows` distinct frames that come first in sample order."""
    _, at = np.unique(codes.view(f"V{2 * LENGTH}").ravel(), return_index=True) if len(codes) else (None, np.zeros(0, int))
    codes = codes[at]
    return codes[np.argsort(sample_order(codes), kind="stable")[:rows]]


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct frames of each chunk of texts, labelled 0 for others, 1 for findings and 2 for findings of digits alone."""
    for batch in batches:
        for label, codes in _labelled(batch.column(0)):
            label = label + (label * _wordless(codes))
            for k in range(3):
                new = _first(codes[label == k], len(codes))
                fields = [pa.array(np.full(len(new), k, np.int32)), pa.array(sample_order(new), pa.int64()), pa.array([c.tobytes() for c in new], pa.binary())]
                yield pa.RecordBatch.from_arrays(fields, ["label", "place", "frame"])


def _codes(frames: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(frames), np.int16).reshape(-1, LENGTH)


def _gathered(table: pa.Table) -> pa.Table:
    """A shard as one row: its findings, which of them are no copies, and its others, in sample order."""
    out: list = [table.column("shard")[0].as_py()]
    for own in (True, False):
        mine = table.filter(pc.not_equal(table.column("label"), 0) if own else pc.equal(table.column("label"), 0)).sort_by([("place", "ascending"), ("frame", "ascending")])
        out += [b"".join(mine.column("frame").to_pylist()), (mine.column("copy").to_numpy() == 0).tobytes()]
    return pa.table({n: pa.array([v], t) for n, v, t in zip(("shard", "own", "original", "other"), out[:4], (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)})


def deal(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int, int]:
    """All distinct training frames of all documents in shards, one to a row, and the numbers of findings and of others.

    Findings of digits alone are left out if there are others, as in `fit`.
    """
    ship(docs.sparkSession)
    found = docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(_training_rows, "label int, place long, frame binary").distinct()
    found, figures = counted(found, "secret-frames", {f"n{k}": F.count(F.when(F.col("label") == k, 1)) for k in range(3)})
    label = 1 if figures["n1"] else 2
    n_own, n_other = figures[f"n{label}"], figures["n0"]
    shards = max(1, -(-(n_own + n_other) // SHARD))
    copies = [min(shards, -(-shards * LEAST_SHARD // max(n, 1))) for n in (n_own, n_other)]
    number = F.when(F.col("label") == label, copies[0]).otherwise(copies[1])
    dealt = found.filter(F.col("label").isin(0, label)).withColumn("copy", F.explode(F.sequence(F.lit(0), number - 1)))
    dealt = dealt.withColumn("shard", F.pmod(F.pmod(F.col("place"), F.lit(shards)) + F.col("copy"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    rows = dealt.groupBy("shard").applyInArrow(_gathered, "shard int, own binary, original binary, other binary")
    return rows, n_own, n_other


def train(docs: DataFrame, text: str = "text") -> Network | None:
    """The network, trained on all distinct frames of findings and of other candidates of all documents; None where there are none of either."""
    rows, n_own, n_other = deal(docs, text)
    if not n_own or not n_other:
        return None
    rows = stored(rows, "secret-shards")

    def total(run: Callable[[Shard], Sums]) -> Sums:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = []
            for batch in batches:
                for row in range(batch.num_rows):
                    number, own, original, other = (column[row].as_py() for column in batch.columns)
                    parts = [_sums([*parts, run(Shard(number, _codes([own]), _codes([other]), np.frombuffer(original, bool), n_own, n_other))])]
            for keys, values in parts:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.int64())], ["key", "value"])

        summed = rows.mapInArrow(each, "key long, value long").groupBy("key").agg(F.sum("value").alias("value")).toArrow().sort_by("key")
        return summed.column("key").to_numpy(), summed.column("value").to_numpy()

    return _learn(total, n_own, EPOCHS, 7)


REPORT = [
    T.StructField("n_assign", T.LongType()),
    T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
    T.StructField("n_candidates", T.LongType()),
]


def scan_texts(column: pa.Array, net: Network | None) -> list[pa.Array]:
    out: list[list] = [[] for _ in REPORT]
    for chunk, base, owner, start, end, a, b in _scan(column):
        texts = chunk.hi - chunk.lo
        added: dict[int, list[tuple[int, int, str]]] = {}
        if net is not None and len(owner):
            which, place = slide(start, end)
            hot = np.zeros(len(owner), bool)
            for i in range(0, len(which), 8192):
                w = which[i : i + 8192]
                hot[w[net.probability(frames(chunk, owner[w], start[w], end[w], place[i : i + 8192])) >= net.threshold]] = True
            for i in np.unique(owner[hot]):
                lo, hi = np.searchsorted(owner, [i, i + 1])
                mine = lo + np.flatnonzero(hot[lo:hi])
                mine = mine[~_covered(a[mine], b[mine], base.get(int(i), []))]
                added[int(i)] = [(int(x), int(y), "model") for x, y in zip(a[mine], b[mine], strict=True)]
        count = np.bincount(owner, minlength=texts)
        for i in range(texts):
            spans = base.get(i, [])
            for k, kind in enumerate(KINDS[:3]):
                out[k].append(sum(1 for s in spans if s[2] == kind))
            out[3].append(hashlib.sha256(join_spans(spans).encode()).hexdigest())
            every = sorted(spans + added.get(i, []), key=lambda f: (f[0], KINDS.index(f[2])))
            out[4].append(join_spans(every))
            out[5].append(int(count[i]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]


def scan(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """docs with the report columns."""
    held = docs.sparkSession.sparkContext.broadcast(net)
    return add_columns(docs, text, REPORT, lambda column: scan_texts(column, held.value))


def redact_text(text: str, spans: str, mark: str = "[secret]") -> str:
    """The text with every span (overlapping ones as one) replaced by the mark."""
    out, last = [], 0
    for a, b in sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in spans.split(",") if s):
        if b <= last:
            continue
        if a >= last:
            out += [text[last:a], mark]
        last = b
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, net: Network | None, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """docs with all findings replaced in the text, and n_chars (if there) brought up to date."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    def run(column: pa.Array) -> list[pa.Array]:
        spans = scan_texts(column, held.value)[4].to_pylist()
        fixed = [redact_text(t, s) if s else t for t, s in zip(column.to_pylist(), spans, strict=True)]
        return [pa.array(fixed, pa.string()), pa.array([s != "" for s in spans], pa.bool_())]

    flag = spare("_redacted", docs.columns)
    fixed = add_columns(docs, text, [T.StructField(text, T.StringType()), T.StructField(flag, T.BooleanType())], run)
    if n_chars in docs.columns:
        fixed = fixed.withColumn(n_chars, F.when(F.col(flag), F.length(text).cast("long")).otherwise(F.col(n_chars)))
    return fixed.select(docs.columns)
