"""A network that predicts a masked token from a window on both sides, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np

#: Tokens on either side, numbers per hidden state, classes of tokens (they fit into a byte).
RADIUS, HIDDEN, CLASSES = 2, 16, 256
#: Classes that words outside the vocabulary share, by their endings; the last class pads a text.
RARE = 64
FREQUENT = CLASSES - RARE - 1
PAD = CLASSES - 1
#: Tokens of a training step, and of a scoring step.
BATCH = 4096
#: Tokens whose numbers of all classes are handled together: they stay in a CPU's cache.
BLOCK = 512
#: Logits up to this size, either way, go into exp as they are; results stay in the range of fast arithmetic.
SAFE = 30.0
#: Endings kept with their class.
CACHE_ENTRIES = 100_000

ONES = np.ones(CLASSES, np.float32)
OFFSETS = [o for o in range(-RADIUS, RADIUS + 1) if o]


class Endings(dict):
    """The class that words outside the vocabulary share, by their last two letters."""

    def __missing__(self, ending: str) -> int:
        found = FREQUENT + crc32(ending.encode()) % RARE
        if len(self) < CACHE_ENTRIES:
            self[ending] = found
        return found


class Tokens:
    """The class of each word: its own if it is in the vocabulary, else one by its ending."""

    def __init__(self, vocabulary: list[str]):
        self.own = {word: i for i, word in enumerate(vocabulary[:FREQUENT])}
        self.endings = Endings()

    def __getitem__(self, word: str) -> int:
        return self.classes([word])[0]

    def classes(self, words: list[str]) -> bytes:
        own, endings = self.own, self.endings
        return bytes([own[word] if word in own else endings[word[-2:]] for word in words])

    def of(self, text: str) -> bytes:
        return self.classes(text.split())


@dataclass(eq=False)
class MaskedModel:
    """``inputs``: what a token at each offset adds to the hidden state; ``outputs``, ``bias``: the softmax."""

    inputs: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, seed: int = 1) -> MaskedModel:
        rng = np.random.default_rng(seed)
        shape = (len(OFFSETS), CLASSES, HIDDEN)
        return cls(
            rng.normal(0, 0.3, shape).astype(np.float32),
            rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
            np.zeros(CLASSES, np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([self.inputs.ravel(), self.outputs.ravel(), self.bias])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> MaskedModel:
        cut = len(OFFSETS) * CLASSES * HIDDEN
        return cls(
            values[:cut].astype(np.float32).reshape(len(OFFSETS), CLASSES, HIDDEN),
            values[cut : cut + HIDDEN * CLASSES].astype(np.float32).reshape(HIDDEN, CLASSES),
            values[cut + HIDDEN * CLASSES :].astype(np.float32),
        )

    def hidden(self, context: np.ndarray) -> np.ndarray:
        state = self.inputs[0].take(context[:, 0], axis=0)
        for i in range(1, len(OFFSETS)):
            state += self.inputs[i].take(context[:, i], axis=0)
        return np.tanh(state, out=state)

    def log_probabilities(self, target: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Of each target given its context; the target itself is not seen."""
        found, weights, safe = np.empty(len(target)), self.with_bias(), self.is_safe()
        for at in range(0, len(target), BLOCK):
            own = target[at : at + BLOCK]
            logits = with_one(self.hidden(context[at : at + BLOCK])) @ weights
            chosen = logits[np.arange(len(own)), own].astype(np.float64)
            if not safe:
                chosen -= shift(logits)
            found[at : at + BLOCK] = chosen - np.log(np.exp(logits, out=logits) @ ONES, dtype=np.float64)
        return found

    def with_bias(self) -> np.ndarray:
        """``outputs`` with the bias below, for states from ``with_one``."""
        return np.concatenate([self.outputs, self.bias[None]])

    def is_safe(self) -> bool:
        """Whether no logit can be too large for exp, nor its exp too small: a state's numbers are between -1 and 1."""
        return bool(np.abs(self.with_bias()).sum(axis=0).max() < SAFE)


def shift(logits: np.ndarray) -> np.ndarray:
    """Take each row's maximum off, in place; what was taken off."""
    most = logits.max(axis=1, keepdims=True)
    logits -= most
    np.maximum(logits, -SAFE, out=logits)
    return most[:, 0]


def with_one(hidden: np.ndarray) -> np.ndarray:
    """States with a column of ones, which takes the bias."""
    return np.concatenate([hidden, np.ones((len(hidden), 1), np.float32)], axis=1)


class Trainer:
    """Learns by AdaGrad steps, starting from a model's values."""

    def __init__(self, model: MaskedModel, rate: float = 0.1):
        self.model = MaskedModel(model.inputs.copy(), model.outputs.copy(), model.bias.copy())
        self.rate = rate
        self.squares = [np.full_like(x, 1e-6) for x in (model.inputs, model.outputs, model.bias)]

    def step(self, target: np.ndarray, context: np.ndarray) -> None:
        """One step on all of these tokens; slopes are added up over blocks that fit into a CPU's cache."""
        m, n, weights, safe = self.model, len(target), self.model.with_bias(), self.model.is_safe()
        back, by_output = np.empty((n, HIDDEN), np.float32), np.zeros((HIDDEN + 1, CLASSES), np.float32)
        outputs = np.ascontiguousarray(m.outputs.T)
        for at in range(0, n, BLOCK):
            part = slice(at, at + BLOCK)
            own, hidden = target[part], m.hidden(context[part])
            state = with_one(hidden)
            each = state @ weights
            if not safe:
                shift(each)
            np.exp(each, out=each)
            # The softmax and its slopes without another pass: each row's sum divides what is small.
            sums = each @ ONES
            back[part] = ((each @ outputs) / sums[:, None] - outputs[own]) * (1 - hidden * hidden) / n
            each[np.arange(len(own)), own] -= sums
            state /= (sums * n)[:, None]
            by_output += state.T @ each
        by_input = np.stack([sums_by_class(context[:, i], back) for i in range(len(OFFSETS))])
        slopes = (by_input, by_output[:HIDDEN], by_output[HIDDEN])
        for value, square, change in zip((m.inputs, m.outputs, m.bias), self.squares, slopes):
            square += change * change
            value -= self.rate * change / np.sqrt(square)


def sums_by_class(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the rows of each class."""
    found = np.zeros((CLASSES, rows.shape[1]), np.float32)
    if len(classes):
        order = np.argsort(classes, kind="stable")
        sizes = np.bincount(classes, minlength=CLASSES)
        there = np.flatnonzero(sizes)
        found[there] = np.add.reduceat(rows.take(order, axis=0), (np.cumsum(sizes) - sizes)[there], axis=0)
    return found


def examples(token_texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Targets and contexts of all tokens of some texts; padding keeps texts apart."""
    gap = bytes([PAD]) * RADIUS
    line = np.frombuffer(gap + gap.join(token_texts) + gap, np.uint8)
    sizes = np.array([len(t) for t in token_texts], np.int64)
    starts = np.cumsum(sizes + RADIUS) - sizes
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return line[at], np.stack([line[at + o] for o in OFFSETS], axis=1)


def text_scores(model: MaskedModel, token_texts: list[bytes]) -> np.ndarray:
    """For each text the sum over its tokens of their log-probabilities given both sides."""
    target, context = examples(token_texts)
    each = np.zeros(len(target) + 1)
    for a in range(0, len(target), BATCH):
        each[a + 1 : a + 1 + BATCH] = model.log_probabilities(target[a : a + BATCH], context[a : a + BATCH])
    sums = np.cumsum(each)
    ends = np.cumsum([len(t) for t in token_texts])
    return sums[ends] - sums[ends - [len(t) for t in token_texts]]


def train(model: MaskedModel, groups: Iterator[list[bytes]]) -> tuple[MaskedModel, int]:
    """The model after one pass over all tokens of the texts, and the number of tokens."""
    trainer, tokens = Trainer(model), 0
    for texts in groups:
        target, context = examples(texts)
        tokens += len(target)
        for a in range(0, len(target), BATCH):
            trainer.step(target[a : a + BATCH], context[a : a + BATCH])
    return trainer.model, tokens
