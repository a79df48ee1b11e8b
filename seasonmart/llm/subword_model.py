"""A classifier of subword bags: embeddings averaged over windows of words, then a linear softmax."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from zlib import crc32

import numpy as np

#: Buckets that n-grams of UTF-8 bytes are hashed to, components of their vectors, their lengths.
BUCKETS, WIDTH = 1 << 17, 8
SHORTEST, LONGEST = 3, 5
#: Words whose vectors are averaged, and the distance between the starts of two windows.
WINDOW, STEP = 8, 4
#: Word scores kept by a scorer; beyond that the table starts anew.
CACHE_ENTRIES = 150_000
#: Words whose subwords are made at once.
CHUNK = 20_000
#: Rounds between two looks at the loss on texts not learned from, and how often it may not fall.
LOOK, PATIENCE = 4, 3
#: Texts that the prior share counts as in the calibration, and the bounds of its scale.
PSEUDO_TEXTS, SCALES = 4.0, (0.2, 3.0)
#: Texts added to both counts of an n-gram, and what its log-odds are multiplied by, at the start.
SMOOTH, HEAD_START = 5.0, 6.0
#: Fixed value: what is stripped from the ends of a word.
PUNCTUATION = ".,;:!?\"'()[]{}<>*#%&$/\\|-_=+~`"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def distinct_words(text: str) -> list[str]:
    """The text's words in lower case, each where it first occurs: a repeated word counts once."""
    return list(dict.fromkeys(text.lower().split()))


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and of the words as a whole; and whose they are.

    Words are stripped of punctuation, their ends are marked, and the n-grams of all of them are
    hashed side by side.
    """
    marked = [f"<{w.strip(PUNCTUATION) or w}>".encode() for w in words]
    sizes = np.array([len(w) for w in marked], np.int64)
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    found = [np.array([crc32(w) for w in marked], np.uint64)]
    owners = [np.arange(len(words))]
    rolling = (data + np.uint64(1)) * _MIX
    for n in range(2, min(LONGEST, len(data)) + 1):
        rolling = ((rolling[:-1] ^ (rolling[:-1] >> np.uint64(29))) + data[n - 1 :] + np.uint64(1)) * _MIX
        if n >= SHORTEST:
            whole = owner[: len(rolling)] == owner[n - 1 :]
            found.append(rolling[whole] >> np.uint64(32))
            owners.append(owner[: len(rolling)][whole])
    buckets = np.concatenate(found) & np.uint64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate(owners)


def window_starts(n: int) -> np.ndarray:
    """Windows that together hold all of ``n`` words; a shorter text is one window."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + 1, STEP)
    return starts if starts[-1] == n - WINDOW else np.append(starts, n - WINDOW)


def window_means(scores: np.ndarray) -> np.ndarray:
    """The mean word score of each window; 0 for a text without words."""
    if not len(scores):
        return np.zeros(1)
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    starts = window_starts(len(scores))
    ends = np.minimum(starts + WINDOW, len(scores))
    return (sums[ends] - sums[starts]) / (ends - starts)


@dataclass(eq=False)
class SubwordModel:
    """``gram_scores``: what each bucket's vector adds to the logit; ``bias``: the logit without."""

    gram_scores: np.ndarray
    bias: float

    @property
    def key(self) -> tuple[int, float]:
        """Tells models apart that were read separately from the same broadcast."""
        return crc32(np.ascontiguousarray(self.gram_scores).tobytes()), self.bias

    def word_scores(self, words: list[str]) -> np.ndarray:
        found = np.zeros(len(words))
        for at in range(0, len(words), CHUNK):
            part = words[at : at + CHUNK]
            buckets, owner = subwords(part)
            sums = np.bincount(owner, self.gram_scores[buckets], len(part))
            found[at : at + CHUNK] = sums / np.bincount(owner, minlength=len(part))
        return found


class Scorer:
    """Scores texts; word scores met before are looked up."""

    def __init__(self, model: SubwordModel):
        self.model, self.known = model, {}

    def logits(self, texts: Iterable[str]) -> np.ndarray:
        """For each text the logit of its most suspicious window."""
        bags = [distinct_words(text) for text in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        new = list(set().union(*bags).difference(self.known))
        if new:
            self.known.update(zip(new, self.model.word_scores(new).tolist()))
        of = self.known
        best = [window_means(np.array([of[w] for w in bag])).max() for bag in bags]
        return np.array(best) + self.model.bias

    def probabilities(self, texts: Iterable[str]) -> np.ndarray:
        return _sigmoid(self.logits(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Bags:
    """Training texts as numbers: words of each text, windows of words, subwords of each word."""

    def __init__(self, texts: list[str], min_texts: int):
        ids: dict[str, int] = {}
        of_text = []
        for text in texts:
            of_text.append(np.array([ids.setdefault(w, len(ids)) for w in distinct_words(text)], np.int32))
        self.words = max(1, len(ids))
        sizes = np.array([len(t) for t in of_text])
        self.word = np.concatenate(of_text)
        del of_text
        self.sizes = sizes
        first = np.cumsum(sizes) - sizes
        starts = [window_starts(n) for n in sizes]
        self.first_window = np.cumsum([0, *(len(s) for s in starts[:-1])])
        self.window_text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(s) for s in starts])
        self.start = np.concatenate([(s + f).astype(np.int32) for s, f in zip(starts, first)])
        self.end = np.minimum(self.start + WINDOW, (first + sizes)[self.window_text]).astype(np.int32)
        self.size = np.maximum(1, self.end - self.start).astype(np.int8)

        # What stands in very few texts can only be learned by heart.
        texts_of_word = np.bincount(self.word, minlength=self.words)
        spelled, chunks = list(ids), range(0, len(ids), CHUNK)
        del ids
        seen = np.zeros(BUCKETS)
        for at in chunks:
            gram, owner = subwords(spelled[at : at + CHUNK])
            seen += np.bincount(gram, texts_of_word[owner + at], BUCKETS)
        self.known = seen >= min_texts
        self.chunks, self.grams = [], np.ones(self.words)
        for at in chunks:
            gram, owner = subwords(spelled[at : at + CHUNK])
            self.grams[at : at + CHUNK] = np.bincount(owner)
            use = self.known[gram]
            # Owners are counted within a chunk, so 16 bits hold them.
            self.chunks.append((at, gram[use].astype(np.int32), owner[use].astype(np.uint16)))

    def by_word(self, of_gram: np.ndarray) -> np.ndarray:
        """For each word the sum over its subwords."""
        found = np.zeros(self.words)
        for at, gram, owner in self.chunks:
            part = np.bincount(owner, of_gram[gram])
            found[at : at + len(part)] = part
        return found

    def by_gram(self, of_word: np.ndarray) -> np.ndarray:
        """For each subword the sum over the words it stands in."""
        found = np.zeros(BUCKETS)
        for at, gram, owner in self.chunks:
            found += np.bincount(gram, of_word[at : at + CHUNK][owner], BUCKETS)
        return found

    def log_odds(self, labels: np.ndarray) -> np.ndarray:
        """How much more often an n-gram stands in texts of label 1, as a smoothed logarithm."""
        ones = np.bincount(self.word, np.repeat(labels, self.sizes), self.words)
        both = np.bincount(self.word, minlength=self.words)
        share = ones.sum() / max(1, both.sum())
        one, other = self.by_gram(ones), self.by_gram(both - ones)
        return np.log((one / share + SMOOTH) / (other / (1 - share) + SMOOTH)) * self.known

    def window_scores(self, gram_scores: np.ndarray) -> np.ndarray:
        of_word = self.by_word(gram_scores) / self.grams
        sums = np.zeros(len(self.word) + 1)
        np.cumsum(of_word.astype(np.float32)[self.word], dtype=np.float64, out=sums[1:])
        return (sums[self.end] - sums[self.start]) / self.size

    def to_grams(self, by_window: np.ndarray) -> np.ndarray:
        """A gradient by window score as a gradient by gram score."""
        n = len(self.word) + 1
        each = by_window / self.size
        steps = np.bincount(self.start, each, n)
        steps -= np.bincount(self.end, each, n)
        np.cumsum(steps, out=steps)
        of_word = np.bincount(self.word, steps[:-1], self.words)
        return self.by_gram(of_word / self.grams)


def _loss(probability: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    right = np.where(labels > 0, probability, 1 - probability)
    return float(-(weight * np.log(np.maximum(right, 1e-9))).sum() / weight.sum())


def fit(
    texts: list[str], labels: list[int], rounds: int = 48, rate: float = 0.03, min_texts: int = 30,
    check_share: int = 5, seed: int = 1, log=None,
) -> SubwordModel:
    """Learn subword vectors and the softmax's weights together, by full-batch gradient steps.

    Vectors start along the weights, by the log-odds of their n-grams. A text's logit is that of
    its windows, weighted by a softmax over them that grows sharper from round to round: several
    windows learn at first, in the end the one that decides. One text in
    ``check_share`` is not learned from; the values of the round with the smallest loss on those
    are kept, and learning ends when that loss keeps rising. N-grams in fewer than ``min_texts``
    texts (1 in 80, for few texts) are left out. The softmax of two classes depends on the difference of their weights only, which is
    what is learned. With one class, or no texts, the model gives that class's share to all texts.
    """
    labels = np.asarray(labels, float)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    prior = math.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    checked = rng.permutation(len(texts)) % check_share == 0
    if not len(texts) or len(set(labels[~checked])) < 2 or len(set(labels[checked])) < 2:
        return SubwordModel(np.zeros(BUCKETS), prior)
    learnable = [t for t, c in zip(texts, checked) if not c]
    bags = Bags(learnable, min(min_texts, max(3, len(learnable) // 80)))
    weights = rng.normal(0, 0.5, WIDTH)
    start = HEAD_START * bags.log_odds(labels[~checked])[:, None] * weights / (weights @ weights)
    values = {
        "vectors": (start + rng.normal(0, 0.02, (BUCKETS, WIDTH))).astype(np.float32),
        "weights": weights,
        "bias": np.array(prior),
    }
    first = {k: np.zeros_like(v) for k, v in values.items()}
    second = {k: np.zeros_like(v) for k, v in values.items()}
    # Rare positives weigh more, half-way to equal classes.
    weight = np.where(labels > 0, 0.5 / share + 0.5, 0.5 / (1 - share) + 0.5)
    learned, counted = labels[~checked], weight[~checked] / (~checked).sum()
    control = [t for t, c in zip(texts, checked) if c]
    best, best_loss, worse = SubwordModel(np.zeros(BUCKETS), prior), math.inf, 0
    for step in range(1, rounds + 1):
        score = bags.window_scores(values["vectors"] @ values["weights"])
        sharp = 4 + 3 * step / rounds
        top = np.maximum.reduceat(score, bags.first_window)
        chosen = np.exp(sharp * (score - top[bags.window_text]))
        chosen /= np.add.reduceat(chosen, bags.first_window)[bags.window_text]
        logit = np.add.reduceat(chosen * score, bags.first_window) + values["bias"]
        error = (_sigmoid(logit) - learned) * counted
        by_gram = bags.to_grams(chosen * error[bags.window_text])
        slopes = {
            "vectors": by_gram.astype(np.float32)[:, None] * values["weights"].astype(np.float32),
            "weights": values["vectors"].T @ by_gram,
            "bias": np.array(error.sum()),
        }
        for k, slope in slopes.items():  # Adam
            first[k] *= 0.9
            first[k] += 0.1 * slope
            second[k] *= 0.99
            second[k] += 0.01 * slope**2
            change = first[k] / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            values[k] = values[k] - change * (rate / (1 - 0.9**step))
        if step % LOOK == 0:
            # An n-gram that was not learned says nothing.
            gram_scores = np.where(bags.known, values["vectors"] @ values["weights"], 0.0)
            model = SubwordModel(gram_scores, float(values["bias"]))
            loss = _loss(Scorer(model).probabilities(control), labels[checked], weight[checked])
            worse = 0 if loss < best_loss else worse + 1
            if loss < best_loss:
                best, best_loss = model, loss
            if log:
                log(step, round(loss, 4), round(_loss(_sigmoid(logit), learned, counted), 4))
            if worse > PATIENCE:
                break
    logits = Scorer(best).logits(control)
    scale, shift = calibration(logits, labels[checked], share)
    return SubwordModel(best.gram_scores * scale, best.bias * scale + shift)


def calibration(logits: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Scale and shift that make logits those of probabilities, where label 1 has the given share.

    Learning weighs rare positives up and the most suspicious of many windows scores high, so the
    logits as they are promise too much. A logistic regression on texts not learned from mends
    both. It is shrunk as if ``PSEUDO_TEXTS`` more texts had been seen with the prior share, and
    the scale is held between ``SCALES``: few texts, or perfectly separated ones, do not decide.
    """
    n = len(logits)
    x = np.concatenate([logits, logits])
    # Each text counts as itself and, a little, as one of the other label.
    lean = PSEUDO_TEXTS / (n + PSEUDO_TEXTS)
    target = np.concatenate([np.ones(n), np.zeros(n)])
    weight = np.concatenate([(1 - lean) * labels + lean * share, (1 - lean) * (1 - labels) + lean * (1 - share)])
    scale, shift = 1.0, 0.0
    for _ in range(100):
        p = _sigmoid(scale * x + shift)
        slope = weight * (p - target)
        curve = weight * np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([(slope * x).sum(), slope.sum()])
        hessian = np.array([[(curve * x * x).sum(), (curve * x).sum()], [(curve * x).sum(), curve.sum()]])
        step = np.linalg.solve(hessian + 1e-6 * np.eye(2), gradient)
        step = np.clip(step, -1, 1)
        scale, shift = float(np.clip(scale - step[0], *SCALES)), shift - float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    return scale, shift
