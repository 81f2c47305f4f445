"""Toxicity by a small recurrent network, written and trained in numpy.

A word enters as a learned vector (known words) beside the mean of its character n-gram
vectors (all words). A bidirectional gated recurrent layer reads windows of words, attention
pools its states, and a logistic unit scores the window. Windows overlap by half and cover the
whole text; a text's score is its worst window's.

Labels are per document. The first passes teach every window its document's label; later
passes teach only the worst window of a toxic document, and all windows of clean ones, their
worst ones more.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32
STRIDE = 16
#: The classifier is fitted on at most so many labelled documents of each class, the first in
#: hash order of their ids, among those of at most so many characters.
FIT_DOCS = 1_500
FIT_CHARS = 20_000
CUT = 0.7

_PAD, _UNKNOWN = 0, 1
_GRAMS = 4_096
_BATCH = 2_048
_TRAINED = 256
_NOTHING = -20.0  # logit of a text without words
_WORDS_HELD = 200_000
#: A-Z to lower case, digits to 0, other ASCII to a space; other bytes stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    """Words; a word that follows itself is read once."""
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    return [word for word, last in zip(words, [b"", *words], strict=False) if word != last]


def char_grams(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams (2 and 3 bytes, with word edges) and each word's count."""
    sizes = np.array([len(w) + 2 for w in words])
    row = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), "uint8").astype("uint64")
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(row))  # bytes from here to the word's end
    kept, owner = [], np.repeat(np.arange(len(words)), sizes)
    code, owners = row, []
    for width in (2, 3):
        code = code[: len(row) - width + 1] * np.uint64(257) + row[width - 1 :]
        fits = left[: len(code)] >= width
        mixed = (code[fits] + np.uint64(width)) * np.uint64(0x9E3779B97F4A7C15)
        kept.append((mixed >> np.uint64(40)) % np.uint64(_GRAMS))
        owners.append(owner[: len(code)][fits])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(kept)[order].astype("int64"), np.bincount(owner, minlength=len(words))


def window_starts(n_words: int, window: int = WINDOW, stride: int = STRIDE) -> np.ndarray:
    """First words of the windows that cover a text; an empty text has one empty window."""
    return np.arange(0, max(1, n_words - window + stride), stride)


@dataclass
class Network:
    """The first axis of ``into``, ``bias`` and ``state`` is the direction, forward first; their
    last axis holds the reset, update and new-state gates, each ``hidden`` wide."""

    vocabulary: dict[bytes, int]
    hidden: int = 8
    width: int = 8
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    #: Of the logits of whole texts: slope and shift that turn them into probabilities.
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        if self.weights:
            return
        rng, h, d = np.random.default_rng(self.seed), self.hidden, self.width
        normal = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype("float32")
        self.weights = {
            "word": normal(len(self.vocabulary) + 2, d),
            "gram": normal(_GRAMS, d),
            "into": normal(2, 2 * d, 3 * h, scale=0.3),
            "bias": np.zeros((2, 1, 3 * h), "float32"),
            "state": normal(2, h, 3 * h, scale=0.3),
            "look": normal(2 * h, scale=0.3),
            "out": normal(2 * h, scale=0.3),
            "base": np.zeros(1, "float32"),
        }
        self.weights["word"][:2] = 0

    def features(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vector of each word, its vocabulary row, and its character n-grams."""
        rows = np.array([self.vocabulary.get(w, _UNKNOWN) for w in words], "int64")
        grams, sizes = char_grams(words)
        sums = np.add.reduceat(self.weights["gram"][grams], np.concatenate(([0], np.cumsum(sizes)[:-1])))
        means = sums / sizes[:, None].astype("float32")
        return np.concatenate((self.weights["word"][rows], means), axis=1), rows, grams, sizes

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        """What words add to the gates (direction, word, gate); row 0 is padding."""
        inputs = np.concatenate((np.zeros((1, inputs.shape[1]), inputs.dtype), inputs))
        return inputs @ self.weights["into"] + self.weights["bias"]

    def run(self, gates: np.ndarray, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows; ``ids`` (window, step) are rows of ``gates``."""
        p, h = self.weights, self.hidden
        n, steps = ids.shape
        ahead = np.ascontiguousarray(ids.T)
        state = np.zeros((2, n, h), gates.dtype)
        states = np.empty((steps, 2, n, h), gates.dtype)
        x = np.empty((2, n, 3 * h), gates.dtype)
        for t in range(steps):
            np.take(gates[0], ahead[t], axis=0, out=x[0])
            np.take(gates[1], ahead[steps - 1 - t], axis=0, out=x[1])
            u = state @ p["state"]
            gate = x[:, :, : 2 * h] + u[:, :, : 2 * h]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            reset, update = gate[:, :, :h], gate[:, :, h:]
            new = reset * u[:, :, 2 * h :]
            new += x[:, :, 2 * h :]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((state, u[:, :, 2 * h :], reset, update, new))
            state = states[t]
            np.subtract(states[t - 1] if t else 0, new, out=state)
            state *= update
            state += new
        # a word's state joins both directions: the backward one was reached steps - 1 - t later
        joined = np.concatenate((states[:, 0], states[::-1, 1]), axis=2)
        empty = ahead == _PAD
        weight = joined @ p["look"]
        weight[empty] = -30.0
        weight = np.exp(weight - weight.max(axis=0))
        weight[empty] = 0
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weight, joined)
        if keep is not None:
            keep.append((joined, weight, pooled))
        return pooled @ p["out"] + p["base"][0]

    def step(self, words: list[bytes], ids: np.ndarray, label: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients over windows; ``ids`` are 0 for padding, else 1 + the place in ``words``."""
        p, h = self.weights, self.hidden
        x, rows, grams, sizes = self.features(words)
        gates = self.gates(x)
        keep: list = []
        score = _sigmoid(self.run(gates, ids, keep))
        joined, weight, pooled = keep.pop()
        steps = ids.shape[1]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_logit = ((score - label) * cost).astype(gates.dtype)
        g["out"], g["base"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = np.einsum("bh,tbh->tb", d_pooled, joined)
        d_look = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["look"] = np.einsum("tb,tbh->h", d_look, joined)
        d_joined = weight[:, :, None] * d_pooled + d_look[:, :, None] * p["look"]
        d_gates = np.zeros_like(gates)
        carried = np.zeros((2, len(ids), h), gates.dtype)
        for t in range(steps - 1, -1, -1):
            before, u_new, reset, update, new = keep[t]
            d = carried + np.stack((d_joined[t, :, :h], d_joined[steps - 1 - t, :, h:]))
            d_new = d * (1 - update) * (1 - new * new)
            d_update = d * (before - new) * update * (1 - update)
            d_reset = d_new * u_new * reset * (1 - reset)
            d_x = np.concatenate((d_reset, d_update, d_new), axis=2)
            d_u = np.concatenate((d_reset, d_update, d_new * reset), axis=2)
            g["state"] += before.transpose(0, 2, 1) @ d_u
            carried = d * update + d_u @ p["state"].transpose(0, 2, 1)
            np.add.at(d_gates[0], ids[:, t], d_x[0])
            np.add.at(d_gates[1], ids[:, steps - 1 - t], d_x[1])
        g["bias"] = d_gates.sum(axis=1, keepdims=True)
        g["into"] = x.T @ d_gates[:, 1:]
        d_x = (d_gates[:, 1:] @ p["into"].transpose(0, 2, 1)).sum(axis=0)
        np.add.at(g["word"], rows, d_x[:, : self.width])
        g["word"][_PAD] = 0
        share = np.repeat(d_x[:, self.width :] / sizes[:, None], sizes, axis=0)
        np.add.at(g["gram"], grams, share.astype(gates.dtype))
        return g


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def window_ids(sizes: Sequence[int], ids: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows over texts laid end to end in ``ids``, padded with 0, and each window's text."""
    starts = [window_starts(n, WINDOW, stride) for n in sizes]
    flat = np.zeros(int(sum(sizes)) + WINDOW * (len(sizes) + 1), "int64")
    at, place, firsts = 0, 0, []
    for n, first in zip(sizes, starts, strict=True):
        flat[at : at + n] = ids[place : place + n]
        firsts.append(first + at)
        at, place = at + n + WINDOW, place + n
    owner = np.repeat(np.arange(len(sizes)), [len(s) for s in starts])
    first = np.concatenate(firsts) if firsts else np.zeros(0, "int64")
    return flat[first[:, None] + np.arange(WINDOW)], owner


class Scorer(dict):
    """Scores texts. Maps a word to its row of gate inputs, kept for a bounded number of words."""

    def __init__(self, net: Network):
        super().__init__()
        self.net = net
        self.fresh: list[bytes] = []
        self.table = net.gates(np.zeros((0, 2 * net.width), "float32"))

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(word)
        self[word] = row = len(self) + 1
        return row

    def _rows(self, group: list[list[bytes]]) -> np.ndarray:
        if len(self) > _WORDS_HELD:
            self.clear()
            self.table = self.table[:, :1]
        ids = np.array([self[w] for words in group for w in words], "int64")
        if self.fresh:
            more = self.net.gates(self.net.features(self.fresh)[0])[:, 1:]
            self.table = np.concatenate((self.table, more), axis=1)
            self.fresh = []
        return ids

    def logits(self, texts: Iterable[str | None]) -> np.ndarray:
        """Of each text's worst window. Texts are taken in groups of some ten thousand words."""
        out, group, held = [], [], 0
        for text in texts:
            words = tokens(text)
            group.append(words)
            held += len(words) + 1
            if held > 200_000:
                out.append(self._group(group))
                group, held = [], 0
        if group:
            out.append(self._group(group))
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return _sigmoid(self.net.slope * self.logits(texts) + self.net.shift)

    def _group(self, group: list[list[bytes]]) -> np.ndarray:
        windows, owner = window_ids([len(w) for w in group], self._rows(group), STRIDE)
        worst = np.where([bool(words) for words in group], -np.inf, _NOTHING)
        windows, owner = windows[worst[owner] == -np.inf], owner[worst[owner] == -np.inf]
        for at in range(0, len(windows), _BATCH):
            np.maximum.at(worst, owner[at : at + _BATCH], self.net.run(self.table, windows[at : at + _BATCH]))
        return worst


class _Adam:
    def __init__(self, net: Network):
        self.net, self.count, self.chance = net, 0, np.random.default_rng(net.seed)
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}

    def move(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.count += 1
        for name, grad in grads.items():
            mean, square = self.moments[name]
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            size = np.sqrt(square / (1 - 0.99**self.count)) + 1e-6
            self.net.weights[name] -= (rate / (1 - 0.9**self.count) * mean / size).astype("float32")


def _shared(chosen: np.ndarray, share: float) -> np.ndarray:
    """``share`` dealt evenly over the chosen places."""
    return chosen * (share / max(1, int(chosen.sum())))


def _train_pass(
    net: Network, adam: _Adam, windows: np.ndarray, words: list[bytes], label: np.ndarray, cost: np.ndarray, rate: float
) -> None:
    """Once over the windows of any cost, in an order of chance."""
    order = adam.chance.permutation(np.flatnonzero(cost))
    cost = cost * (len(order) / cost.sum())
    for at in range(0, len(order), _TRAINED):
        chosen = order[at : at + _TRAINED]
        used, ids = np.unique(np.append(_PAD, windows[chosen]), return_inverse=True)
        if len(used) > 1:
            ids = ids[1:].reshape(len(chosen), -1)
            adam.move(net.step([words[i - 1] for i in used[1:]], ids, label[chosen], cost[chosen] / len(chosen)), rate)


def fit(
    texts: Sequence[str | None], labels: Sequence[int], toxic_share: float = 0.5, seed: int = 7, passes: tuple[int, int] = (2, 6)
) -> Network:
    """Train on texts labelled 0 or 1. Words found in three texts or more get vectors.

    Every fifth text is left out of training and serves to turn logits into probabilities, for
    a corpus in which ``toxic_share`` of the documents are toxic. With one class only, every
    score is near that class; without any text, 0.5.
    """
    label = np.array(labels, "int64")
    rest = np.arange(len(label)) % 5 == 4
    split = [tokens(t) for t, out in zip(texts, rest, strict=True) if not out]
    seen = Counter(w for words in split for w in set(words))
    net = Network({w: i + 2 for i, w in enumerate(sorted(w for w, n in seen.items() if n >= 3))}, seed=seed)
    if len(np.unique(label[~rest])) < 2:
        net.weights["out"][:] = 0
        net.weights["base"][:] = (6.0 if label[0] == 1 else -6.0) if len(label) else 0.0
        return net
    trained = label[~rest]
    words = sorted(seen)
    place = {w: i + 1 for i, w in enumerate(words)}
    windows, owner = window_ids(
        [len(t) for t in split], np.array([place[w] for text in split for w in text], "int64"), WINDOW
    )
    toxic, adam = trained[owner] == 1, _Adam(net)
    for number in range(sum(passes)):
        if number < passes[0]:
            cost = _shared(toxic, 0.5) + _shared(~toxic, 0.5)
        else:
            gates = net.gates(net.features(words)[0])
            logits = np.concatenate([net.run(gates, windows[i : i + _BATCH]) for i in range(0, len(windows), _BATCH)])
            order = np.lexsort((-logits, owner))
            worst = np.zeros(len(owner), bool)
            worst[order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))]] = True
            cost = _shared(toxic & worst, 0.5) + _shared(~toxic & worst, 0.25) + _shared(~toxic, 0.25)
        _train_pass(net, adam, windows, words, toxic.astype("int64"), cost, 0.02 if number < passes[0] else 0.01)
    _calibrate(net, [t for t, out in zip(texts, rest, strict=True) if out], label[rest], toxic_share)
    return net


def _calibrate(net: Network, texts: Sequence[str | None], label: np.ndarray, toxic_share: float) -> None:
    """Logistic regression of labels on logits, by Newton steps with a small ridge."""
    if len(np.unique(label)) < 2:
        return
    logit = Scorer(net).logits(texts)
    weight = np.where(label == 1, toxic_share / label.mean(), (1 - toxic_share) / (1 - label.mean()))
    x, beta = np.stack((logit, np.ones_like(logit)), axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(x @ beta)
        slope = x.T @ (weight * (p - label)) + 0.01 * (beta - (1, 0))
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(bend, slope), -2, 2)
    net.slope, net.shift = float(max(beta[0], 0.05)), float(beta[1])


def fit_on(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS, max_chars: int = FIT_CHARS) -> Network:
    """Fit on a bounded sample: of each class the first ``per_class`` rows of ``labels`` (doc_id,
    toxic) in hash order of their ids, with the ``docs`` of those ids that have a text of at most
    ``max_chars`` characters. Rows with other labels, or without id or text, teach nothing."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    classes = [known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id")).limit(per_class) for toxic in (0, 1)]
    picked = F.broadcast(classes[0].unionAll(classes[1]))  # 2 * per_class ids at most
    texts = docs.select("doc_id", "text").where(F.char_length("text") <= max_chars)
    sample = sorted(texts.join(picked, "doc_id").select("toxic", F.xxhash64("doc_id"), "text").collect())
    share = known.agg(F.avg("toxic").alias("share")).first()["share"]
    return fit([r["text"] for r in sample], [int(r["toxic"]) for r in sample], share if share is not None else 0.5)


def toxicity_udf(net: Network):
    """A column function: text to a score between 0 and 1, close to 0 if it has no words."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(net)
        for texts in parts:
            yield pd.Series(scorer.scores(list(texts)))

    return score


