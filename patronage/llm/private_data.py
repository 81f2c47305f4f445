"""Personal data by weak supervision.

Strict spans (written as a fixed form) and looser candidates come from ``private_scan``. Five
labelers (form, checksum, gazetteer, words before, neighbouring characters) vote yes, no or
abstain on every candidate. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is and how likely each pattern is personal data. A logistic span
classifier per kind is trained on these probabilities and decides which candidates are added.

All corpus statistics are counts of (kind, votes, features) over all documents. They have a fixed
number of possible keys, so what reaches the driver does not grow with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import remove_folders, store
from patronage.llm.private_scan import (
    ABSTAIN,
    FEATURES,
    KINDS,
    LABELERS,
    N_FEATURES,
    N_VOTES,
    YES,
    candidates,
)

#: A labeler is taken to be better than chance, and never certain.
LEAST_RELIABLE, MOST_RELIABLE = 0.55, 0.99
#: Votes that every labeler is given beforehand, and the share of them that is right; what fails
#: its checksum is hardly ever a valid number.
PRIOR_VOTES = 8.0
PRIOR_RIGHT = (0.75, 0.95, 0.75, 0.75, 0.75)
ROUNDS = 200
#: Candidates at least this likely are added.
CUT = 0.5

_COUNTS = "kind int, votes int, features int, n long"
SPANS = "array<struct<kind: string, start: int, end: int>>"


@dataclass(frozen=True)
class Reliabilities:
    """Of one kind: the share of personal data, and per labeler how often it says yes to personal
    data and no to other things, when it votes."""

    share: float
    hits: np.ndarray
    rejections: np.ndarray


def unpack(votes: np.ndarray) -> np.ndarray:
    """Vote patterns as rows of votes, in the order of ``LABELERS``."""
    powers = 3 ** np.arange(len(LABELERS) - 1, -1, -1)
    return votes[:, None] // powers % 3


def posterior(table: np.ndarray, found: Reliabilities) -> np.ndarray:
    """Probability of personal data for each row of votes; the share alone if all abstain."""
    yes, no = table == YES, (table != YES) & (table != ABSTAIN)
    true = np.log(found.share) + yes @ np.log(found.hits) + no @ np.log(1 - found.hits)
    false = np.log(1 - found.share) + yes @ np.log(1 - found.rejections) + no @ np.log(found.rejections)
    return 1 / (1 + np.exp(np.clip(false - true, -700, 700)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Reliabilities:
    """Expectation-maximisation for one kind, over vote patterns and how often they occur.

    Reliabilities stay between LEAST_RELIABLE and MOST_RELIABLE, which rules out the mirrored
    solution. Without candidates, the values given beforehand are returned.
    """
    table, n = unpack(votes), counts.astype("float64")
    yes, voted = (table == YES).astype("float64"), (table != ABSTAIN).astype("float64")
    prior = np.array(PRIOR_RIGHT)
    found = Reliabilities(0.5, prior, prior)
    for _ in range(rounds):
        likely = posterior(table, found)
        true, false = n * likely, n * (1 - likely)
        hits = (true @ yes + prior * PRIOR_VOTES) / (true @ voted + PRIOR_VOTES)
        rejections = (false @ (voted - yes) + prior * PRIOR_VOTES) / (false @ voted + PRIOR_VOTES)
        new = Reliabilities(
            float(np.clip((true.sum() + 1) / (n.sum() + 2), 0.001, 0.999)),
            np.clip(hits, LEAST_RELIABLE, MOST_RELIABLE),
            np.clip(rejections, LEAST_RELIABLE, MOST_RELIABLE),
        )
        moved = max(abs(new.share - found.share), *np.abs(new.hits - found.hits), *np.abs(new.rejections - found.rejections))
        found = new
        if moved < 1e-10:
            break
    return found


def _design(features: np.ndarray) -> np.ndarray:
    bits = features[:, None] >> np.arange(len(FEATURES)) & 1
    return np.concatenate((np.ones((len(features), 1)), bits), axis=1).astype("float64")


def train(features: np.ndarray, likely: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic classifier on feature bits, by Newton steps with backtracking; each
    row is ``counts`` spans of mean probability ``likely``."""
    x, n = _design(features), counts.astype("float64")
    weights = np.zeros(x.shape[1])
    scale = n.sum() or 1.0
    penalty = np.full(x.shape[1], ridge / scale)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n / scale) @ (np.logaddexp(0, z) - likely * z) + 0.5 * penalty @ w**2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        slope = x.T @ (n / scale * (p - likely)) + penalty * weights
        bend = (x * (n / scale * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        size, before = 1.0, loss(weights)
        while size > 1e-6 and loss(weights - size * step) > before:
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return weights


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities and classifier weights by kind; kinds without candidates are left out."""

    reliabilities: dict[str, Reliabilities]
    weights: dict[str, np.ndarray]

    def accepted(self, cut: float = CUT) -> frozenset[tuple[int, int]]:
        """All (kind, features) whose candidates are personal data."""
        every = np.arange(N_FEATURES)
        return frozenset(
            (KINDS.index(kind), int(f))
            for kind, w in self.weights.items()
            for f in every[1 / (1 + np.exp(-np.clip(_design(every) @ w, -50, 50))) >= cut]
        )


def count_patterns(docs: DataFrame) -> DataFrame:
    """How often each (kind, votes, features) occurs among the candidates of all texts. Tasks add
    up their own before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update((c.kind, c.votes, c.features) for c in candidates(text))
        columns = list(zip(*((*key, n) for key, n in seen.items()), strict=True)) or [(), (), (), ()]
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["kind", "votes", "features", "n"]
        )

    counted = docs.where("text is not null").select("text").mapInArrow(count, _COUNTS)
    return counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> SpanModel:
    """Learn from the candidates of all rows of ``docs`` (text). One pass over the texts.

    At most len(KINDS) * N_VOTES pattern counts reach the driver, and len(KINDS) * N_FEATURES
    rows of training data, both whatever the size of the corpus.
    """
    spark = docs.sparkSession
    patterns, folder = store(count_patterns(docs), "private-patterns")
    votes = patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")).toPandas()
    assert len(votes) <= len(KINDS) * N_VOTES
    reliabilities, rows = {}, []
    for kind, part in votes.sort_values(["kind", "votes"]).groupby("kind"):
        found = estimate(part["votes"].to_numpy(), part["n"].to_numpy())
        reliabilities[KINDS[kind]] = found
        likely = posterior(unpack(part["votes"].to_numpy()), found)
        rows += [(int(kind), int(v), float(p)) for v, p in zip(part["votes"], likely, strict=True)]
    by_votes = F.broadcast(spark.createDataFrame(rows, "kind int, votes int, likely double"))
    examples = patterns.join(by_votes, ["kind", "votes"]).groupBy("kind", "features")
    table = examples.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("likely")) / F.sum("n")).alias("likely")).toPandas()
    remove_folders(spark, [folder])
    weights = {
        KINDS[kind]: train(part["features"].to_numpy(), part["likely"].to_numpy(), part["n"].to_numpy())
        for kind, part in table.sort_values(["kind", "features"]).groupby("kind")
    }
    return SpanModel(reliabilities, weights)


def spans_of(text: str | None, accepted: frozenset[tuple[int, int]]) -> tuple[list, list]:
    """Strict spans, and all spans, as (kind, start, end) by kind as in ``KINDS`` and then start."""
    found = sorted(candidates(text), key=lambda c: c[:3])
    strict = [(KINDS[c.kind], c.start, c.end) for c in found if c.strict]
    return strict, [(KINDS[c.kind], c.start, c.end) for c in found if c.strict or (c.kind, c.features) in accepted]


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; of spans that overlap,
    one bracket with the kind that starts first."""
    if text is None:
        return None
    parts, done, shown = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= shown:
            parts += [text[done:start], f"<{kind}>"]
        done = shown = max(shown, end)
    return "".join([*parts, text[done:]])


def private_udf(model: SpanModel, mask: bool = False):
    """A column function: text to a struct of strict spans, all spans and, if asked for, the
    masked text."""
    accepted = model.accepted()
    schema = f"strict {SPANS}, spans {SPANS}" + (", masked string" if mask else "")

    @F.pandas_udf(schema)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            strict, spans = spans_of(text, accepted)
            rows.append((strict, spans, masked(text, spans)) if mask else (strict, spans))
        return pd.DataFrame(rows, columns=["strict", "spans", "masked"][: 3 if mask else 2])

    return find


def find_private(docs: DataFrame, model: SpanModel | None = None, mask: bool = False) -> DataFrame:
    """``doc_id`` and a struct ``private``: strict spans, all spans and, with ``mask``, the text
    with all spans masked. One row for each row of ``docs``.

    Two passes over the texts (one with a given ``model``), without a shuffle of them. Null and
    empty texts have no spans (the masked text of null is null); repeated rows, null ids and other
    columns, whatever their names, do not matter; an empty table gives an empty one. A task holds
    one batch of texts and the spans found in it, and each scan is linear, so very long texts cost
    what their length says. Equal starts are ordered by kind.
    """
    model = fit(docs) if model is None else model
    return docs.select("doc_id", private_udf(model, mask)(F.col("text")).alias("private"))
