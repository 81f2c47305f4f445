"""Exact quantiles whose memory is bounded whatever the number of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.session import cut_lineage

ACCURACY = 10_000
# values a last step may sort, per wanted rank; no result depends on it
PICK_ROWS = 20_000


@dataclass
class _Search:
    """Looking for the ``rank``-th value (from 0) of ``column`` strictly between two bounds."""

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def inside(self) -> Column:
        value = F.col(self.column)
        keep = value.isNotNull()
        if self.low is not None:
            keep = keep & (value > F.lit(self.low))
        if self.high is not None:
            keep = keep & (value < F.lit(self.high))
        return keep


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], pick_rows: int = PICK_ROWS
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, NULLs and NaNs skipped.

    Each wanted order statistic is bracketed by a sketch with a known rank error, the values
    outside the bracket are counted, and the search goes on inside it until ``pick_rows``
    values or fewer are left to sort; a round keeps well under a thousandth of the rows, and
    a value that is repeated any number of times becomes a bound and is counted, not kept.
    Order statistics are exact, and there is one formula for all sizes. Only counts and bounds
    reach the driver. The columns are stored first, as they are read at least twice and may be
    the end of a long plan.
    """
    values = cut_lineage(
        df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    )
    counts = values.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    positions = {c: [p * (counts[c] - 1) for p in probs] for c in columns if counts[c]}
    ranks = {(c, r) for c, places in positions.items() for x in places for r in (math.floor(x), math.ceil(x))}
    found = _order_statistics(values, sorted(ranks), counts, pick_rows)
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for c, places in positions.items():
        pairs = [(found[c, math.floor(x)], found[c, math.ceil(x)], x - math.floor(x)) for x in places]
        result[c] = [below + (above - below) * part for below, above, part in pairs]
    return result


def _order_statistics(
    values: DataFrame, ranks: Sequence[tuple[str, int]], counts: dict[str, int], pick_rows: int
) -> dict[tuple[str, int], float]:
    searches = {(c, r): _Search(c, r, counts[c]) for c, r in ranks}
    open_searches = list(searches.values())
    while open_searches:
        final = [s for s in open_searches if s.rows <= pick_rows]
        if final:
            _pick(values, final)
        open_searches = [s for s in open_searches if s.answer is None]
        if open_searches:
            _narrow(values, open_searches)
        open_searches = [s for s in open_searches if s.answer is None]
    return {key: s.answer for key, s in searches.items()}


def _pick(values: DataFrame, searches: Sequence[_Search]) -> None:
    """Few enough rows are left: sort them and take the wanted one."""
    picks = [
        F.get(F.sort_array(F.collect_list(F.when(s.inside(), F.col(s.column)))), F.lit(s.rank)).alias(f"s{i}")
        for i, s in enumerate(searches)
    ]
    row = values.agg(*picks).first()
    for i, s in enumerate(searches):
        s.answer = row[f"s{i}"]


def _narrow(values: DataFrame, searches: Sequence[_Search]) -> None:
    """One round: new bounds from a sketch, then exact counts around them."""
    brackets = []
    for i, s in enumerate(searches):
        margin = 2.0 / ACCURACY
        at = (s.rank + 0.5) / s.rows
        wanted = F.array(F.lit(max(0.0, at - margin)), F.lit(min(1.0, at + margin)))
        inside = F.when(s.inside(), F.col(s.column))
        brackets.append(F.percentile_approx(inside, wanted, ACCURACY).alias(f"s{i}"))
    bounds = values.agg(*brackets).first()

    tallies = []
    for i, s in enumerate(searches):
        low, high = bounds[f"s{i}"]
        v = F.col(s.column)
        tallies += [
            F.count_if(s.inside() & (v < low)).alias(f"below{i}"),
            F.count_if(s.inside() & (v == low)).alias(f"low{i}"),
            F.count_if(s.inside() & (v > low) & (v < high)).alias(f"mid{i}"),
            F.count_if(s.inside() & (v == high)).alias(f"high{i}"),
        ]
    tally = values.agg(*tallies).first()
    for i, s in enumerate(searches):
        low, high = bounds[f"s{i}"]
        below = tally[f"below{i}"]
        upto_low = below + tally[f"low{i}"]
        upto_mid = upto_low + tally[f"mid{i}"]
        upto_high = upto_mid + (tally[f"high{i}"] if high > low else 0)
        if s.rank < below:
            s.high, s.rows = low, below
        elif s.rank < upto_low:
            s.answer = low
        elif s.rank < upto_mid:
            s.low, s.high, s.rank, s.rows = low, high, s.rank - upto_low, upto_mid - upto_low
        elif s.rank < upto_high:
            s.answer = high
        else:
            s.low, s.rank, s.rows = high, s.rank - upto_high, s.rows - upto_high
