"""Best-fit decreasing packing of token sequences.

Pieces of one length are alike, so the packing is decided on how many pieces each length has:
at most one number per length, whatever the number of documents. A segment tree over the
remaining capacities finds the tightest open bins in logarithmic time. The decision is a list
of moves; each piece finds its move, and so its bin and place, from its rank among the pieces
of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import store
from patronage.llm.tokens import Encoder

CAPACITY = 2048
END_ID = 0


class Move(NamedTuple):
    """Pieces of ``length`` with ranks from ``rank`` on go ``per_bin`` at a time into the bins
    from ``bin`` on, the first of a bin at ``offset``."""

    length: int
    rank: int
    bin: int
    per_bin: int
    offset: int


class OpenBins:
    """Intervals of bins by remaining capacity, under a segment tree of the capacities in use."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.width)
        self.bins: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _mark(self, room: int) -> None:
        node = room + self.width
        self.used[node] = bool(self.bins[room])
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] | self.used[2 * node + 1]

    def push(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.bins[room].append((first, count))
            self._mark(room)

    def pop(self, room: int) -> tuple[int, int]:
        taken = self.bins[room].pop()
        self._mark(room)
        return taken

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of an open bin that is ``least`` or more."""
        node = least + self.width
        if self.used[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.width:
            node = 2 * node + (not self.used[2 * node])
        return node - self.width


def best_fit_plan(counts: Mapping[int, int], capacity: int) -> list[Move]:
    """Moves that place ``counts[length]`` pieces of every length, longest first."""
    bins, moves, made = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, count = made, -(-left // (room // length))
                made += count
            else:
                first, count = bins.pop(room)
            per_bin = room // length  # what is left of a bin that took one piece is the tightest next
            full = min(count, left // per_bin)
            if full:
                moves.append(Move(length, rank, first, per_bin, capacity - room))
                bins.push(room - per_bin * length, first, full)
                rank, left = rank + full * per_bin, left - full * per_bin
            if left and full < count:
                moves.append(Move(length, rank, first + full, left, capacity - room))
                bins.push(room - left * length, first + full, 1)
                bins.push(room, first + full + 1, count - full - 1)
                left = 0
            else:
                bins.push(room, first + full, count - full)
    return moves


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (unsigned 32-bit, as bytes).

    A null text has no ids but ``end_id``. Only documents longer than ``capacity`` are cut; all
    of their pieces but the first are full. Rows without doc_id and repeated rows are cut too.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long, ids binary"
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks, pattern)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text) + end
                size = len(ids) // 4
                start, stop = 0, (size - 1) % capacity + 1
                for piece in range(-(-size // capacity)):
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(part), part if with_ids else None))
                    start, stop = stop, stop + capacity
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    pieces = docs.select("doc_id", "text").mapInArrow(cut, schema)
    return pieces if with_ids else pieces.drop("ids")


def rank_in_length(pieces: DataFrame, counts: Mapping[int, int]) -> DataFrame:
    """``pieces`` with ``rank``, 0, 1, ... among the rows of one length.

    A length's rows are dealt into as many buckets as the square root of their number, so no
    task holds more than that many rows of one length, nor more bucket totals.
    """
    by_bucket = Window.partitionBy("length", "bucket")
    place = F.create_map(*(F.lit(x) for item in counts.items() for x in (item[0], int(item[1] ** 0.5) + 1)))
    dealt = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), place[F.col("length")])
    )
    before = (
        dealt.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn(
            "before",
            F.sum("rows").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    )
    ranked = dealt.withColumn(
        "in_bucket", F.row_number().over(by_bucket.orderBy("doc_id", "piece", "ids_crc32")) - 1
    )
    return ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("in_bucket"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...) with ``sequence_id`` and ``offset``.

    ``pieces`` is stored once, counted by length, and ranked. The counts, one number per length
    up to ``capacity``, are all that the driver sees. An empty table stays empty.
    """
    names = pieces.columns
    stored, _ = store(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    if not counts:
        return stored.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    moves = sorted(best_fit_plan(counts, capacity))
    length, rank, first, per_bin, offset = (np.array(c, "int64") for c in zip(*moves, strict=True))
    shift = np.int64(max(counts.values()) + 1)
    starts = length * shift + rank

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size, at = frame["length"].to_numpy(), frame["rank"].to_numpy()
            move = np.searchsorted(starts, size * shift + at, side="right") - 1
            nth = at - rank[move]
            frame["sequence_id"] = first[move] + nth // per_bin[move]
            frame["offset"] = offset[move] + nth % per_bin[move] * size
            yield frame.drop(columns="rank")

    ranked = rank_in_length(stored, counts).select(*names, "rank")
    schema = ", ".join(f"`{n}` {t}" for n, t in stored.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInPandas(place, schema)


def sequences(pieces_with_ids: DataFrame, packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids``: the packed sequences themselves, at most one capacity each."""
    ids = pieces_with_ids.select("doc_id", "piece", "ids_crc32", "ids").dropDuplicates(["doc_id", "piece", "ids_crc32"])
    same = [packed[c].eqNullSafe(ids[c]) for c in ("doc_id", "piece", "ids_crc32")]
    placed = packed.join(ids, same)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )


