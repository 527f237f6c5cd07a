"""Packing whole documents into few sequences: a configuration program by multiplicative weights.

Only documents longer than a sequence are cut, so lengths are what they are, and all the
planner needs is their histogram: at most a row for each length up to that of a sequence,
whatever the corpus. A configuration says how many pieces of each length share a sequence.

The linear program asks for the fewest sequences whose configurations cover the histogram.
Multiplicative weights solve it: a length's price, its size at first, falls with the part of its
demand that is covered already, a knapsack dynamic program over the prices finds the dearest configuration
around each length, and those near the best are all taken a step further, until everything
is covered. Uses are rounded down and the rest is planned again, as long as that fills
sequences; what remains in the end, some pieces of each length, is packed by best fit: the
largest piece, then the pieces that leave the least room beside it.

Pieces are ranked within their length, in shares that are counted first, so no task ranks a
length by itself. A rank says which sequence a piece is in, and where.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchledger.llm.common import TAG, Scratch, table
from matchledger.llm.packing import cut_documents

SEQUENCE = 2_048
END_ID = 0
#: Of a round's best price, what a configuration must reach to be used; how far a round goes, as a part of the
#: demand; how steeply prices fall with what is covered; rounds at most.
NEAR_BEST = 0.97
STEP = 0.05
STEEPNESS = 50.0
MOST_ROUNDS = 60
#: Configurations of a round, at most: those around the lengths that are covered least.
ROUND_CONFIGURATIONS = 128
#: How often the rest is planned anew; what is left then goes by best fit.
MOST_PHASES = 5

#: (how many sequences, {length: pieces of it in each})
Configuration = tuple[int, dict[int, int]]


# planning ----------------------------------------------------------------------


def dearest(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack: for each room up to `capacity`, the best price and which size the best filling has next (-1: none)."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(int(sizes[0]), capacity + 1):
        n = fitting[room]
        value = prices[:n] + best[room - sizes[:n]]
        k = int(value.argmax())
        best[room], taken[room] = value[k], k
    return best, taken


def _around(which: np.ndarray, taken: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A row for each size in `which`: the pieces of each size in the dearest configuration that holds it."""
    rows = np.arange(len(which))
    found = np.zeros((len(which), len(sizes)), np.int64)
    found[rows, which] = 1
    room = capacity - sizes[which]
    while len(rows):
        k = taken[room]
        rows, room, k = rows[k >= 0], room[k >= 0], k[k >= 0]
        found[rows, k] += 1
        room = room - sizes[k]
    return found


def covering(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (rows) and how often each is used, so that about all of the demand is covered."""
    covered = np.zeros(len(sizes))
    found: dict[bytes, list] = {}
    for _ in range(MOST_ROUNDS):
        prices = sizes * np.exp(-STEEPNESS * (covered - covered.min()))
        best, taken = dearest(prices, sizes, capacity)
        value = prices + best[capacity - sizes]
        near = np.nonzero((value >= NEAR_BEST * value.max()) & (covered < 1))[0]
        if not len(near):
            break
        near = near[np.argsort(covered[near], kind="stable")[:ROUND_CONFIGURATIONS]]
        rows = _around(near, taken, sizes, capacity)
        each = demand[near] * (1 - covered[near]) / rows[np.arange(len(near)), near]
        gained = each @ rows / demand
        scale = min(1.0, STEP / gained.max())
        covered += scale * gained
        for row, times in zip(rows, scale * each, strict=True):
            found.setdefault(row.tobytes(), [row, 0.0])[1] += times
        if covered.min() >= 1:
            break
    return np.array([row for row, _ in found.values()]), np.array([times for _, times in found.values()])


def best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[Configuration]:
    """Sequences for the pieces left: the largest of them, and those that leave the least room beside it."""
    left, plan = left.copy(), []
    while left.any():
        first = int(np.nonzero(left)[0][-1])
        chosen = {first: 1}
        left[first] -= 1
        room = capacity - int(sizes[first])
        # Sums that pieces make, as bits; one step for each length and power of two of its pieces.
        sums, steps, full = 1, [], (1 << (room + 1)) - 1
        for i in np.nonzero(left[: np.searchsorted(sizes, room, side="right")])[0][::-1].tolist():
            size, many, power = int(sizes[i]), min(int(left[i]), room // int(sizes[i])), 1
            while many:
                n = min(power, many)
                steps.append((i, n, sums))
                sums |= (sums << (n * size)) & full
                many, power = many - n, power * 2
            if sums >> room & 1:
                break
        at = sums.bit_length() - 1
        for i, n, before in reversed(steps):
            if not before >> at & 1:
                chosen[i] = chosen.get(i, 0) + n
                at -= n * int(sizes[i])
        left[first] += 1
        times = min(int(left[i]) // n for i, n in chosen.items())
        for i, n in chosen.items():
            left[i] -= times * n
        plan.append((times, {int(sizes[i]): n for i, n in chosen.items()}))
    return plan


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[Configuration]:
    """Configurations that together hold every piece of the histogram exactly once."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], np.int64)
    plan: list[Configuration] = []
    for _ in range(MOST_PHASES):
        held = np.nonzero(left)[0]
        if left.sum() <= 4 * len(held):
            break
        rows, used = covering(sizes[held], left[held].astype(float), capacity)
        gone = 0
        for k in np.argsort(-used, kind="stable"):
            own = np.nonzero(rows[k])[0]
            times = min(int(used[k] + 1e-6), int((left[held[own]] // rows[k][own]).min()))
            if times > 0:
                plan.append((times, {int(sizes[held[i]]): int(rows[k][i]) for i in own}))
                left[held[own]] -= times * rows[k][own]
                gone += times
        if not gone:
            break
    return plan + best_fit(sizes, left, capacity)


# assignment --------------------------------------------------------------------


def ranked(pieces: DataFrame, size: str, total: int) -> DataFrame:
    """`pieces` with `_rank`, from 0 without gaps among those of a size.

    As many shares of a size are ranked apart as keep both a share and the list of shares short.
    """
    shares = max(1, math.isqrt(total) // 4)
    shared = pieces.withColumn("_share", F.pmod(F.xxhash64(TAG, "start"), F.lit(shares)).cast("int"))
    counts = shared.groupBy(size, "_share").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(size).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(size, "_share", F.coalesce(before, F.lit(0)).alias("_before"))
    in_share = F.row_number().over(Window.partitionBy(size, "_share").orderBy(TAG, "start"))
    out = shared.withColumn("_rank", in_share - 1).join(offsets, [size, "_share"])
    return out.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_share")


class Places:
    """Where the piece of some length and rank goes, by a plan."""

    def __init__(self, plan: list[Configuration]):
        parts: dict[int, list[tuple[int, int, int, int]]] = {}
        first, taken = 0, {}
        for times, configuration in plan:
            offset = 0
            for size, each in configuration.items():
                start = taken.get(size, 0)
                parts.setdefault(size, []).append((start, each, first, offset))
                taken[size] = start + times * each
                offset += size * each
            first += times
        self._parts = {size: np.array(rows, np.int64).T for size, rows in parts.items()}

    def __call__(self, size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each rank."""
        starts, each, first, offset = self._parts[size]
        k = np.searchsorted(starts, ranks, side="right") - 1
        turn, slot = np.divmod(ranks - starts[k], each[k])
        return first[k] + turn, offset[k] + slot * size


def assign_sequences(pieces: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """(_tag, start, sequence_id, offset) of each piece; pieces: a staged table of _tag, start and length, 1 to `length`."""
    sized = pieces.select(TAG, "start", "length")
    histogram = {r["length"]: r["n"] for r in sized.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # A row for each length of each configuration: bounded by the rounds of the planner, not by the corpus.
    shared = pieces.sparkSession.sparkContext.broadcast(Places(plan_sequences(histogram, length)))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            for at in np.split(order, np.nonzero(np.diff(size[order]))[0] + 1):
                if len(at):
                    sequence[at], offset[at] = shared.value(int(size[at[0]]), rank[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(TAG), batch.column("start"), pa.array(sequence), pa.array(offset)], [TAG, "start", "sequence_id", "offset"]
            )

    rows = ranked(sized, "length", sum(histogram.values()))
    return rows.mapInArrow(of_batches, f"{TAG} long, start long, sequence_id long, offset long")


def pack_whole(
    docs: DataFrame, scratch: Scratch, vocabulary: str | None = None, length: int = SEQUENCE, with_ids: bool = True
) -> DataFrame:
    """All documents in few sequences of at most `length` ids, uncut where they fit in one.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids if asked
    for. A document is its ids and a closing one, so NULL and empty texts have a piece of
    one id; a longer one is cut into pieces of `length` and a rest. A sequence is filled
    without gaps from offset 0. Equal rows are packed like any others, ids of documents may
    be NULL or repeat, other columns are not looked at; an empty table gives no pieces.
    """
    cut = cut_documents(docs, vocabulary, length, END_ID)
    cut = cut.withColumn("piece", (F.col("start") / length).cast("int"))
    pieces = scratch.stage(cut if with_ids else cut.drop("ids"), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pieces.join(assign_sequences(pieces, length), [TAG, "start"]).select(*columns, *["ids"] * with_ids)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_whole(table(spark, sf_dir, "documents"), Scratch(spark), with_ids=False)
