"""Packing documents into sequences: cutting stock by column generation.

Documents are cut at multiples of the sequence length; what remains of each has
some length below it, so the histogram of lengths has at most 4096 rows, whatever
the size of the corpus. Lengths are rounded up to a unit of 1 to 16 tokens, which is 16
only if that costs under 0.5 % of padding, and gathered into at most 256 sizes, each the largest
length in it, chosen by the histogram so that little is lost: short texts keep their exact lengths. A pattern says how many pieces of each size share a
sequence. The linear program over patterns, whose columns are found by a knapsack
dynamic program over the sizes' dual prices, is solved to within `GAP` of its optimum
and rounded down; what is left over, less than one sequence for each pattern, is
filled largest first.

Pieces are ranked within their size, in shares that are counted first, so no task
ranks a size by itself. A rank says which sequence of which pattern a piece is in.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections import Counter, OrderedDict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from matchledger.llm.common import TAG, Scratch, table, tagged

SEQUENCE = 4_096
GRID = 16
#: By how much the linear program may stay above its optimum, as a share of it.
GAP = 1e-3
MOST_ROUNDS = 400
#: Lengths are counted in the largest unit, up to the grid, that adds no more padding than this share of the tokens.
ROUNDING = 0.005
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
KEPT_WORDS = 250_000


# tokens ------------------------------------------------------------------------

#: Texts whose words are remembered: blanks, ASCII and Latin letters, without the one that lower case makes two of.
_LATIN = re.compile("[\t\n -~\u00a1-\u012f\u0131-\u024f]*")
#: What the vocabulary takes as a word, for lower-cased texts of that kind.
_LETTERS, _NUMBERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ \t\n{_LETTERS}{_NUMBERS}]+")


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Recent(dict):
    """Values by key, made when first asked for: two generations, the older of which goes when the younger is full."""

    def __init__(self, make: Callable[[str], bytes], bound: int):
        super().__init__()
        self._make, self._bound, self._old = make, bound, {}

    def __missing__(self, key: str) -> bytes:
        found = self._old.get(key)
        if found is None:
            found = self._make(key)
        self[key] = found
        return found

    def trim(self) -> None:
        if len(self) > self._bound:
            self._old = dict(self)
            self.clear()


class WordIds:
    """Ids of texts. The vocabulary lower-cases a text, parts it into words and encodes each by itself, so in
    texts of Latin letters each distinct word is encoded once while it is remembered; others are encoded whole."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._model, self._letters = self._tokenizer.model, _byte_letters()
        self._words = Recent(self._encode, KEPT_WORDS)

    def _encode(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join([self._letters[b] for b in word.encode()])
        ids = [t.id for t in self._model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        """The ids of a text, as little-endian 32-bit numbers."""
        if not _LATIN.fullmatch(text) or "<|" in text:
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self._words.trim()
        return b"".join(map(self._words.__getitem__, _PARTS.findall(text.lower())))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One store for a worker, over all its tasks."""
    return WordIds(path)


def cut_documents(
    docs: DataFrame, vocabulary: str | None = None, length: int = SEQUENCE, end_id: int = END_ID, compressed: bool = False
) -> DataFrame:
    """(doc_id, _tag, start, length, ids, doc_tokens, ids_crc32): each document's ids and a closing one, cut into pieces.

    ids: little-endian 32-bit numbers, compressed by zstd if asked for. NULL text counts as empty, so every row has
    a piece. `vocabulary` is a file that every executor has at that path.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = tagged(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")), "doc_id", "_text")
    out = rows.select(
        "doc_id", TAG, F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
        F.lit(b"").alias("ids"), F.lit(0).cast("long").alias("doc_tokens"), F.lit(0).cast("long").alias("ids_crc32"),
    ).schema
    end = np.array([end_id], "<u4").tobytes()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        for batch in batches:
            found = [encode(text) + end for text in batch.column("_text").to_pylist()]
            owner, starts, pieces = [], [], []
            for i, ids in enumerate(found):
                for start in range(0, len(ids), 4 * length):
                    owner.append(i)
                    starts.append(start // 4)
                    pieces.append(ids[start : start + 4 * length])
            at = pa.array(owner, pa.int64())
            sizes, sums = [len(p) // 4 for p in pieces], [zlib.crc32(p) for p in pieces]
            if compressed:
                pieces = [pa.compress(p, codec="zstd", asbytes=True) for p in pieces]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at), batch.column(TAG).take(at), pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(pieces, pa.binary()),
                    pa.array([len(found[i]) // 4 for i in owner], pa.int64()), pa.array(sums, pa.int64()),
                ],
                out.names,
            )

    return rows.mapInArrow(of_batches, out)


def _expanded(pieces: DataFrame) -> DataFrame:
    """The pieces with their `ids` as they were before they were compressed; `length` says how many there are."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist(), strict=True)
            ids = [pa.decompress(packed, 4 * n, codec="zstd", asbytes=True) for packed, n in both]
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

    return pieces.mapInArrow(of_batches, pieces.schema)


# patterns ----------------------------------------------------------------------


def unit_of(histogram: dict[int, int], grid: int) -> int:
    """The largest halving of `grid` to which lengths can be rounded up for at most `ROUNDING` of padding, or 1."""
    tokens = sum(each * n for each, n in histogram.items())
    while grid > 1 and (grid % 2 or sum(-each % grid * n for each, n in histogram.items()) > ROUNDING * tokens):
        grid = grid // 2 if grid % 2 == 0 else 1
    return grid


def size_of_lengths(histogram: dict[int, int], most: int) -> dict[int, int]:
    """The size that each length is rounded up to, `most` sizes at most.

    Every length is a size at first; then, again and again, that size goes to the next larger one that adds the
    fewest tokens of padding by it.
    """
    lengths = np.array(sorted(histogram), np.int64)
    tops, pieces = lengths.copy(), np.array([histogram[int(x)] for x in lengths], np.int64)
    while len(tops) > most:
        k = int((np.diff(tops) * pieces[:-1]).argmin())
        pieces[k + 1] += pieces[k]
        tops, pieces = np.delete(tops, k), np.delete(pieces, k)
    return dict(zip(lengths.tolist(), tops[np.searchsorted(tops, lengths)].tolist(), strict=True))


def _priced(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack: the dearest pattern, as the number of pieces of each size.

    Size by size, and for each in powers of two, so that a step improves all rooms at once.
    """
    best = np.zeros(capacity + 1)
    added, copies = np.full(capacity + 1, -1, np.int64), np.zeros(capacity + 1, np.int64)
    for i in np.argsort(-prices / sizes, kind="stable").tolist():
        price, size, many = float(prices[i]), int(sizes[i]), 1
        while price > 0 and size * many <= capacity:
            value = best[: capacity + 1 - size * many] + price * many
            better = np.flatnonzero(value > best[size * many :] + 1e-12)
            if not len(better):
                break
            rooms = better + size * many
            best[rooms], added[rooms], copies[rooms] = value[better], i, many
            many *= 2
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while added[room] >= 0:
        i, many = int(added[room]), int(copies[room])
        pattern[i] += many
        room -= many * int(sizes[i])
    return float(best[capacity]), pattern


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Their product, made without the threads of a linear algebra library, which hung in a driver."""
    return (matrix * vector).sum(axis=1)


def _exchanged(inverse: np.ndarray, change: np.ndarray, leaves: int) -> None:
    """The inverse of a basis after a column with these coefficients took the place of column `leaves`."""
    row = inverse[leaves] / change[leaves]
    inverse -= np.outer(change, row)
    inverse[leaves] = row


def _first_basis(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns filled largest first, each used until a size runs out, which later ones do without; and their inverse.

    A pattern is the column of the size that it uses up, so the basis is triangular but for the order of its columns.
    """
    n, left = len(sizes), wanted.astype(float)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    here = list(range(n - 1, -1, -1))
    for _ in range(n):
        room, pattern = capacity, np.zeros(n)
        for i in here:
            pattern[i] = room // sizes[i]
            room -= int(pattern[i]) * int(sizes[i])
        held = np.flatnonzero(pattern)
        times = left[held] / pattern[held]
        gone = int(held[times.argmin()])
        left[held] -= times.min() * pattern[held]
        here.remove(gone)
        basis[:, gone] = pattern
        _exchanged(inverse, _times(inverse, pattern), gone)
    return basis, inverse


def fractional_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, most_rounds: int = MOST_ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, by the revised simplex method.

    Prices divided by the value of the dearest pattern are feasible, so the optimum is at least what is used now divided
    by that value: the method ends once that is within `GAP`, or with the patterns it has after `most_rounds`.
    """
    n, total = len(sizes), float(demand.sum())
    wanted = demand / total
    basis, inverse = _first_basis(sizes, wanted, capacity)
    used = np.maximum(_times(inverse, wanted), 0)
    for _ in range(most_rounds):
        value, pattern = _priced(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + GAP:
            break
        change = _times(inverse, pattern)
        ratio = np.full(n, np.inf)
        np.divide(used, change, out=ratio, where=change > 1e-9)
        leaves = int(ratio.argmin())
        if not np.isfinite(ratio[leaves]):
            break
        basis[:, leaves] = pattern
        _exchanged(inverse, change, leaves)
        used = np.maximum(_times(inverse, wanted), 0)
    return basis.astype(np.int64), used * total


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(number of sequences, {size: pieces of it in each})] that together hold every piece of the histogram."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], np.int64)
    columns, used = fractional_patterns(sizes, left.astype(float), capacity)
    plan: list[tuple[int, dict[int, int]]] = []
    for k in np.argsort(-used, kind="stable"):
        pattern = columns[:, k]
        held = pattern > 0
        times = min(int(used[k] + 1e-6), int((left[held] // pattern[held]).min()))
        if times > 0:
            plan.append((times, {int(sizes[i]): int(pattern[i]) for i in np.nonzero(held)[0]}))
            left = left - times * pattern
    return plan + _largest_first(sizes, left, capacity)


def _largest_first(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """The pieces that rounding left over, sequence by sequence, the largest that fits next."""
    left, plan = left.copy(), []
    while left.any():
        room, pattern = capacity, OrderedDict()
        for i in range(len(sizes) - 1, -1, -1):
            fits = min(int(left[i]), room // int(sizes[i]))
            if fits:
                pattern[int(sizes[i])] = fits
                room -= fits * int(sizes[i])
        times = min(int(left[np.searchsorted(sizes, s)]) // n for s, n in pattern.items())
        for s, n in pattern.items():
            left[np.searchsorted(sizes, s)] -= times * n
        plan.append((times, dict(pattern)))
    return plan


# assignment --------------------------------------------------------------------


def assign_sequences(pieces: DataFrame, scratch: Scratch, length: int = SEQUENCE, grid: int = GRID) -> DataFrame:
    """The pieces with their sequence_id and offset; pieces: _tag, start, length and any other columns.

    The pieces should be a staged table, as they are read for the histogram, the
    counts of the shares, and the result. There are as many sizes as `grid` goes into `length`, at most.
    """
    if length % grid:
        raise ValueError("the grid must divide the sequence length")
    spark = pieces.sparkSession
    # At most a row for each length up to that of a sequence.
    by_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    unit = unit_of(by_length, grid)
    in_units: Counter[int] = Counter()
    for each, n in by_length.items():
        in_units[-(-each // unit)] += n
    tops = size_of_lengths(in_units, length // grid)
    sizes = {each: tops[-(-each // unit)] for each in by_length}
    histogram: Counter[int] = Counter()
    for each, n in by_length.items():
        histogram[sizes[each]] += n
    named = spark.createDataFrame(list(sizes.items()), "length long, _size int")
    sized = pieces.join(F.broadcast(named), "length")
    # As many shares as keep both a share of a size and the list of a size's shares short.
    shares = max(1, math.isqrt(sum(histogram.values())) // 4)
    sized = sized.withColumn("_share", F.pmod(F.xxhash64(TAG, "start"), F.lit(shares)).cast("int"))

    rows, first, taken = [], 0, dict.fromkeys(histogram, 0)
    for times, pattern in plan_sequences(histogram, length // unit):
        for size, each in pattern.items():
            rows.append((size, taken[size], taken[size] + times * each, each, first))
            taken[size] += times * each
        first += times
    # At most a row for each size and pattern, and there are about as many patterns as sizes.
    ranges = spark.createDataFrame(rows, "_size int, _from long, _to long, _each long, _first long")

    counts = sized.groupBy("_size", "_share").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_size").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_size", "_share", F.coalesce(before, F.lit(0)).alias("_before"))
    in_share = F.row_number().over(Window.partitionBy("_size", "_share").orderBy(TAG, "start"))
    ranked = sized.withColumn("_rank", in_share - 1).join(offsets, ["_size", "_share"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_share")
    held = ranked.alias("p").join(
        F.broadcast(ranges).alias("r"),
        F.expr("p._size = r._size and p._rank >= r._from and p._rank < r._to"),
    )
    placed = held.select(
        "p.*", (F.col("r._first") + F.floor((F.col("p._rank") - F.col("r._from")) / F.col("r._each"))).alias("sequence_id")
    )
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("_size"), "_rank")
    offset = F.sum("length").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(offset, F.lit(0))).drop("_size", "_rank")


def pack(docs: DataFrame, scratch: Scratch, vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """All documents in sequences of at most 4096 ids: the pieces, with their ids or only a checksum of them.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    ids if asked for. Each sequence is filled without gaps from offset 0. Equal
    rows are packed like any others; an empty table gives no pieces.
    """
    cut = cut_documents(docs, vocabulary, compressed=with_ids)
    pieces = scratch.stage(cut if with_ids else cut.drop("ids"), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not with_ids:
        return assign_sequences(pieces, scratch).select(*columns)
    # Ids are heavy: they are moved once, compressed, to where the places of their pieces are known.
    placed = scratch.stage(assign_sequences(pieces.select(TAG, "start", "length"), scratch), "placed")
    return _expanded(pieces.join(placed.drop("length"), [TAG, "start"]).select(*columns, "ids"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Scratch(spark), with_ids=False)
