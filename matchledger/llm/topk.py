"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into m segments. In round r, every query whose answer is not
settled looks up, in each segment, the keys at distance exactly r from its
own. After round r all codes within m * (r + 1) - 1 bits have been met: a code
farther than r in every segment differs in at least m * (r + 1) bits. So a query
is settled once its k-th verified distance is no larger.

m follows from the number of codes, so that a key holds about one: few segments
for many codes. Equal codes are one entry with its k smallest ids, equal query codes
are one query. A code that several segments or rounds would fetch is taken only
at the smallest of its segment distances, and there in the first segment.

A segment's table is dealt out by the leading bits of the key, and within them in
chunks of bounded size, whatever the codes. A query goes only to the parts that
its ball of the round reaches, and there changes the other bits by what the
leading bits leave of the radius. So the lookups of a part are made within
tasks, over arrays, and what leaves a task is k codes for each query at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce
from itertools import combinations
from math import comb, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchledger.llm.common import Scratch, table

BITS = 64
#: The multiplier that the signs of components after the 64th come from.
TURN = 40_503
NEIGHBOURS = 10
QUERY_EVERY = 50
#: A round of more changes than this is not made with segments over 16 bits wide (which never need as many).
MOST_MASKS = 20_000
CHUNK_ENTRIES = 16_384
BLOCK_QUERIES = 4_096
_PAIRS = 2_000_000
FOUND = "query long, code long, least_id long, distance int"


def sign_code(vector: str = "embedding", bits: int = BITS) -> Column:
    """A code of 64 bits: of vectors of up to 64 components the bits are their signs, set where one is 0 or more.

    In longer vectors every component counts: bit b is the sign of the sum of components b, b + 64, b + 128 and so on,
    each after the first 64 with a sign of its own (`_turned`). NULL, missing and NaN components are left out
    of the sum; a bit without any other component is not set. A NULL vector has no code.
    """
    at = F.col(vector)

    def code_of(bit_set: Callable[[int], Column]) -> Column:
        ones = [F.when(bit_set(i), F.lit(_signed(1 << i))).otherwise(F.lit(0).cast("long")) for i in range(bits)]
        return reduce(Column.bitwiseOR, ones)

    short = code_of(lambda i: (F.get(at, F.lit(i)) >= 0) & ~F.isnan(F.get(at, F.lit(i))))
    signed = F.transform(at, lambda x, i: F.when(_turned(i), -x.cast("double")).otherwise(x.cast("double")))
    # Sums by bit, in the order of the components.
    rows = F.sequence(F.lit(0), F.lit(bits - 1))
    sums = F.transform(rows, lambda bit: F.aggregate(
        F.filter(signed, lambda x, i: (F.pmod(i, F.lit(bits)) == bit) & x.isNotNull() & ~F.isnan(x)),
        F.lit(None).cast("double"), lambda total, x: F.coalesce(total, F.lit(0.0)) + x,
    ))
    summed = F.aggregate(
        F.transform(sums, lambda x, i: F.when((x >= 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda code, bit: code.bitwiseOR(bit),
    )
    return F.when(at.isNotNull(), F.when(F.size(at) <= bits, short).otherwise(summed))


def _turned(i: Column) -> Column:
    """Whether component `i` (from 0) enters its sum with the opposite sign: an arbitrary half of those after the first 64."""
    mixed = F.shiftright(i.cast("long") * F.lit(TURN), 16)
    return (i >= BITS) & (mixed.bitwiseAND(F.lit(1)) == 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def segment_counts(codes: int) -> list[int]:
    """How many segments to search with, then with how many what is left.

    A segment has about log2(codes) bits, between 10 and 32. Wide segments can't be
    searched to the end, as their balls grow too large; queries that far
    from everything go on with segments half as wide, until 16 bits or fewer.
    """
    wide = min(32.0, max(10.0, log2(max(codes, 2))))
    counts = [max(2, round(BITS / wide))]
    while -(-BITS // counts[-1]) > 16:
        counts.append(2 * counts[-1])
    return counts


def segments_of(m: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each of m segments."""
    edges = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _segment(code: Column, segment: tuple[int, int]) -> Column:
    first, wide = segment
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << wide) - 1))


# lookups within a task ---------------------------------------------------------


@lru_cache(maxsize=64)
def masks_of(wide: int, radius: int) -> np.ndarray:
    """All numbers of `wide` bits of which `radius` are set."""
    return np.array([sum(1 << i for i in flipped) for flipped in combinations(range(wide), radius)], np.uint64)


def _bits_of(codes: np.ndarray, segment: tuple[int, int]) -> np.ndarray:
    return (codes >> np.uint64(segment[0])) & np.uint64((1 << segment[1]) - 1)


def look_up(
    queries: np.ndarray, codes: np.ndarray, least_ids: np.ndarray, segments: list[tuple[int, int]], at: int, part: int,
    low: int, radius: int, k: int,
) -> pd.DataFrame:
    """The k nearest of a part's codes at distance `radius` from each query in segment `at`, met there first.

    The part's keys have `part` as their bits from `low` on.
    """
    keys = _bits_of(codes, segments[at])
    order = np.argsort(keys, kind="stable")
    keys, codes, least_ids = keys[order], codes[order], least_ids[order]
    asked = _bits_of(queries, segments[at])
    spent = np.bitwise_count((asked >> np.uint64(low)) ^ np.uint64(part)).astype(np.int64)
    found = []
    for used in np.unique(spent[(spent <= radius) & (radius - spent <= low)]):
        masks = masks_of(low, int(radius - used))
        some = np.nonzero(spent == used)[0]
        # As many queries at a time as their lookups, and in a crowded part the codes they may meet, allow.
        step = max(1, _PAIRS // max(len(masks), len(codes), 1))
        for begin in range(0, len(some), step):
            rows = some[begin : begin + step]
            own = np.uint64(part << low) | (asked[rows] & np.uint64((1 << low) - 1))
            wanted = (own[:, None] ^ masks[None, :]).ravel()
            first = np.searchsorted(keys, wanted, "left")
            many = np.searchsorted(keys, wanted, "right") - first
            hit = np.nonzero(many)[0]
            first, many = first[hit], many[hit]
            of = np.repeat(rows[hit // len(masks)], many)
            entry = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            apart = queries[of] ^ codes[entry]
            once = np.ones(len(of), bool)
            for other, segment in enumerate(segments):
                if other != at:
                    near = np.bitwise_count(_bits_of(apart, segment))
                    once &= near > radius if other < at else near >= radius
            of, entry, distance = of[once], entry[once], np.bitwise_count(apart[once]).astype(np.int32)
            ranked = np.lexsort((least_ids[entry], distance, of))
            of, entry, distance = of[ranked], entry[ranked], distance[ranked]
            opens = np.ones(len(of), bool)
            opens[1:] = of[1:] != of[:-1]
            place = np.arange(len(of)) - np.maximum.accumulate(np.where(opens, np.arange(len(of)), 0))
            best = place < k
            found.append((queries[of[best]], codes[entry[best]], least_ids[entry[best]], distance[best]))
    if not found:
        found = [(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))]
    query, code, least, distance = (np.concatenate(x) for x in zip(*found, strict=True))
    return pd.DataFrame(
        {"query": query.view(np.int64), "code": code.view(np.int64), "least_id": least, "distance": distance}
    )


# rounds ------------------------------------------------------------------------


def _best(df: DataFrame, k: int) -> DataFrame:
    """The k nearest codes of each query; Spark cuts each task's share to k before the shuffle."""
    order = Window.partitionBy("query").orderBy("distance", "least_id")
    return df.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k).drop("_place")


_PART = ["segment", "part", "low"]


def _buckets(
    entries: DataFrame, segments: list[tuple[int, int]], lows: list[int], scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """(segment, part, low, chunk, code, least_id), and how many chunks each part has."""
    parts = F.array(*[
        F.struct(F.lit(at).alias("segment"), F.shiftrightunsigned(_segment(F.col("code"), s), low).alias("part"), F.lit(low).alias("low"))
        for at, (s, low) in enumerate(zip(segments, lows, strict=True))
    ])
    keyed = entries.select("code", "least_id", F.explode(parts).alias("p")).select("p.*", "code", "least_id")
    chunks = F.ceil(F.count(F.lit(1)) / CHUNK_ENTRIES).cast("int")
    sizes = scratch.stage(keyed.groupBy(*_PART).agg(chunks.alias("chunks")), "parts")
    chunk = F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int")
    return scratch.stage(keyed.join(sizes, _PART).withColumn("chunk", chunk).drop("chunks"), "buckets"), sizes


def _reached(open_queries: DataFrame, segments: list[tuple[int, int]], lows: list[int], radius: int) -> DataFrame:
    """(query, segment, part, low): the parts in the ball of each query, by changes of the leading bits."""
    balls = []
    for at, (s, low) in enumerate(zip(segments, lows, strict=True)):
        leading = s[1] - low
        masks = [int(x) for r in range(max(0, radius - low), min(radius, leading) + 1) for x in masks_of(leading, r)]
        own = F.shiftrightunsigned(_segment(F.col("query"), s), low)
        parts = F.array(*[own.bitwiseXOR(F.lit(x).cast("long")) for x in masks])
        balls.append(F.struct(F.lit(at).alias("segment"), parts.alias("parts"), F.lit(low).alias("low")))
    return open_queries.select("query", F.explode(F.array(*balls)).alias("b")).select(
        "query", "b.segment", F.explode("b.parts").alias("part"), "b.low"
    )


def _in_group(segments: list[tuple[int, int]], radius: int, k: int):
    def of_group(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        either = q if len(q) else x
        at, part, low = (int(either[c].iloc[0]) for c in _PART)
        codes = (c.to_numpy(np.int64).view(np.uint64) for c in (q["query"], x["code"]))
        return look_up(*codes, x["least_id"].to_numpy(np.int64), segments, at, part, low, radius, k)

    return of_group


def _search(
    open_queries: DataFrame, entries: DataFrame, total: int, m: int, k: int, most_masks: int, settled: list[DataFrame],
    scratch: Scratch,
) -> DataFrame:
    """Round after round with m segments; answers go to `settled`, and queries without one are returned."""
    segments = segments_of(m)
    widest = max(wide for _, wide in segments)
    leading = max(0, round(log2(total / CHUNK_ENTRIES)))
    lows = [max(wide - leading, min(wide, 8)) for _, wide in segments]
    buckets, sizes = _buckets(entries, segments, lows, scratch)
    group = [*_PART, "chunk", "block"]
    found = None
    for radius in range(widest + 1):
        if open_queries.isEmpty() or (widest > 16 and comb(widest, radius) > most_masks):
            break

        reached = _reached(open_queries, segments, lows, radius).join(sizes, _PART)
        reached = scratch.stage(reached, "reached")
        blocks = F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int")
        dealt = scratch.stage(reached.groupBy(*_PART).agg(blocks.alias("blocks")), "blocks")
        left = reached.join(dealt, _PART).select(
            "query", *_PART, F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        )
        right = buckets.join(dealt, _PART).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        new = left.groupBy(*group).cogroup(right.drop("blocks").groupBy(*group)).applyInPandas(_in_group(segments, radius, k), FOUND)
        found = _best(new if found is None else new.union(found), k)
        whole = Window.partitionBy("query")
        found = found.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_farthest", F.max("distance").over(whole))
        covered = m * (radius + 1) - 1
        done = ((F.col("_n") >= k) & (F.col("_farthest") <= covered)) | (F.col("_n") >= total)
        state = scratch.stage(found.withColumn("done", done).drop("_n", "_farthest"), "found")
        settled.append(state.filter("done").drop("done"))
        found = state.filter("not done").drop("done")
        answered = state.filter("done").select("query").distinct()
        open_queries = scratch.stage(open_queries.join(answered, "query", "left_anti"), "open")
    return open_queries


def nearest_codes(queries: DataFrame, codes: DataFrame, scratch: Scratch, k: int = NEIGHBOURS, most_masks: int = MOST_MASKS) -> DataFrame:
    """(query_id, rank, id, distance): the k rows of `codes` nearest to each query, by (distance, id).

    Both frames have columns id and code (a 64-bit number); rows where either is
    NULL take no part. A query meets every row, its own included if it is there;
    repeated rows take a rank each; with fewer than k rows, all are returned.
    """
    spark = scratch.spark
    smallest = Window.partitionBy("code").orderBy("id")
    rows = codes.select("id", "code").dropna().withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k)
    entries = scratch.stage(
        rows.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("least_id", F.element_at("ids", 1)),
        "entries",
    )
    asked = scratch.stage(queries.select("id", "code").dropna(), "asked")
    total = entries.count()
    open_queries = scratch.stage(asked.select(F.col("code").alias("query")).distinct(), "open")
    settled: list[DataFrame] = []
    for m in segment_counts(total):
        if total and not open_queries.isEmpty():
            open_queries = _search(open_queries, entries, total, m, k, most_masks, settled, scratch)
    if not settled:
        return spark.createDataFrame([], "query_id long, rank int, id long, distance int")
    codes_found = reduce(DataFrame.union, settled)
    listed = codes_found.join(entries.select("code", "ids"), "code").select("query", "distance", F.explode("ids").alias("id"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    ranked = listed.withColumn("rank", place).filter(F.col("rank") <= k)
    return asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(ranked, "query").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "id", F.col("distance").cast("int").alias("distance")
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code().alias("code"))
    found = nearest_codes(rows.filter(F.col("id") % QUERY_EVERY == 0), rows, Scratch(spark))
    return found.withColumnRenamed("id", "vec_id")


def op10_sql(k: int = NEIGHBOURS) -> str:
    turned = f"i > {BITS} AND ((i - 1) * {TURN} >> 16) & 1 = 1"
    parts = (
        f"list_transform(range(b, len(embedding) + 1, {BITS}), "
        f"lambda i: CASE WHEN {turned} THEN -embedding[i]::DOUBLE ELSE embedding[i]::DOUBLE END)"
    )
    added = f"list_reduce(list_filter({parts}, lambda x: x IS NOT NULL AND NOT isnan(x)), lambda s, x: s + x, 0.0::DOUBLE)"
    some = f"len(list_filter({parts}, lambda x: x IS NOT NULL AND NOT isnan(x))) > 0"
    bits = f"list_transform(range(1, {BITS + 1}), lambda b: coalesce({some} AND {added} >= 0 AND NOT isnan({added}), false))"
    return (
        f"WITH codes AS (SELECT vec_id, {bits} AS b FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL), "
        "pairs AS (SELECT q.vec_id AS query_id, x.vec_id, "
        "len(list_filter(list_zip(q.b, x.b), lambda p: p[1] <> p[2]))::INTEGER AS distance "
        f"FROM codes q JOIN codes x ON q.vec_id % {QUERY_EVERY} = 0), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM pairs) "
        f"SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {k}"
    )
