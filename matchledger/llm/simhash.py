"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits, and texts are linked when at most 3 of them differ.
Split in two halves, such a pair agrees in one half up to one bit. So every
fingerprint enters a table under either half, and looks up the small Hamming ball
around either half: the half itself, and the halves with one 0 bit turned to 1 (of
two halves that differ in one bit, one has the 0, so each pair meets once). What is
fetched is compared over all 64 bits.

Equal fingerprints are one node, whatever the number of their documents. A half
that very many different fingerprints share is looked up by 48 bits instead: the
half and one quarter of the rest, with the ball of radius one around that quarter,
since of the 3 differing bits a quarter of the other half has at most one. A task then holds at
most 2 ** 16 table entries for a key. Within a key, links are reduced to a spanning
forest before they are emitted, never listed as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import ROW, TAG, Scratch, table, tagged, tagged_rows, utf8
from matchledger.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
HOT_KEY = 20_000

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: bytes, words_each: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle; one of the whole sequence if it is shorter; none without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= words_each:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)], np.uint64)
    joined = b" ".join(words)
    ends, end = [], -1
    for w in words:
        end += len(w) + 1
        ends.append(end)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[words_each - 1 :], strict=False)], np.uint64
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bit by bit, whether over half of the hashes have it."""
    if not len(hashes):
        return 0
    by_place = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_place[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int((_PLACES * (2 * ones > len(hashes))).sum(dtype=np.uint64))


def fingerprints(rows: DataFrame, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, _tag, fp): the fingerprint of every document, as a signed long; rows: doc_id, _tag, _text."""
    out = rows.select("doc_id", TAG, F.lit(0).cast("long").alias("fp")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py(), words_each)) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(TAG), pa.array(np.array(found, np.uint64).view(np.int64))],
                ["doc_id", TAG, "fp"],
            )

    return rows.mapInArrow(of_batches, out)


# multi-index lookup ------------------------------------------------------------


def _ball(value, bits: int):
    """The value, and the value with each one of its 0 bits set; `value` is a column of longs."""
    flips = F.filter(F.array(*[F.lit(1 << i) for i in range(bits)]), lambda m: value.bitwiseAND(m) == 0)
    return F.transform(flips, lambda m: value.bitwiseOR(m))


def _keyed(nodes: DataFrame) -> DataFrame:
    """(half, key, probe, fp): the table's entries (probe 0) and the lookups of one changed bit (probe 1)."""
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    halves = nodes.select("fp", F.posexplode(F.array(low, high)).alias("half", "value"))
    entries = halves.select("half", F.col("value").alias("key"), F.lit(0).alias("probe"), "fp")
    lookups = halves.select("half", F.explode(_ball(F.col("value"), 32)).alias("key"), F.lit(1).alias("probe"), "fp")
    return entries.union(lookups)


def _requarter(keyed: DataFrame) -> DataFrame:
    """The same rows under 48 bits: half, quarter of the other half, and its ball of radius one.

    Here the ball has all 16 flips and belongs to lookups alone, as an entry may
    now meet an entry that differs in the quarter: each entry looks up too.
    """
    rest = F.when(F.col("half") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF))
    quarters = keyed.withColumn("_rest", rest).select(
        "half", "key", "probe", "fp",
        F.posexplode(F.array(F.col("_rest").bitwiseAND(0xFFFF), F.shiftrightunsigned("_rest", 16))).alias("quarter", "value"),
    )
    near = F.transform(F.array(*[F.lit(1 << i) for i in range(16)]), lambda m: F.col("value").bitwiseXOR(m))
    own = quarters.select("half", "key", "quarter", "value", "probe", "fp")
    lookups = quarters.select("half", "key", "quarter", F.explode(near).alias("value"), F.lit(1).alias("probe"), "fp")
    return own.union(lookups)


def spanning_links(entries: np.ndarray, lookups: np.ndarray, most: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that join whatever pairs entry-entry and lookup-entry within `most` bits join.

    All pairs are compared, block by block; a link is kept only where it joins two
    parts that were apart, so there are fewer links than fingerprints.
    """
    nodes = np.unique(np.concatenate([entries, lookups]))
    table = np.unique(entries)
    if not len(table) or len(nodes) < 2:
        return []
    part, found = np.arange(len(nodes)), []
    step = max(1, 2_000_000 // len(nodes))
    for k in range(0, len(table), step):
        close = np.bitwise_count(table[k : k + step, None] ^ nodes[None, :]) <= most
        for a in np.nonzero(close.sum(axis=1) > 1)[0]:
            near = np.nonzero(close[a])[0]
            parts, first = np.unique(part[near], return_index=True)
            if len(parts) > 1:
                own = int(table[k + a])
                found += [(own, x) for x in nodes[near[first]].tolist() if x != own]
                part[np.isin(part, parts)] = parts[0]
    return found


def _linker(keys: list[str], most: int):
    """Links within the runs of equal keys of a sorted partition."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def links(part: dict[str, np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
            out: list[tuple[int, int]] = []
            sizes = np.diff(bounds)
            tables = np.add.reduceat(part["probe"] == 0, bounds[:-1]) if len(sizes) else sizes
            for g in np.nonzero((sizes > 1) & (tables > 0))[0]:
                run = slice(bounds[g], bounds[g + 1])
                fp, probe = part["fp"][run], part["probe"][run]
                out += spanning_links(fp[probe == 0], fp[probe == 1], most)
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in [*keys, "probe", "fp"]}
            part["fp"] = part["fp"].view(np.uint64)
            if held is not None:
                part = {n: np.concatenate([held[n], part[n]]) for n in part}
            new = np.zeros(len(part["fp"]), bool)
            for n in keys:
                new[1:] |= part[n][1:] != part[n][:-1]
            cuts = np.concatenate([[0], np.nonzero(new)[0]])
            held = {n: v[cuts[-1] :] for n, v in part.items()}
            if len(cuts) > 1:
                yield links(part, cuts)
        if held is not None:
            yield links(held, np.array([0, len(held["fp"])]))

    return of_batches


def fingerprint_links(nodes: DataFrame, scratch: Scratch, most: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b): links enough to connect all fingerprints (distinct `fp`) within `most` (at most 3) bits."""
    if most > 3:
        raise ValueError("two halves with balls of radius one cover at most 3 differing bits")
    keyed = _keyed(nodes)
    crowded = keyed.filter("probe = 0").groupBy("half", "key").count().filter(F.col("count") > hot_key)
    crowded = scratch.stage(crowded.select("half", "key"), "crowded")

    def linked(rows: DataFrame, keys: list[str]) -> DataFrame:
        dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "probe")
        return dealt.mapInArrow(_linker(keys, most), "a long, b long")

    if crowded.isEmpty():
        return linked(keyed, ["half", "key"])
    calm = linked(keyed.join(crowded, ["half", "key"], "left_anti"), ["half", "key"])
    hot = _requarter(keyed.join(crowded, ["half", "key"], "left_semi"))
    return calm.union(linked(hot, ["half", "key", "quarter", "value"])).distinct()


def near_duplicate_groups(
    docs: DataFrame, scratch: Scratch, words_each: int = SHINGLE_WORDS, most: int = MAX_BITS, hot_key: int = HOT_KEY
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _tag, fp) of all documents, tagged in one job, and (fp, component_id, first_tag) of all fingerprints.

    component_id is the smallest doc_id of the group, first_tag the row to keep:
    that of the smallest doc_id, and the first such row in the table. NULL text
    counts as empty; texts without words share fingerprint 0 and are linked like
    any other. Rows with a NULL doc_id take part but come after all others; a group
    of them alone has a NULL component_id. Equal rows are documents of their own.
    """
    rows = tagged(docs.select("doc_id", utf8("text").alias("_text")), "doc_id", "_text")
    return _groups(rows, scratch, words_each, most, hot_key)


def _groups(
    rows: DataFrame, scratch: Scratch, words_each: int = SHINGLE_WORDS, most: int = MAX_BITS, hot_key: int = HOT_KEY
) -> tuple[DataFrame, DataFrame]:
    """See near_duplicate_groups; rows: doc_id, _tag, _text."""
    marked = scratch.stage(fingerprints(rows, words_each), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col(TAG).alias("t"))
    nodes = scratch.stage(marked.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    roots = connected_components(fingerprint_links(nodes.select("fp"), scratch, most, hot_key), scratch)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("least"))
    groups = rooted.select("fp", "root").join(firsts, "root").select(
        "fp", F.col("least.d").alias("component_id"), F.col("least.t").alias("first_tag")
    )
    return marked, scratch.stage(groups, "groups")


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The first document of each group (see near_duplicate_groups), all columns unchanged."""
    rows = tagged_rows(docs, scratch)
    texts = rows.select(f"{ROW}.doc_id", TAG, utf8(f"{ROW}.text").alias("_text"))
    marked, groups = _groups(texts, scratch, **options)
    others = marked.join(groups, "fp").filter(F.col(TAG) != F.col("first_tag")).select(TAG)
    return rows.join(scratch.stage(others, "others"), TAG, "left_anti").select(f"{ROW}.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marked, groups = near_duplicate_groups(docs, Scratch(spark))
    return marked.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
