"""Passages that occur more than once, by a sparse suffix array.

A window of 50 words is repeated if the same words stand at another place, in
another document or in the same one; a passage is a run of words that repeated
windows cover. Words are what ASCII blanks part, compared byte by byte.

Retained are the suffixes that start at minimisers: in every 30 consecutive
8-word grams, the leftmost with the smallest hash. Any window of 50 words has
one at most 29 words from its start, so at least 21 of its words follow it, and
equal windows have it at the same offset. Grouped by a hash of their first 21 words,
in place of a sort and a comparison of neighbours (all that is asked of the order
being which are equal, and a group can be summed up before it is shuffled), suffixes
that a repeated window shares come together. They are then extended, left by up to
29 words and right to 50:

1. Suffixes whose whole surroundings (29 words before, 50 from the suffix on)
   are equal are one class: all of that is repeated, wherever it stands.
2. Classes that share the 21 words but not the surroundings are compared window
   by window, one member for each class, as its others read the same.

So a passage that a third of all documents share is grouped by partial
aggregation and never listed pair by pair. Hashes have 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchledger.llm.common import ROW, TAG, RunHashes, Scratch, mixed, table, tagged_rows, utf8

MIN_WORDS = 50
GRAM_WORDS = 8
WINDOW_GRAMS = 30
LEFT = WINDOW_GRAMS - 1
PREFIX_WORDS = MIN_WORDS - LEFT

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def run_hashes(text: bytes) -> tuple[int, RunHashes | None]:
    """Number of words, and the hashes of their runs if there is a window."""
    words = text.split()
    if len(words) < MIN_WORDS:
        return len(words), None
    digest = xxhash.xxh64_intdigest
    return len(words), RunHashes(np.fromiter((digest(w) for w in words), np.uint64, len(words)))


def minimisers(hashes: RunHashes, n: int) -> np.ndarray:
    """Starts of the retained suffixes, those with too few words left aside."""
    at = np.arange(n - GRAM_WORDS + 1)
    grams = hashes(at, at + GRAM_WORDS)
    chosen = np.unique(sliding_window_view(grams, WINDOW_GRAMS).argmin(axis=1) + at[: len(grams) - WINDOW_GRAMS + 1])
    return chosen[chosen + PREFIX_WORDS <= n]


def _surroundings(hashes: RunHashes, at: np.ndarray, n: int) -> np.ndarray:
    """One hash of what stands around each suffix start, and of how far that goes on either side."""
    start, end = np.maximum(at - LEFT, 0), np.minimum(at + MIN_WORDS, n)
    extent = ((at - start) * (MIN_WORDS + 1) + (end - at)).astype(np.uint64)
    return mixed(hashes(start, end) ^ mixed(extent))


def suffixes(rows: DataFrame) -> DataFrame:
    """(_doc, _tag, prefix, around, at, n) of each retained suffix; rows: _doc, _tag and the text's bytes, _text."""
    whole = F.lit(0).cast("long")
    out = rows.select("_doc", TAG, whole.alias("prefix"), whole.alias("around"), F.lit(0).alias("at"), F.lit(0).alias("n")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i, text in enumerate(batch.column("_text")):
                n, hashes = run_hashes(text.as_py())
                if hashes:
                    at = minimisers(hashes, n)
                    around = _surroundings(hashes, at, n)
                    parts.append((np.full(len(at), i), hashes(at, at + PREFIX_WORDS), around, at, np.full(len(at), n)))
            if parts:
                owner, prefix, around, at, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                owner = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_doc").take(owner), batch.column(TAG).take(owner), pa.array(prefix.view(np.int64)),
                        pa.array(around.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
                    ],
                    out.names,
                )

    return rows.mapInArrow(of_batches, out)


def _windows(rows: DataFrame) -> DataFrame:
    """(_doc, _tag, window, at): every window that holds the prefix of a suffix of `ats`; rows: _doc, _tag, _text, ats."""
    out = rows.select("_doc", TAG, F.lit(0).cast("long").alias("window"), F.lit(0).alias("at")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, ats) in enumerate(zip(batch.column("_text"), batch.column("ats"), strict=True)):
                n, hashes = run_hashes(text.as_py())
                around = np.asarray(ats.as_py())[:, None] - np.arange(LEFT + 1)
                at = np.unique(around[(around >= 0) & (around <= n - MIN_WORDS)])
                if len(at):
                    owner = pa.array(np.full(len(at), i))
                    found = pa.array(hashes(at, at + MIN_WORDS).view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_doc").take(owner), batch.column(TAG).take(owner), found, pa.array(at.astype(np.int32))],
                        out.names,
                    )

    return rows.mapInArrow(of_batches, out)


def _place() -> Column:
    """Where a suffix or window stands, in the order of doc_id (NULL last), row and word."""
    return F.struct(F.col("_doc").isNull().alias("no_doc"), "_doc", TAG, "at")


def _row_and_word(place: str) -> Column:
    return F.struct(F.col(f"{place}.{TAG}").alias(TAG), F.col(f"{place}.at").alias("at"))


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document as one; a group is one document's."""
    ordered = Window.partitionBy(TAG).orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= F.col("_before"), 0).otherwise(1)
    return (
        spans.withColumn("_before", before)
        .withColumn("_run", F.sum(opens).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(TAG, "_run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(TAG, "start", "end")
    )


def _texts(rows: DataFrame) -> DataFrame:
    """(_doc, _tag, _text) of tagged rows."""
    return rows.select(F.col(f"{ROW}.doc_id").alias("_doc"), TAG, utf8(f"{ROW}.text").alias("_text"))


def _spans(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(_tag, later, start, end) of repeated windows of tagged texts, not yet merged.

    later: whether there is an earlier place for each window in the span.
    """
    # What is grouped is staged before it is joined: a join of two plain tables is one
    # whose skewed partitions Spark splits, however often a passage occurs.
    retained = scratch.stage(suffixes(rows), "suffixes")
    shared = (
        retained.groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("around").alias("_least"), F.max("around").alias("_most"))
        .filter("_n > 1")
        .select("prefix", (F.col("_least") != F.col("_most")).alias("differ"))
    )
    shared = scratch.stage(shared, "shared")
    scratch.release()  # here and below: what was shuffled for a staged table goes before the next shuffle
    neighbours = scratch.stage(retained.join(shared, "prefix").drop("prefix"), "neighbours")
    scratch.release(retained, shared)
    classes = neighbours.groupBy("around").agg(F.min(_place()).alias("_first"), F.count(F.lit(1)).alias("_n"))
    classes = scratch.stage(classes, "firsts")
    scratch.release()
    placed = scratch.stage(
        neighbours.join(classes, "around").select(
            TAG, "at", "n", "differ", (F.struct(TAG, "at") == _row_and_word("_first")).alias("first"),
            (F.col("_n") > 1).alias("again"),
        ),
        "classes",
    )
    scratch.release(neighbours, classes)
    whole = placed.filter("again").select(
        TAG, (~F.col("first")).alias("later"), F.greatest(F.col("at") - LEFT, F.lit(0)).alias("start"),
        F.least(F.col("at") + MIN_WORDS, F.col("n")).alias("end"),
    ).filter(F.col("end") - F.col("start") >= MIN_WORDS)

    members = placed.filter("first and differ").groupBy(TAG).agg(F.collect_list("at").alias("ats"))
    windows = scratch.stage(_windows(rows.join(members, TAG)), "windows")
    scratch.release()
    repeated = windows.groupBy("window").agg(F.min(_place()).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = scratch.stage(repeated.filter("_n > 1"), "repeated")
    scratch.release()
    single = windows.join(repeated, "window").select(
        TAG, (F.struct(TAG, "at") != _row_and_word("_first")).alias("later"), F.col("at").alias("start"),
        (F.col("at") + MIN_WORDS).alias("end"),
    )
    spans = scratch.stage(whole.union(single), "spans")
    scratch.release(placed, windows, repeated)
    return spans


def repeated_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, start_word, n_words, later): the passages of each document, words counted from 0.

    later false: all repeated passages. later true: their parts of which each window
    has an earlier place (places go by doc_id, NULL last, for equal ids by the row, then
    by the words of a text); without them every passage would stand once.
    Documents without a repeated window have no row; NULL text counts as empty,
    equal rows are documents of their own, ids may be NULL.
    """
    rows = _texts(tagged_rows(docs.select("doc_id", "text"), scratch))
    spans = _spans(rows, scratch)
    later = _merged(spans.filter("later")).withColumn("later", F.lit(True))
    return _merged(spans).withColumn("later", F.lit(False)).union(later).join(rows.select(TAG, "_doc"), TAG).select(
        F.col("_doc").alias("doc_id"), F.col("start").alias("start_word"), (F.col("end") - F.col("start")).alias("n_words"), "later"
    )


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans (sorted, apart) and the blanks after them."""
    places = [m.start() for m in _WORD.finditer(text)]
    out, done = [], 0
    for start, end in spans:
        out.append(text[done : places[start]])
        done = places[end] if end < len(places) else len(text)
    return b"".join([*out, text[done:]])


def drop_repeats(docs: DataFrame, scratch: Scratch, sizes: dict[str, Column] | None = None) -> DataFrame:
    """The documents without their repeats; a passage stays in the document of the smallest doc_id.

    Documents that had words and have none left go. `sizes` names columns to make
    anew from the shortened text. Other columns, and texts without a repeat, are
    unchanged (NULL stays NULL).
    """
    rows = tagged_rows(docs, scratch)
    spans = _spans(_texts(rows), scratch)
    later = _merged(spans.filter("later"))
    by_row = later.groupBy(TAG).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    joined = rows.join(scratch.stage(by_row, "cuts"), TAG, "left").select(ROW, "_cuts")
    scratch.release(spans)
    names = docs.columns
    at = names.index("text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(ROW).flatten()
            texts, keep = columns[at].to_pylist(), np.ones(batch.num_rows, bool)
            for i, cuts in enumerate(batch.column("_cuts").to_pylist()):
                if cuts:
                    left = cut_words(texts[i].encode(), [(c["start"], c["end"]) for c in cuts]).decode()
                    texts[i], keep[i] = left, bool(left.strip())
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    out = joined.mapInArrow(of_batches, docs.schema)
    return out.withColumns(sizes) if sizes else out


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), Scratch(spark))


def op4_sql() -> str:
    """All windows, grouped by their words."""
    return rf"""WITH docs AS (
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+') AS w
    FROM documents
), windows AS (
    SELECT k, i, array_to_string(w[i + 1 : i + {MIN_WORDS}], ' ') AS words
    FROM (SELECT k, w, unnest(range(0, len(w) - {MIN_WORDS - 1})) AS i FROM docs WHERE len(w) >= {MIN_WORDS})
), places AS (
    SELECT k, i, count(*) OVER (PARTITION BY words) AS n, row_number() OVER (PARTITION BY words ORDER BY k, i) AS place
    FROM windows
), spans AS (
    SELECT k, i, false AS later FROM places WHERE n > 1 UNION ALL SELECT k, i, true FROM places WHERE place > 1
), opened AS (
    SELECT *, i > coalesce(lag(i) OVER (PARTITION BY k, later ORDER BY i) + {MIN_WORDS}, -1) AS opens FROM spans
), runs AS (
    SELECT *, sum(opens::INTEGER) OVER (PARTITION BY k, later ORDER BY i) AS run FROM opened
)
SELECT doc_id, min(i)::INTEGER AS start_word, (max(i) + {MIN_WORDS} - min(i))::INTEGER AS n_words, later
FROM runs JOIN docs USING (k) GROUP BY doc_id, k, later, run"""
