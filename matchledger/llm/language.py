"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound from its
letters' vectors: each is rotated by its distance from the n-gram's end, and they
are multiplied. A text is the bundle, that is the sum, of its n-grams' vectors; so
is a language, over all its training texts, each of weight one. A text gets
the language whose prototype has the largest cosine with it.

A letter's vector comes from a generator seeded with its code point, so no table
is shared, and every task makes the same vectors. Letters are lower-cased; what is
not a letter parts words, and a word's edges count as one more letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import table

DIMENSIONS = 1024
GRAM = 3
SEED = 20_817
UNDETERMINED = "und"
MAX_LANGUAGES = 2_000
KEPT_VECTORS = 50_000
EDGE = 32
#: A text is taken for none of the languages if its cosine is under LEAST of what all but LOW of
#: the language's unseen texts of its size reach. Where fewer than ENOUGH such texts have a size, the
#: next smaller size's bound holds, as cosines grow with the size; without one none is, nor a text of under SHORT different n-grams, which a clean text may well share with nothing learned.
LEAST = 0.4
LOW = 0.01
ENOUGH = 30
SHORT = 64
#: No text has 2 ** LARGEST n-grams.
LARGEST = 32
_BLOCK = 4_096
_CODE_BITS = np.uint64(21)


# n-grams of a text -------------------------------------------------------------


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, each as one number, and how often they occur; empty without letters."""
    empty = np.empty(0, np.uint64), np.empty(0, np.int64)
    if not text:
        return empty
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return empty
    codes = np.where(letter, codes, EDGE)
    edged = np.concatenate([[EDGE], codes, [EDGE]]).astype(np.uint64)
    same = (edged[1:] != EDGE) | (edged[:-1] != EDGE)
    edged = edged[np.concatenate([[True], same])]  # one edge between words
    if len(edged) < n:
        return empty
    grams = np.zeros(len(edged) - n + 1, np.uint64)
    for k in range(n):
        grams = (grams << _CODE_BITS) | edged[k : len(edged) - n + 1 + k]
    return np.unique(grams, return_counts=True)


# vectors -----------------------------------------------------------------------


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, dimensions, dtype=np.int8) * np.int8(2) - np.int8(1)


def gram_vector(gram: int, n: int, dimensions: int) -> np.ndarray:
    """The letters' vectors, each rotated by its distance from the end, multiplied."""
    mask, bound = (1 << 21) - 1, np.ones(dimensions, np.int8)
    for back in range(n):
        bound = bound * np.roll(letter_vector((gram >> (21 * back)) & mask, dimensions), back)
    return bound


class GramVectors:
    """Vectors of n-grams, made when first asked for; about `KEPT_VECTORS` are kept."""

    def __init__(self, n: int, dimensions: int):
        self.n, self.dimensions, self._place = n, dimensions, {}
        self._vectors = np.empty((1_024, dimensions), np.int8)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        """One row for each of the n-grams, of which there are at most a few thousand."""
        if len(self._place) > KEPT_VECTORS:
            self._place.clear()
        place = self._place
        for gram in grams.tolist():
            if gram not in place:
                if len(place) == len(self._vectors):
                    self._vectors = np.concatenate([self._vectors, np.empty_like(self._vectors)])
                self._vectors[len(place)] = gram_vector(gram, self.n, self.dimensions)
                place[gram] = len(place)
        return self._vectors[[place[g] for g in grams.tolist()]].astype(np.float32)


@lru_cache(maxsize=4)
def gram_vectors(n: int, dimensions: int) -> GramVectors:
    """One store for a worker, over all its tasks."""
    return GramVectors(n, dimensions)


def bundles(counted: list[tuple[np.ndarray, np.ndarray]], n: int, dimensions: int) -> np.ndarray:
    """One row for each text: the sum of its n-grams' vectors."""
    out = np.zeros((len(counted), dimensions), np.float32)
    sizes = [len(g) for g, _ in counted]
    if not sum(sizes):
        return out
    owner = np.repeat(np.arange(len(counted)), sizes)
    grams, at = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
    counts = np.concatenate([c for _, c in counted]).astype(np.float32)
    order = np.argsort(at, kind="stable")
    owner, at, counts = owner[order], at[order], counts[order]
    vectors = gram_vectors(n, dimensions)
    for k in range(0, len(grams), _BLOCK):
        a, b = np.searchsorted(at, [k, k + _BLOCK])
        width = min(_BLOCK, len(grams) - k)
        table = np.zeros((len(counted), width), np.float32)
        table[owner[a:b], at[a:b] - k] = counts[a:b]
        out += table @ vectors(grams[k : k + width])
    return out


# training ----------------------------------------------------------------------


def prototypes(
    labelled: DataFrame, dimensions: int = DIMENSIONS, n: int = GRAM, max_languages: int = MAX_LANGUAGES
) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their prototypes, from all rows of (text, lang); rows without lang do not count.

    A task sums up what it reads, the sums are added by Spark; what reaches the
    driver is one vector for each language. More than `max_languages` languages,
    beyond which that would not be small, are refused.
    """
    rows = labelled.filter(F.col("lang").isNotNull()).select("text", "lang")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                grams, counts = gram_counts(text.as_py(), n)
                if len(grams):
                    by_lang.setdefault(lang, []).append((grams, counts / counts.sum()))
            for lang, found in by_lang.items():
                grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                total = grams, np.bincount(at, np.concatenate([c for _, c in found]))
                weights[lang] = weights.get(lang, 0) + bundles([total], n, dimensions)[0].astype(np.float64)
        for lang, vector in weights.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(vector)],
                ["lang", "place", "total"],
            )

    # Decimal sums do not depend on the order in which parts arrive, so a repeated run learns the same.
    total = F.sum(F.col("total").cast("decimal(28,8)")).cast("double")
    parts = rows.mapInArrow(sums, "lang string, place int, total double")
    by_place = parts.groupBy("lang", "place").agg(total.alias("total"))
    listed = by_place.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "total"))).alias("v"))
    found = listed.select("lang", F.col("v.total").alias("v")).orderBy("lang").limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if that is meant")
    vectors = np.array([r["v"] for r in found], np.float64).reshape(len(found), dimensions)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return [r["lang"] for r in found], (vectors / np.where(norms == 0, 1, norms)).astype(np.float32)


# prediction --------------------------------------------------------------------


def predict(
    texts: list[str | None], languages: list[str], profiles: np.ndarray, n: int = GRAM
) -> tuple[list[str], np.ndarray]:
    """The language of each text and its cosine, cut to 0 to 1; ties go to the language that sorts first."""
    found, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if not languages:
        return found, scores
    for k in range(0, len(texts), 256):
        counted = [gram_counts(t, n) for t in texts[k : k + 256]]
        vectors = bundles(counted, n, profiles.shape[1])
        norms = np.linalg.norm(vectors, axis=1)
        cosines = (vectors @ profiles.T) / np.where(norms == 0, 1, norms)[:, None]
        best = cosines.argmax(axis=1)
        for i, (grams, _) in enumerate(counted):
            if len(grams):
                found[k + i] = languages[best[i]]
                scores[k + i] = min(1.0, max(0.0, float(cosines[i, best[i]])))
    return found, scores


def identify(docs: DataFrame, languages: list[str], profiles: np.ndarray, n: int = GRAM) -> DataFrame:
    """(doc_id, lang_pred, score) of every document, by its text alone.

    `und` with score 0 where the text is NULL, empty or has no letter, or where
    nothing was learned.
    """
    sent = docs.sparkSession.sparkContext.broadcast((languages, profiles))  # languages x dimensions, bounded above
    rows = docs.select("doc_id", "text")
    out = rows.select("doc_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = predict(batch.column("text").to_pylist(), *sent.value, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(scores)],
                ["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(of_batches, out)


def held_out() -> Column:
    """Whether a document is kept from training: a quarter, by its id. A NULL id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _size(text: str | None, n: int) -> int:
    """The binary order of a text's number of different n-grams, as a repeated word tells no more than one."""
    return len(gram_counts(text, n)[0]).bit_length()


def least_cosines(
    unseen: DataFrame, languages: list[str], profiles: np.ndarray, n: int = GRAM, enough: int = ENOUGH
) -> dict[tuple[str, int], float]:
    """The cosine that a text needs, by the predicted language and the order of its number of different n-grams.

    unseen: labelled rows of (text, lang) that were not learned from. Only those that
    are taken for their own language count; a size with few of them has the bound of
    the next smaller one, or none, so what nothing is known about stays. The driver gets a number for each language and size.
    """
    sent = unseen.sparkSession.sparkContext.broadcast((languages, profiles))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found, scores = predict(texts, *sent.value, n)
            own = pa.array([f == lang for f, lang in zip(found, batch.column("lang").to_pylist(), strict=True)], pa.bool_())
            sizes = pa.array([_size(t, n) for t in texts], pa.int32())
            columns = [pa.array(found, pa.string()), sizes, pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "score"]).filter(own)

    rows = unseen.filter(F.col("lang").isNotNull()).select("text", "lang")
    by_size = rows.mapInArrow(scored, "lang string, size int, score double").groupBy("lang", "size")
    low = by_size.agg(F.percentile_approx("score", LOW, 10_000).alias("low"), F.count(F.lit(1)).alias("_n"))
    known = low.filter((F.col("_n") >= enough) & (F.col("size") >= SHORT.bit_length())).orderBy("size").collect()
    return {(r["lang"], size): LEAST * r["low"] for r in known for size in range(r["size"], LARGEST + 1)}


def drop_undetermined(
    docs: DataFrame, languages: list[str], profiles: np.ndarray, min_score: float, n: int = GRAM,
    least: dict[tuple[str, int], float] | None = None,
) -> DataFrame:
    """The documents with a language and a cosine of at least min_score, all columns unchanged.

    least: more that is asked of the cosine (see least_cosines).
    """
    sent = docs.sparkSession.sparkContext.broadcast((languages, profiles))
    bounds = least or {}
    at = docs.columns.index("text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found, scores = predict(texts, *sent.value, n)
            keep = [
                f != UNDETERMINED and s >= min_score and (not bounds or s >= bounds.get((f, _size(t, n)), 0.0))
                for t, f, s in zip(texts, found, scores, strict=True)
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(of_batches, docs.schema)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = prototypes(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), *learned).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
