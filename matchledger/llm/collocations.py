"""Collocations: phrases of two to four words that hold together, mined by partitions (SON).

The corpus is parted into shards by a hash of the text, so copies meet in one. A phrase that
occurs `MIN_COUNT` times in a language has, in one shard at least, its share of that: as many
times that count as the shard has of the language's words. So:

1. Each shard is mined completely at that lowered support. A task sorts the 48-bit keys of
   its phrases, and sends them as compressed runs, one for each range of keys. A range holds
   a bounded number of keys, however large the shard is.
2. The union of what is frequent in a shard becomes a bitmap of bounded size.
3. All texts are read again. Phrases that the bitmap lets through, and whose parts it lets
   through, are counted by their text, so a key or a bit that two phrases share costs a row
   and never a wrong count. A bitmap too full for its corpus lets more through, no less.

What is counted is grouped within each task first: neither a hot language nor a hot phrase
sends its occurrences anywhere. Scores are sums and joins of the phrases found.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchledger.llm.common import Scratch, mixed, table, utf8

MIN_COUNT = 30
MOST_WORDS = 4
#: A longer phrase with this percentage of a phrase's occurrences takes its place.
COVERED = 80
KEPT = 2_000
SCALE = 2_000_000
UNKNOWN = "und"

#: Each shard is mined at about MIN_COUNT / SHARDS, at every size of the corpus.
SHARDS = 6
#: Bytes of text that a task works on at once; a longer text is worked on alone.
CHUNK_BYTES = 8_000_000
#: Keys of one range of one shard, about.
RANGE_KEYS = 1_000_000
KEY_BITS = 48
#: Bits of the bitmap for each phrase frequent in a shard, and the most bits it may have (32 MB).
BITS_EACH, MOST_BITS = 64, 2**28
_BITMAP_BITS = 8 * 4_096  # of one value of bitmap_construct_agg

# Capitals to small letters, blanks to a blank, what parts pieces to a full stop.
_CAPITALS = bytes(range(65, 91))
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_CAPITALS + b"\x09" + _ENDS, _CAPITALS.lower() + b"\x20" + b"." * len(_ENDS))
_END = b"."
_STEP = np.uint64(0x9E3779B97F4A7C15)


# words and keys ----------------------------------------------------------------


def split_words(texts: list[bytes]) -> list[bytes]:
    """The words of some texts in order, a full stop where a piece ends."""
    return _END.join(texts).translate(_PLAIN).replace(_END, b" . ").split()


class Words:
    """Words of one language, as `split_words` has them.

    `codes` numbers the distinct words from 1; 0 is the end of a piece.
    """

    def __init__(self, tokens: list[bytes], lang: str):
        self.tokens = tokens
        codes: defaultdict[bytes, int] = defaultdict()
        codes.default_factory = codes.__len__
        codes[_END]
        self.codes = np.fromiter(map(codes.__getitem__, self.tokens), np.int64, len(self.tokens))
        self.distinct = list(codes)
        self._seed = xxhash.xxh64_intdigest(lang.encode())

    def counts(self) -> np.ndarray:
        """Occurrences of each distinct word, ends of pieces left out."""
        return np.bincount(self.codes, minlength=len(self.distinct))[1:]

    def keys(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, key, whole) for phrases of two words and more: the key at each place, and whether a phrase is there."""
        digest, seed = xxhash.xxh64_intdigest, self._seed
        of_word = np.fromiter((digest(w, seed) for w in self.distinct), np.uint64, len(self.distinct))[self.codes]
        inside = self.codes != 0
        key, whole = of_word, inside
        for size in range(2, MOST_WORDS + 1):
            if len(key) < 2:
                return
            key = mixed(key[:-1] * _STEP + of_word[size - 1 :])
            whole = whole[:-1] & inside[size - 1 :]
            yield size, key >> np.uint64(64 - KEY_BITS), whole

    def phrases(self, bitmap: np.ndarray, mask: np.uint64) -> Iterator[tuple[int, list[str], np.ndarray]]:
        """(words, phrases, occurrences) of the distinct phrases that the bitmap lets through with all their parts."""
        n, codes, places = len(self.distinct), self.codes, None
        pair = np.full(len(codes), -1, np.int64)
        pairs = 0
        for size, key, whole in self.keys():
            bit = key & mask
            passes = whole & ((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            if places is not None:
                passes &= places[:-1] & places[1:]
            places = passes
            at = np.nonzero(passes)[0]
            if not len(at):
                return
            # Distinct phrases by the numbers of their words: two numbers below 2 ** 31 make one of 64 bits.
            if size == 2:
                found, inverse, first, times = _distinct(codes[at] * n + codes[at + 1])
                pair[at], pairs = inverse, len(found)
            elif size == 3:
                _, _, first, times = _distinct(pair[at] * n + codes[at + 2])
            else:
                _, _, first, times = _distinct(pair[at] * pairs + pair[at + 2])
            starts = at[first].tolist()
            yield size, [b" ".join(self.tokens[i : i + size]).decode() for i in starts], times


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found, first, inverse, times = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    return found, inverse, first, times


def packed_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys with their counts, compressed as the bytes of the steps between them, plane by plane."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    plain = steps.T.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(plain, codec="zstd", asbytes=True)


def unpacked_run(run: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    plain = np.frombuffer(pa.decompress(run, 12 * n, codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(plain[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    counts = np.ascontiguousarray(plain[8 * n :].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps), counts


# passes over the texts ---------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    """(_lang, _shard, _text) of each row."""
    text = utf8("text")
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("_lang"),
        F.pmod(F.xxhash64(text), F.lit(SHARDS)).cast("int").alias("_shard"),
        text.alias("_text"),
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, dict[int, list[bytes]]]]:
    """Texts by language and shard, some `CHUNK_BYTES` at a time."""
    texts: dict[str, dict[int, list[bytes]]] = {}
    size = 0
    for batch in batches:
        for lang, shard, text in zip(batch.column("_lang").to_pylist(), batch.column("_shard").to_pylist(), batch.column("_text"), strict=True):
            text = text.as_py()
            texts.setdefault(lang, {}).setdefault(shard, []).append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield texts
                texts, size = {}, 0
    if texts:
        yield texts


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, shard, word, n): the words of each chunk of a task with their occurrences there (no shard), and all of a shard (no word)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            for lang, shards in chunk.items():
                tokens, totals = [], []
                for of_shard in shards.values():
                    part = split_words(of_shard)
                    totals.append(len(part) - part.count(_END))
                    tokens += [_END, *part]
                words = Words(tokens, lang)
                named, shard = [w.decode() for w in words.distinct[1:]], list(shards)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (len(named) + len(shard)), pa.string()), pa.array([None] * len(named) + shard, pa.int32()),
                        pa.array(named + [None] * len(shard), pa.string()), pa.array([*words.counts().tolist(), *totals], pa.int64()),
                    ],
                    ["lang", "shard", "word", "n"],
                )

    return texts.mapInArrow(of_batches, "lang string, shard int, word string, n long")


def _runs(texts: DataFrame, range_bits: int) -> DataFrame:
    """(lang, shard, range, n, run): the keys of each chunk's phrases, cut into 2 ** range_bits ranges."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.arange(1, 1 << range_bits, dtype=np.uint64) << np.uint64(KEY_BITS - range_bits)
        for chunk in _chunks(batches):
            for lang, shard, of_shard in ((lang, *part) for lang, shards in chunk.items() for part in shards.items()):
                found = [key[whole] for _, key, whole in Words(split_words(of_shard), lang).keys()]
                keys, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64),) * 2
                cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
                parts = [(r, a, b) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(parts), pa.string()), pa.array([shard] * len(parts), pa.int32()),
                        pa.array([r for r, _, _ in parts], pa.int32()), pa.array([b - a for _, a, b in parts], pa.int32()),
                        pa.array([packed_run(keys[a:b], counts[a:b]) for _, a, b in parts], pa.binary()),
                    ],
                    ["lang", "shard", "range", "n", "run"],
                )

    return texts.mapInArrow(of_batches, "lang string, shard int, range int, n int, run binary")


def _frequent_here(group: pa.Table) -> pa.Table:
    """Keys of one range of a shard that reach the support of that shard."""
    runs = [unpacked_run(r, n) for r, n in zip(group["run"].to_pylist(), group["n"].to_pylist(), strict=True)]
    keys, counts = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    starts = np.nonzero(np.diff(keys, prepend=keys[0] ^ np.uint64(1)))[0]
    held = np.add.reduceat(counts, starts) >= group["need"][0].as_py()
    return pa.table({"key": pa.array(keys[starts][held].astype(np.int64))})


def locally_frequent(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(key,): phrases that are frequent in a shard of their language, a row for each such shard.

    words: lang, shard, n of all words. A language's phrase that occurs MIN_COUNT times is among them.
    """
    own, all_words = F.col("n").cast("decimal(20,0)"), F.sum("n").over(Window.partitionBy("lang")).cast("decimal(20,0)")
    need = F.call_function("div", own * F.lit(MIN_COUNT).cast("decimal(3,0)") + all_words - 1, all_words)
    need = words.filter("n > 0").select("lang", "shard", need.cast("long").alias("need"))  # rounded up
    most = words.groupBy("lang").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    ranges = (MOST_WORDS - 1) * most // SHARDS // RANGE_KEYS
    runs = _runs(texts, min(max(ranges, 1).bit_length(), 24)).join(need, ["lang", "shard"])
    return runs.groupBy("lang", "shard", "range").applyInArrow(_frequent_here, "key long")


def key_bitmap(keys: DataFrame) -> tuple[np.ndarray, np.uint64]:
    """The keys as set bits, and the mask that makes a key the number of its bit."""
    bits = max(2**16, min(MOST_BITS, 1 << (BITS_EACH * keys.count()).bit_length()))
    bit = F.col("key").bitwiseAND(F.lit(bits - 1))
    slices = keys.groupBy((bit / _BITMAP_BITS).cast("int").alias("slice")).agg(
        F.bitmap_construct_agg((bit % _BITMAP_BITS).cast("long")).alias("bits")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in slices.collect():  # at most MOST_BITS / 8 bytes
        at = row["slice"] * _BITMAP_BITS // 8
        bitmap[at : at + _BITMAP_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return bitmap, np.uint64(bits - 1)


def counted_phrases(texts: DataFrame, bitmap: np.ndarray, mask: np.uint64) -> DataFrame:
    """(lang, phrase, words, a) of all phrases that occur MIN_COUNT times, if their keys are in the bitmap."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            for lang, shards in chunk.items():
                tokens = split_words([text for of_shard in shards.values() for text in of_shard])
                for size, phrases, times in Words(tokens, lang).phrases(shared.value, mask):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array([size] * len(phrases), pa.int32()), pa.array(times, pa.int64())],
                        ["lang", "phrase", "words", "a"],
                    )

    found = texts.mapInArrow(of_batches, "lang string, phrase string, words int, a long")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter(F.col("a") >= MIN_COUNT)


# scores ------------------------------------------------------------------------


def _part(first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice("_w", first, length), " ")


def scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """The phrases with l, r and score of their weakest cut; counts: (lang, phrase, a) of words and phrases."""
    cuts = phrases.withColumn("_w", F.split("phrase", " ")).select(
        "lang", "phrase", "words", "a", "_w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang", "phrase", "words", "a", "k", _part(1, F.col("k")).alias("_left"),
        _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("_right"),
    )
    for side, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    exact = [F.col(c).cast("decimal(20,0)") for c in "alr"]
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * exact[0], exact[1] + exact[2])
    return (
        cuts.withColumn("score", score.cast("long"))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
        .select("lang", "phrase", "words", "a", "_cut.l", "_cut.r", "_cut.score")
    )


def uncovered(phrases: DataFrame) -> DataFrame:
    """The phrases that no longer phrase of `phrases` covers."""
    inner = phrases.filter("words > 2").withColumn("_w", F.split("phrase", " "))
    inner = inner.withColumn("_size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("_first", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_size") + 1)))
    covers = inner.groupBy("lang", _part(F.col("_first"), F.col("_size")).alias("phrase")).agg(F.max("a").alias("_longer"))
    most = F.coalesce("_longer", F.lit(0)).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    held = phrases.join(covers, ["lang", "phrase"], "left")
    return held.filter(most < F.col("a").cast("decimal(20,0)") * F.lit(COVERED).cast("decimal(3,0)")).drop("_longer")


def collocations(docs: DataFrame, scratch: Scratch, kept: int = KEPT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `kept` best phrases.

    NULL text is empty, NULL lang is `und`; equal rows are counted each; other columns are
    not looked at. Ties go by more occurrences, then by the bytes of the phrase, which
    is unique within its language. A corpus without a phrase of MIN_COUNT gives no rows.
    """
    texts = _texts(docs)
    of_words = scratch.stage(word_counts(texts), "words")
    words = scratch.stage(of_words.filter("word IS NULL").groupBy("lang", "shard").agg(F.sum("n").alias("n")), "shards")
    keys = scratch.stage(locally_frequent(texts, words), "frequent")
    phrases = scratch.stage(counted_phrases(texts, *key_bitmap(keys)), "phrases")
    single = of_words.filter("word IS NOT NULL").groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("n").alias("a"))
    counts = scratch.stage(
        single.filter(F.col("a") >= MIN_COUNT).union(phrases.select("lang", "phrase", "a")), "counts"
    )
    scratch.release(of_words, keys)
    best = scored(uncovered(phrases), counts)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= kept)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), Scratch(spark))


def op11_sql() -> str:
    """Every phrase counted by itself."""
    return rf"""WITH lowered AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, row_number() OVER () AS doc,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered
), lists AS MATERIALIZED (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counted AS MATERIALIZED (
    SELECT lang, k AS words, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, range(1, {MOST_WORDS + 1}) AS sizes(k) WHERE len(w) >= k)
    GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang
), found AS (
    SELECT lang, words, phrase, a, string_split(phrase, ' ') AS w FROM counted WHERE words > 1
), inner_parts AS (
    SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longer
    FROM (
        SELECT lang, w, a, s, unnest(range(1, words - s + 2)) AS i
        FROM found, range(2, {MOST_WORDS}) AS sizes(s) WHERE s < words
    ) GROUP BY ALL
), kept AS (
    SELECT f.* FROM found f LEFT JOIN inner_parts p USING (lang, phrase)
    WHERE p.longer IS NULL OR 100 * p.longer::HUGEINT < {COVERED} * f.a::HUGEINT
), cuts AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, ({SCALE} * c.a::HUGEINT // (x.a + y.a))::BIGINT AS score
    FROM (
        SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS first_part, array_to_string(w[k + 1 :], ' ') AS rest
        FROM (SELECT *, unnest(range(1, words)) AS k FROM kept)
    ) c
    JOIN counted x ON x.lang = c.lang AND x.phrase = c.first_part
    JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {KEPT}"""
