import numpy as np
from pyspark.sql import functions as F

from matchledger.llm import language
from tests.conftest import SF_DIR


def test_held_out_accuracy(spark):
    found = language.op8_language(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_is_the_checksum_of_the_id(spark):
    import zlib

    rows = spark.range(100).select(F.col("id").alias("doc_id")).withColumn("h", language.held_out()).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_a_bundle_is_the_sum_of_bound_letters():
    grams, counts = language.gram_counts("Aba aba")
    letters = [language.letter_vector(ord(c), 64).astype(int) for c in " ab"]
    blank, a, b = letters
    bound = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    expected = 2 * (bound(blank, a, b) + bound(a, b, a) + bound(b, a, blank)) + bound(a, blank, a)
    assert (language.bundles([(grams, counts)], 3, 64)[0] == expected).all()


def test_many_ngrams_and_a_full_store(monkeypatch):
    monkeypatch.setattr(language, "KEPT_VECTORS", 10)
    text = "".join(chr(0x4E00 + i) for i in range(9_000))
    grams, counts = language.gram_counts(text)
    whole = language.bundles([(grams, counts), language.gram_counts("ab")], 3, 32)
    expected = sum(language.gram_vector(int(g), 3, 32).astype(int) for g in grams)
    assert (whole[0] == expected).all()


TRAINING = [
    (1, "the cat and the dog", "en"), (3, "le chat et le chien", "fr"), (4, None, "en"), (5, "", "fr"), (7, "unlabelled", None),
    (8, "the cat and the dog", "en"), (8, "the cat and the dog", "en"),
]


def test_odd_documents(documents):
    docs = documents(*TRAINING, (20, "123 !?"), (None, "LE CHAT!"), (21, "the " * 100_000))
    learned = language.prototypes(docs)
    assert learned[0] == ["en", "fr"]
    found = [(r.doc_id, r.lang_pred) for r in language.identify(docs, *learned).collect()]
    assert sorted(found, key=repr) == sorted(
        [(1, "en"), (3, "fr"), (4, "und"), (5, "und"), (7, found[4][1]), (8, "en"), (8, "en"), (20, "und"), (None, "fr"), (21, "en")],
        key=repr,
    )
    kept = language.drop_undetermined(docs, *learned, 0.02)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} >= {1, 3, 8, None, 21}
    assert not {r.doc_id for r in kept.collect()} & {4, 5, 20}


def test_nothing_learned_and_nothing_to_predict(documents):
    docs = documents((1, "some words"))
    learned = language.prototypes(docs)
    assert learned[0] == []
    assert [r.lang_pred for r in language.identify(docs, *learned).collect()] == ["und"]
    empty = documents(*TRAINING).limit(0)
    assert language.prototypes(empty)[0] == []
    assert language.identify(empty, *language.prototypes(documents(*TRAINING))).count() == 0


def test_too_many_languages_are_refused(documents):
    import pytest

    with pytest.raises(ValueError, match="max_languages"):
        language.prototypes(documents((1, "a b", "x"), (2, "c d", "y")), max_languages=1)


def test_ties_go_to_the_first_language(documents):
    learned = language.prototypes(documents((1, "same words", "zz"), (2, "same words", "aa")))
    assert language.predict(["same words"], *learned)[0] == ["aa"]
