"""The language stage of the pipeline turns away what is in no learned language."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.conftest import SF_DIR


def noise(rng, alphabet: str, size: int) -> str:
    words = []
    while sum(map(len, words)) + len(words) < size:
        words.append("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 9))))
    return " ".join(words)


def test_noise_and_unlearned_scripts_go_and_clean_texts_stay(spark, tmp_path):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = F.explode(F.array(*[F.lit(n) for n in (8, 30, 120, 300, 1_000_000)])).alias("size")
    cut = documents.select("*", sizes).withColumn("text", F.substring("text", F.lit(1), F.col("size")))
    clean = cut.withColumn("doc_id", F.col("doc_id") * 1_000_003 + F.col("size")).select(documents.columns)
    rng, rows = random.Random(5), []
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "".join(chr(0x4E00 + i) for i in range(3_000))):
        for size in (200, 300, 700, 1_500, 3_000):
            for _ in range(4):
                rows.append((-1 - len(rows), noise(rng, alphabet, size), None, "junk", size))
    planted = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clean.unionByName(planted.select(*[F.col(f.name).cast(f.dataType) for f in clean.schema])).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    kept = {r.doc_id for r in pipeline.identify_language(spark, docs, SF_DIR).select("doc_id").collect()}
    lost = docs.filter("doc_id >= 0").filter(~F.col("doc_id").isin([k for k in kept if k >= 0])).select("text", "lang").collect()
    with_letters = [r for r in lost if any(c.isalpha() for c in r.text)]
    assert not with_letters
    assert len([k for k in kept if k < 0]) <= len(rows) // 20
