"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: documents with
their columns, in the end the pieces of packed sequences. `docs` should be a stored
table, as a stage may read it more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm import language, mixing, packing, repeats, simhash
from matchledger.llm.common import ROW, Scratch, prepare, table

#: Asked of every text; a short clean one may be close to no language, so what else is asked goes by the
#: size of a text (see language.least_cosines).
MIN_LANGUAGE_SCORE = 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones.

    Texts without letters go, and those less close to their language than its held-out texts of that size are.
    """
    prepare(spark)
    learned = language.prototypes(docs.filter(~language.held_out()))
    least = language.least_cosines(docs.filter(language.held_out()), *learned)
    return language.drop_undetermined(docs, *learned, MIN_LANGUAGE_SCORE, least=least)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that 3 bits or fewer link, over 3-word shingles."""
    return simhash.drop_near_duplicates(docs, Scratch(spark), words_each=simhash.SHINGLE_WORDS, most=simhash.MAX_BITS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay where they stand first; n_chars follows the text."""
    sizes = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return repeats.drop_repeats(docs, Scratch(spark), sizes)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered shares of sources, languages and topics."""
    return mixing.mix(docs, Scratch(spark)).select(f"{ROW}.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs, Scratch(spark))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints and tokens are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each staged before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
