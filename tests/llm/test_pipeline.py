"""Each stage on what its predecessor kept, against a plain version, and the whole."""

import duckdb
import pytest

import corpus_pipeline as pipeline
from matchledger.llm import language
from matchledger.llm.mixing import op7_sql
from tests.llm.test_packing import check_layout, check_pieces, plain_ids
from tests.llm.test_repeats import covered
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The documents before each stage, and the result, written and read again as a driver would."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, found[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        found.append(spark.read.parquet(f"{folder}/{name}"))
    return found


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_stages_keep_the_columns_of_documents(staged):
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "repeats", "mixing", "packing"]
    assert all(df.schema == staged[0].schema for df in staged[1:-1])
    counts = [df.count() for df in staged]
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > counts[4] > 0


def test_language_stage(spark, staged):
    before, after = staged[:2]
    found = language.identify(before, *language.prototypes(before.filter(~language.held_out())))
    kept = {r.doc_id for r in found.collect() if r.lang_pred != "und" and r.score >= pipeline.MIN_LANGUAGE_SCORE}
    assert rows_of(after) == sorted(r for r in rows_of(before) if r[0] in kept)


def test_near_duplicates_stage(staged):
    before, after = (sorted(df.collect()) for df in staged[1:3])
    groups = plain_components([plain_fingerprint(r.text) for r in before], [r.doc_id for r in before])
    assert after == [r for r, g in zip(before, groups, strict=True) if r.doc_id == g]


def test_repeats_stage(staged):
    before, after = (df.collect() for df in staged[2:4])
    _, later = covered([r.text for r in before])
    expected = {}
    for k, r in enumerate(before):
        left = [w for i, w in enumerate(r.text.split()) if i not in later[k]]
        if left:
            expected[r.doc_id] = left
    assert {r.doc_id: r.text.split() for r in after} == expected
    assert any(later.values())
    assert all(r.n_chars == len(r.text) for r in after)
    unchanged = {r.doc_id: r for k, r in enumerate(before) if not later[k]}
    assert all(r == unchanged[r.doc_id] for r in after if r.doc_id in unchanged)


def test_mixing_stage(staged):
    con = duckdb.connect()
    con.register("documents", staged[3].toPandas())
    kept = {r[0] for r in con.execute(op7_sql()).fetchall()}
    assert rows_of(staged[4]) == [r for r in rows_of(staged[3]) if r[0] in kept]


def test_packing_stage(staged):
    docs, rows = staged[4].collect(), staged[5].collect()
    check_pieces(rows, dict(zip((d.doc_id for d in docs), plain_ids([d.text for d in docs]), strict=True)))
    check_layout(rows)


def test_run_applies_all_stages(spark, staged):
    columns = staged[-1].columns
    assert rows_of(pipeline.run(spark, SF_DIR).select(*columns)) == rows_of(staged[-1])


def test_odd_documents_pass_all_stages(spark, documents, tmp_path):
    passage = " ".join(f"passage{i}" for i in range(70))
    docs = documents(
        (1, "plain words of a text", "en", "a"), (1, "plain words of a text", "en", "a"), (2, None), (3, "", "en", None),
        (None, "no id here", None, "b"), (4, f"before {passage} after", "en", "b"), (5, f"{passage} alone", "en", "b"),
        (6, "12345 !!", "en", "a"), (7, "very long text " * 40_000, "en", "a"),
    )
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name == "language":
            assert sorted((r.doc_id for r in docs.collect()), key=repr) == sorted([1, 1, None, 4, 5, 7], key=repr)
        if name != "packing":
            assert docs.columns == before.columns
    assert docs.count() > 0


def test_an_empty_table_passes_all_stages(spark, documents, tmp_path):
    docs = documents((1, "a", "en", "s")).limit(0)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
