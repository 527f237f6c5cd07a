import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchledger.llm.packing import END_ID, SEQUENCE, WordIds, op2_packing, pack, plan_sequences
from tests.conftest import SF_DIR

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(texts) -> list[list[int]]:
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, END_ID] for e in found]


def check_layout(rows) -> None:
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= SEQUENCE


def check_pieces(rows, ids: dict) -> None:
    by_doc = {}
    for r in rows:
        whole = ids[r.doc_id]
        piece = np.array(whole[r.start : r.start + r.length], "<u4").tobytes()
        assert (r.doc_tokens, r.ids_crc32) == (len(whole), zlib.crc32(piece))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
    assert by_doc.keys() == ids.keys()
    for doc, pieces in by_doc.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(ids[doc])


def test_query_packs_every_id_once_with_little_padding(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip((d.doc_id for d in docs), plain_ids([d.text for d in docs]), strict=True))
    rows = op2_packing(spark, SF_DIR).collect()
    check_pieces(rows, ids)
    check_layout(rows)
    sequences = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) / (sequences * SEQUENCE) > 0.97


def test_words_are_encoded_as_within_their_text(monkeypatch):
    texts = [
        "Don't stop--it's  the ÉCOLE'S  1,234.50!! end.\nΣΑΣ ΟΔΟΣ İstanbul a\x1cb c\x85d e f", "…«x»… naïve é 한국 하",
        "", " ", "\n\n", "<|endoftext|> x<|startoftext|>y", "a'b' 'll I'LL we'Ve ’s", "word_with_underscores 3rd x2 ²³ ½", "🙂🙂 ok🙂.",
        "".join(map(chr, range(32, 127))), " ".join(map(chr, range(0xA1, 0x250))), "".join(map(chr, range(0xA1, 0x250))),
        "Ünïcödé ÀÉÎ straße ŒUVRE ǅ ŉ ª1º ¼½ x\tY\nz \xa0 <| a|> don'T 'S", "日本語 ελληνικά русский",
        "Tail, tail. TAIL!? (tail) \"tail\" tail's tail'll tail'",
    ]
    for kept in (250_000, 3):
        monkeypatch.setattr("matchledger.llm.packing.KEPT_WORDS", kept)
        encode = WordIds(PATH)
        assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == [x[:-1] for x in plain_ids(texts)]


def test_plans_hold_everything_and_come_close_to_the_bound():
    rng = random.Random(5)
    for sizes in (range(1, 257), [100, 130], [256], [255, 1], range(60, 90)):
        histogram = {s: rng.randrange(1, 5_000) for s in sizes}
        plan = plan_sequences(histogram, 256)
        held = {}
        for times, pattern in plan:
            assert times > 0
            assert sum(s * n for s, n in pattern.items()) <= 256
            for s, n in pattern.items():
                held[s] = held.get(s, 0) + n * times
        assert held == histogram
    histogram = {s: 1_000_000 // s for s in range(1, 257)}
    sequences = sum(times for times, _ in plan_sequences(histogram, 256))
    assert sequences <= 1.001 * sum(s * n for s, n in histogram.items()) / 256 + 256
    assert plan_sequences({}, 256) == []


def test_odd_documents(spark, scratch, documents):
    texts = {1: None, 2: "", 3: "a few words", 4: "many words here " * 4_000, 5: " ".join(["x"] * (SEQUENCE - 1)), 6: " ".join(["x"] * SEQUENCE)}
    docs = documents(*texts.items())
    rows = pack(docs, scratch).collect()
    check_pieces(rows, dict(zip(texts, plain_ids(texts.values()), strict=True)))
    check_layout(rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)

    same = pack(documents((1, "equal"), (1, "equal"), (None, "equal")), scratch).collect()
    assert len(same) == 3
    check_layout(same)


def test_many_pieces_of_a_size(scratch, documents):
    rows = pack(documents(*[(k, "same length") for k in range(2_000)]), scratch, with_ids=False).collect()
    check_layout(rows)
    assert len(rows) == 2_000
    assert len({(r.sequence_id, r.offset) for r in rows}) == 2_000


def test_empty_table(scratch, documents):
    assert pack(documents((1, "a")).limit(0), scratch).count() == 0


def test_the_grid_must_divide_the_length(scratch, documents):
    from matchledger.llm.packing import assign_sequences, cut_documents

    with pytest.raises(ValueError, match="grid"):
        assign_sequences(cut_documents(documents((1, "a"))), scratch, length=100, grid=16)


def test_short_texts_fill_their_sequences(spark, scratch):
    for words in (1, 2, 20, 100):  # and the closing id
        rows = pack(
            spark.range(20_000).selectExpr("id AS doc_id", f"trim(repeat('the ', {words - 1})) AS text"), scratch, with_ids=False
        ).collect()
        check_layout(rows)
        sequences = len({r.sequence_id for r in rows})
        assert {r.doc_tokens for r in rows} == {words}
        # No whole number of them may fill a sequence, and one sequence is not full.
        assert sequences == -(-20_000 // (SEQUENCE // words))
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet").selectExpr("monotonically_increasing_id() AS doc_id", "text")
    rows = pack(turns, scratch, with_ids=False).collect()
    check_layout(rows)
    assert sum(r.length for r in rows) / SEQUENCE / len({r.sequence_id for r in rows}) > 0.95


def test_sizes_lose_little_and_the_planner_is_quick():
    from matchledger.llm.packing import size_of_lengths, unit_of

    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, SEQUENCE + 1, 100_000), rng.lognormal(5, 1.2, 100_000).clip(1, SEQUENCE).astype(int)):
        histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
        sizes = size_of_lengths(histogram, 256)
        assert sizes.keys() == histogram.keys() and all(s >= x for x, s in sizes.items()) and len(set(sizes.values())) == 256
        assert sum((sizes[x] - x) * n for x, n in histogram.items()) < 0.01 * lengths.sum()
        rounded = {}
        for x, n in histogram.items():
            rounded[sizes[x]] = rounded.get(sizes[x], 0) + n
        sequences = sum(times for times, _ in plan_sequences(rounded, SEQUENCE))
        assert lengths.sum() / SEQUENCE / sequences > 0.98
    assert unit_of({3: 100}, 16) == 1 and unit_of({4_000: 100}, 16) == 16 and unit_of({}, 16) == 16
