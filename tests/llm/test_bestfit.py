"""Whole documents in few sequences: every id once, against the tokenizer, bounds and plain packers."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchledger.llm.bestfit import SEQUENCE, best_fit, op12_best_fit, pack_whole, plan_sequences
from tests.conftest import SF_DIR


def plain_ids(texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    return [[*e.ids, 0] for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, ids: dict, length: int = SEQUENCE) -> int:
    """Every id in one piece, uncut where it can be, no gap; the number of sequences."""
    expected = {
        (doc, i, i * length, len(whole[i * length : (i + 1) * length]), zlib.crc32(np.array(whole[i * length : (i + 1) * length], "<u4").tobytes()))
        for doc, whole in ids.items()
        for i in range(-(-len(whole) // length))
    }
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    return check_layout(rows, length)


def check_layout(rows, length: int = SEQUENCE) -> int:
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence)


def sequences(histogram: dict[int, int], capacity: int) -> int:
    """How many a plan needs; it must hold the histogram."""
    held = dict.fromkeys(histogram, 0)
    plan = plan_sequences(histogram, capacity)
    for times, configuration in plan:
        assert times > 0 and sum(s * n for s, n in configuration.items()) <= capacity
        for s, n in configuration.items():
            held[s] += n * times
    assert held == histogram
    return sum(times for times, _ in plan)


def fewest(sizes: list[int], capacity: int) -> int:
    """Exhaustive: the fewest bins, one piece after another into each kind of open bin or a new one."""
    best, sizes = len(sizes), sorted(sizes, reverse=True)

    def place(i: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            rest = list(rooms)
            rest.remove(room)
            place(i + 1, [*rest, room - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def first_fit(histogram: dict[int, int], capacity: int) -> int:
    left, n = dict(histogram), 0
    while any(left.values()):
        room, held = capacity, {}
        for s in sorted(left, reverse=True):
            if fits := min(left[s], room // s):
                held[s] = fits
                room -= fits * s
        times = min(left[s] // fits for s, fits in held.items())
        left = {s: m - times * held.get(s, 0) for s, m in left.items()}
        n += times
    return n


def test_query_packs_every_id_in_the_fewest_sequences(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip((d.doc_id for d in docs), plain_ids([d.text for d in docs]), strict=True))
    needed = check(op12_best_fit(spark, SF_DIR).collect(), ids)
    assert needed <= -(-sum(map(len, ids.values())) // SEQUENCE) + 1


def test_small_cases_against_all_packings():
    rng = random.Random(2)
    worse = 0
    for _ in range(60):
        sizes = [rng.randrange(1, 20) for _ in range(rng.randrange(1, 9))]
        found, best = sequences({s: sizes.count(s) for s in sizes}, 20), fewest(sizes, 20)
        assert best <= found <= best + 1
        worse += found > best
    assert worse <= 3


@pytest.mark.parametrize("low, high, most", [(1, 2_049, 1.01), (300, 1_100, 1.012), (600, 760, 1.01), (3, 40, 1.001)])
def test_large_histograms_come_close_to_the_bound(low, high, most):
    rng = random.Random(low)
    histogram = {s: rng.randrange(1, 500) for s in range(low, high)}
    bound = max(-(-sum(s * n for s, n in histogram.items()) // SEQUENCE), sum(n for s, n in histogram.items() if 2 * s > SEQUENCE))
    found = sequences(histogram, SEQUENCE)
    assert found <= most * bound or found <= first_fit(histogram, SEQUENCE)


def test_plans_of_few_lengths():
    assert plan_sequences({}, 100) == []
    assert sequences({100: 7}, 100) == 7
    assert sequences({1: 1_000_000}, 2_048) == 489
    assert sequences({1_025: 500, 1_023: 400, 3: 10}, 2_048) == 500
    assert sequences({1_024: 10**12 + 1}, 2_048) == (10**12) // 2 + 1


def test_best_fit_leaves_the_least_room():
    sizes = np.array([3, 5, 7, 9], np.int64)
    assert best_fit(sizes, np.array([1, 1, 1, 1]), 16) == [(1, {9: 1, 7: 1}), (1, {5: 1, 3: 1})]
    for many in itertools.product(range(3), repeat=4):
        plan = best_fit(sizes, np.array(many), 16)
        held = {int(s): sum(times * c.get(int(s), 0) for times, c in plan) for s in sizes}
        assert held == dict(zip(sizes.tolist(), many, strict=True))


def test_odd_documents(scratch, documents):
    texts = {1: None, 2: "", 3: "a few words", 4: "many words here " * 4_000, 5: " ".join(["x"] * (SEQUENCE - 1)), 6: " ".join(["x"] * SEQUENCE)}
    rows = pack_whole(documents(*texts.items()), scratch).collect()
    check(rows, dict(zip(texts, plain_ids(texts.values()), strict=True)))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_repeated_rows_and_many_of_one_length(scratch, documents):
    same = pack_whole(documents((1, "equal"), (1, "equal"), (None, "equal")), scratch, with_ids=False).collect()
    assert len(same) == 3 and check_layout(same) == 1
    rows = pack_whole(documents(*[(k, "same length") for k in range(3_000)]), scratch, with_ids=False).collect()
    (ids,) = plain_ids(["same length"])
    assert check(rows, dict.fromkeys(range(3_000), ids)) == -(-3_000 // (SEQUENCE // len(ids)))


def test_empty_table(scratch, documents):
    assert pack_whole(documents((1, "a")).limit(0), scratch).count() == 0
