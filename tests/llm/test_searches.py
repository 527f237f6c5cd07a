import math
import random

import numpy as np
import pytest

from matchledger.llm.nearest import nearest, tile_nearest
from matchledger.llm.topk import nearest_codes, segment_counts, segments_of, sign_code

VECTORS = "vec_id long, embedding array<float>, label int, id long, score double, _q int, size int, vector string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2.0, 3, 4, "v") for i, v in rows], VECTORS)


def plain_nearest(queries, rows, k):
    out = set()
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for q, x in usable:
        if q in queries:
            found = []
            for i, y in usable:
                if i != q and len(x) == len(y):
                    total = 0.0
                    for a, b in zip(x, y, strict=True):
                        total += a * b
                    found.append((-total, i))
            for rank, (score, i) in enumerate(sorted(found)[:k], 1):
                out.add((q, rank, i, -score))
    return out


@pytest.mark.parametrize("blocks", [(2_048, 16_384), (3, 10)])
def test_nearest_agrees_with_comparing_all(spark, scratch, blocks):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(-3, 4)).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(30)]  # ties
    df = vectors(spark, rows)
    asked = [i for i, _ in rows if i % 10 == 0]
    found = nearest(df.filter("vec_id % 10 = 0"), df, scratch, k=7, query_block=blocks[0], candidate_block=blocks[1])
    assert {tuple(r) for r in found.collect()} == plain_nearest(asked, rows, 7)


def test_few_survive_the_bounds(monkeypatch):
    seen = []
    from matchledger.llm import nearest as module

    plain = module._inner_products
    monkeypatch.setattr(module, "_inner_products", lambda v, q: seen.append(len(v)) or plain(v, q))
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3_000, 64))
    q, i, s = tile_nearest(np.arange(10), x[:10], np.arange(3_000), x, 20)
    exact = x[:10] @ x.T
    exact[np.arange(10), np.arange(10)] = -np.inf
    for k in range(10):
        assert set(i[q == k]) == set(np.argsort(-exact[k])[:20])
    assert max(seen) < 200


def test_odd_vectors(spark, scratch):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]),
        (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [1e-45, 0.0]), (10, [-1.0, 3e38]), (11, [0.5, 0.5]), (11, [0.5, 0.5]),
    ]
    df = vectors(spark, rows)
    found = {tuple(r) for r in nearest(df, df, scratch, k=20).collect()}
    twice = [(0, 1, 1, 0.5), (0, 2, 11, 0.5), (0, 3, 11, 0.5)]
    assert {r for r in found if r[0] == 0 and r[1] <= 3} == set(twice)
    assert {r[0] for r in found} == {0, 1, 9, 10, 11}  # 8 has no partner of its length
    assert nearest(df.limit(0), df, scratch).count() == nearest(df, df.limit(0), scratch).count() == 0


def plain_codes(queries, codes, k):
    out = set()
    for q, x in queries:
        found = sorted(((x ^ y) & (2**64 - 1)).bit_count() * 10**9 + i for i, y in codes)[:k]
        out |= {(q, r, f % 10**9, f // 10**9) for r, f in enumerate(found, 1)}
    return out


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize(("most_masks", "chunk"), [(20_000, 16_384), (40, 16_384), (20_000, 40), (40, 7)])
def test_codes_agree_with_comparing_all(spark, scratch, monkeypatch, most_masks, chunk):
    rng = random.Random(most_masks + chunk)
    monkeypatch.setattr("matchledger.llm.topk.CHUNK_ENTRIES", chunk)
    monkeypatch.setattr("matchledger.llm.topk.BLOCK_QUERIES", chunk)
    if most_masks < 100:  # two wide segments first, then four
        monkeypatch.setattr("matchledger.llm.topk.segment_counts", lambda codes: [2, 4])
    centres = [rng.getrandbits(64) for _ in range(5)]
    rows = []
    for i in range(300):
        x = rng.choice(centres)
        for _ in range(rng.choice([0, 1, 3, 8, 40])):
            x ^= 1 << rng.randrange(64)
        rows.append((i, signed(x)))
    rows += [(1_000 + i, rows[0][1]) for i in range(20)] + [(2_000, rows[5][1])] * 2
    df = spark.createDataFrame(rows, "id long, code long")
    queries = [r for r in rows if r[0] % 25 == 0]
    found = [tuple(r) for r in nearest_codes(df.filter("id % 25 = 0"), df, scratch, k=6, most_masks=most_masks).collect()]
    expected = plain_codes([q for q in queries if q[0] != 2_000], rows, 6)
    assert {f for f in found if f[0] != 2_000} == expected
    assert len([f for f in found if f[0] == 2_000]) == 12


def test_fewer_codes_than_asked_for_and_nulls(spark, scratch):
    df = spark.createDataFrame([(1, 0), (2, -1), (3, None), (None, 5)], "id long, code long")
    assert {tuple(r) for r in nearest_codes(df, df, scratch).collect()} == {(1, 1, 1, 0), (1, 2, 2, 64), (2, 1, 2, 0), (2, 2, 1, 64)}
    assert nearest_codes(df.limit(0), df, scratch).count() == nearest_codes(df, df.limit(0), scratch).count() == 0


def test_segments_fit_the_number_of_codes():
    assert segment_counts(50_000) == [4]
    assert segment_counts(10**9) == [2, 4]
    assert segment_counts(2**21) == [3, 6]
    for m in (2, 3, 4, 5, 6):
        assert sum(wide for _, wide in segments_of(m)) == 64


def test_sign_codes(spark):
    df = spark.createDataFrame([(1, [0.0, -1.0, 2.0, math.nan, None]), (2, [-1.0] * 63 + [1.0]), (3, None), (4, [])], "i int, embedding array<float>")
    found = {r.i: r.c for r in df.select("i", sign_code().alias("c")).collect()}
    assert found == {1: 5, 2: -(2**63), 3: None, 4: 0}


@pytest.mark.parametrize("size", [63, 64, 65, 72, 200])
def test_codes_take_all_components_and_agree_with_sql(spark, size):
    import duckdb
    import pandas as pd

    from matchledger.llm.topk import op10_sql

    rng = random.Random(size)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.0, -0.0, math.nan, None]) for _ in range(size)]) for i in range(40)]
    rows += [(100 + i, [1.0] * 64 + [5.0 * rng.choice([-1, 1]) for _ in range(size - 64)]) for i in range(50 if size > 64 else 0)]
    rows += [(200, None), (250, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    codes = [(r.vec_id, r.code) for r in df.select("vec_id", sign_code().alias("code")).collect()]
    assert size < 72 or len({c for i, c in codes if 100 <= i < 150}) > 30
    asked = [(i, c) for i, c in codes if i % 50 == 0 and c is not None]
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    found = {tuple(r) for r in con.execute(f"SELECT query_id, rank, vec_id, distance FROM ({op10_sql()})").fetchall()}
    assert found == plain_codes(asked, [c for c in codes if c[1] is not None], 10)


@pytest.mark.parametrize("magnitude", [1e200, 1e-200, 1e154, 1.0])
def test_nearest_of_any_magnitude(spark, scratch, magnitude):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * (magnitude if i % 3 else 1.0)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in nearest(df.filter("vec_id % 10 = 0"), df, scratch, k=8, query_block=4, candidate_block=30).collect()]
    expected = []
    for q, x in rows[::10]:
        scored = []
        for i, y in rows:
            total = 0.0
            for a, b in zip(x, y, strict=True):
                total += a * b
            if i != q:
                scored.append((math.inf if math.isnan(total) else -total, i))
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:8], 1)]
    assert sorted(found) == sorted(expected)
