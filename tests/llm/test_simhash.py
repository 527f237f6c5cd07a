import random

import numpy as np
import xxhash

from matchledger.llm.components import connected_components
from matchledger.llm.simhash import (
    drop_near_duplicates,
    fingerprint,
    fingerprint_links,
    near_duplicate_groups,
    op9_simhash,
    shingle_hashes,
)
from tests.conftest import SF_DIR
from tests.llm.conftest import components


def plain_fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", lower) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], ids: list[int]) -> list[int]:
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    x = np.array([prints[i] for i in order], np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    root = components(len(ids), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    found = {order[k]: ids[order[r]] for k, r in enumerate(root)}
    return [found[i] for i in range(len(ids))]


def test_query_agrees_with_comparing_all_pairs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    expected = {
        (r.doc_id, f"{p:016x}", c)
        for r, p, c in zip(rows, prints, plain_components(prints, [r.doc_id for r in rows]), strict=True)
    }
    assert {tuple(r) for r in op9_simhash(spark, SF_DIR).collect()} == expected
    assert len({c for _, _, c in expected}) < len(rows)


def test_a_half_of_the_hashes_is_not_over_half():
    assert fingerprint(np.array([1, 2], np.uint64)) == 0
    assert fingerprint(np.array([3, 2, 1 << 63], np.uint64)) == 2
    assert fingerprint(np.empty(0, np.uint64)) == 0


def test_blanks_and_case_are_ascii_only():
    assert shingle_hashes("Ab\x0bC\td".encode()).tolist() == shingle_hashes(b"aB c D").tolist()
    assert shingle_hashes("a b".encode()).tolist() != shingle_hashes(b"a b").tolist()
    assert len(shingle_hashes("É b c d".encode())) == 2
    assert shingle_hashes("É".encode()).tolist() != shingle_hashes("é".encode()).tolist()


def crowd(seed: int) -> list[int]:
    """Fingerprints around a few centres, many with the same half."""
    rng = random.Random(seed)
    out = []
    for centre in (rng.getrandbits(64) for _ in range(4)):
        for _ in range(60):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.choice([rng.randrange(32), rng.randrange(64)])
            out.append(x)
    return sorted(set(out + [rng.getrandbits(64) for _ in range(50)]))


def test_links_connect_what_all_pairs_connect_however_crowded_a_key(spark, scratch):
    for seed, hot_key in ((1, 10_000), (2, 10), (3, 0)):
        prints = crowd(seed)
        signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
        nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
        links = fingerprint_links(nodes, scratch, hot_key=hot_key)
        at = {s: k for k, s in enumerate(signed)}
        pairs = links.collect()
        assert all((prints[at[r.a]] ^ prints[at[r.b]]).bit_count() <= 3 for r in pairs)
        expected = plain_components(prints, list(range(len(prints))))
        assert components(len(prints), [(at[r.a], at[r.b]) for r in pairs]) == expected
        found = {r.node: r.root for r in connected_components(links, scratch).collect()}
        for s, e in zip(signed, expected, strict=True):
            group = [signed[k] for k in range(len(prints)) if expected[k] == e]
            assert found.get(s, s) == min(group)


def test_links_of_a_crowd_grow_with_its_members(spark, scratch):
    nodes = spark.range(300).selectExpr("id as fp")
    assert fingerprint_links(nodes, scratch).count() < 64 * 300


def test_odd_documents(spark, scratch, documents):
    text = "one two three four five six seven eight"
    docs = documents(
        (5, text), (4, text.upper()), (4, text), (None, text), (7, None), (6, ""), (8, " \n"), (None, "alone"), (9, "x"),
        (10, "word " * 50_000),
    )
    marked, groups = near_duplicate_groups(docs, scratch)
    found = marked.join(groups, "fp").select("doc_id", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(
        [(5, 4), (4, 4), (4, 4), (None, 4), (7, 6), (6, 6), (8, 6), (None, None), (9, 9), (10, 10)], key=repr
    )
    kept = drop_near_duplicates(docs, scratch)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([4, 6, None, 9, 10], key=repr)


def test_empty_table(spark, scratch, documents):
    docs = documents((1, "a")).limit(0)
    marked, groups = near_duplicate_groups(docs, scratch)
    assert marked.count() == groups.count() == drop_near_duplicates(docs, scratch).count() == 0


def test_long_chain_is_one_component(spark, scratch):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in connected_components(links, scratch).collect()} == {0}
    assert connected_components(links.limit(0), scratch).count() == 0
    assert connected_components(spark.range(5).selectExpr("id as a", "id as b"), scratch).count() == 0
