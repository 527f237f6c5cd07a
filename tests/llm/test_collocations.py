"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from matchledger.llm import collocations as op
from matchledger.llm.collocations import Words, collocations, packed_run, split_words, unpacked_run


def plain_collocations(rows, least: int, kept: int = 2_000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    covered = set()
    for p, a in found.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                inner = (p[0], *p[i : i + k])
                if 100 * a >= 80 * counts[inner]:
                    covered.add(inner)
    out = []
    for lang in totals:
        scored = []
        for p, a in found.items():
            if p[0] == lang and p not in covered:
                words = p[1:]
                score, _, l, r = min(
                    (2_000_000 * a // (counts[(lang, *words[:k])] + counts[(lang, *words[k:])]), k, counts[(lang, *words[:k])], counts[(lang, *words[k:])])
                    for k in range(1, len(words))
                )
                scored.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:kept], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture()
def few(monkeypatch):
    """Production reads all through a chunk and a range; here there are many of both."""
    monkeypatch.setattr(op, "CHUNK_BYTES", 300)
    monkeypatch.setattr(op, "RANGE_KEYS", 50)


def corpus(seed: int, n: int = 400):
    rng = random.Random(seed)
    words = ["New", "york", "é", "É", "the", "a\x1cb", "x-y", "'s", "big apple", "日本", "of", "city"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! ", "\x0b", "\x0c", ";", ":", "?"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends if rng.random() < 0.3 else [" "]) for _ in range(rng.randrange(40)))
        rows.append((i, rng.choice([text, text, "NEW york city of the"]), rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    rows += [(None, None, "en"), (7, "", "xx"), (7, "one", "xx"), (7, " . ", "yy")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_count(seed, few, scratch, documents):
    rows = corpus(seed)
    found = rows_of(collocations(documents(*rows, partitions=5), scratch))
    assert found == plain_collocations([(lang, text) for _, text, lang in rows], 30)
    assert {r[0] for r in found} >= {"en", "und"}


def test_only_the_best_are_kept(scratch, documents):
    rows = corpus(3)
    found = rows_of(collocations(documents(*rows), scratch, kept=4))
    assert found == plain_collocations([(lang, text) for _, text, lang in rows], 30, 4)


def test_counts_at_the_bound_and_copies_of_one_document(scratch, documents):
    rows = [(1, "twice told tale", "en")] * 29 + [(1, "told tale", "en")] + [(2, "just short of it", "en")] * 29
    found = rows_of(collocations(documents(*rows), scratch))
    assert found == [("en", 1, "told tale", 30, 30, 30, 29 * 3 + 2 + 29 * 4, 1_000_000)]


def test_a_full_bitmap_lets_through_more_and_counts_the_same(monkeypatch, few, scratch, documents):
    rows = corpus(4)
    monkeypatch.setattr(op, "key_bitmap", lambda keys: (np.full(2**13, 255, np.uint8), np.uint64(2**16 - 1)))
    assert rows_of(collocations(documents(*rows), scratch)) == plain_collocations([(lang, text) for _, text, lang in rows], 30)


def test_runs_of_keys_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**48, 5_000, dtype=np.uint64))
    counts = rng.integers(1, 2**31, len(keys))
    found, times = unpacked_run(packed_run(keys, counts), len(keys))
    assert (found == keys).all() and (times == counts).all()


def test_words_of_empty_texts():
    assert Words(split_words([b"", b" . "]), "en").distinct == [b"."]
    assert split_words([b"Big\tTOP", b"\xc3\x89t\xc3\xa9!x"]) == [b"big", b"top", b".", b"\xc3\x89t\xc3\xa9", b".", b"x"]
    assert list(Words([], "en").keys()) == []


def test_long_text_and_empty_table(scratch, documents):
    rows = [(1, "over and " * 200_000, "en")]
    assert rows_of(collocations(documents(*rows), scratch)) == plain_collocations([("en", rows[0][1])], 30)
    assert collocations(documents((1, "a b")).limit(0), scratch).count() == 0
