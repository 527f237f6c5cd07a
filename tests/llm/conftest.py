from __future__ import annotations

import pytest

from matchledger.llm.common import Scratch

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of a document table that might meet names the operators use themselves.
CLASHING = "_tag long, _row string, fp long, at int, ids string, component_id string, score double, start int, _text string"


@pytest.fixture()
def scratch(spark):
    space = Scratch(spark)
    yield space
    space.drop()


@pytest.fixture()
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]), with columns of clashing names beside."""

    def build(*rows, partitions: int = 2):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            size = None if text is None else len(text)
            full.append((doc_id, text, lang, source, size, 7, "r", 8, 9, "i", "c", 0.5, 3, "t"))
        return spark.createDataFrame(full, f"{DOCUMENT}, {CLASHING}").coalesce(partitions)

    return build


def components(n: int, links) -> list[int]:
    """The smallest member that each of n numbers is joined to."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]
