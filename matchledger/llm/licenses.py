"""License scans by template markup.

A template is a license's wording in which parts are marked, as license lists
publish them:

    <<beginOptional>> ... <<endOptional>>      may be missing, may be nested
    <<var;name="...";words="0-12">>            any words, so many

It is compiled to an automaton over words. A text is accepted where the automaton
runs from some word to its end, that is where all wording outside of the marks
stands exactly, word by word, whatever the punctuation and the case of A-Z.

Base phrases are templates without marks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import table, utf8

BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TEMPLATES = {
    "apache-2.0": [
        'licensed under the apache license<<beginOptional>>, version<<endOptional>> 2.0',
        'licensed under the apache license version 2.0 the license you may not use this '
        '<<var;name="what";words="1-3">> except in compliance with the license',
    ],
    "mit": [
        '<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>> under the '
        '<<beginOptional>>terms of the<<endOptional>> mit license',
        'permission is hereby granted free of charge to any person obtaining a copy of this software and associated '
        'documentation files<<beginOptional>> the software<<endOptional>> to deal in the software without restriction',
    ],
    "gpl-3.0": [
        'licensed under the <<beginOptional>>terms of the<<endOptional>> gnu general public license'
        '<<beginOptional>> as published by the free software foundation either<<endOptional>> version 3',
        'redistribute it and or modify it under the terms of the gnu general public license as published by '
        '<<var;name="publisher";words="1-6">> either version 3 of the license',
    ],
    "gpl-2.0": [
        'licensed under the <<beginOptional>>terms of the<<endOptional>> gnu general public license'
        '<<beginOptional>> as published by the free software foundation either<<endOptional>> version 2',
        'redistribute it and or modify it under the terms of the gnu general public license as published by '
        '<<var;name="publisher";words="1-6">> either version 2 of the license',
    ],
    "bsd": [
        'redistribution and use in source and binary forms with or without modification are permitted provided that '
        'the following conditions are met',
    ],
    "mpl-2.0": [
        'this source code form is subject to the terms of the mozilla public license<<beginOptional>> v<<endOptional>> 2.0',
    ],
    "isc": [
        'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted',
    ],
    "cc-by-4.0": ['licensed under <<beginOptional>>a<<endOptional>> cc by<<beginOptional>> license<<endOptional>> 4.0'],
    "cc-by-sa-4.0": ['licensed under <<beginOptional>>a<<endOptional>> cc by sa<<beginOptional>> license<<endOptional>> 4.0'],
    "cc-by-nc-4.0": ['licensed under <<beginOptional>>a<<endOptional>> cc by nc<<beginOptional>> license<<endOptional>> 4.0'],
    "copyright-notice": [
        'copyright <<beginOptional>>c<<endOptional>> <<var;name="holder";words="1-12">> all rights reserved',
    ],
}

#: Score of a document with an accepted template, and of one with a base phrase only.
TEMPLATE_SCORE, PHRASE_SCORE = 1.0, 0.5

_KEPT = bytes(c for c in range(256) if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128)
_BLANKED = bytes(c if c in _KEPT else 32 for c in range(256))
_MARK = re.compile(r"<<(.*?)>>")


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    return text.lower().translate(_BLANKED).split()


# templates ---------------------------------------------------------------------

Part = bytes | tuple[int, int] | list  # a word, a number of free words, an optional part


def parse_template(markup: str) -> list[Part]:
    """Words, free regions as (least, most), and optional parts as lists of the same."""
    stack: list[list[Part]] = [[]]
    for k, piece in enumerate(_MARK.split(markup)):
        if k % 2 == 0:
            stack[-1].extend(words_of(piece.encode()))
        elif piece == "beginOptional":
            stack.append([])
        elif piece == "endOptional":
            if len(stack) == 1:
                raise ValueError("an optional part ends that has not begun")
            part = stack.pop()
            stack[-1].append(part)
        elif piece.startswith("var;"):
            found = re.search(r'words="(\d+)-(\d+)"', piece)
            stack[-1].append((int(found[1]), int(found[2])) if found else (0, 20))
        else:
            raise ValueError(f"unknown mark <<{piece}>>")
    if len(stack) > 1:
        raise ValueError("an optional part does not end")
    return stack[0]


@dataclass
class TokenAutomaton:
    """States with steps on a word or on any word, and jumps without one; 0 starts, `last` accepts."""

    steps: list[dict[bytes, list[int]]] = field(default_factory=lambda: [{}])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    jumps: list[list[int]] = field(default_factory=lambda: [[]])
    last: int = 0
    needed: bytes = b""

    def _state(self) -> int:
        self.steps.append({})
        self.free.append([])
        self.jumps.append([])
        return len(self.steps) - 1

    def _add(self, parts: list[Part], at: int) -> int:
        for part in parts:
            before, at = at, self._state()
            if isinstance(part, bytes):
                self.steps[before].setdefault(part, []).append(at)
            elif isinstance(part, list):
                self.jumps[before].append(at)
                self.jumps[self._add(part, before)].append(at)
            else:
                least, most = part
                for k in range(most):
                    if k >= least:
                        self.jumps[before].append(at)
                    after = self._state()
                    self.free[before].append(after)
                    before = after
                self.jumps[before].append(at)
        return at

    @classmethod
    def of(cls, markup: str) -> TokenAutomaton:
        parts = parse_template(markup)
        found = cls()
        found.last = found._add(parts, 0)
        runs, run = [], []
        for part in [*parts, (0, 0)]:
            if isinstance(part, bytes):
                run.append(part)
            else:
                runs, run = [*runs, b" ".join(run)], []
        found.needed = max(runs, key=len)
        if not found.needed:
            raise ValueError("a template needs a word that may not be missing")
        if found.last in found.closed({0}):
            raise ValueError("a template must not accept no words at all")
        return found

    def closed(self, states: set[int]) -> set[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.jumps[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return found

    def accepts_at(self, words: list[bytes], start: int) -> bool:
        states = self.closed({0})
        for k in range(start, len(words)):
            states = self.closed({t for s in states for t in (*self.steps[s].get(words[k], ()), *self.free[s])})
            if self.last in states:
                return True
            if not states:
                break
        return False

    def starts(self, words: list[bytes], joined: bytes) -> Iterator[int]:
        """Words from which the automaton accepts; `joined` is the words between single blanks, for a quick no."""
        if b" " + self.needed + b" " not in joined:
            return
        first = self.closed({0})
        known = {w for s in first for w in self.steps[s]}
        any_word = any(self.free[s] for s in first)
        for k, word in enumerate(words):
            if (any_word or word in known) and self.accepts_at(words, k):
                yield k


@lru_cache(maxsize=1)
def _compiled() -> tuple[list[tuple[str, TokenAutomaton]], list[tuple[str, TokenAutomaton]]]:
    base = [(label, TokenAutomaton.of(phrase)) for phrase, label in BASE_PHRASES.items()]
    return base, [(label, TokenAutomaton.of(t)) for label, markups in TEMPLATES.items() for t in markups]


def scan_text(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    base, templates = _compiled()
    places: list[int] = []
    base_labels, labels = set(), set()
    for label, automaton in base:
        if found := list(automaton.starts(words, joined)):
            places += found
            base_labels.add(label)
    for label, automaton in templates:
        if label not in labels and next(automaton.starts(words, joined), None) is not None:
            labels.add(label)
    score = TEMPLATE_SCORE if labels else PHRASE_SCORE if base_labels else 0.0
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score,
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document.

    Phrases and templates are found wherever they stand in the whole text. NULL
    text counts as empty; without a place, first_word and last_word are NULL and
    the labels empty. Each row is scanned by itself, repeated rows included.
    """
    rows = docs.select("doc_id", utf8("text").alias("_text"))
    kinds = {
        "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
        "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
    }
    sql = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    out = rows.select("doc_id", *[F.lit(None).cast(sql[k]).alias(n) for n, k in kinds.items()]).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t.as_py()) for t in batch.column("_text")]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *kinds])

    return rows.mapInArrow(of_batches, out)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


# SQL ---------------------------------------------------------------------------


def _pattern(parts: list[Part]) -> str:
    """The template as a regular expression over words with a blank before each."""
    out = ""
    for part in parts:
        if isinstance(part, bytes):
            out += " " + part.decode()
        elif isinstance(part, list):
            out += f"(?:{_pattern(part)})?"
        else:
            out += f"(?: [^ ]+){{{part[0]},{part[1]}}}"
    return out


def op5_sql() -> str:
    upper = "".join(map(chr, range(65, 91)))
    places, named = [], []
    for phrase, label in BASE_PHRASES.items():
        words = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {same})")
        named.append((f"contains(j, ' {phrase} ')", label))
    bases = ", ".join(f"CASE WHEN {test} THEN '{label}' END" for test, label in named)
    found = []
    for label, markups in TEMPLATES.items():
        test = " OR ".join(f"regexp_matches(j, '{_pattern(parse_template(m))} ')" for m in markups)
        found.append(f"CASE WHEN {test} THEN '{label}' END")
    return (
        "WITH split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), "
        f"'{upper}', '{upper.lower()}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents), "
        "joined AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS j FROM split), "
        f"found AS (SELECT doc_id, len(w) AS n_words, flatten([{', '.join(places)}]) AS p, "
        f"list_filter([{bases}], lambda x: x IS NOT NULL) AS b, "
        f"list_filter([{', '.join(found)}], lambda x: x IS NOT NULL) AS t FROM joined) "
        "SELECT doc_id, n_words::BIGINT AS n_words, len(p)::BIGINT AS n_base, (list_min(p) - 1)::BIGINT AS first_word, "
        "(list_max(p) - 1)::BIGINT AS last_word, array_to_string(list_sort(b), ',') AS base_labels, "
        "array_to_string(list_sort(list_distinct(list_concat(b, t))), ',') AS labels, "
        f"CASE WHEN len(t) > 0 THEN {TEMPLATE_SCORE} WHEN len(b) > 0 THEN {PHRASE_SCORE} ELSE 0 END::DOUBLE AS score FROM found"
    )
