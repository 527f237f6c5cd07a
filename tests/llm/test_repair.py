"""Conversation repair against all possible edits, and how much it holds."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from matchledger.llm.repair import Repair, damaged, repair_conversations

BLANKS = " \t\n\x0b\x0c\r"
FORM = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """(initial, fault) of each row in order."""
    out, seen = [], set()
    for role, text in rows:
        plain = text.strip(BLANKS)
        fault = "blank" if not plain else "duplicate" if (role, text) in seen else "" if plain[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(rows) -> tuple[int, str, list[tuple[str, str]]]:
    """All edits tried: cost, audit and repaired rows, the least by cost, then audit."""
    marks = faults(rows)
    best = (10**9, "", [])
    inserts = ["", "u", "a", "ua", "au"]
    choices = []
    for (role, text), (initial, fault) in zip(rows, marks, strict=True):
        own = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            own += [(more, "K", [(role, text)]), (more + 1, "R", [("user", text)]), (more + 1, "R", [("assistant", text)])]
        choices.append(own)
    gap = [(5 * len(i), "I" * len(i), [({"u": "user", "a": "assistant"}[c], "") for c in i]) for i in inserts]
    steps = [gap]
    for own in choices:
        steps += [own, gap]
    for chosen in itertools.product(*steps):
        cost = sum(c for c, _, _ in chosen)
        if cost > best[0]:
            continue
        after = [row for _, _, rows_ in chosen for row in rows_]
        if FORM.fullmatch("".join(role[:1] or "?" for role, _ in after)):
            audit = "".join(a for _, a, _ in chosen)
            best = min(best, (cost, audit, after), key=lambda x: x[:2])
    return best


def plain_cheapest(rows) -> tuple[int, str]:
    """Whole audits kept for each state: cost and audit."""
    nexts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def least(options):
        found = {}
        for state, cost, audit in options:
            found[state] = min(found.get(state, (cost, audit)), (cost, audit))
        return found

    def opened(found):
        options = [(s, c, a) for s, (c, a) in found.items()]
        for _ in range(3):
            options += [(t, c + 5, a + "I") for s, c, a in options for r, t in nexts[s].items() if r != "s"]
        return least(options)

    ways = opened({0: (0, "")})
    for initial, fault in faults(rows):
        options = []
        for s, (c, a) in ways.items():
            options.append((s, c + 2, a + "D"))
            if fault not in ("blank", "duplicate"):
                c += 5 if fault == "truncated" else 0
                for r, t in nexts[s].items():
                    if r == initial:
                        options.append((t, c, a + "K"))
                    if r != "s":
                        options.append((t, c + 1, a + "R"))
        ways = opened(least(options))
    return min(ways[s] for s in (0, 3) if s in ways)


def run(rows) -> tuple[int, str, int]:
    """Cost, audit, and the most edits held at a time."""
    audit, most = [], 0
    repair = Repair(audit.append)
    for initial, fault in faults(rows):
        repair.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        most = max(most, repair.undecided())
    return repair.finish(), "".join(audit), most


def some_rows(rng, n, roles=("user", "assistant", "system", "tool", "", "s2")):
    texts = ["", " \n", "yes.", "no", "why?", "so!\n", "and"]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}{rng.choice(['.', ''])}") for _ in range(n)]


def test_against_all_edits():
    rng = random.Random(4)
    for n in (0, 1, 2, 3):
        for _ in range(30 if n < 3 else 12):
            rows = some_rows(rng, n)
            cost, audit, _ = cheapest(rows)
            assert run(rows)[:2] == (cost, audit) == plain_cheapest(rows)


def test_against_whole_audits():
    rng = random.Random(5)
    for k in range(400):
        roles = [("user", "assistant"), ("user",), ("system", "user"), ("user", "assistant", "system", "tool")][k % 4]
        rows = some_rows(rng, rng.randrange(1, 40), roles)
        assert run(rows)[:2] == plain_cheapest(rows)


def test_what_is_decided_is_not_held():
    rng = random.Random(7)
    for n, damage in ((1_500, 0.0), (3_000, 0.2)):
        rows = [(["user", "assistant"][i % 2], f"{i}.") for i in range(n)]
        rows = [(role, text if rng.random() >= damage else rng.choice(["", "0.", text[:-1]])) for role, text in rows]
        cost, audit, most = run([("system", "Be brief.")] + rows)
        assert (cost, audit) == plain_cheapest([("system", "Be brief.")] + rows)
        assert most <= (8 if not damage else 400)


def test_what_only_the_end_decides_is_held():
    """An odd row among equal ones could be any of them, until their number is known."""
    for n in (7, 8):
        rows = [("tool", f"{i}.") for i in range(n)]
        cost, audit, most = run(rows)
        assert (cost, audit) == plain_cheapest(rows)
        assert audit == "D" * (n % 2) + "R" * (n - n % 2)
        assert most >= n


def test_ways_given_up_are_forgotten():
    repair = Repair(lambda edit: None)
    for i in range(2_000):
        repair.row("ua"[i % 2], False, False)
    ways, todo = 0, [repair._root]
    while todo:
        way = todo.pop()
        ways += 1
        todo += way.after
    assert ways <= 20


@pytest.fixture()
def conversations(spark):
    def build(*rows, partitions=3):
        return spark.createDataFrame(
            [(*r, 1, "g") for r in rows], "conv_id long, turn long, role string, text string, cost int, audit string"
        ).repartition(partitions)

    return build


def plain_damage(conv_id, turn, role, text):
    role, text = (" " if v is None else v for v in (role, text))
    place = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
    kind = zlib.crc32(place.encode()) % 20
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def expected(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = [d for r in rows if r[0] == conv_id for d in plain_damage(*r)]
        own.sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1], d[2]))
        marks = faults([d[1:] for d in own])
        turns = {d[0] for d in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [sum(f == kind for _, f in marks) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(marks))
        cost, audit = plain_cheapest([d[1:] for d in own])
        lines, left, after_user = [], list(own), False
        for edit in audit:
            role, text = (None, "") if edit == "I" else left.pop(0)[1:]
            if edit != "D":
                role = role if edit == "K" else "assistant" if after_user else "user"
                after_user = role.startswith("u")
                lines.append(f"{role}:{text}")
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[c] for c in names) for r in df.collect()}


def test_conversations_of_odd_rows(conversations, scratch):
    rng = random.Random(6)
    rows = []
    for conv_id in [None, *range(60)]:
        for turn, (role, text) in enumerate(some_rows(rng, rng.randrange(1, 9), ("user", "assistant", "system", None))):
            rows.append((conv_id, rng.choice([turn, turn, turn * 3, None]), role, rng.choice([text, text, None])))
    rows += rng.sample(rows, 20)
    rows += [(100, t, "user", "the same.") for t in range(300)] + [(101, 5, "user", "x" * 2_000_000)]
    assert found(repair_conversations(damaged(conversations(*rows)), scratch)) == expected(rows)


def test_a_conversation_without_rows_left(conversations, scratch):
    gone = next(c for c in itertools.count() if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(repair_conversations(damaged(conversations((gone, 0, "user", "hello."))), scratch)) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    }


def test_undamaged_rows_and_empty_table(conversations, scratch):
    rows = conversations((1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."))
    whole = repair_conversations(rows.withColumn("gone", F.lit(False)), scratch)
    text = "system:Be kind.\nuser:Hi!\nassistant:Hello."
    assert found(whole) == {1: (0, 0, 0, 0, 0, 0, "KKK", hashlib.sha256(text.encode()).hexdigest())}
    assert found(repair_conversations(damaged(rows.limit(0)), scratch)) == {}
