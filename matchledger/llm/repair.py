"""Conversation structure repair: the cheapest edits that make a conversation alternate.

A repaired conversation is empty, or reads user, assistant, user, assistant and so on to an
assistant, after at most one system row. Every row is kept (0), given the role user or
assistant (1) or deleted (2), and empty rows may be inserted anywhere (5). Blank and repeated
rows must be deleted, and a truncated row that is not costs 5 more.

A Viterbi search walks the rows in order over four states: nothing kept yet, after the system
row, after a user, after an assistant. The best way into each state survives. The ways form a
tree of backpointers with reference counts: a way that no survivor goes through is given up at
once, and edits that all survivors share are emitted and forgotten, so what is held is only the
part that is not decided yet. Of two ways of equal cost, the one whose edits come first as text
survives; both are compared in full from the place where they part. Neither can be the beginning
of the other, as inserted rows cost, so what follows never changes that order.

Which rows repeat an earlier one is found by aggregation before. The rows are then sorted by
conversation and turn, and a task walks through them: it holds neither a conversation nor its
texts, however long, but the undecided rows of one. As the digest of a repaired conversation
runs over all its text in order, one task has to see that text.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import Scratch, prepare, table

USER, ASSISTANT = "user", "assistant"
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: State after a row of each initial, by state: nothing kept, after system, after user, after assistant.
NOTHING, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = (
    {"s": AFTER_SYSTEM, "u": AFTER_USER},
    {"u": AFTER_USER},
    {"a": AFTER_ASSISTANT},
    {"u": AFTER_USER},
)
LARGEST = 2**63 - 1


class Way:
    """One edit and the way to it."""

    __slots__ = ("before", "edit", "depth", "after", "held")

    def __init__(self, before: Way | None, edit: str):
        self.before, self.edit = before, edit
        self.depth = before.depth + 1 if before else 0
        self.after: set[Way] = set()
        self.held = False
        if before:
            before.after.add(self)


def _comes_first(a: tuple[Way, str], b: tuple[Way, str]) -> bool:
    """Whether the edits of `a`, a way and one edit more, come before those of `b` as text."""
    (x, end_x), (y, end_y) = a, b
    left, right = [end_x], [end_y]
    while x is not y:
        if x.depth >= y.depth:
            left.append(x.edit)
            x = x.before
        else:
            right.append(y.edit)
            y = y.before
    return left[::-1] < right[::-1]


class Repair:
    """The cheapest repair of one conversation, row by row; `emit` is given each edit once it is decided."""

    def __init__(self, emit: Callable[[str], None]):
        self._emit = emit
        self._root = Way(None, "")
        self._best: dict[int, tuple[int, Way]] = {NOTHING: (0, self._root)}
        self._settle({NOTHING: (0, self._root)})

    def row(self, initial: str, delete: bool, truncated: bool) -> None:
        """The next row: the initial of its role, whether it has to go, and whether its text is truncated."""
        found: dict[int, tuple[int, Way, str]] = {}

        def offer(state: int, cost: int, way: Way, edit: str) -> None:
            old = found.get(state)
            if old is None or cost < old[0] or cost == old[0] and _comes_first((way, edit), old[1:]):
                found[state] = (cost, way, edit)

        for state, (cost, way) in self._best.items():
            offer(state, cost + DELETE, way, "D")
            if not delete:
                kept = cost + (TRUNCATED if truncated else 0)
                for role, then in NEXT[state].items():
                    if role == initial:
                        offer(then, kept, way, "K")
                    if role != "s":
                        offer(then, kept + REROLE, way, "R")
        self._settle({s: (cost, Way(way, edit)) for s, (cost, way, edit) in found.items()})

    def _settle(self, best: dict[int, tuple[int, Way]]) -> None:
        """Insert where that is cheaper, give up what can't be part of the best way, emit what is decided."""
        for state, after in ((NOTHING, AFTER_USER), (AFTER_SYSTEM, AFTER_USER), (AFTER_ASSISTANT, AFTER_USER), (AFTER_USER, AFTER_ASSISTANT)):
            if state in best:
                cost, way = best[state][0] + INSERT, best[state][1]
                old = best.get(after)
                if old is None or cost < old[0] or cost == old[0] and _comes_first((way, "I"), (old[1].before, old[1].edit)):
                    best[after] = (cost, Way(way, "I"))
        # What can follow nothing can follow an assistant, but for a system row, which could be deleted there.
        # What can follow a system row can follow nothing or an assistant as well.
        at = {s: cost for s, (cost, _) in best.items()}
        if at[AFTER_ASSISTANT] + DELETE < at.get(NOTHING, 0):
            del best[NOTHING]
        if min(at.get(NOTHING, at[AFTER_ASSISTANT]), at[AFTER_ASSISTANT]) < at.get(AFTER_SYSTEM, 0):
            del best[AFTER_SYSTEM]
        ways = {way for _, way in best.values()}
        old, self._best = self._best, best
        for way in ways:
            way.held = True
        for _, way in old.values():
            if way not in ways:
                way.held = False
        for _, way in old.values():
            self._give_up(way)
        # An insertion that another one replaced, or a state given up, left ways that nothing goes through.
        for way in list(self._leaves(old, ways)):
            self._give_up(way)
        while not self._root.held and len(self._root.after) == 1:
            (self._root,) = self._root.after
            self._root.before = None
            self._emit(self._root.edit)

    def _leaves(self, old: dict[int, tuple[int, Way]], ways: set[Way]) -> Iterator[Way]:
        """Ways of at most three edits beyond what survived before that end nowhere."""
        level = {way for _, way in old.values()}
        for _ in range(3):
            level = {after for way in level for after in way.after}
            yield from (way for way in level if not way.after and not way.held)

    @staticmethod
    def _give_up(way: Way) -> None:
        while not way.held and not way.after and way.before:
            way.before.after.discard(way)
            way = way.before

    def undecided(self) -> int:
        """How many edits are held."""
        return max(way.depth for _, way in self._best.values()) - self._root.depth

    def finish(self) -> int:
        """Emit the rest; the cost of all edits."""
        ends = [self._best[s] for s in (NOTHING, AFTER_ASSISTANT) if s in self._best]
        cost, way = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or other_cost == cost and self._text(other) < self._text(way):
                cost, way = other_cost, other
        for edit in self._text(way):
            self._emit(edit)
        return cost

    def _text(self, way: Way) -> str:
        edits = []
        while way is not self._root:
            edits.append(way.edit)
            way = way.before
        return "".join(reversed(edits))


class Conversation:
    """What is returned of one conversation, from its rows in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self._undecided: deque[tuple[str, str]] = deque()
        self._audit, self._digest, self._lines, self._after_user = [], hashlib.sha256(), 0, False
        self._least = self._turn = self._previous = self._last = None
        self._turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._repair = Repair(self._edited)

    def add(self, turn: int | None, role: str, text: str, repeats: bool) -> None:
        """The next row; `repeats`: its role and text occur in an earlier turn."""
        row = (turn, role, text)
        repeats, self._last = repeats or row == self._last, row
        if turn is not None and turn != self._turn:
            self._least = turn if self._least is None else self._least
            self._turn, self._turns = turn, self._turns + 1
        plain = text.rstrip(BLANKS)
        blank, cut = not plain, False
        if blank:
            self.blank += 1
        elif repeats:
            self.duplicate += 1
        elif plain[-1] not in ENDS:
            cut = True
            self.truncated += 1
        initial = role[:1]
        if self._previous is not None and self._previous + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self._previous = initial
        self._undecided.append((role, text))
        self._repair.row(initial, blank or repeats, cut)

    def _edited(self, edit: str) -> None:
        self._audit.append(edit)
        if edit == "I":
            role, text = None, ""
        else:
            role, text = self._undecided.popleft()
        if edit == "D":
            return
        if edit != "K":
            role = ASSISTANT if self._after_user else USER
        self._after_user = role[:1] == "u"
        self._digest.update((("\n" if self._lines else "") + f"{role}:{text}").encode())
        self._lines += 1

    def result(self) -> tuple:
        cost = self._repair.finish()
        gaps = 0 if self._least is None else min(self._turn - self._least + 1 - self._turns, LARGEST)
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
            "".join(self._audit), self._digest.hexdigest(),
        )


# rows --------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults, by a checksum of conversation and turn: what a test of the repair starts from.

    Adds `gone`: a row that was dropped stays as a mark of its conversation, without role and
    text. Nulls of any column read as one blank, but a turn or conv_id stays NULL.
    """
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(place.cast("binary")), F.lit(20))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    gone = F.col("_kind") == 0
    return rows.select("conv_id", "turn", *known, kind.alias("_kind")).select(
        "conv_id", "turn",
        F.when(~gone, F.when(F.col("_kind") == 4, USER).otherwise(F.col("role"))).alias("role"),
        F.when(~gone, text).alias("text"), gone.alias("gone"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


def repair_conversations(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    rows: conv_id, turn, role, text, and `gone` for rows that only name their conversation.
    A conversation's rows go by turn, NULL first, those of one turn by role and text, so their
    order in the table does not matter; a NULL conv_id is a conversation too. NULL role or text
    reads as one blank. An empty table gives no rows, other columns are not looked at, turns
    that are 2 ** 63 apart have 2 ** 63 - 1 gaps.
    """
    prepare(rows.sparkSession)
    known = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = scratch.stage(rows.select("conv_id", "turn", *known, "gone").withColumn("_content", F.when(~F.col("gone"), content)), "rows")
    # NULL is the first turn: a struct of whether there is one and which.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = rows.filter("not gone").groupBy("conv_id", "_content").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    again = scratch.stage(again.filter("_n > 1").select(F.col("conv_id").alias("_conv"), F.col("_content").alias("_same"), "_first"), "again")
    marked = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_content") == F.col("_same")), "left")
    marked = marked.select(
        "conv_id", "turn", "role", "text", "gone",
        F.coalesce(~F.col("turn").eqNullSafe(F.col("_first.turn")) & F.col("_first").isNotNull(), F.lit(False)).alias("repeats"),
    )
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = F.lit(0).cast("long")
    out = rows.select("conv_id", *[whole.alias(n) for n in names], F.lit("").alias("audit"), F.lit("").alias("repaired_sha256")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done, types = None, [], None

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], out.names)

        for batch in batches:
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * len(names), pa.string(), pa.string()]
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "repeats")]
            for conv_id, turn, role, text, gone, repeats in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current:
                        done.append(current.result())
                    current = Conversation(conv_id)
                if not gone:
                    current.add(turn, role, text, repeats)
            if len(done) >= 1_000:
                yield flushed()
        if current:
            done.append(current.result())
        if done:
            yield flushed()

    return ordered.mapInArrow(of_batches, out)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")), Scratch(spark))


def op13_sql() -> str:
    """The same search as a recursive query that keeps whole audits and texts."""
    return r"""WITH RECURSIVE known AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
), kinds AS (
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(place, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, b: list_reduce(
            list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda r, bit: xor(r >> 1, 3988292384 * (r & 1))
        )
    ), 4294967295) % 20 AS kind
    FROM known
), hurt AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0)
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS plain
    FROM hurt
), faults AS (
    SELECT *, left(role, 1) AS initial,
        CASE WHEN plain = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN right(plain, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM ordered
), nexts(state, role, after) AS (
    VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), convs AS (
    SELECT c.conv_id, coalesce(max(f.i), 0) AS n FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY c.conv_id
), ways AS (
    SELECT conv_id, n, 0::BIGINT AS i, s.state, s.cost::BIGINT AS cost, s.audit, s.lines
    FROM convs, (VALUES (0, 0, '', []::VARCHAR[]), (2, 5, 'I', ['user:']), (3, 10, 'II', ['user:', 'assistant:'])) s(state, cost, audit, lines)
    UNION ALL
    (
    WITH moved AS (
        SELECT w.conv_id, w.n, w.i + 1 AS i, w.state, w.cost + 2 AS cost, w.audit || 'D' AS audit, w.lines
        FROM ways w WHERE w.i < w.n
        UNION ALL
        SELECT w.conv_id, w.n, w.i + 1, x.after, w.cost + (f.initial <> x.role)::BIGINT + 5 * (f.fault = 'truncated')::BIGINT,
            w.audit || CASE WHEN f.initial = x.role THEN 'K' ELSE 'R' END,
            list_append(w.lines, CASE WHEN f.initial = x.role THEN f.role WHEN x.role = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text)
        FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
        JOIN nexts x ON x.state = w.state
        WHERE f.fault NOT IN ('blank', 'duplicate') AND (f.initial = x.role OR x.role <> 's')
    ), inserted AS (
        SELECT * FROM moved
        UNION ALL
        SELECT m.conv_id, m.n, m.i, x.after, m.cost + 5, m.audit || 'I', list_append(m.lines, CASE x.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
        FROM moved m JOIN nexts x ON x.state = m.state AND x.role <> 's'
        UNION ALL
        SELECT m.conv_id, m.n, m.i, 3, m.cost + 10, m.audit || 'II', list_concat(m.lines, ['user:', 'assistant:'])
        FROM moved m WHERE m.state IN (0, 1)
    )
    SELECT * FROM inserted QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
    )
), ends AS (
    SELECT * FROM ways WHERE i = n AND state IN (0, 3) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
), measures AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
    sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN measures m ON m.conv_id IS NOT DISTINCT FROM e.conv_id"""
