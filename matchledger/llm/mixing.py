"""Mixing sources to target weights by iterative proportional fitting.

The corpus is summed up to cells: tokens by source, language and topic. A stated
share of the tokens is to be kept. Cell weights are raked: scaled to the target
shares of one dimension after the other, again and again, until all marginals hold
within `TOLERANCE`; no cell gets more weight than keeping all of it would give. A
document stays with the probability that gives its cell its weight, so the kept
tokens have the stated size and the target marginals in expectation, and each
document's draw depends on its id and the seed alone.

Without targets of the caller's, a category's share goes by its tokens to a power,
but is no more than all its tokens: a rare source is kept whole, and how rare it is
has no bearing on how much is kept of the others.

DataFrame operations throughout. Documents are read, once for the cells and once
for the draw, but not shuffled while the cells fit `BROADCAST_CELLS`; beyond, the
rates are joined like any table.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchledger.llm.common import ROW, Scratch, table

#: Sweeps that are always made; more follow until no marginal is off by more than TOLERANCE.
SWEEPS = 8
TOLERANCE = 1e-4
#: No more sweeps than these, nor after one that leaves the error as it was, but for STALLED of it; small cells may take long to grow.
MOST_SWEEPS = 200
STALLED = 1e-9
#: Sweeps from one look at the error to the next.
SWEEPS_A_JOB = 4
SEED = "mix-1"
BROADCAST_CELLS = 100_000
CELLS_A_TASK = 50_000
#: The share of a category is in proportion to its tokens to this power.
TEMPER = {"source": 0.8, "lang": 0.85, "topic": 0.9}
#: The share of all tokens that is kept, in expectation.
KEPT_SHARE = 0.8


def word_count(text: str = "text") -> Column:
    """Words between ASCII blanks, 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def _marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def layout_topic(text: str = "text") -> Column:
    """A topic by the look of the whole text, for corpora that name none."""
    c = F.coalesce(F.col(text), F.lit(""))
    size = F.length(c)
    return (
        F.when(size == 0, "empty")
        .when(_marks(c, "|") * 40 >= size, "table")
        .when(_marks(c, "!") * 40 >= size, "loud")
        .when(_marks(c, "\n") * 150 >= size, "lines")
        .otherwise("prose")
    )


def dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic()}


def token_cells(docs: DataFrame, by: dict[str, Column], tokens: Column, scratch: Scratch) -> DataFrame:
    """(the dimensions, tokens) for every cell, NULL being a category like any other."""
    summed = docs.select(*[c.alias(d) for d, c in by.items()], tokens.alias("tokens")).groupBy(*by).agg(
        F.sum("tokens").alias("tokens")
    )
    return scratch.stage(summed, "cells")


def tempered_targets(cells: DataFrame, dimension: str, power: float, kept: float = KEPT_SHARE) -> DataFrame:
    """(dimension, share): tokens to a power, but no more than all tokens of a category, as shares that add up to 1.

    From the smallest category on, one is kept whole as long as its part of what is left would be more than that.
    """
    totals = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    raised = totals.select(dimension, "tokens", F.pow("tokens", F.lit(power)).alias("_raised"))
    whole = raised.agg(F.sum("tokens")).first()[0] or 1
    raised = raised.withColumn("_all", F.col("tokens") / F.lit(whole * kept))
    up = Window.orderBy("tokens", dimension)
    smaller = F.coalesce(F.sum("_all").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_raised").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    scaled = raised.withColumn("_scale", (1 - smaller) / rest)
    fits = F.col("_scale") * F.col("_raised") <= F.col("_all")
    scale = scaled.agg(F.max(F.when(fits, F.col("_scale")))).first()[0]  # that of the first one that fits
    share = F.col("_all") if scale is None else F.least("_all", F.lit(scale) * F.col("_raised"))
    return raised.select(dimension, share.alias("share"))


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", right_hint: str = "") -> DataFrame:
    """Join on equal values, NULL being equal to NULL; the left side's columns, and the right side's others."""
    renamed = right.withColumnsRenamed({d: f"_r_{d}" for d in on})
    renamed = renamed.hint(right_hint) if right_hint else renamed
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_r_{d}")) for d in on])
    return left.join(renamed, same, how).drop(*[f"_r_{d}" for d in on])


def _marginal_error(weighted: DataFrame, goals: dict[str, DataFrame]) -> float:
    """By how much the weight of a category is off its target, at most."""
    off = []
    for d, goal in goals.items():
        total = weighted.groupBy(d).agg(F.sum("weight").alias("_total"))
        off.append(_joined(goal, total, [d], "left").select(F.abs(F.coalesce("_total", F.lit(0.0)) - F.col("share")).alias("_off")))
    return reduce(DataFrame.union, off).agg(F.max("_off")).first()[0] or 0.0


def _scaled(weighted: DataFrame, d: str, goal: DataFrame, cap: Column) -> DataFrame:
    """The weights scaled to the shares of one dimension, summed up before the shuffle and joined."""
    total = weighted.groupBy(d).agg(F.sum("weight").alias("_total"))
    factor = _joined(total, goal, [d], "left").select(
        d, F.when(F.col("_total") > 0, F.coalesce("share", F.lit(0.0)) / F.col("_total")).otherwise(0.0).alias("_f")
    )
    return _joined(weighted, factor, [d]).withColumn("weight", F.least(F.col("weight") * F.col("_f"), cap)).drop("_f")


def _scaled_within(weighted: DataFrame, d: str, cap: Column) -> DataFrame:
    """The same within one partition, where windows need no shuffle; `_share_<d>` is the category's share."""
    total = F.sum("weight").over(Window.partitionBy(d))
    scaled = F.when(total > 0, F.least(F.col("weight") * F.col(f"_share_{d}") / total, cap)).otherwise(0.0)
    return weighted.withColumn("weight", scaled)


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], scratch: Scratch, sweeps: int = SWEEPS, kept: float = KEPT_SHARE
) -> DataFrame:
    """The cells with their raked `weight`, which add up to 1 and have the targets as marginals.

    No weight is more than the cell's tokens over the tokens to be kept. `sweeps` are made
    at least, and more until all marginals hold within TOLERANCE, by SWEEPS_A_JOB. Targets that
    contradict each other on the cells there are cannot be met: a warning gives the error that is left.
    A category without a target, and a cell without tokens, gets weight 0. Few cells
    stay in one partition, where no step needs a shuffle.
    """
    few = cells.count() <= CELLS_A_TASK
    budget = F.lit(float(kept * (cells.agg(F.sum("tokens")).first()[0] or 1)))
    cap = F.col("tokens") / budget
    goals = {d: scratch.stage(t, f"target_{d}") for d, t in targets.items()}
    weighted = cells.withColumn("weight", F.col("tokens").cast("double"))
    if few:
        for d, goal in goals.items():
            weighted = _joined(weighted, goal.withColumnRenamed("share", f"_share_{d}"), [d], "left").fillna(0.0, [f"_share_{d}"])
    made, error, before = 0, float("inf"), float("inf")
    while made < sweeps or (error > TOLERANCE and made < MOST_SWEEPS and error < before * (1 - STALLED)):
        weighted = weighted.coalesce(1) if few else weighted
        for _ in range(SWEEPS_A_JOB):
            for d, goal in goals.items():
                # A join reads the weights twice, so each one is staged; a window reads them once.
                weighted = _scaled_within(weighted, d, cap) if few else scratch.stage(_scaled(weighted, d, goal, cap), "scaled")
        made += SWEEPS_A_JOB
        weighted = scratch.stage(weighted, "raked") if few else weighted
        if made >= sweeps:
            error, before = _marginal_error(weighted, goals), error
    if TOLERANCE < error < float("inf"):
        warnings.warn(f"after {made} sweeps a marginal is still off its target by {error:.6f}", RuntimeWarning, stacklevel=2)
    return weighted.select(*cells.columns, "weight")


def sampling_rates(weighted: DataFrame, by: list[str], scratch: Scratch, kept: float = KEPT_SHARE) -> DataFrame:
    """(the dimensions, probability): what part of a cell's tokens gives it its weight among those kept."""
    budget = F.lit(float(kept * (weighted.agg(F.sum("tokens")).first()[0] or 1)))
    probability = F.when(F.col("tokens") > 0, F.least(F.col("weight") * budget / F.col("tokens"), F.lit(1.0))).otherwise(0.0)
    return scratch.stage(weighted.select(*by, probability.alias("probability")), "rates")


def draw(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A number from 0 to 1 (excluded) by the document's id: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(
    docs: DataFrame, scratch: Scratch, by: dict[str, Column] | None = None, targets: dict[str, DataFrame] | None = None,
    tokens: Column | None = None, sweeps: int = SWEEPS, seed: str = SEED, kept: float = KEPT_SHARE,
) -> DataFrame:
    """The sampled documents: `_row`, the whole row as a struct, the dimensions, and the probability it was kept with.

    kept: the share of the tokens to keep, above 0 and below 1. targets: (dimension, share)
    for each dimension; without them, tempered token shares. Targets of more tokens than a
    category has are met as far as they go, with a warning, and less is kept. Documents of a cell without tokens have probability 0 and go; so do
    all of a corpus without tokens. NULL in a dimension is a category. Rows with
    equal ids are kept or left together; NULL ids draw as one.
    """
    if not 0 < kept < 1:
        raise ValueError("kept is a share between 0 and 1")
    by = by or dimensions()
    cells = token_cells(docs, by, word_count() if tokens is None else tokens, scratch)
    targets = targets or {d: tempered_targets(cells, d, TEMPER.get(d, 1.0), kept) for d in by}
    rates = sampling_rates(rake(cells, targets, scratch, sweeps, kept), list(by), scratch, kept)
    small = rates.count() <= BROADCAST_CELLS
    rows = docs.select(F.struct("*").alias(ROW), draw("doc_id", seed).alias("_draw"), *[c.alias(d) for d, c in by.items()])
    held = _joined(rows, rates, list(by), right_hint="broadcast" if small else "")
    return held.filter("_draw < probability").drop("_draw")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, Scratch(spark)).select(
        f"{ROW}.doc_id", "source", "lang", "topic", F.round("probability", 6).alias("probability")
    )


def op7_sql(sweeps: int = 40) -> str:
    """The same in SQL, one step of the raking after the other; the first look that finds the marginals met counts, or the last one."""
    words = r"coalesce(len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')), 0)"
    size, marks = "length(t)", lambda m: f"(length(t) - length(replace(t, {m}, '')))"
    topic = (
        f"CASE WHEN {size} = 0 THEN 'empty' WHEN {marks("'|'")} * 40 >= {size} THEN 'table' "
        f"WHEN {marks("'!'")} * 40 >= {size} THEN 'loud' WHEN {marks('chr(10)')} * 150 >= {size} THEN 'lines' ELSE 'prose' END"
    )
    steps = [
        f"docs AS MATERIALIZED (SELECT doc_id, source, lang, {topic} AS topic, n FROM "
        f"(SELECT doc_id, source, lang, coalesce(text, '') AS t, {words} AS n FROM documents))",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n)::DOUBLE AS tokens FROM docs GROUP BY ALL)",
        f"budget AS MATERIALIZED (SELECT {KEPT_SHARE} * sum(tokens) AS n FROM cells)",
    ]
    for d, power in TEMPER.items():
        steps.append(
            f"size_{d} AS MATERIALIZED (SELECT {d}, sum(tokens) AS n, pow(sum(tokens), {power}) AS raised, sum(tokens) / any_value(budget.n) AS whole "
            f"FROM cells, budget GROUP BY {d} HAVING sum(tokens) > 0), "
            f"scale_{d} AS (SELECT *, (1 - coalesce(sum(whole) OVER (ORDER BY n, {d} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) "
            f"/ sum(raised) OVER (ORDER BY n, {d} NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM size_{d}), "
            f"goal_{d} AS MATERIALIZED (SELECT {d}, least(whole, raised * coalesce("
            f"(SELECT max(scale) FROM scale_{d} WHERE scale * raised <= whole), 'infinity')) AS share FROM size_{d})"
        )
    last = "step_0"
    steps.append("step_0 AS MATERIALIZED (SELECT *, tokens AS weight FROM cells)")
    looks = []
    for k, d in enumerate(list(TEMPER) * sweeps, 1):
        steps.append(
            f"step_{k} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, "
            f"CASE WHEN s.total > 0 THEN least(c.weight * coalesce(g.share, 0) / s.total, c.tokens / budget.n) ELSE 0 END AS weight FROM budget, {last} c "
            f"JOIN (SELECT {d}, sum(weight) AS total FROM {last} GROUP BY {d}) s ON c.{d} IS NOT DISTINCT FROM s.{d} "
            f"LEFT JOIN goal_{d} g ON c.{d} IS NOT DISTINCT FROM g.{d})"
        )
        last = f"step_{k}"
        made = k / len(TEMPER)
        if made >= SWEEPS and made % SWEEPS_A_JOB == 0:
            off = " UNION ALL ".join(
                f"SELECT abs(g.share - coalesce(sum(s.weight), 0)) AS off FROM goal_{d} g LEFT JOIN {last} s "
                f"ON s.{d} IS NOT DISTINCT FROM g.{d} GROUP BY g.{d}, g.share" for d in TEMPER
            )
            looks.append(f"SELECT {k} AS k, coalesce(max(off), 0) AS off FROM ({off})")
    found = f"coalesce((SELECT min(k) FROM looks WHERE off <= {TOLERANCE}), {k})"
    raked = " UNION ALL ".join(f"SELECT {k} AS k, * FROM step_{k}" for k in range(SWEEPS * len(TEMPER), k + 1, SWEEPS_A_JOB * len(TEMPER)))
    steps += [
        f"looks AS MATERIALIZED ({' UNION ALL '.join(looks)})",
        f"raked AS (SELECT * FROM ({raked}) WHERE k = {found})",
        f"kept AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(weight * budget.n / tokens, 1) ELSE 0 END AS p FROM raked, budget)",
    ]
    u = f"('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0"
    return (
        f"WITH {', '.join(steps)} SELECT d.doc_id, d.source, d.lang, d.topic, round(k.p, 6) AS probability "
        "FROM docs d JOIN kept k ON d.source IS NOT DISTINCT FROM k.source AND d.lang IS NOT DISTINCT FROM k.lang "
        f"AND d.topic = k.topic WHERE {u} < k.p"
    )
