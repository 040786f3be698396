"""Mixing sources to target weights by fitting document lengths to word budgets.

The lengths of a source's documents are counted exactly. Every length gets its share of the budget in
proportion to its documents, up to three copies of each; what one length can't take in whole documents
goes on to the next shorter one. Then the shares of the shortest lengths are taken back until a window of
words is free, and a bounded-knapsack dynamic programme over all copies that are left fills it; the
window grows until the budget is met or nothing more can be taken back. Documents are then chosen
by a seeded hash, so many of each length as the plan says.

Edge cases: a null text has no words; a null source is a source of its own, the last one; a document
without words is never taken (it adds nothing to a budget); repeated rows are documents of their own;
an empty table gives an empty result; columns of the input other than the three used are ignored by
``mix`` and kept by ``mixed_documents``, whatever their names; a document longer than the window makes
the programme's tables as long as twice that document, in words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import positions, ship_package, stored, unused, words

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = 20240607
#: Words of a budget left to the dynamic programme at first, and the most that it is given while shares
#: of longer budgets stand.
WINDOWS = (0, 1 << 11, 1 << 13, 1 << 15)
#: Documents of one source and length are ranked in this many independent slices.
SLICES = 256
#: Levels tried in one pass over the sources.
LEVELS = 64


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.0, most: float = MOST_REPEATS) -> DataFrame:
    """Adds ``part`` (rank by code point, null last), ``weight`` and ``target`` to (source, source_size).

    ``share`` of all words is dealt by weight. A target stops at ``most`` times its source; what it
    cannot take goes to the others by weight, until none is above. So a target is the lesser of its cap and
    of its weight times one level for all. The level is found by narrowing an interval ``LEVELS`` times
    a pass, each pass one aggregate, until no source's cap is met inside it: a few passes, however
    many sources there are. They are ranked over ranges of their names.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(
        positions(sources, [F.col("source").asc_nulls_last()], "part", "mix-order")
        .withColumn("weight", F.element_at(cycle, (F.col("part") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most))),
        "mix-sources",
    )
    met = F.col("cap") / F.col("weight")  # the level at which a source is full
    words_, caps, highest = ranked.agg(F.sum("source_size"), F.sum("cap"), F.max(met)).first()
    goal = share * (words_ or 0)
    low, high = 0.0, float(highest or 0.0)
    if goal < (caps or 0.0):
        while True:
            step = (high - low) / LEVELS
            levels = [low + step * i for i in range(1, LEVELS)] + [high]
            dealt = ranked.agg(*[F.sum(F.least("cap", F.col("weight") * F.lit(level))) for level in levels]).first()
            i = next(i for i, total in enumerate(dealt) if total >= goal or i == LEVELS - 1)
            narrowed = (levels[i - 1] if i else low), levels[i]
            if narrowed == (low, high) or not step:
                break
            low, high = narrowed
            if ranked.filter((met > low) & (met < high)).isEmpty():
                break
        full = met <= low
        fixed, rest = ranked.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        high = (goal - fixed) / rest if rest else high
    return ranked.withColumn("target", F.least("cap", F.col("weight") * F.lit(high)))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, windows=WINDOWS) -> np.ndarray:
    """How many documents of each length to take so that their words sum to ``budget`` or, where no choice
    does, to a number near it. Lengths are positive and distinct, counts bound the answer. A budget within
    the last window gets the nearest sum there is."""
    order = np.argsort(-lengths, kind="stable")
    sizes, most = [int(v) for v in lengths[order]], [int(v) for v in counts[order]]
    whole = sum(size * n for size, n in zip(sizes, most))
    budget = max(0, min(int(budget), whole))
    take, owed = [], 0  # owed: whole * (words due so far - words taken), in exact integers
    for size, n in zip(sizes, most):
        owed += size * n * budget
        take.append(min(n, owed // (size * whole)) if whole else 0)
        owed -= take[-1] * size * whole
    best, least = take, None
    for window in windows:
        plan = list(take)
        free = budget - sum(size * n for size, n in zip(sizes, plan))
        for i in range(len(sizes) - 1, -1, -1):
            back = min(plan[i], max(0, window - free) // sizes[i])
            plan[i] -= back
            free += back * sizes[i]
        picked, gap = knapsack(sizes, [n - took for n, took in zip(most, plan)], free)
        if least is None or gap < least:
            best, least = [took + picked.get(i, 0) for i, took in enumerate(plan)], gap
        if not least or not any(plan):
            break
    answer = np.zeros(len(lengths), dtype=np.int64)
    answer[order] = best
    return answer


def knapsack(sizes: list[int], counts: list[int], budget: int) -> tuple[dict[int, int], int]:
    """Bounded subset sum: item -> copies with the sum nearest to ``budget`` (of two, the smaller), and how far
    it is from it.

    ``reached_by[s]`` is the chunk (an item and a power of two of copies) that first made the sum s;
    the sum without it was reachable by earlier chunks alone, so walking back uses each chunk once.
    Sums beyond twice the budget are farther than no document at all.
    """
    reached_by = np.full(2 * budget + 1, -1, dtype=np.int64)
    reachable = np.zeros(2 * budget + 1, dtype=bool)
    reachable[0] = True
    chunks: list[tuple[int, int]] = []
    for item, (size, left) in enumerate(zip(sizes, counts)):
        left, copies = min(left, 2 * budget // size), 1
        while left > 0 and not reachable[budget]:
            copies = min(copies, left)
            step = size * copies
            new = np.flatnonzero(reachable[: len(reachable) - step] & ~reachable[step:]) + step
            reachable[new] = True
            reached_by[new] = len(chunks)
            chunks.append((item, copies))
            left -= copies
            copies *= 2
        if reachable[budget]:
            break
    sums = np.flatnonzero(reachable)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    gap = abs(at - budget)
    picked: dict[int, int] = {}
    while at:
        item, copies = chunks[reached_by[at]]
        picked[item] = picked.get(item, 0) + copies
        at -= sizes[item] * copies
    return picked, gap


def _plan(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Copies of the documents of each length of one source: so many of all, one more of some."""
        lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        copies = fit(lengths, most * counts, int(rows["budget"].iloc[0]))
        return pd.DataFrame({"part": rows["part"], "size": lengths, "base": copies // counts, "extra": copies % counts})

    return run


def mix(
    documents: DataFrame, weights=WEIGHTS, share: float = 1.0, most: int = MOST_REPEATS, seed: int = SEED
) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken) of every row of ``documents``."""
    return _mix(documents, "doc_id", weights, share, most, seed)


def _mix(documents: DataFrame, key: str, weights=WEIGHTS, share=1.0, most=MOST_REPEATS, seed=SEED) -> DataFrame:
    """``mix`` with ``key`` in place of doc_id. Rows of one key, source and length are interchangeable."""
    ship_package(documents.sparkSession)
    sized = stored(
        documents.select(
            F.col(key).alias("doc_id"), "source", F.size(words(F.col("text"))).cast("long").alias("size")
        ),
        "mix-sizes",
    )
    sources = stored(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
        .withColumn("budget", F.round(F.col("target")).cast("long")),
        "mix-targets",
    )
    rank = F.xxhash64("doc_id", F.lit(seed))
    placed = (
        sized.join(sources.select(F.col("source").alias("__s"), "part"), F.col("source").eqNullSafe(F.col("__s")))
        .select("doc_id", "size", "part", rank.alias("rank"))
        .withColumn("slice", F.pmod("rank", F.lit(SLICES)))
    )
    slices = placed.filter("size > 0").groupBy("part", "size", "slice").agg(F.count(F.lit(1)).alias("n"))
    plan = stored(
        slices.groupBy("part", "size")
        .agg(F.sum("n").alias("n"))
        .join(sources.filter("budget > 0").select("part", "budget"), "part")
        .groupBy("part")
        .applyInPandas(_plan(most), "part long, size long, base long, extra long"),
        "mix-plan",
    )
    earlier = F.sum("n").over(
        Window.partitionBy("part", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    quotas = stored(
        slices.join(plan, ["part", "size"])
        .withColumn("before", F.coalesce(earlier, F.lit(0)))
        .withColumn("quota", F.greatest(F.least("n", F.col("extra") - F.col("before")), F.lit(0)))
        .select("part", "size", "slice", "n", "quota", "base"),
        "mix-quotas",
    )
    # Only slices of which some documents get one copy more need ranking.
    joined = placed.join(quotas, ["part", "size", "slice"], "left")
    settled = joined.filter("quota is null or quota in (0, n)").withColumn(
        "copies", F.coalesce(F.col("base") + F.when(F.col("quota") > 0, 1).otherwise(0), F.lit(0))
    )
    ranks = F.row_number().over(Window.partitionBy("part", "size", "slice").orderBy("rank", "doc_id"))
    ranked = joined.filter("quota > 0 and quota < n").withColumn(
        "copies", F.col("base") + F.when(ranks <= F.col("quota"), 1).otherwise(0)
    )
    columns = ["doc_id", "size", "part", F.col("copies").cast("int").alias("copies")]
    return (
        settled.select(*columns)
        .unionByName(ranked.select(*columns))
        .join(sources.select("part", "source", "source_size", "target"), "part")
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("doc_id", "size", "source", "source_size", "target", "copies", "taken")
    )


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """``documents`` with each row as often as the mix takes it.

    Rows are numbered once, in a written copy, so rows that agree in every column, or have no id, are
    still documents of their own and the targets are met with them too."""
    row, copy = unused(documents, "row"), unused(documents, "copy")
    numbered = stored(
        documents.withColumn(row, F.monotonically_increasing_id()), "mix-rows"
    )
    copies = _mix(numbered, row, **settings).filter("copies > 0").select(
        F.col("doc_id").alias(row), F.col("copies").alias(copy)
    )
    repeats = F.explode(F.array_repeat(F.lit(0), F.col(copy)))
    return numbered.join(copies, row).withColumn(copy, repeats).select(*documents.columns)
