"""Mixing sources to target weights: subset-sum budget fitting over counts of exact document lengths.

A source's budget is met by whole passes over it and one partial pass. The partial pass needs a subset of documents
whose lengths add up to what is left: documents are counted by exact length, every length gives its share of the
budget rounded down, and a bounded-knapsack dynamic program over the counts that are left closes the rest. Which
documents of a length are taken is decided by a seeded hash. The program sees counts, never documents, so its work
depends on the number of distinct lengths, not on the size of the corpus.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import fresh, staged, with_python

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often than this.
MOST = 3
#: Documents of one source and length are ranked in this many parts by their hash, so a length may hold any number of them.
PARTS = 256
#: The dynamic program closes a gap of about this many words; larger gaps are first narrowed with the longest documents.
GAP = 1 << 16
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_times")


def size_of(text_col: str = "text") -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def pick_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each distinct size to take, so that the taken sizes add up to ``budget`` or just below.

    Sizes are positive and distinct; no more than ``counts`` are taken. Exact whenever the lengths allow it, up to the
    gap that the dynamic program looks at.
    """
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    gap = budget - int((sizes * taken).sum())
    order = np.argsort(-sizes)
    for k in order.tolist():
        more = min(int(counts[k] - taken[k]), max(0, gap - GAP) // int(sizes[k]))
        taken[k] += more
        gap -= more * int(sizes[k])
    first = np.full(gap + 1, -1, np.int64)  # the first item that reached a sum
    reached = np.zeros(gap + 1, bool)
    reached[0] = True
    items: list[tuple[int, int]] = []
    for k in order[::-1].tolist():
        size, left, step = int(sizes[k]), int(counts[k] - taken[k]), 1
        while left and size * step <= gap and not reached[gap]:
            step = min(step, left)
            new = np.flatnonzero(reached[: gap + 1 - size * step]) + size * step if size * step <= gap else np.array([], np.int64)
            new = new[~reached[new]]
            reached[new], first[new] = True, len(items)
            items.append((k, step))
            left, step = left - step, step * 2
        if reached[gap]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        k, step = items[first[at]]
        taken[k] += step
        at -= step * int(sizes[k])
    return taken


def targets(by_source: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``target`` for every row (source, source_size): shares of the whole by weight, none above ``most`` times the source.

    The weights repeat over the sources in the order of their code points, null last. What a capped source leaves is
    shared again by weight among the others, until none is above its cap. One row per source is looked at here.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    # A source is capped if at the level where its cap is met the capped ones and all others exceed the whole.
    level = F.col("cap") / F.col("weight")
    before = Window.orderBy(level, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = (
        ranked.withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("open_level", (F.col("total") - F.col("capped_before")) / (F.col("weights") - F.col("weight_before")))
        # The levels of the sources that stay open agree; it is the first one that no cap lies below.
        .withColumn("final", F.max(F.when(level >= F.col("open_level"), F.col("open_level"))).over(everything))
    )
    target = F.when(F.col("final").isNull() | (level < F.col("final")), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("final")
    )
    return shared.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 17,
) -> DataFrame:
    """The rows of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_times`` (how often each is taken).

    Null texts have size 0; documents of size 0 are taken in whole passes only (they change no sum). A null source is
    a source of its own. Equal rows are told apart by rank, so of repeated rows some may be taken once more than
    others; rows with a null id are ranked by their text. An empty table gives an empty result. Columns of ``docs``
    stay as they are, but for those with one of the four names, which are replaced.
    """
    ranked_by = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    docs = docs.drop(*ADDED)
    own = {n: fresh(docs, f"mix_{n}") for n in ("hash", "part", "source", "length", "slot", "base", "extra", "passes")}
    sized = (
        docs.withColumn("mix_size", size_of(text_col))
        .withColumn(own["hash"], ranked_by)
        .withColumn(own["part"], F.pmod(own["hash"], F.lit(PARTS)))
    )
    keys = [F.col(source_col).alias("source"), F.col("mix_size").alias("size"), F.col(own["part"]).alias("part")]
    parts = staged(sized.groupBy(*keys).count(), "mix-counts")
    lengths = parts.groupBy("source", "size").agg(F.sum("count").alias("count"))
    by_source = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"))
    goals = staged(targets(by_source, weights, most), "mix-targets")
    passes = F.least(F.floor(F.floor(F.col("target") + 0.5) / F.greatest("source_size", F.lit(1))), F.lit(most))
    goals = goals.withColumn("passes", passes.cast("long")).withColumn(
        "budget",
        F.when(F.col("passes") == most, 0).otherwise(F.floor(F.col("target") + 0.5) - F.col("passes") * F.col("source_size")),
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        taken = pick_counts(rows["size"].to_numpy(np.int64), rows["count"].to_numpy(np.int64), int(rows["budget"].iloc[0]))
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "extra": taken})

    budgets = goals.select(F.col("source").alias("s"), "budget")
    partial = lengths.filter("size > 0").join(budgets, F.col("source").eqNullSafe(F.col("s"))).filter("budget > 0")
    extra = with_python(partial.select("source", "size", "count", "budget")).groupBy("source").applyInPandas(
        fit, "source string, size long, extra long"
    )
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))
    e, g = extra.alias("e"), goals.alias("g")
    plan = staged(
        based.alias("p")
        .join(e, F.col("p.source").eqNullSafe(F.col("e.source")) & (F.col("p.size") == F.col("e.size")), "left")
        .join(g, F.col("p.source").eqNullSafe(F.col("g.source")))
        .select(
            F.col("p.source").alias(own["source"]), F.col("p.size").alias(own["length"]), F.col("p.part").alias(own["slot"]),
            F.col("base").alias(own["base"]), F.coalesce("extra", F.lit(0)).alias(own["extra"]),
            F.col("passes").alias(own["passes"]), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        ),
        "mix-plan",
    )
    same = [F.col(source_col).eqNullSafe(F.col(own["source"])), F.col("mix_size") == F.col(own["length"]), F.col(own["part"]) == F.col(own["slot"])]
    joined = sized.join(plan, reduce(lambda a, b: a & b, same))
    order = Window.partitionBy(source_col, "mix_size", own["part"]).orderBy(own["hash"], id_col)
    rank = F.col(own["base"]) + F.row_number().over(order)
    times = F.col(own["passes"]) + (rank <= F.col(own["extra"])).cast("long")
    return joined.withColumn("mix_times", times).select(*[joined[f"`{c}`"] for c in docs.columns], *ADDED)
