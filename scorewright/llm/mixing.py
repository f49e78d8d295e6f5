"""Operator 3, mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact length).  A source's budget is whole passes over it plus a rest;
the rest is first spread evenly over the lengths, then a bounded-knapsack program over the lengths' spare
counts fills what remains, so the chosen lengths add up to the budget or to the nearest sum below it.
Within a length the documents of least seeded hash are chosen.

Only counts meet in one task: a source is one row per distinct length there, however many documents it
has.  Ranks within (source, length) are taken in 256 slices of the hash, so a length that holds a third
of all rows is spread as well.  Sources are numbered, and their targets found, where they lie: the driver
only sees three sums a round of the resharing, so sources may be as many as hosts.

Defined results: null text: size 0, taken 0.  A null source is a source of its own, last.  Repeated rows are
separate documents of equal rank; either may be the one chosen.  Empty table: no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import spans

KNAPSACK_WORDS = 1 << 16
SLICE_BITS = 8


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of every whole text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = spans.buffers(batch.column(1))
            n = np.zeros(len(off) - 1, np.int64)
            for lo in range(0, len(n), 64):          # a few texts at a time: the masks are as long as the texts
                hi = min(lo + 64, len(n))
                part = off[lo:hi + 1]
                starts, _ = spans.runs(~spans.SPACES[buf[part[0]:part[-1]]], part - part[0])
                n[lo:hi] = np.bincount(spans.doc_of(part - part[0], starts), minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], ["doc_id", "source", "size"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")).mapInArrow(
        count, "doc_id long, source string, size long")


def _unit(total: int, over: Callable[[float], tuple[int, int, float]], most: int) -> float:
    """Words for a weight of one: what full sources leave of the total, shared by the others.  ``over(unit)`` gives the number
    and size of the sources that the unit fills, and the weight of the others."""
    unit, before, (full, size, weight) = 0.0, -1, over(0.0)
    while full > before and weight:
        unit, before = (total - most * size) / weight, full
        full, size, weight = over(unit)
    return unit


def targets(size: dict[str | None, int], cycle: Sequence[float] = (1, 2, 3), most: int = 3) -> dict[str | None, float]:
    """Words of each source: the total shared by weight, none above ``most`` times its size."""
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: float(cycle[i % len(cycle)]) for i, s in enumerate(names)}

    def over(unit: float) -> tuple[int, int, float]:
        full = {s for s in names if unit * weight[s] > most * size[s]}
        return len(full), sum(size[s] for s in full), sum(weight[s] for s in names if s not in full)

    unit = _unit(sum(size.values()), over, most)
    return {s: float(min(unit * weight[s], most * size[s])) for s in names}


def source_targets(sources: DataFrame, cycle: Sequence[float] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``targets`` of any number of sources: rows (name, source, source_size) with their target; a source is one row."""
    numbered = spans.numbered(sources, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in cycle)), (F.col("place") % len(cycle) + 1).cast("int"))
    known = materialize(numbered.select("name", "source", "source_size", weight.alias("weight")), "sources")

    def over(unit: float) -> tuple[int, int, float]:
        full = F.lit(unit) * F.col("weight") > most * F.col("source_size")
        return tuple(x or 0 for x in known.agg(F.count_if(full), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first())

    unit = _unit(known.agg(F.sum("source_size")).first()[0] or 0, over, most)
    return known.select("name", "source", "source_size", F.least(F.lit(unit) * F.col("weight"), (most * F.col("source_size")).cast("double")).alias("target"))


def knapsack(lengths: list[int], spare: list[int], budget: int) -> list[int]:
    """How many of each length to take, none beyond its spare count, for the largest sum within the budget."""
    take = [0] * len(lengths)
    reach, mask, steps = 1, (1 << (budget + 1)) - 1, []
    for i, (n, count) in enumerate(zip(lengths, spare, strict=True)):
        count, block = min(count, budget // n) if n else 0, 1
        while count and not reach >> budget & 1:      # counts in binary blocks
            block = min(block, count)
            steps.append((i, block, reach))
            reach |= (reach << (n * block)) & mask
            count -= block
            block *= 2
    at = reach.bit_length() - 1
    for i, block, before in reversed(steps):
        if not before >> at & 1:
            take[i] += block
            at -= lengths[i] * block
    return take


def quotas(lengths: np.ndarray, counts: np.ndarray, budget: int, times: int) -> np.ndarray:
    """How many documents of each length make up the budget; none more than so many times."""
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    got = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((got * lengths).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order[lengths[order] > 0]:               # down to what the program can hold
        n = min(int(times * counts[i] - got[i]), max(0, left - KNAPSACK_WORDS) // int(lengths[i]))
        got[i] += n
        left -= n * int(lengths[i])
    usable = np.flatnonzero((lengths > 0) & (got < times * counts))
    return got + np.bincount(usable, weights=knapsack(lengths[usable].tolist(), (times * counts - got)[usable].tolist(), left), minlength=len(got)).astype(np.int64)


def mix(docs: DataFrame, cycle: Sequence[float] = (1, 2, 3), most: int = 3, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, times, taken) of every document."""
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("name")
    order = F.xxhash64("doc_id", F.lit(seed)).bitwiseAND((1 << 62) - 1).alias("r")
    sized = materialize(sizes(docs).select("doc_id", "source", "size", name, order, F.shiftright(order, 62 - SLICE_BITS).alias("slice")), "sizes")
    by_length = sized.groupBy("name", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    goal = source_targets(by_length.groupBy("name", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), cycle, most)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        passes = min(most, int(target / size + 1e-9)) if size else 0
        rows = rows.sort_values("size")
        counts = rows["n"].to_numpy(np.int64)
        extra = quotas(rows["size"].to_numpy(np.int64), counts, 0 if passes == most else round(target - passes * size), most - passes)
        return pd.DataFrame({"name": rows["name"], "size": rows["size"], "source_size": size, "target": target, "passes": passes + extra // counts, "extra": extra % counts})

    budgets = by_length.join(spans.small_side(goal.drop("source")), "name").select("name", "size", "n", "source_size", "target")
    quota = budgets.groupBy("name").applyInPandas(fit, "name string, size long, source_size long, target double, passes long, extra long")
    running = Window.partitionBy("name", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sliced = sized.groupBy("name", "size", "slice").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    need = sliced.join(quota, ["name", "size"]).select("name", "size", "slice", "source_size", "target", "passes", (F.col("extra") - F.col("before")).alias("need"))
    ranked = sized.withColumn("rank", F.row_number().over(Window.partitionBy("name", "size", "slice").orderBy("r", "doc_id")))
    times = F.col("passes") + F.when(F.col("rank") <= F.col("need"), 1).otherwise(0)
    return ranked.join(need, ["name", "size", "slice"]).select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).cast("long").alias("taken"))


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes its document; rows of one doc_id alike."""
    times = materialize(mixed.groupBy("doc_id").agg(F.max("times").cast("int").alias("times")).where("times > 0"), "times")
    key, n = (next(c for k in range(len(docs.columns) + 1) if (c := f"{name} {k}") not in docs.columns) for name in ("mix doc_id", "mix times"))
    joined = docs.join(spans.small_side(times.toDF(key, n)), docs["doc_id"].eqNullSafe(F.col(f"`{key}`")))
    return joined.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(f"`{n}`")))).select(*(docs[c] for c in docs.columns))
