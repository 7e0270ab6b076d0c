"""Skill sampling by rejection: a chain whose next start depends on what a draw has eaten, found by composing jumps.

A draw that starts at row s takes that row, or, with odds ``fraction``, hunts for a row of a drawn
skill: it eats up to ``max_skips`` rows, gives the first of that skill, else the first of any skill,
else the last one. The next draw starts behind what was eaten. Draws are hashes of (seed, s), so
every start's outcome is known without knowing whether a draw ever starts there: a jump s -> s'.

Rows are cut into blocks that are longer than a jump, so a block is entered at one of its first
``max_skips`` rows and left into the next. Pointer doubling gives a block's exit for every entry; these
small maps are composed over runs of blocks, and from the first row's entry every block's own entry
follows. Then each block walks its part of the chain. Positions and skills travel, texts don't.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import uniform
from ..functions.fixed import SKILLS
from ..session import shared_folder
from .corpus import category_weights
from .order import numbered

#: Rows of a block, maps of blocks that the driver composes, and blocks composed by a task where there are more.
BLOCK, DRIVER_BLOCKS, RUN = 1 << 20, 4096, 1024


def next_starts(cat: np.ndarray, hunted: np.ndarray, any_: bool, skips: int) -> tuple[np.ndarray, np.ndarray]:
    """(next start, row given) of each start, in rows of one block and what follows it.

    ``cat`` is a row's skill (-1: none, or too short), ``hunted`` the skill that a draw there
    hunts for (-1: it takes the row as it is). A hunt that runs beyond the rows gives -1 and starts no more.
    """
    n = len(cat)
    starts = np.arange(n)
    give, after = starts.copy(), starts + 1
    fallback = np.full(n, -1)
    any_at = np.flatnonzero(cat >= 0)
    hunts = np.flatnonzero(hunted >= 0)
    if any_ and len(any_at):
        k = np.searchsorted(any_at, hunts)
        first = np.where(k < len(any_at), any_at[np.minimum(k, len(any_at) - 1)], n + skips)
        fallback[hunts] = np.where(first < hunts + skips, first, -1)
    for c in np.unique(hunted[hunts]):
        at, mine = np.flatnonzero(cat == c), hunts[hunted[hunts] == c]
        k = np.searchsorted(at, mine)
        hit = np.append(at, n + skips)[k]
        found, last = hit < mine + skips, mine + skips - 1
        give[mine] = np.where(found, hit, np.where(fallback[mine] >= 0, fallback[mine], last))
        after[mine] = np.where(found, hit + 1, last + 1)
    beyond = after > n
    give[beyond] = -1
    return after, give


def exits(after: np.ndarray, size: int, entries: int) -> np.ndarray:
    """Where the chain leaves the first ``size`` rows, for each of the first entries, by doubling jumps."""
    e = after[:size].copy()
    while (inside := e < size).any():
        e[inside] = e[e[inside]]
    return e[:entries] if size >= entries else np.concatenate((e, np.arange(size, entries)))


def _outcomes(rows: DataFrame, skill: Column, order: str, fraction: float, weights: dict[str, float] | None, min_chars: int, text: str, seed: int) -> DataFrame:
    """(pos, key, cat, hunted): every row's place, its skill and what a draw that starts there would hunt for."""
    names = [n for n, _ in SKILLS]
    w = category_weights(weights)
    total, upto, target = sum(w.values()), 0.0, F.lit(-1)
    code = F.create_map(*(F.lit(x) for k, n in enumerate(names) for x in (n, k)))
    cat = F.when(F.length(text) >= min_chars, F.coalesce(code[skill], F.lit(-1))).otherwise(-1)
    keys = numbered(rows.select(F.col(order).alias("key"), cat.alias("cat")), ["key"])
    u = uniform(F.lit("skill"), F.lit(seed), F.col("pos"))
    bounds = []
    for k, n in enumerate(names):
        upto += w[n] / total
        bounds.append((k, upto))
    for k, high in reversed(bounds):
        target = F.when((u < high) | F.lit(k == len(names) - 1), k).otherwise(target)
    return keys.select("pos", "key", "cat", F.when(uniform(F.lit("hunt"), F.lit(seed), F.col("pos")) < fraction, target).otherwise(-1).alias("hunted"))


def entries_of(maps: DataFrame, n_blocks: int, width: int, first: int = 0, driver_blocks: int = DRIVER_BLOCKS, run: int = RUN) -> DataFrame:
    """(block, entry) from (block, exits): each block's entry on the chain from the first block's ``first``.

    Up to ``driver_blocks`` maps of ``width`` numbers are composed on the driver. More are composed by runs of blocks
    in tasks, the runs' entries are found the same way, and each run walks its blocks from its own.
    """
    spark = maps.sparkSession
    if n_blocks <= driver_blocks:
        by = {r.block: r.exits for r in maps.collect()}
        out, at = [], first
        for b in range(n_blocks):
            out.append((b, at))
            at = by[b][at]
        return spark.createDataFrame(out, "block long, entry int")

    def composed(t: pa.Table) -> pa.Table:
        e = np.arange(width)
        for x in t.sort_by("block")["exits"].to_pylist():
            e = np.array(x)[e]
        return pa.table({"block": [t["run"][0].as_py()], "exits": [e.tolist()]}, pa.schema([("block", pa.int64()), ("exits", pa.list_(pa.int32()))]))

    def walked(t: pa.Table) -> pa.Table:
        t, out = t.sort_by("block"), []
        at = t["entry"][0].as_py()
        for x in t["exits"].to_pylist():
            out.append(at)
            at = x[at]
        return pa.table({"block": t["block"], "entry": pa.array(out, pa.int32())})

    shared_folder(spark)
    held = maps.withColumn("run", F.floor(F.col("block") / run)).checkpoint()
    runs = entries_of(held.groupBy("run").applyInArrow(composed, "block long, exits array<int>"), -(-n_blocks // run), width, first, driver_blocks, run)
    return held.join(runs.select(F.col("block").alias("_r"), "entry"), F.col("run") == F.col("_r")).drop("_r").groupBy("run").applyInArrow(walked, "block long, entry int")


def sampled(rows: DataFrame, skill: Column, order: str = "id", fraction: float = 0.2, weights: dict[str, float] | None = None, max_skips: int = 64, any_skill: bool = True, min_chars: int = 200, text: str = "text", seed: int = 42, block: int = BLOCK, driver_blocks: int = DRIVER_BLOCKS, run: int = RUN) -> DataFrame:
    """The rows that the draws give, in the order of ``draw``, with ``start`` and ``hunted``: the skill looked for, NULL where a row was taken as it came.

    ``order`` is total. Rows that a hunt passes over are gone, as they are in a stream; a hunt that
    runs into the end gives nothing. ``skill`` classifies a row's text; texts under ``min_chars`` have none.
    """
    if not 0 <= fraction <= 1 or max_skips < 1:
        raise ValueError("fraction must be in [0, 1] and max_skips at least 1")
    size = max(block, max_skips)
    outcomes = _outcomes(rows, skill, order, fraction, weights, min_chars, text, seed)
    shared_folder(rows.sparkSession)
    held = outcomes.checkpoint()  # the texts are classified once
    n = held.count()
    if not n:
        return rows.limit(0).withColumns({"draw": F.lit(0).cast("long"), "start": F.lit(0).cast("long"), "hunted": F.lit(None).cast("string")})
    n_blocks = -(-n // size)
    b = F.floor(F.col("pos") / size)
    # a block also sees the rows that a hunt from its last ones may reach
    seen = held.select("pos", "cat", "hunted", F.explode(F.when((b > 0) & (F.col("pos") % size < max_skips), F.array(b, b - 1)).otherwise(F.array(b))).alias("block"))

    def read(t: pa.Table) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        t = t.sort_by("pos")
        k = t["block"][0].as_py()
        hunted = t["hunted"].to_numpy()
        own = min(size, n - k * size)
        after, give = next_starts(t["cat"].to_numpy(), hunted, any_skill, max_skips)
        return k, own, after, give, hunted

    def leave(t: pa.Table) -> pa.Table:
        k, own, after, _, _ = read(t)
        e = exits(np.minimum(after, own + max_skips), own, max_skips) - own
        return pa.table({"block": [k], "exits": [np.clip(e, 0, max_skips - 1).tolist()]}, pa.schema([("block", pa.int64()), ("exits", pa.list_(pa.int32()))]))

    def walk(t: pa.Table) -> pa.Table:
        k, own, after, give, hunted = read(t)
        jump, at, starts = after.tolist(), t["entry"][0].as_py(), []
        while at < own:
            starts.append(at)
            at = jump[at]
        s = np.array(starts, np.int64)
        s = s[give[s] >= 0]
        return pa.table({"start": s + k * size, "pos": give[s].astype(np.int64) + k * size, "hunted": hunted[s].astype(np.int32)})

    maps = seen.groupBy("block").applyInArrow(leave, "block long, exits array<int>")
    entries = entries_of(maps, n_blocks, max_skips, 0, driver_blocks, run).withColumnRenamed("block", "_b")
    chain = seen.join(entries, F.col("block") == F.col("_b")).drop("_b").groupBy("block").applyInArrow(walk, "start long, pos long, hunted int")
    drawn = numbered(chain, ["start"], name="draw")
    label = F.get(F.array(*(F.lit(name) for name, _ in SKILLS)), F.col("hunted"))
    keyed = held.select(F.col("pos").alias("_p"), F.col("key").alias("_k")).join(drawn, F.col("_p") == F.col("pos")).select("_k", "draw", "start", F.when(F.col("hunted") >= 0, label).alias("hunted"))
    return rows.join(keyed, F.col(order) == F.col("_k")).drop("_k")
