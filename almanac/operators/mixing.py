"""Mixing sources that run out: turns drawn among the living, or one after another, as joins and not as a loop.

A mix hands out ``docs_per_turn`` rows of a source a turn. In weighted mode turn t's source is drawn
among the living by a hash of (seed, t); in sequential mode the living take turns in the
listed order. A source is found to be at its end only when a turn asks it for more than
it has: that turn is cut short, also to nothing, and it is dead from then on.

Between two deaths the living don't change, so a phase is a range of turns with fixed shares. A
living source with r rows left dies at its (r // d + 1)-th turn of the phase; the phase ends with
the first of these. In weighted mode that turn is found by counting hashed draws in blocks of
turns and searching the blocks' prefix sums: only counts of a few sources reach the driver, and
there are as many phases as sources. The phases are a small table; every row's turn and place
follow from its number within its source by joins.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import uniform
from .order import numbered

#: Turns of a block whose draws are counted together.
BLOCK = 4096
#: What a state of this version looks like is ``MixState``.
VERSION = "mix_v2"


@dataclass(frozen=True)
class MixState:
    """Where a mix stands: to be kept as JSON beside the consumer's own checkpoint.

    ``turn`` is the turn to go on with, ``used`` how many rows it has given already, ``given``
    how many each source has given in all, ``dead`` which were found at their end, ``place`` the
    rows handed out, and ``nth`` the number of turns that the sequential mode has taken.
    """

    names: list[str]
    seed: int
    docs_per_turn: int
    sequential: bool
    turn: int = 0
    used: int = 0
    active: int | None = None
    next_source: int = 0
    place: int = 0
    given: list[int] = field(default_factory=list)
    dead: list[bool] = field(default_factory=list)
    version: str = VERSION

    def to_dict(self) -> dict:
        return asdict(self)


def mix_state(names: list[str], docs_per_turn: int = 4096, seed: int = 42, sequential: bool = False) -> MixState:
    """The state of a mix that hasn't begun."""
    if not names or len(set(names)) != len(names):
        raise ValueError("a mix needs sources with names of their own")
    if docs_per_turn <= 0:
        raise ValueError("docs_per_turn must be over 0")
    return MixState(list(names), seed, docs_per_turn, sequential, given=[0] * len(names), dead=[False] * len(names))


def restored(state: dict, names: list[str]) -> MixState:
    """A saved state for these sources. Version 1 has no sources' names and no dead ones; those are found at their ends again.

    A state of unknown version, or of other sources, is an error.
    """
    version = state.get("version")
    if version not in ("mix_v1", VERSION):
        raise ValueError(f"a mix state of version {version}")
    if version == "mix_v1":
        state = {"dead": [False] * len(names), **state, "names": list(names), "version": VERSION}
    if list(state["names"]) != list(names):
        raise ValueError(f"a state of sources {state['names']}, not {list(names)}")
    if len(state["given"]) != len(names) or len(state["dead"]) != len(names):
        raise ValueError("a state of another number of sources")
    return MixState(**state)


@dataclass(frozen=True)
class Phase:
    """Turns first to last in which ``living`` share the draws; ``base`` is how many whole turns each source had before, ``dies`` whom the last turn finds at its end.

    Places of the phase's turns begin at ``place``; its first turn has given ``used`` rows before.
    """

    first: int
    last: int
    living: list[int]
    base: list[int]
    place: int
    dies: int | None
    start: int = 0


def _shares(living: list[int], weights: list[float]) -> list[tuple[int, float, float]]:
    """(source, low, high) of the living with weight on [0, 1)."""
    total, low, out = sum(weights[i] for i in living), 0.0, []
    for n, i in enumerate(living):
        high = 1.0 if n == len(living) - 1 else low + weights[i] / total
        out.append((i, low, high))
        low = high
    return out


def drawn(turn: Column, living: list[int], weights: list[float], seed: int) -> Column:
    """The source that a turn draws among the living."""
    u, pick = uniform(F.lit(seed), turn), F.lit(None).cast("int")
    for i, _, high in reversed(_shares(living, weights)):
        pick = F.when(u < high, i).otherwise(pick)
    return pick


def nth_turn(spark: SparkSession, first: int, living: list[int], weights: list[float], seed: int, wanted: dict[int, int]) -> tuple[int, int]:
    """(turn, source): the earliest turn from ``first`` on at which a source is drawn for its ``wanted``-th time.

    A stretch as long as the expected turns is counted by blocks; the block where a prefix sum
    reaches the number is drawn again to find the turn. A stretch without an end is followed by one twice as long.
    """
    shares = {i: high - low for i, low, high in _shares(living, weights)}
    span = max(BLOCK, min(math.ceil(1.1 * n / shares[i]) for i, n in wanted.items() if shares[i] > 0) + BLOCK)
    had = dict.fromkeys(wanted, 0)
    while True:
        span = math.ceil(span / BLOCK) * BLOCK
        turns = spark.range(first, first + span).select(F.floor((F.col("id") - first) / BLOCK).alias("block"), drawn(F.col("id"), living, weights, seed).alias("source"))
        counts = turns.groupBy("block", "source").agg(F.count("*").alias("n"))
        ahead = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
        sums = counts.withColumn("upto", F.sum("n").over(ahead))
        need = F.create_map(*(F.lit(x) for i, n in wanted.items() for x in (i, n - had[i])))[F.col("source")]
        ends = sums.groupBy("source").agg(F.min(F.when(F.col("upto") >= need, F.struct("block", (F.col("upto") - F.col("n")).alias("before")))).alias("at"), F.sum("n").alias("all")).collect()
        found = []
        for r in ends:
            if r.at is not None:
                block = spark.range(first + r.at.block * BLOCK, first + (r.at.block + 1) * BLOCK).where(drawn(F.col("id"), living, weights, seed) == r.source)
                n = wanted[r.source] - had[r.source] - r.at.before
                found.append((block.orderBy("id").limit(n).agg(F.max("id")).first()[0], r.source))  # at most one block of numbers
        if found:
            return min(found)
        for r in ends:
            had[r.source] = had.get(r.source, 0) + r["all"]
        first, span = first + span, 2 * span


def _in_turn(first: int, living: list[int], next_source: int, n: int, wanted: dict[int, int]) -> tuple[int, int]:
    """The same in sequential mode: the living, from ``next_source`` on, take one turn after another."""
    order = sorted(living, key=lambda i: (i - next_source) % n)
    return min((first + order.index(i) + (w - 1) * len(order), i) for i, w in wanted.items())


def phases(spark: SparkSession, sizes: list[int], weights: list[float], state: MixState) -> list[Phase]:
    """All phases from a state to the end of the last source. A source without weight is never drawn and so never ends."""
    d = state.docs_per_turn
    given, dead, out = list(state.given), list(state.dead), []
    turn, place, nxt = state.turn, state.place, state.next_source
    if state.used and state.active is not None:  # the turn that a state cuts, as a phase of its own
        i = state.active
        rest = min(d - state.used, sizes[i] - given[i])
        ends = sizes[i] - given[i] < d - state.used
        out.append(Phase(turn, turn, [i], list(given), place, i if ends else None, state.used))
        given[i], place, turn = given[i] + rest, place + rest, turn + 1
        dead[i] = ends
    while True:
        living = [i for i in range(len(sizes)) if not dead[i] and (state.sequential or weights[i] > 0)]
        if not living:
            return out
        wanted = {i: (sizes[i] - given[i]) // d + 1 for i in living}
        last, who = _in_turn(turn, living, nxt, len(sizes), wanted) if state.sequential else nth_turn(spark, turn, living, weights, state.seed, wanted)
        out.append(Phase(turn, last, living, list(given), place, who))
        taken = _taken(spark, turn, last, living, weights, state, nxt)
        for i in living:
            given[i] += d * taken.get(i, 0)
        cut = given[who] - sizes[who]  # what the last turn couldn't give
        given[who], dead[who] = sizes[who], True
        place += d * (last - turn + 1) - cut
        turn, nxt = last + 1, (who + 1) % len(sizes) if state.sequential else nxt


def _taken(spark: SparkSession, first: int, last: int, living: list[int], weights: list[float], state: MixState, nxt: int) -> dict[int, int]:
    """Turns of each source from first to last."""
    if state.sequential:
        order = sorted(living, key=lambda i: (i - nxt) % len(state.names))
        whole, rest = divmod(last - first + 1, len(order))
        return {i: whole + (k < rest) for k, i in enumerate(order)}
    rows = spark.range(first, last + 1).groupBy(drawn(F.col("id"), living, weights, state.seed).alias("s")).count().collect()
    return {r.s: r["count"] for r in rows}


def _sources_of_turns(spark: SparkSession, found: list[Phase], weights: list[float], state: MixState) -> DataFrame:
    """(turn, source, phase): every turn's source."""
    parts, nxt = None, state.next_source
    for k, p in enumerate(found):
        turn = F.col("id")
        if len(p.living) == 1:
            source = F.lit(p.living[0])
        elif state.sequential:
            order = sorted(p.living, key=lambda i: (i - nxt) % len(state.names))
            source = F.get(F.array(*map(F.lit, order)), ((turn - p.first) % len(order)).cast("int"))
        else:
            source = drawn(turn, p.living, weights, state.seed)
        if state.sequential and p.dies is not None and not p.start:
            nxt = (p.dies + 1) % len(state.names)
        rows = spark.range(p.first, p.last + 1).select(turn.alias("turn"), source.cast("int").alias("source"), F.lit(k).alias("phase"))
        parts = rows if parts is None else parts.unionAll(rows)
    return parts


def mixed(rows: DataFrame, weights: dict[str, float], state: MixState, n_docs: int | None = None, source: str = "source", order: str = "id") -> tuple[DataFrame, MixState]:
    """(the next rows of the mix with ``turn`` and ``place``; the state behind them).

    ``rows`` are the sources' rows in the order of ``order``, which is total within a source; rows of
    sources that the state doesn't name go. Without ``n_docs`` all rows come, up to the end of every
    source that can be drawn. A mix that is cut anywhere and gone on with by its state gives the rows of
    one long mix. Only (source, order) are sorted; the other columns meet their places in a join.
    """
    spark, names, d = rows.sparkSession, state.names, state.docs_per_turn
    index = F.create_map(*(F.lit(x) for i, n in enumerate(names) for x in (n, i)))[F.col(source)]
    w = [float(weights.get(n, 0.0)) for n in names]
    if not state.sequential and not sum(x for x in w if x > 0) > 0:
        raise ValueError("the sources' weights must sum up to more than 0")
    keys = rows.where(F.col(source).isin(names)).select(index.alias("_s"), F.col(order).alias("_o"))
    counts = {r._s: r["count"] for r in keys.groupBy("_s").count().collect()}
    sizes = [counts.get(i, 0) for i in range(len(names))]
    found = phases(spark, sizes, w, state)
    if not found:
        return rows.limit(0).withColumns({"turn": F.lit(0).cast("long"), "place": F.lit(0).cast("long")}), state
    turns = numbered(_sources_of_turns(spark, found, w, state), ["turn"], ["source"], name="nth")
    table = spark.createDataFrame([(k, i, p.base[i], p.first, p.place, p.start) for k, p in enumerate(found) for i in p.living], "phase int, source int, base long, first long, begins long, start long")
    before = turns.groupBy("phase", "source").agg(F.min("nth").alias("n0"))
    # a turn's rows: of the source's those from base + d * (its turns in the phase) on; its place follows from the phase's first turn
    placed = turns.join(F.broadcast(table), ["phase", "source"]).join(F.broadcast(before), ["phase", "source"]).select(
        F.col("source").alias("_s"), "turn", (F.col("base") + d * (F.col("nth") - F.col("n0"))).alias("_first"), (F.col("begins") + d * (F.col("turn") - F.col("first"))).alias("_place"), (d - F.col("start")).alias("_most"))
    rank = numbered(keys, ["_s", "_o"], ["_s"], name="_k")
    # sources' turns begin at base + d * n; rows are given to them by that grid, of which a phase has one origin a source
    grid = spark.createDataFrame([(i, p.base[i], (found[k + 1].base[i] if k + 1 < len(found) else sizes[i]), p.start) for k, p in enumerate(found) for i in p.living], "_s int, _b long, _e long, _u long")
    cell = rank.join(F.broadcast(grid.withColumnRenamed("_s", "_g")), (F.col("_s") == F.col("_g")) & (F.col("_k") >= F.col("_b")) & (F.col("_k") < F.col("_e")))
    cells = cell.select("_s", "_o", "_k", (F.col("_b") + d * F.floor((F.col("_k") - F.col("_b")) / d)).alias("_first"))
    told = cells.join(placed, ["_s", "_first"]).where(F.col("_k") - F.col("_first") < F.col("_most")).select("_s", "_o", "_k", "turn", (F.col("_place") + F.col("_k") - F.col("_first")).alias("place"))
    end = found[-1].place + d * (found[-1].last - found[-1].first + 1) if n_docs is None else state.place + n_docs
    out = told.where(F.col("place") < end)
    behind = _behind(out, state, sizes, found, n_docs, w)
    full = rows.withColumn("_s", index).join(out.drop("_k").withColumnsRenamed({"_s": "_t"}), (F.col("_s") == F.col("_t")) & (F.col(order) == F.col("_o")))
    return full.select(*rows.columns, "turn", "place"), behind


def _behind(out: DataFrame, state: MixState, sizes: list[int], found: list[Phase], n_docs: int | None, weights: list[float]) -> MixState:
    """The state behind the rows that were handed out."""
    given = list(state.given)
    seen = {r._s: r.n for r in out.groupBy("_s").agg((F.max("_k") + 1).alias("n")).collect()}
    for i, n in seen.items():
        given[i] = int(n)
    place = sum(given) - sum(state.given) + state.place
    if n_docs is None or place < state.place + n_docs:
        dead = [f or i in {p.dies for p in found} for i, f in enumerate(state.dead)]
        return replace(state, turn=found[-1].last + 1, used=0, active=None, place=place, given=given, dead=dead)
    last = out.orderBy(F.desc("place")).limit(1).select("_s", "turn").first()
    if last is None:
        return state
    in_turn = out.where(F.col("turn") == last.turn).count() + (state.used if last.turn == state.turn else 0)
    dead = list(state.dead)
    for p in found:
        if p.last < last.turn and p.dies is not None:
            dead[p.dies] = True
    whole = in_turn >= state.docs_per_turn
    nxt = (last._s + 1) % len(sizes) if state.sequential else state.next_source
    return replace(state, turn=last.turn + whole, used=0 if whole else in_turn, active=None if whole else last._s, place=place, given=given, dead=dead, next_source=nxt)
