"""Row filters, source weights, mixing, shuffling and packing of corpus rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import crawl_year, snapshot_year, stable_seed, uniform
from ..functions.fixed import SKILLS
from .order import numbered, permuted, running_total


class CutoffError(ValueError):
    """A source lies after the cutoff, or there is none."""


def passes_quality(int_score: Column, score: Column, min_int_score: int | None = None, min_score: float | None = None) -> Column:
    """The quality floor: a NULL int_score keeps the row at once where that floor is set, and a NULL score likewise."""
    low = F.when(score.isNull(), True).otherwise(score >= min_score) if min_score is not None else F.lit(True)
    return F.when(int_score.isNull(), True).when(int_score < min_int_score, False).otherwise(low) if min_int_score is not None else low


def passes_date(year: Column, first: int | None, last: int | None, require: bool = False) -> Column:
    """A year window; rows without a year stay unless a date is required."""
    inside = F.lit(True)
    if first is not None:
        inside = inside & (year >= first)
    if last is not None:
        inside = inside & (year <= last)
    return F.when(year.isNull(), not require).otherwise(inside)


def keeps_source_row(year: Column, cutoff: int, has_snapshot: bool, has_date_field: bool, min_year: int | None = None, require_date: bool = False) -> Column:
    """The keep rule of a dated source: a snapshot vouches for undated rows, dated rows obey cutoff and minimum."""
    if has_snapshot and not has_date_field:
        return F.lit(True)
    undated = False if require_date or min_year is not None else has_snapshot or not has_date_field
    dated = year <= cutoff
    return F.when(year.isNull(), undated).otherwise(dated & (year >= min_year) if min_year is not None else dated)


def check_cutoff(names: DataFrame, cutoff: int, column: str = "dump", year=crawl_year) -> None:
    """Raise unless every name has a year and none lies after the cutoff (one aggregate reaches the driver)."""
    y = year(F.col(column))
    n, bad, late = names.agg(F.count("*"), F.count_if(y.isNull()), F.count_if(y > cutoff)).first()
    if not n:
        raise CutoffError("at least one source is required")
    if bad or late:
        raise CutoffError(f"{late} sources after {cutoff}, {bad} names without a year")


def check_snapshot(names: DataFrame, cutoff: int, column: str = "snapshot") -> None:
    check_cutoff(names, cutoff, column, snapshot_year)


def check_disjoint(a: DataFrame, b: DataFrame) -> None:
    """Training and validation must share nothing."""
    if not a.intersect(b).isEmpty():
        raise CutoffError("training and validation overlap")


def source_weights(dumps: DataFrame, year_weights: DataFrame | None = None) -> DataFrame:
    """(dump, weight): a year's share of the positive mass, split evenly over its crawls; uniform without year weights.

    A year without an entry is an error, and so is no positive weight at all.
    """
    d = dumps.select("dump", crawl_year(F.col("dump")).alias("year"))
    if year_weights is None:
        return d.select("dump", (F.lit(1.0) / F.count("*").over(Window.partitionBy(F.lit(1)))).alias("weight"))
    counts = d.groupBy("year").agg(F.count("*").alias("n"))
    known = counts.join(year_weights.select("year", F.col("weight").cast("double").alias("w")), "year", "left")
    missing, positive = known.agg(F.count_if(F.col("w").isNull()), F.sum(F.when(F.col("w") > 0, F.col("w")))).first()
    if missing:
        raise ValueError(f"{missing} years have no weight")
    if not positive:
        raise ValueError("no positive weight")
    share = known.select("year", F.when(F.col("w") > 0, F.col("w") / F.lit(positive) / F.col("n")).otherwise(0.0).alias("weight"))
    return d.join(share, "year").select("dump", "weight")


def category_weights(given: dict[str, float] | None) -> dict[str, float]:
    """Weights of all skill categories: 0 for unlisted ones, all equal if none is positive."""
    names = [n for n, _ in SKILLS]
    w = {n: float((given or {}).get(n, 0.0)) for n in names}
    return w if given and sum(w.values()) > 0 else dict.fromkeys(names, 1.0)


def pick_source(rows: DataFrame, weights: DataFrame, key: Column, source: str = "dump", turn: int = 1, seed: int = 42) -> DataFrame:
    """Each row's drawn source by inverse cumulative weights; ``turn`` neighbouring keys share a draw.

    The weights table is small (one row a source): its cumulative sums are a broadcast interval join's build side.
    """
    w = Window.orderBy(source).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("weight").over(Window.partitionBy(F.lit(1)))
    cum = weights.where("weight > 0").select(F.col(source).alias("picked"), (F.sum("weight").over(w) / total).alias("_hi"), ((F.sum("weight").over(w) - F.col("weight")) / total).alias("_lo"))
    drawn = rows.withColumn("_u", uniform(F.lit(seed), F.floor(key / turn)))
    return drawn.join(F.broadcast(cum), (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))).drop("_u", "_lo", "_hi")


def turns(rows: DataFrame, source: str, order: str, docs_per_turn: int) -> DataFrame:
    """Rows numbered within their source, and the turn each falls into."""
    return numbered(rows, [source, order], [source]).withColumn("turn", F.floor(F.col("pos") / docs_per_turn).cast("long"))


def mix(rows: DataFrame, weights: DataFrame, source: str, order: str) -> DataFrame:
    """Weighted interleaving: the k-th row of a source with weight w stands at (k + 0.5) / w.

    Sources that run out leave the rest to the others, which is what renormalising among the
    living sources does; rows of sources without weight go.
    """
    joined = numbered(rows, [source, order], [source], name="_k").join(F.broadcast(weights.where("weight > 0").select(F.col(source).alias("_s"), "weight")), F.col(source) == F.col("_s")).drop("_s")
    return joined.withColumn("place", (F.col("_k") + 0.5) / F.col("weight")).drop("weight", "_k")


def shuffled(rows: DataFrame, key: Column, seed: int = 0, epoch: int = 0) -> DataFrame:
    """Rows in a seeded order that the key decides: a range sort on a hash, the same on every cluster."""
    return rows.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed).cast("string"), F.lit(epoch).cast("string"), key.cast("string")).cast("binary"))).orderBy("shuffle_key", key)


def seeded_shuffle(rows: DataFrame, dump: str, cycle: str, key: str, base_seed: int = 42) -> DataFrame:
    """``rows`` with their place in the shuffle of their partition and cycle, whose seed those two decide."""
    seeded = rows.withColumn("_k", F.md5(F.concat_ws("|", stable_seed(F.lit(base_seed), F.col(dump), F.col(cycle)).cast("string"), F.col(key).cast("string")).cast("binary")))
    return numbered(seeded, [dump, cycle, "_k", key], [dump, cycle]).drop("_k")


def first_rows(rows: DataFrame, order: list[str], most: int | None) -> DataFrame:
    """The first ``most`` rows in an order, or all: what a scan keeps that stops at a number of rows."""
    return rows.orderBy(*order).limit(most) if most else rows


def epochs(rows: DataFrame, n: int) -> DataFrame:
    """The rows once per epoch (an explode of a fixed range, no join)."""
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def skill_mix(rows: DataFrame, skill: Column, key: Column, fraction: float = 0.2, weights: dict[str, float] | None = None, min_chars: int = 200, text: str = "text", seed: int = 42) -> DataFrame:
    """Batch analogue of skill upsampling: every row once, and rows of a skill again with the odds that give skilled
    draws the share ``fraction`` split by category weight.

    The number of copies is decided per row by a hash of its key, so no order or single task is needed.
    """
    if not 0 <= fraction < 1:
        raise ValueError(f"a skilled share of {fraction}: a batch has every row once")
    w = category_weights(weights)
    total = sum(w.values())
    tagged = rows.withColumn("_skill", F.when(F.length(text) >= min_chars, skill))
    counts = tagged.groupBy("_skill").agg(F.count("*").alias("_n"))
    n_all = F.sum("_n").over(Window.partitionBy(F.lit(1)))
    share = F.create_map(*(F.lit(x) for k, v in w.items() for x in (k, v / total)))
    rate = counts.select("_skill", F.coalesce(n_all * (fraction / (1 - fraction)) * share[F.col("_skill")] / F.col("_n"), F.lit(0.0)).alias("_rate"))
    joined = tagged.join(F.broadcast(rate), tagged["_skill"].eqNullSafe(rate["_skill"])).drop(rate["_skill"])
    extra = (F.floor("_rate") + (uniform(F.lit(seed), key) < F.col("_rate") - F.floor("_rate")).cast("int")).cast("int")
    return joined.withColumn("copies", 1 + extra).drop("_rate").withColumnRenamed("_skill", "skill")


def token_offsets(docs: DataFrame, n_tokens: Column, order: str) -> DataFrame:
    """``docs`` with their tokens and the running token offset in the order of ``order``."""
    return running_total(docs.withColumn("n_tokens", n_tokens), F.col("n_tokens"), [order], name="offset")


def pack_blocks(tokens: DataFrame, block: int, order: str = "doc_id", eos: int = 0) -> DataFrame:
    """(block_id, input_ids): documents' token arrays with an end token each, cut into blocks; the unfilled rest is dropped.

    ``tokens`` has columns (order, ids array). A document without tokens, or with NULL, gives nothing, no end
    token either. Each document is cut at the block borders first, so only slices are gathered by
    block, never single tokens.
    """
    return _filled(tokens, block, order, eos, []).where(F.size("input_ids") == block)


def pack_on(tokens: DataFrame, block: int, state: dict | None = None, order: str = "doc_id", eos: int = 0) -> tuple[DataFrame, dict]:
    """(blocks as ``pack_blocks`` gives them, the state behind them): packing that goes on where documents ended before.

    The state is the number of blocks so far and the tokens that filled none, fewer than a block; a
    packing of documents in parts by it gives the blocks of all of them together.
    """
    state = state or {"version": PACK_VERSION, "block": block, "blocks": 0, "buffer": []}
    if state.get("version") != PACK_VERSION or state["block"] != block:
        raise ValueError(f"a packing state of version {state.get('version')} and blocks of {state.get('block')}")
    every = _filled(tokens, block, order, eos, state["buffer"])
    n, rest = every.agg(F.count_if(F.size("input_ids") == block), F.max(F.when(F.size("input_ids") < block, F.col("input_ids")))).first()
    full = every.where(F.size("input_ids") == block).withColumn("block_id", F.col("block_id") + state["blocks"])
    return full, {**state, "blocks": state["blocks"] + n, "buffer": list(rest or ([] if n else state["buffer"]))}


#: What a packing's state looks like.
PACK_VERSION = "packed_v1"


def _filled(tokens: DataFrame, block: int, order: str, eos: int, buffer: list[int]) -> DataFrame:
    """(block_id, input_ids) of all blocks, the last one maybe not full; ``buffer`` lies in front, shorter than a block."""
    docs = token_offsets(tokens.where(F.size("ids") > 0).select(order, F.concat("ids", F.array(F.lit(eos).cast("int"))).alias("ids")), F.size("ids").cast("long"), order)
    docs = docs.withColumn("offset", F.col("offset") + len(buffer))
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("n_tokens") - 1) / block)
    cut = docs.withColumn("block_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.lit(0).cast("long"), F.col("block_id") * block - F.col("offset"))
    end = F.least(F.col("n_tokens"), (F.col("block_id") + 1) * block - F.col("offset"))
    part = cut.select("block_id", F.struct((F.col("offset") + begin).alias("at"), F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids")).alias("p"))
    if buffer:
        part = part.unionByName(tokens.sparkSession.createDataFrame([(0, (0, [int(x) for x in buffer]))], part.schema))
    return part.groupBy("block_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["ids"])).alias("input_ids"))


#: What a scan's state looks like; one of version 1, which had no sources' names, is taken over.
SCAN_VERSION = 2


def scan_state(seed: int = 42) -> dict:
    """The state of a scan that hasn't begun: a few numbers, to be kept as JSON beside the consumer's own checkpoint."""
    return {"version": SCAN_VERSION, "seed": seed, "next_turn": 0, "turns": {}, "names": None}


def _scan_restored(state: dict | None, names: list[str]) -> dict:
    state = state or scan_state()
    if state.get("version") == 1:
        state = {**state, "version": SCAN_VERSION, "names": None}
    if state.get("version") != SCAN_VERSION:
        raise ValueError(f"a scan state of version {state.get('version')}, not {SCAN_VERSION}")
    if state["names"] is not None and state["names"] != names:
        raise ValueError(f"a state of sources {state['names']}, not {names}")
    if unknown := set(state["turns"]) - set(names):
        raise ValueError(f"a state of unknown sources {sorted(unknown)}")
    return {**state, "names": names}


def weighted_scan(rows: DataFrame, weights: DataFrame, n_turns: int, docs_per_turn: int, state: dict | None = None, source: str = "source", key: str = "id", keep: Column | None = None) -> tuple[DataFrame, dict]:
    """(the rows of the next turns with turn, place, cycle; the state behind them): an endless weighted scan, cut where the caller likes.

    Every turn draws a source by its weight and takes its next ``docs_per_turn`` rows; a source
    that runs out begins its next cycle, and each cycle has a seeded order of its own. ``keep``
    filters rows before they count. Two scans that follow one another by their state give the
    rows of one long scan. Sources and turns are few. Keys alone are numbered, by ranges; the wanted
    ones meet their rows at the end. A key is one row within its source.
    """
    kept = rows.where(keep) if keep is not None else rows
    sizes = {r[0]: r[1] for r in kept.groupBy(source).count().collect()}
    listed = sorted(((r[0], float(r[1] or 0.0)) for r in weights.select(source, "weight").collect()), key=lambda x: str(x[0]))
    state = _scan_restored(state, [s for s, _ in listed])
    spark, first, seed = rows.sparkSession, state["next_turn"], state["seed"]
    living = [(s, w) for s, w in listed if s in sizes and w > 0]
    total, low, bounds = sum(w for _, w in living), 0.0, []
    for s, w in living:
        low += w
        bounds.append((s, low / total))
    u, drawn = uniform(F.lit(seed), F.col("id")), F.lit(None).cast("string")
    for k, (s, high) in reversed(list(enumerate(bounds))):
        drawn = F.when((u < high) | F.lit(k == len(bounds) - 1), s).otherwise(drawn)
    done = F.coalesce(F.create_map(*(F.lit(x) for s in sizes for x in (s, int(state["turns"].get(s, 0)))))[F.col("picked")], F.lit(0))
    size = F.create_map(*(F.lit(x) for s, n in sizes.items() for x in (s, int(n))))[F.col("picked")]
    mine = F.row_number().over(Window.partitionBy("picked").orderBy("turn")) - 1
    turns_ = spark.range(first, first + n_turns).select(F.col("id").alias("turn"), drawn.alias("picked")).withColumn("nth", (mine + done).cast("long"))
    counts = {r.picked: r.n for r in turns_.groupBy("picked").agg(F.max("nth").alias("n")).collect()}
    slot = turns_.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(docs_per_turn - 1)))).withColumn("index", F.col("nth") * docs_per_turn + F.col("slot"))
    wanted = slot.select(F.col("picked").alias(source), "turn", (F.col("turn") * docs_per_turn + F.col("slot")).alias("place"), F.floor(F.col("index") / size).cast("long").alias("cycle"), (F.col("index") % size).alias("pos"))
    # the cycles that these turns go through follow from the sources' turns; only their keys are put in order
    through = {s: (state["turns"].get(s, 0) * docs_per_turn // sizes[s], ((n + 1) * docs_per_turn - 1) // sizes[s]) for s, n in counts.items()}
    cycle = F.create_map(*(F.lit(x) for s, (a, b) in through.items() for x in (s, F.sequence(F.lit(a), F.lit(b)))))[F.col(source)]
    keys = kept.where(F.col(source).isin(list(through))).select(source, key, F.explode(cycle).alias("cycle"))
    told = wanted.join(seeded_shuffle(keys, source, "cycle", key, seed), [source, "cycle", "pos"]).select(F.col(source).alias("_s"), F.col(key).alias("_k"), "turn", "place", "cycle")
    out = kept.join(told, (F.col(source) == F.col("_s")) & (F.col(key) == F.col("_k")))
    return out.select(*rows.columns, "turn", "place", "cycle"), {**state, "next_turn": first + n_turns, "turns": {**state["turns"], **{s: n + 1 for s, n in counts.items()}}}


#: Values of an allow-list that are broadcast.
BROADCAST_VALUES = 100_000


def within(rows: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of an allow-list, which is the caller's own: broadcast up to ``BROADCAST_VALUES``, else a join."""
    listed = rows.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` {rows.schema[column].dataType.simpleString()}")
    return rows.join(F.broadcast(listed) if len(values) <= BROADCAST_VALUES else listed, column, "left_semi")


def over_limits(limits: dict[str, float]) -> Column:
    """Whether any column lies beyond (not at) its limit."""
    over = F.lit(False)
    for c, most in limits.items():
        over = over | (F.col(c) > most)
    return over


def first_found(keys: DataFrame, key: str, value: str, *tables: DataFrame) -> DataFrame:
    """``keys`` with the value of the first table that has one: the preferred file, else the next."""
    names = []
    for k, t in enumerate(tables):
        names.append(f"_v{k}")
        keys = keys.join(t.select(key, F.col(value).alias(names[-1])), key, "left")
    return keys.withColumn(value, F.coalesce(*names)).drop(*names)


#: What a local source's state looks like; older ones, which kept a table of the order, are refused.
LOCAL_VERSION = "local_v4"


def local_state(docs: DataFrame, path: str, order: list[str], text: str = "text", seed: int = 42, shuffle: bool = True, cycle: bool = True, start: int = 0) -> dict:
    """The state of a local source that hasn't begun: its path and digest, the number of documents, and where it stands.

    Epochs' orders follow from (seed, epoch), so no order is kept.
    """
    n, digest = docs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*order, text).cast("decimal(38,0)")), F.lit(0)).cast("string")).first()
    if not n:
        raise ValueError(f"{path} has no usable documents")
    start = max(0, start)
    return {"version": LOCAL_VERSION, "path": path, "digest": digest, "n": n, "seed": seed, "shuffle": shuffle, "cycle_flag": cycle, "cycle": 0, "offset": start % n if cycle else min(start, n)}


def local_scan(docs: DataFrame, state: dict, n_docs: int, order: list[str]) -> tuple[DataFrame, dict]:
    """(the next ``n_docs`` documents with ``epoch`` and ``place``; the state behind them).

    ``docs`` are in the order of ``order``, which is total. Every epoch has an order of its own, a
    permutation computed row by row. Without ``cycle_flag`` the source ends with its first epoch. A state
    belongs to documents: another number of them is an error.
    """
    if state.get("version") != LOCAL_VERSION:
        raise ValueError(f"a local state of version {state.get('version')}")
    n, first = state["n"], state["cycle"] * state["n"] + state["offset"]
    last = first + n_docs if state["cycle_flag"] else min(first + n_docs, n)
    at = numbered(docs, order, name="_pos")
    if docs.count() != n:
        raise ValueError(f"{state['path']} has another number of documents than {n}")
    epochs_ = F.explode(F.sequence(F.lit(first // n).cast("long"), F.lit(max(first, last - 1) // n).cast("long")))
    each = at.withColumn("epoch", epochs_)
    place = permuted(F.col("_pos"), n, F.lit(state["seed"]), F.col("epoch")) if state["shuffle"] else F.col("_pos")
    rows = each.withColumn("place", F.col("epoch") * n + place).where((F.col("place") >= first) & (F.col("place") < last)).drop("_pos")
    cycle, offset = divmod(last, n) if state["cycle_flag"] else (0, last)
    return rows, {**state, "cycle": cycle, "offset": offset}


def checked_local_state(state: dict, docs: DataFrame, path: str, order: list[str], text: str = "text") -> dict:
    """``state`` if it is of these documents; another path or other texts are an error."""
    now = local_state(docs, path, order, text)
    if state.get("path") != path or state.get("digest") != now["digest"]:
        raise ValueError(f"a state of {state.get('path')}, not of {path} as it is")
    return state


def buffered_shuffle(rows: DataFrame, buffer: int, seed: int, name: str = "", cycle: int = 0) -> DataFrame:
    """Rows shuffled as a stream shuffles them: a buffer of so many rows in each partition, of which every new row replaces a drawn one.

    The draws follow from (seed, name, cycle) and the partition's number, so a partition that is done again gives the
    same order, as long as its rows come in the same one. Nothing moves between partitions.
    """
    if buffer < 1:
        raise ValueError("a buffer of at least one row")
    base = int.from_bytes(hashlib.sha256(f"{seed}|{name}|{cycle}".encode()).digest()[4:8], "big") & 0x7FFFFFFF

    def run(batches):
        rng, held = np.random.default_rng([base, TaskContext.get().partitionId()]), None
        for b in batches:
            table = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])]).combine_chunks()
            had = 0 if held is None else held.num_rows
            fill = min(buffer, table.num_rows)
            slots, out = list(range(fill)), []
            for new, at in zip(range(fill, table.num_rows), rng.integers(0, buffer, table.num_rows - max(fill, had)).tolist(), strict=True):
                out.append(slots[at])
                slots[at] = new
            if out:
                yield from table.take(pa.array(out)).combine_chunks().to_batches()
            held = table.take(pa.array(slots)).combine_chunks()
        if held is not None:
            yield from held.take(pa.array(rng.permutation(held.num_rows))).combine_chunks().to_batches()

    return rows.mapInArrow(run, rows.schema)
