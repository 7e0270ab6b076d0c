"""Global places and running sums without one task for all rows or for a whole group.

Rows fall into ranges of their order by bounds from a bounded sample; within a range they are
sorted, and the ranges' totals, one small row each, say where every range begins. The range
is a function of the row's own values, so a recomputed task gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.core import let

#: Rows of the sample for each range; its bounds only even out the ranges.
SAMPLE_EACH = 40
#: Rows for which one range is made, and ranges at most: beyond, a range's sort spills.
RANGE_ROWS, MOST_RANGES = 1_000_000, 4096
#: Bounds that one step of the search goes through.
STEP = 64


def with_range(rows: DataFrame, order: list[str], n_ranges: int | None = None) -> DataFrame:
    """``rows`` with ``_range``: how many bounds lie at or below a row in the order (nulls first).

    Bounds are searched in two steps, among every STEP-th one and then behind the one found.
    """
    total = rows.count()
    n = n_ranges or min(MOST_RANGES, max(8, rows.sparkSession.sparkContext.defaultParallelism, total // RANGE_ROWS))
    want = n * SAMPLE_EACH
    share = max(1, total // want)
    sample = rows.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(share)) == 0).orderBy(*order).limit(4 * want).collect()
    bounds = [sample[len(sample) * k // n] for k in range(1, n)] if sample else []
    key = F.struct(*order)
    if not bounds:
        return rows.withColumn("_range", F.lit(0))
    literal = [F.struct(*(F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(order, b, strict=True))) for b in bounds]
    below = lambda some: F.size(F.filter(some, lambda b: b <= key))
    chunks = F.array(*(F.array(*literal[k : k + STEP]) for k in range(0, len(literal), STEP)))
    place = let(F.greatest(below(F.array(*literal[::STEP])) - 1, F.lit(0)), lambda c: c * STEP + below(F.get(chunks, c)))
    # exploded, because the optimizer may otherwise put the expression in a filter on the side of the totals
    return rows.select("*", F.explode(F.array(place)).alias("_range"))


def running_total(rows: DataFrame, value: Column, order: list[str], by: list[str] | None = None, n_ranges: int | None = None, name: str = "before") -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows in front (of the same ``by``)."""
    by = by or []
    dealt = with_range(rows.withColumn("_v", value), order, n_ranges)
    inner = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"_by_{c}" for c in by]
    ahead = Window.partitionBy(*(keys or [F.lit(1)])).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*(F.col(c).alias(k) for c, k in zip(by, keys, strict=True)), F.col("_range").alias("_r")).agg(F.sum("_v").alias("_t"))
    begins = totals.select(*keys, "_r", F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_b"))
    on = F.col("_range") == F.col("_r")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return dealt.join(begins, on).withColumn(name, F.col("_b") + F.coalesce(F.sum("_v").over(inner), F.lit(0))).drop("_v", "_range", "_r", "_b", *(f"_by_{c}" for c in by))


def numbered(rows: DataFrame, order: list[str], by: list[str] | None = None, n_ranges: int | None = None, name: str = "pos") -> DataFrame:
    """``rows`` with their place in the order (of the same ``by``), from 0; the order must be total."""
    return running_total(rows, F.lit(1).cast("long"), order, by, n_ranges, name)


#: Steps of a walk back into the range; on domains this tight far fewer happen.
WALK = 64


def permuted(pos: Column, n: Column | int, *key: Column) -> Column:
    """A place in [0, n) for every ``pos`` in [0, n), each place once: a permutation that the key decides, without a table of it.

    Four rounds of a Feistel network on an a x b grid with a = b = ceil(sqrt(n)), walked on until the
    place lies in the range again. Places can be computed anywhere, also for one row alone.
    """
    n = F.lit(n).cast("long") if isinstance(n, int) else n.cast("long")
    side = F.ceil(F.sqrt(n.cast("double"))).cast("long") + 1

    def step(x: Column) -> Column:
        left, right = F.floor(x / side).cast("long"), x % side
        for k in range(2):
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(2 * k), right, *key), side), side)
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(2 * k + 1), left, *key), side), side)
        return left * side + right

    walked = F.reduce(F.sequence(F.lit(2), F.lit(WALK)), step(pos.cast("long")), lambda x, _: F.when(x < n, x).otherwise(step(x)))
    return let(walked, lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("a permutation's walk didn't end")).cast("long")))
