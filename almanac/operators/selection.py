"""Exact medians of groups of any size, by radix selection where a group is large.

A double's 64 bits are mapped onto an unsigned order. Each of four rounds counts a group's values by the
next 16 bits under the prefix found so far: an ordinary aggregate with partial sums before the shuffle and
at most 65,536 counts a group. A running sum over the counts picks the bits of the wanted rank, so
no value is ever sorted and no buffer grows with a group. Both medians are followed at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_folder

ROUND_BITS, ROUNDS = 16, 4
#: Values of a group up to which one aggregate's buffer holds them, and groups up to which their prefixes are broadcast.
BUFFERED, BROADCAST_GROUPS = 1 << 20, 100_000
_SIGN = -(1 << 63)


def _of_double(method: str, x: Column, kind: str) -> Column:
    return F.java_method(F.lit("java.lang.Double"), F.lit(method), x).cast(kind)


def ordered_bits(value: Column) -> Column:
    """A long whose unsigned order is that of doubles; -0.0 counts as 0.0, NaN lies behind all numbers. Not for NULL."""
    bits = _of_double("doubleToLongBits", F.when(value == 0, 0.0).otherwise(value.cast("double")), "long")
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(_SIGN)))


def double_of(bits: Column) -> Column:
    return _of_double("longBitsToDouble", F.when(bits < 0, bits.bitwiseXOR(F.lit(_SIGN))).otherwise(F.bitwise_not(bits)), "double")


def largest_group(rows: DataFrame, keys: list[str]) -> int:
    return rows.groupBy(*keys).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def medians(rows: DataFrame, keys: list[str], value: str, buffered: int = BUFFERED) -> DataFrame:
    """(…keys, lower, upper): sorted(x)[(n - 1) // 2] and sorted(x)[n // 2] of each group's values; NULL values don't count, keys may be NULL.

    Groups of up to ``buffered`` values are one aggregate. Where any is larger, all go through radix selection.
    """
    held = rows.select(*keys, F.col(value).cast("double").alias("_x")).where("_x IS NOT NULL")
    if largest_group(held, keys) <= buffered:
        lower, upper = (F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {s}_x)") for s in ("", "-"))
        return held.groupBy(*keys).agg(lower.alias("lower"), (-upper).alias("upper"))
    return selected(held, keys)


def selected(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``medians`` of (…keys, _x) by radix selection."""
    shared_folder(rows.sparkSession)
    bits = rows.select(*keys, F.col("_x").alias("_d")).select(*keys, ordered_bits(F.col("_d")).alias("_b")).checkpoint()
    sizes = bits.groupBy(*keys).agg(F.count("*").alias("_n"))
    rank = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor((F.col("_n") - 1) / 2).alias("rank")), F.struct(F.lit(1).alias("side"), F.floor(F.col("_n") / 2).alias("rank"))))
    state = sizes.select(*keys, rank.alias("_r"), F.lit(0).cast("long").alias("_p")).select(*keys, "_p", F.col("_r.side").alias("_side"), F.col("_r.rank").alias("_rank")).checkpoint()
    few = state.count() <= 2 * BROADCAST_GROUPS
    small = F.broadcast if few else lambda x: x
    for k in range(ROUNDS):
        shift = 64 - ROUND_BITS * (k + 1)
        here = bits.withColumn("_q", F.shiftrightunsigned("_b", shift + ROUND_BITS) if k else F.lit(0).cast("long"))
        asked = state.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)), F.col("_p").alias("_asked")).distinct()
        inside = here.join(small(asked), _same(keys, "_q", "_asked"), "left_semi") if k else here
        counts = inside.groupBy(*keys, "_q", F.shiftrightunsigned("_b", shift).bitwiseAND(F.lit((1 << ROUND_BITS) - 1)).alias("_c")).agg(F.count("*").alias("_m"))
        mine = state.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)), F.col("_p"), "_side", "_rank")
        met = counts.join(small(mine), _same(keys, "_q", "_p"))
        ahead = Window.partitionBy(*keys, "_side").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
        told = met.withColumn("_upto", F.sum("_m").over(ahead)).where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_m") <= F.col("_rank")))
        state = told.select(*keys, (F.shiftleft("_p", ROUND_BITS) + F.col("_c")).alias("_p"), "_side", (F.col("_rank") - F.col("_upto") + F.col("_m")).alias("_rank")).checkpoint()
    side = lambda s: F.max(F.when(F.col("_side") == s, F.col("_x")))
    return state.select(*keys, "_side", double_of(F.col("_p")).alias("_x")).groupBy(*keys).agg(side(0).alias("lower"), side(1).alias("upper"))


def _same(keys: list[str], a: str, b: str) -> Column:
    same = F.col(a) == F.col(b)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return same
