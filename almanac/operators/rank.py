"""Leak scoring, qualification, tournaments, rewards and the result cache."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import drawn_swap
from ..functions.fixed import BEST_SCORE, DEFAULTS, GATE_EPSILON
from ..functions.vectors import log_softmax
from .order import numbered
from .selection import BUFFERED, largest_group, medians


def upper_median(name: str) -> Column:
    """The aggregate sorted(x)[n // 2] of a column: the upper of the two middle values. Equal values are counted before the shuffle."""
    return -F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY -`{name}`)")


def lower_median(name: str) -> Column:
    """The aggregate sorted(x)[(n - 1) // 2] of a column."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{name}`)")


def sequence_log_probs(items: DataFrame, tokens: DataFrame, keys: list[str]) -> DataFrame:
    """``items`` with ``score``: the sum of log(p + 1e-10) over a phrase's expected tokens; 0 for a phrase without tokens.

    ``tokens`` has (…keys, logits array, expected): a model's logits at each token's place and the
    index of the token that stands there; an index that the logits don't have is an error. Any
    number of items is one aggregate.
    """
    at = F.col("expected").cast("int")
    known = F.when((at >= 0) & (at < F.size("logits")), at).otherwise(F.raise_error(F.concat(F.lit("no logit for token "), F.col("expected").cast("string"))).cast("int"))
    p = F.exp(F.get(log_softmax(F.col("logits")), known))
    sums = tokens.groupBy(*keys).agg(F.sum(F.log(p + 1e-10)).alias("_s"))
    return items.join(sums, keys, "left").withColumn("score", F.coalesce("_s", F.lit(0.0))).drop("_s")


def perplexity(loss: str, weight: str, most: float = 20.0) -> Column:
    """The aggregate exp of the weighted mean loss, capped at exp(most); NULL without weight."""
    mean = F.try_divide(F.sum(F.col(loss) * F.col(weight)), F.sum(weight))
    return F.when(mean.isNotNull(), F.exp(F.least(mean, F.lit(most))))


def build_benchmark(facts: DataFrame, cutoff: int, known: bool, cutoff_weight: int = DEFAULTS["known_cutoff_weight"]) -> DataFrame:
    """(prompt, phrase, year, weight): facts up to the cutoff, those of its year heavier; or facts after it."""
    picked = facts.where(F.col("year") <= cutoff if known else F.col("year") > cutoff)
    return picked.withColumn("weight", F.when(F.lit(known) & (F.col("year") == cutoff), cutoff_weight).otherwise(1))


def benchmarks(facts: DataFrame, years: list[int], cutoff_weight: int = DEFAULTS["known_cutoff_weight"]) -> DataFrame:
    """(year, kind, prompt, phrase, fact_year, weight): both sides of every evaluated year, by an explode of the few years.

    A year without items on either side is an error.
    """
    dated = facts.select("prompt", "phrase", F.col("year").alias("fact_year"), F.explode(F.array(*map(F.lit, years))).alias("year"))
    known = F.col("fact_year") <= F.col("year")
    sides = dated.select("year", F.when(known, "known").otherwise("unknown").alias("kind"), "prompt", "phrase", "fact_year", F.when(F.col("fact_year") == F.col("year"), cutoff_weight).otherwise(1).alias("weight"))
    return checked_benchmarks(sides, years)


def checked_benchmarks(sides: DataFrame, years: list[int]) -> DataFrame:
    """``sides`` (year, kind, …) of the years, if every year has known and unknown items."""
    there = {(r.year, r.kind) for r in sides.where(F.col("year").isin(years)).select("year", "kind").distinct().collect()}
    if missing := [(y, k) for y in years for k in ("known", "unknown") if (y, k) not in there]:
        raise ValueError(f"no benchmark items for {missing}")
    return sides.where(F.col("year").isin(years))


def gates(scores: DataFrame, keys: list[str], config: dict = DEFAULTS) -> DataFrame:
    """(…keys, kind, median, ratio, exceeded) from (…keys, kind, weight, score): the weighted share above epsilon against the kind's threshold."""
    limit = F.when(F.col("kind") == "known", config["known_threshold"]).otherwise(config["leak_threshold"])
    failed = F.sum(F.when(F.col("score") > config.get("leak_epsilon", GATE_EPSILON), F.col("weight")).otherwise(0))
    ratio = F.coalesce(F.try_divide(failed.cast("double"), F.sum("weight")), F.lit(0.0))
    by = [*keys, "kind"]
    if largest_group(scores, by) <= BUFFERED:
        return scores.groupBy(*by).agg(upper_median("score").alias("median"), ratio.alias("ratio")).withColumn("exceeded", F.col("ratio") > limit)
    met = medians(scores, by, "score").select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col("upper").alias("median"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)))
    return scores.groupBy(*by).agg(ratio.alias("ratio")).join(met, same, "left").select(*by, "median", "ratio").withColumn("exceeded", F.col("ratio") > limit)


def year_scores(scores: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """(uid, year, score, known_ok, unknown_ok): the difference of medians where both gates pass, else 0.

    The unknown gate passes below its threshold, the known one above; a missing side has the
    empty median and isn't exceeded.
    """
    g = gates(scores, ["uid", "year"], config)
    side = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    wide = g.groupBy("uid", "year").agg(
        F.coalesce(side("known", "median"), F.lit(config["empty_median"])).alias("km"), F.coalesce(side("unknown", "median"), F.lit(config["empty_median"])).alias("um"),
        F.coalesce(side("known", "exceeded"), F.lit(False)).alias("known_ok"), (~F.coalesce(side("unknown", "exceeded"), F.lit(False))).alias("unknown_ok"),
    )
    return wide.select("uid", "year", F.when(F.col("known_ok") & F.col("unknown_ok"), F.col("um") - F.col("km")).otherwise(0.0).alias("score"), "known_ok", "unknown_ok")


def leak_scores(by_year: DataFrame, years: list[int]) -> DataFrame:
    """(uid, score): the mean over all required years; a missing year counts 0, so a sum over the years present is enough."""
    return by_year.where(F.col("year").isin(years)).groupBy("uid").agg((F.sum("score") / len(years)).alias("score"))


def normalised(score: Column, config: dict = DEFAULTS) -> Column:
    """Where a score lies between the threshold (0) and the best score (1): the configured epsilon, or ``BEST_SCORE`` where none is configured."""
    t = config["min_eval_score"]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (t - score) / (t - config.get("leak_epsilon", BEST_SCORE))))


def qualify(scores: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """(uid, score, normalised, rank): the best scores strictly below the threshold, at most top_n; ties by ``pos`` if there, then uid."""
    order = [F.asc("score"), *([F.asc("pos")] if "pos" in scores.columns else []), F.asc("uid")]
    top = scores.where(F.col("score") < config["min_eval_score"]).orderBy(*order).limit(config["top_n_for_quality"])
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("uid", "score", normalised(F.col("score"), config).alias("normalised"), "rank")


#: Players of a round robin, whose table is broadcast to itself.
MOST_PLAYERS = 10_000


def pairs(players: DataFrame, order: str) -> DataFrame:
    """Round robin: every pair once, (uid_a, uid_b) in list order. Players are the qualified few; more than ``MOST_PLAYERS`` are an error."""
    if (n := players.count()) > MOST_PLAYERS:
        raise ValueError(f"{n} players for a round robin, more than {MOST_PLAYERS}")
    numbered = players.select("uid", F.row_number().over(Window.orderBy(order)).alias("_p"))
    a, b = numbered.withColumnsRenamed({"uid": "uid_a", "_p": "_a"}), numbered.withColumnsRenamed({"uid": "uid_b", "_p": "_b"})
    return a.join(F.broadcast(b), F.col("_a") < F.col("_b")).select("uid_a", "uid_b")


def duel_inputs(completions: DataFrame, duels: DataFrame, prompts: DataFrame) -> DataFrame:
    """(uid_a, uid_b, year, prompt_idx, prompt, swap, first, second): both players' completions of each prompt as a judge sees them.

    ``completions`` is (uid, year, prompt_idx, text), ``duels`` (uid_a, uid_b) of the qualified few,
    ``prompts`` (year, prompt_idx, prompt). Two players meet in every year in which both completed
    anything, over all of its prompts; a prompt that one left out has the empty completion. Equi-joins.
    """
    text = lambda side: completions.select(F.col("uid").alias(f"uid_{side}"), "year", "prompt_idx", F.col("text").alias(f"_{side}"))
    years = completions.select("uid", "year").distinct()
    meet = duels.join(years.withColumnRenamed("uid", "uid_a"), "uid_a").join(years.withColumnRenamed("uid", "uid_b"), ["uid_b", "year"])
    asked = meet.join(prompts, "year")
    both = asked.join(text("a"), ["uid_a", "year", "prompt_idx"], "left").join(text("b"), ["uid_b", "year", "prompt_idx"], "left").na.fill("", ["_a", "_b"])
    shown = both.withColumn("swap", drawn_swap(*map(F.col, ("uid_a", "uid_b", "year", "prompt_idx"))))
    return shown.select("uid_a", "uid_b", "year", "prompt_idx", "prompt", "swap", F.when(F.col("swap"), F.col("_b")).otherwise(F.col("_a")).alias("first"), F.when(F.col("swap"), F.col("_a")).otherwise(F.col("_b")).alias("second"))


def unswapped(raw: Column, swap: Column) -> Column:
    """The verdict as if the pair hadn't been shown in swapped order."""
    return F.when(swap & (raw == "a"), "b").when(swap & (raw == "b"), "a").otherwise(raw)


def tally(verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, wins_a, wins_b, ties, n) of verdict rows (…keys, raw, swap)."""
    v = verdicts.withColumn("_v", unswapped(F.col("raw"), F.col("swap")))
    won = lambda x: F.count_if(F.col("_v") == x)
    return v.groupBy(*keys).agg(won("a").alias("wins_a"), won("b").alias("wins_b"), won("tie").alias("ties"), F.count("*").alias("n"))


def tally_by_category(verdicts: DataFrame) -> DataFrame:
    """(category, wins_a, wins_b, ties, n) with a row for all of them, named total."""
    v = verdicts.withColumn("_v", unswapped(F.col("raw"), F.col("swap")))
    won = lambda x: F.count_if(F.col("_v") == x)
    return v.rollup("category").agg(won("a").alias("wins_a"), won("b").alias("wins_b"), won("tie").alias("ties"), F.count("*").alias("n")).withColumn("category", F.coalesce("category", F.lit("total")))


def win_rates(duels: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(…keys, uid, wins, prompts, win_rate) over all duels of a player: won prompts by prompts, losers keep their credit."""
    both = duels.select(*keys, F.inline(F.array(F.struct(F.col("uid_a").alias("uid"), F.col("wins_a").alias("w"), "n"), F.struct(F.col("uid_b").alias("uid"), F.col("wins_b").alias("w"), "n"))))
    agg = both.groupBy(*keys, "uid").agg(F.sum("w").alias("wins"), F.sum("n").alias("prompts"))
    return agg.withColumn("win_rate", F.col("wins") / F.greatest(F.lit(1), F.col("prompts")))


def mean_over_years(rates: DataFrame, n_years: int) -> DataFrame:
    """(uid, win_rate): the mean over the evaluated years; a year without the player counts 0."""
    return rates.groupBy("uid").agg((F.sum("win_rate") / n_years).alias("win_rate"))


def final_scores(qualified: DataFrame, rates: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """(uid, score, normalised, rank, win_rate, final); a single qualifier gets 1 without a duel."""
    q = qualified.join(rates.select("uid", "win_rate"), "uid", "left").withColumn("win_rate", F.coalesce("win_rate", F.lit(0.0)))
    alone = F.count("*").over(Window.partitionBy(F.lit(1))) == 1
    return q.withColumn("final", F.when(alone, 1.0).otherwise(config["leak_weight"] * F.col("normalised") + config["quality_weight"] * F.col("win_rate")))


def rewards(finals: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """(uid, place, weight): exp(-0.8 i^0.9) over the best, scaled to the emission share; the rest of the share is the owner's (place NULL)."""
    best = finals.where((F.col("final") > 0) & (F.col("uid") != config["owner_uid"])).orderBy(F.desc("final"), F.asc("rank")).limit(config["top_paid"])
    top = best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("final"), F.asc("rank"))))  # the paid few
    curve = F.exp(-0.8 * F.pow(F.col("place") - 1, 0.9))
    paid = top.select("uid", "place", (curve / F.sum(curve).over(Window.partitionBy(F.lit(1))) * config["emission_pct"]).alias("weight"))
    if config["emission_pct"] >= 1.0:
        return paid
    owner = paid.limit(1).select(F.lit(config["owner_uid"]).cast(finals.schema["uid"].dataType).alias("uid"), F.lit(None).cast("int").alias("place"), F.lit(1.0 - config["emission_pct"]).alias("weight"))
    return paid.unionByName(owner)


def places(scores: DataFrame, order: list[str]) -> DataFrame:
    """``scores`` with their place from 1, by ranges and not in one task."""
    return numbered(scores, order, name="_p").withColumn("place", (F.col("_p") + 1).cast("int")).drop("_p")


def current_weights(weights: DataFrame, owner: int) -> DataFrame:
    """Entries that aren't zero; the owner alone with 1 where there are none."""
    kept = weights.where("weight > 0").select("uid", "weight")
    fallback = weights.agg(F.coalesce(F.max("weight"), F.lit(0.0)).alias("m")).where("m <= 0").select(F.lit(owner).cast(weights.schema["uid"].dataType).alias("uid"), F.lit(1.0).alias("weight"))
    return kept.unionByName(fallback)


def upsert(table: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Insert or replace: the row with the highest version of each key."""
    both = table.unionByName(new)
    held = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*held), version).alias("_r")).select(*keys, "_r.*").select(*both.columns)


def insert_ignore(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return table.unionByName(new.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti"))


def delete_after_last(table: DataFrame, uid: int, time: str = "evaluated_at") -> DataFrame:
    """Without rows later than the last one of ``uid`` (none goes where it has no row)."""
    last = table.where(F.col("uid") == uid).agg(F.max(time).alias("_last"))
    return table.join(F.broadcast(last), F.col(time) > F.col("_last"), "left_anti")


def active(turns: DataFrame, player: str, answered: Column) -> DataFrame:
    """(player, active): whether a player has any turn that counts as an answer."""
    return turns.groupBy(player).agg(F.coalesce(F.bool_or(answered), F.lit(False)).alias("active"))


def with_category(verdicts: DataFrame, prompts: DataFrame, keys: tuple[str, ...] = ("prompt_idx",)) -> DataFrame:
    """``verdicts`` with the category of their prompt, unknown where it has none."""
    named = prompts.select(*keys, F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit("unknown")).alias("_c"))
    return verdicts.join(named, list(keys), "left").withColumn("category", F.coalesce("_c", F.lit("unknown"))).drop("_c")
