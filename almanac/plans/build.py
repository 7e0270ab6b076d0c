"""Building a corpus or a round from a specification: the operators put together."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import claims, dates
from ..functions.fixed import DEFAULTS
from ..operators import corpus, mixing, rank
from ..operators.order import numbered
from ..sources import text_files


def load_config(text: str) -> dict:
    """A JSON configuration, or YAML where that library is there."""
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        import yaml

        return yaml.safe_load(text)


def layered(*configs: dict | None) -> dict:
    """Defaults, then fetched, then explicit settings; later ones win, None entries don't count."""
    return reduce(lambda a, b: a | {k: v for k, v in (b or {}).items() if v is not None}, configs, {})


def first_bank(*banks: DataFrame | None) -> DataFrame:
    """The first prompt bank that is there and has rows: a file, a generated one, the bundled one."""
    for b in banks:
        if b is not None and not b.isEmpty():
            return b
    raise ValueError("no prompt bank")


def date_window(spec: dict) -> tuple[int | None, int | None]:
    """First and last year of a source; ``date_year`` sets both."""
    year = spec.get("date_year")
    return (year, year) if year is not None else (spec.get("date_year_min"), spec.get("date_year_max"))


def skip(rows: DataFrame, order: list[str], offset: int) -> DataFrame:
    """Rows from a start offset of their order on."""
    return rows if offset <= 0 else numbered(rows, order, name="_place").where(F.col("_place") >= offset).drop("_place")


def source(spark: SparkSession, spec: dict, cutoff: int) -> DataFrame:
    """(source, id, text, title, year) of one source; ``counted_source`` also counts what its preprocessing skips.

    A specification has name, path (Parquet) or table (a DataFrame), and optionally text_field,
    title_field, date_field, id_field, min_chars, snapshot_year, min_year, require_date,
    date_year…, min_int_score, min_score, start_offset and preprocess.
    """
    rows = spec["table"] if "table" in spec else spark.read.parquet(spec["path"])
    snapshot = spec.get("snapshot_year")
    if snapshot is not None and snapshot > cutoff:
        raise corpus.CutoffError(f"{spec['name']}: snapshot {snapshot} after {cutoff}")
    column = lambda key, default: F.col(spec[key]) if spec.get(key) else default
    none = F.lit(None).cast("string")
    # a year window without a date field looks at the column date
    windowed = any(spec.get(k) is not None for k in ("date_year", "date_year_min", "date_year_max"))
    spec = {**spec, "date_field": "date"} if windowed and not spec.get("date_field") and "date" in rows.columns else spec
    date = column("date_field", None)
    numeric = date is not None and dict(rows.dtypes)[spec["date_field"]] not in ("string",) if date is not None and "." not in spec["date_field"] else False
    year = F.lit(None).cast("int") if date is None else dates.year_of_number(date) if numeric else dates.year_of_text(date)
    kept = rows
    if spec.get("min_int_score") is not None or spec.get("min_score") is not None:
        have = {c: F.col(c) if c in rows.columns else F.lit(None).cast("double") for c in ("int_score", "score")}
        kept = kept.where(corpus.passes_quality(have["int_score"], have["score"], spec.get("min_int_score"), spec.get("min_score")))
    kept = kept.where(corpus.keeps_source_row(year, cutoff, snapshot is not None, date is not None, spec.get("min_year"), bool(spec.get("require_date"))))
    first, last = date_window(spec)
    kept = kept.where(corpus.passes_date(year, first, last, bool(spec.get("require_date"))))
    out = text_files.scan(kept, spec.get("text_field", "text"), spec.get("min_chars", 1)).select(F.lit(spec["name"]).alias("source"), column("id_field", F.col("doc_id") if "doc_id" in rows.columns else none).alias("id"), column("text_field", F.col("text")).alias("text"), column("title_field", none).alias("title"), year.alias("year"))
    out = skip(out, ["id"], spec.get("start_offset", 0))
    return preprocessed(out, spec, cutoff).where("text IS NOT NULL") if claims.preprocess_enabled(spec.get("preprocess")) else out


def preprocessed(rows: DataFrame, spec: dict, cutoff: int) -> DataFrame:
    """Rows with their text as the specification's preprocessing leaves it: NULL where it leaves none."""
    return rows.withColumn("text", claims.preprocess_by_config(F.col("text"), spec["preprocess"], cutoff, F.col("title")))


def counted_source(spark: SparkSession, spec: dict, cutoff: int) -> tuple[DataFrame, Observation]:
    """(the rows of ``source``, counters that are there once an action has run): ``scanned`` rows of the source,
    ``kept`` and ``skipped`` ones of its preprocessing, without a pass of their own."""
    plain = source(spark, {k: v for k, v in spec.items() if k != "preprocess"}, cutoff)
    rows = preprocessed(plain, spec, cutoff) if claims.preprocess_enabled(spec.get("preprocess")) else plain
    return text_files.counted(rows, F.when(F.col("text").isNull(), "skipped").otherwise("kept"))


def build_corpus(spark: SparkSession, specs: list[dict], cutoff: int, sequential: bool = False, docs_per_turn: int | None = None, seed: int = 42) -> DataFrame:
    """All sources mixed, in the order of ``place``: in turns of ``docs_per_turn`` rows, drawn by weight among the sources
    that still have some or taken one after another (``sequential``); without turns interleaved by weight."""
    if not specs:
        raise corpus.CutoffError("at least one source is required")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [source(spark, s, cutoff) for s in specs])
    weights = {s["name"]: float(s.get("weight", 1.0)) for s in specs}
    if sequential or docs_per_turn:
        return mixing.mixed(rows, weights, mixing.mix_state(list(weights), docs_per_turn or 4096, seed, sequential))[0]
    return corpus.mix(rows, spark.createDataFrame(list(weights.items()), "source string, weight double"), "source", "id")


def two_model_duel(verdicts: DataFrame) -> DataFrame:
    """(uid_a, uid_b, wins_a, wins_b, ties, n, winner): the winner is NULL on equal wins."""
    t = rank.tally(verdicts, ["uid_a", "uid_b"])
    return t.withColumn("winner", F.when(F.col("wins_a") > F.col("wins_b"), F.col("uid_a")).when(F.col("wins_b") > F.col("wins_a"), F.col("uid_b")))


def self_test(scores: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """(uid, passed, years): whether both gates pass in every year of a submission."""
    y = rank.year_scores(scores, config)
    return y.groupBy("uid").agg(F.every(F.col("known_ok") & F.col("unknown_ok")).alias("passed"), F.count("*").alias("years"))


def leak_test(items: DataFrame, tokens: DataFrame, keys: list[str], config: dict = DEFAULTS) -> DataFrame:
    """(uid, year, score, known_ok, unknown_ok) from items (…keys, uid, year, kind, weight) and a model's logits at their tokens."""
    return rank.year_scores(rank.sequence_log_probs(items, tokens, keys), config)
