"""Repositories, files, parameters and small text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .fixed import FIRST_YEAR, LAST_YEAR

COMMIT = r"^[^/@\s]+/[^/@\s]+@[0-9a-f]{40}$"


def repo_parts(repo: Column) -> Column:
    """struct(name, revision) split at the last @; no @ gives no revision."""
    at = F.length(repo) - F.locate("@", F.reverse(repo)) + 1
    has = F.contains(repo, F.lit("@"))
    return F.struct(F.when(has, F.substr(repo, F.lit(1), at - 1)).otherwise(repo).alias("name"), F.when(has, F.substr(repo, at + 1)).alias("revision"))


def is_commit(repo: Column) -> Column:
    return repo.rlike(COMMIT)


def required_years() -> Column:
    return F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR))


def missing_years(years: Column) -> Column:
    return F.array_sort(F.array_except(required_years(), years))


def file_set(paths: Column, sizes: Column, times: Column) -> tuple[Column, Column]:
    """Aggregates of a set of files: its size and the sha1 over its sorted ``path:size:time`` lines."""
    line = F.concat_ws(":", paths, sizes.cast("string"), times.cast("string"))
    return F.sum(sizes), F.sha1(F.array_join(F.array_sort(F.collect_list(line)), "\n").cast("binary"))


def number_after(name: Column, prefix: str) -> Column:
    """The number that follows a prefix and ends the name; NULL where there is none."""
    tail = F.substr(name, F.lit(len(prefix) + 1))
    return F.when(F.startswith(name, F.lit(prefix)), tail.try_cast("int"))


def settings(text: Column) -> Column:
    """A map from ``key=value`` lines."""
    return F.str_to_map(text, F.lit("\n"), F.lit("="))


def truncated(prompt: Column, completion: Column, most_prompt: int = 500, most_completion: int = 300) -> Column:
    return F.struct(F.substring(prompt, 1, most_prompt).alias("prompt"), F.substring(completion, 1, most_completion).alias("completion"))


def stored_bytes(name: Column, numel: Column) -> Column:
    """Bytes of a parameter: two each in embeddings that are kept in half precision, else four."""
    return numel * F.when(name.rlike("aux_embeds|embed_tokens"), 2).otherwise(4)


def is_local_path(model: Column) -> Column:
    """Whether a model's name looks like a path: absolute, relative with dots, home, a drive, back slashes, or more than one slash."""
    return model.rlike(r"^[/.~]|^[A-Za-z]:|\\") | (F.length(model) - F.length(F.replace(model, F.lit("/"), F.lit(""))) > 1)


def dotted(json: Column, path: str) -> Column:
    """The field of a JSON object by a path with dots; a key that is literally so named wins."""
    return F.coalesce(F.get_json_object(json, f"$['{path}']"), F.get_json_object(json, f"$.{path}"))


def first_free(used: DataFrame, prefix: str = "prefix", number: str = "k") -> DataFrame:
    """(prefix, free): the first number from 0 on that no name of a prefix uses. The gaps come from neighbours in number order."""
    w = Window.partitionBy(prefix).orderBy(number)
    gaps = used.select(prefix, number).distinct().withColumn("_next", F.coalesce(F.lead(number).over(w), F.lit((1 << 31) - 1))).where(F.col("_next") > F.col(number) + 1)
    least = used.groupBy(prefix).agg(F.min(number).alias("_least")).join(gaps.groupBy(prefix).agg(F.min(F.col(number) + 1).alias("_free")), prefix)
    return least.select(prefix, F.when(F.col("_least") > 0, 0).otherwise(F.col("_free")).cast("int").alias("free"))
