"""The skill classifier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import SKILL_CHARS, SKILLS


def skill_scores(text: Column, url: Column | None = None) -> Column:
    """How many of each category's patterns occur in the text's first characters and the address."""
    blob = F.concat(F.substring(text, 1, SKILL_CHARS), F.lit("\n"), F.coalesce(url, F.lit("")) if url is not None else F.lit(""))
    return F.array(*(F.struct(F.lit(name).alias("skill"), sum(blob.rlike(f"(?iuUd){p}").cast("int") for p in patterns).alias("score")) for name, patterns in SKILLS))


def classify_skill(text: Column, url: Column | None = None) -> Column:
    """The category with most patterns, the first declared on ties; NULL where none occurs or the text is empty."""
    best = F.reduce(skill_scores(text, url), F.struct(F.lit(None).cast("string").alias("skill"), F.lit(0).alias("score")), lambda a, x: F.when(x["score"] > a["score"], x).otherwise(a))
    return F.when(text != "", best["skill"])
