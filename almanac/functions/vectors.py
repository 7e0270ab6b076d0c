"""Vector expressions over array columns, and the one kernel that needs numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import let
from .fixed import SPECTRUM_TOP


def _sum(a: Column) -> Column:
    return F.reduce(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    return let(norm(a) + 1e-10, lambda n: F.transform(a, lambda x: x.cast("double") / n))


#: Norms count as at least this in a cosine.
LEAST_NORM = 1e-8


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """The cosine of two vectors, whose norms may be known; 0 where one of them is zero."""
    of = lambda v, n: F.greatest(norm(v) if n is None else n, F.lit(LEAST_NORM))
    return dot(a, b) / (of(a, norm_a) * of(b, norm_b))


def top_prefix(spectrum: Column, share: float = SPECTRUM_TOP) -> Column:
    """The unit vector of the leading quarter (at least one value) of a spectrum."""
    return unit(F.slice(spectrum, F.lit(1), F.greatest(F.lit(1), F.floor(F.size(spectrum) * share).cast("int"))))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def log_softmax(logits: Column) -> Column:
    top = F.array_max(logits).cast("double")
    return let(top + F.log(_sum(F.transform(logits, lambda x: F.exp(x.cast("double") - top)))), lambda z: F.transform(logits, lambda x: x.cast("double") - z))


def symmetric_kl(a: Column, b: Column) -> Column:
    """Half the sum of both divergences of two log-probability arrays."""
    return _sum(F.zip_with(a, b, lambda x, y: (F.exp(x) - F.exp(y)) * (x - y))) / 2


def with_probability(lp: Column) -> Column:
    """Log-probabilities, each with its probability: found once a row, not once a pair."""
    return F.transform(lp, lambda x: F.struct(x.alias("lp"), F.exp(x).alias("p")))


def symmetric_kl_known(a: Column, b: Column) -> Column:
    """``symmetric_kl`` of two arrays of ``with_probability``."""
    return _sum(F.zip_with(a, b, lambda x, y: (x["p"] - y["p"]) * (x["lp"] - y["lp"]))) / 2


def singular_values(matrix: Column, columns: int) -> Column:
    """Singular values of row-major matrices, in Arrow batches (same-shape matrices are stacked)."""
    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(s), index=s.index, dtype=object)
        sizes = s.map(lambda m: -1 if m is None else len(m))
        for n in sizes[sizes > 0].unique():
            at = sizes[sizes == n].index
            values = np.linalg.svd(np.stack(s[at]).reshape(len(at), -1, columns).astype(float), compute_uv=False)
            for i, v in zip(at, values, strict=True):
                out[i] = v
        return out

    return run(matrix)
