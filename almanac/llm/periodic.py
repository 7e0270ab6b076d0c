"""Periodic runs of words: every lag of a document is compared with the document, in vectors.

A run with period q is a stretch of at least ``MIN_EXP`` periods and ``MIN_WORDS`` words. At lag q
it is a stretch of at least ``max(MIN_WORDS, MIN_EXP * q) - q`` places whose word equals the word q
places on, so lags up to n / MIN_EXP are all there are. Such a stretch holds every s-th place's
truth many times in a row for a step s of an eighth of its least length, so the places of that step
are compared first and only stretches that pass are measured place by place: nothing is missed, and
all lags of n words take about n log n comparisons. A multiple of a run's period gives the same
stretch of words again and the smallest lag counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.core import let
from . import text as tx

MIN_EXP, MIN_WORDS = 4, 6
#: Bytes of a text for each task that shares its lags, and tasks at most; shorter texts are done where they lie.
LONG, MOST_RANGES = 4 << 20, 64
#: Bytes of texts that go through the lags together.
TOGETHER = 2 << 20
#: Steps that a stretch of the least length holds.
STEPS = 8

_RUN = "struct<start: long, length: long, period: long>"


def lag_stretches(x: np.ndarray, end: int, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of places of every maximal stretch of at least ``least`` places i < end - q with x[i] == x[i + q]."""
    s = max(1, least // STEPS)
    k = least // s
    hit = np.flatnonzero(x[: end - q : s] == x[q:end:s])
    none = np.zeros(0, np.int64)
    if len(hit) < k:
        return none, none
    if s > 1 and not (hit[k - 1 :] - hit[: len(hit) - k + 1] == k - 1).any():
        return none, none
    gap = np.flatnonzero(np.diff(hit) != 1)
    first, last = hit[np.concatenate(([0], gap + 1))], hit[np.concatenate((gap, [len(hit) - 1]))]
    wide = last - first + 1 >= k
    first, last = first[wide], last[wide]
    if s == 1:
        return first, last - first + 1
    starts, sizes = [], []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        lo, hi = max(0, (a - 1) * s + 1), min(end - q, (b + 1) * s)
        u, v = tx.runs(x[lo:hi] == x[lo + q : hi + q])
        wide = v - u >= least
        starts.append(u[wide] + lo)
        sizes.append((v - u)[wide])
    return (np.concatenate(starts), np.concatenate(sizes)) if starts else (none, none)


def scan(ids: list[np.ndarray], lags: tuple[float, float] = (0.0, 1.0)) -> list[np.ndarray]:
    """For each document's word ids its runs as rows (start, length, period), by start, then period.

    ``lags`` is the share of each document's lags to look at; a share's runs may have a
    smaller period in an earlier share. All documents go through a lag together: the longest
    first, so that those with enough words for it lie in front, each with a quarter of its size
    of values behind it that equal nothing.
    """
    sizes = np.array([len(a) for a in ids], np.int64)
    found = [np.zeros((0, 3), np.int64)] * len(ids)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= MIN_WORDS]
    if not len(order):
        return found
    pad = sizes[order] // MIN_EXP + 1
    first = np.concatenate(([0], np.cumsum(sizes[order] + pad)))
    x = -np.arange(1, first[-1] + 1, dtype=np.int64)
    for at, d in zip(first.tolist(), order.tolist(), strict=False):
        x[at : at + sizes[d]] = ids[d]
    x = x.astype(np.int32) if first[-1] < 1 << 31 else x
    most = int(sizes[order[0]]) // MIN_EXP
    parts = []
    for q in range(int(most * lags[0]) + 1, int(most * lags[1]) + 1):
        need = max(MIN_WORDS, MIN_EXP * q)
        n = int(np.searchsorted(-sizes[order], -need, "right"))
        if not n:
            break
        u, m = lag_stretches(x, int(first[n]), q, need - q)
        if len(u):
            parts.append(np.stack([u, m + q, np.full(len(u), q)], 1))
    if not parts:
        return found
    every = smallest_periods(np.concatenate(parts))
    doc = np.searchsorted(first, every[:, 0], "right") - 1
    for k in np.unique(doc):
        mine = every[doc == k]
        mine[:, 0] -= first[k]
        found[order[k]] = mine
    return found


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Of rows (start, length, period) with equal start and length the one with the smallest period, by start, then period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside the runs and in each one's first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist())


def word_ids(texts: list[bytes]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Every text's words and their numbers, equal for equal words of one call."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    words = [t.split() for t in texts]
    return words, [np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in words]


def _as_list(runs: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
    fields = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))


def _texts(column: pa.Array) -> list[bytes]:
    return tx.plain(column).cast(pa.large_binary()).to_pylist()


def _done(batches: Iterator[pa.RecordBatch], runs_column: bool) -> Iterator[pa.RecordBatch]:
    """(id, text[, runs]) to (id, n_words, runs, collapsed); runs are searched for where they aren't given."""
    for b in batches:
        for i, j in tx.pieces(b.column(1), TOGETHER):
            if runs_column:
                words = [t.split() for t in _texts(b.column(1).slice(i, j - i))]
                rows = [[(r["start"], r["length"], r["period"]) for r in x or []] for x in b.column(2).slice(i, j - i).to_pylist()]
                runs = [smallest_periods(np.array(r, np.int64)) if r else np.zeros((0, 3), np.int64) for r in rows]
            else:
                words, ids = word_ids(_texts(b.column(1).slice(i, j - i)))
                runs = scan(ids)
            out = pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([len(w) for w in words], pa.int64()), _as_list(runs), out], ["doc_id", "n_words", "runs", "collapsed"])
    tx.trim()


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, range, ranges) to (key, runs) of that range of the text's lags."""
    for b in batches:
        for i in range(len(b)):
            r, n = b.column(2)[i].as_py(), b.column(3)[i].as_py()
            runs = scan(word_ids(_texts(b.column(1).slice(i, 1)))[1], (r / n, (r + 1) / n))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), _as_list(runs)], ["key", "runs"])
    tx.trim()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_bytes: int = LONG) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` has (start, length, period) of all periodic runs by start, then period; ``collapsed``
    the text without their repetitions, its words joined by one space. A text of up to
    ``long_bytes`` is done where it lies, without a shuffle; the lags of a longer one are dealt
    over the cluster in ranges, whose runs meet again in its row. A null text is empty and has
    neither words nor runs. Rows keep their ids, nulls and repeats included; an empty table gives
    none; other columns are dropped.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = StructType.fromDDL(f"doc_id {kind}, n_words long, runs array<{_RUN}>, collapsed string")
    size = F.octet_length("text")
    short = rows.where(size <= long_bytes).mapInArrow(lambda it: _done(it, False), out)
    long = rows.where(size > long_bytes).withColumn("key", F.sha2(F.col("text"), 256))
    n = F.least(F.lit(MOST_RANGES), F.ceil(F.octet_length("text") / long_bytes)).cast("int")
    dealt = long.dropDuplicates(["key"]).withColumn("ranges", n).withColumn("range", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)))
    parts = dealt.select("key", "text", "range", "ranges").repartition(F.col("key"), F.col("range")).mapInArrow(_ranges, f"key string, runs array<{_RUN}>")
    whole = parts.groupBy(F.col("key").alias("of")).agg(F.flatten(F.collect_list("runs")).alias("runs"))
    met = long.join(whole, F.col("key") == F.col("of")).select("doc_id", "text", "runs")
    return short.unionByName(met.mapInArrow(lambda it: _done(it, True), out))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length by period; ties go to the smallest start, then period. NULL without runs."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.reduce(F.slice(runs, F.lit(2), F.greatest(F.lit(0), F.size(runs) - 1)), F.get(runs, 0), lambda best, r: F.when(more(r, best), r).otherwise(best))


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (doc_id, text) in which every tenth document, by its id's crc32, repeats a stretch of its words to its end.

    h is the crc32 of the decimal id, g = floor(h / 10). Where h ends in 0, word i >= a = g % n becomes
    word a + (i - a) % p with p = 1 + floor((n - a) / (3 + g % 8)). A null id changes nothing.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def again(w: Column) -> Column:
        n = F.size(w).cast("long")
        return let(F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8)).cast("long")).alias("p")), lambda v: F.array_join(
            F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, F.when(i < v["a"], i).otherwise(v["a"] + (i - v["a"]) % v["p"]).cast("int"))), " "))

    changed = let(words, lambda w: F.when(F.size(w) > 0, again(w)))  # let: the words are made once a row
    return rows.select("doc_id", F.when(h % 10 == 0, F.coalesce(changed, "text")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of what ``periodic_runs`` returns."""
    best = found.withColumn("best", strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
