"""Vectors as four bytes: a codebook for each of four parts, entries found through a ball tree.

Components are integers, so every distance, sum and mean is exact and the same on every cluster.
An entry's search is metric branch and bound: a ball's entries lie no nearer than the distance to
its centre less its radius. Radii are rounded up and distances down, balls whose bound equals the best
distance so far are visited too, and entries are compared by their integer squared distance and
index, so the result is the nearest entry with the smallest index, always.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import cut

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of a ball that isn't divided any more, and vectors that go through a tree together.
LEAF, TOGETHER = 64, 8192
#: What the rounding of a squared bound may come to, as a share of it.
SLACK = 1e-12
#: Labels whose error sums are broadcast; more of them meet their rows in a shuffle.
BROADCAST_LABELS = 200_000


@dataclass
class Ball:
    """Entries (indexes) within a radius, rounded up, of a centre; two smaller balls, or none."""

    centre: np.ndarray
    radius: float
    entries: np.ndarray
    inner: tuple[Ball, Ball] | None


def ball(book: np.ndarray, entries: np.ndarray) -> Ball:
    """A tree over some of a codebook's entries: divided by the nearer of two entries that lie far apart."""
    some = book[entries]
    centre = some.sum(0) // len(some)
    away = ((some - centre) ** 2).sum(1)
    radius = math.isqrt(int(away.max())) + 1.0
    if len(entries) <= LEAF or not away.max():
        return Ball(centre, radius, entries, None)
    a = some[int(away.argmax())]
    to_a = ((some - a) ** 2).sum(1)
    b = some[int(to_a.argmax())]
    left = to_a <= ((some - b) ** 2).sum(1)
    return Ball(centre, radius, entries, (ball(book, entries[left]), ball(book, entries[~left])))


def largest_distance(*blocks: np.ndarray) -> int:
    """What squared distances of integer vectors stay below; an error where that is beyond 64-bit integers."""
    most = max((int(np.abs(b).max()) for b in blocks if b.size), default=0)
    width = max((b.shape[-1] for b in blocks), default=1)
    if (bound := width * (2 * most + 1) ** 2) >= 1 << 62:
        raise ValueError(f"components of up to {most} in parts of {width} have squared distances beyond 2^62")
    return bound


class Nearest:
    """The nearest entries of one part's codebook."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.real = book.astype(float)
        self.squares = (book * book).sum(1).astype(float)
        self.top = ball(book, np.arange(len(book)))
        #: entries looked at, for a figure of what the bounds save
        self.compared = 0

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) for each row of integers."""
        real = x.astype(float)
        # doubles hold integers below 2^53 exactly; larger ones are multiplied as integers
        small = largest_distance(x, self.book) < 1 << 53
        best, at = np.full(len(x), np.inf if small else np.iinfo(np.int64).max, float if small else np.int64), np.full(len(x), len(self.book))
        self._visit(self.top, None if small else x, real, (real * real).sum(1), np.arange(len(x)), best, at)
        return at, best.astype(np.int64)

    def _visit(self, b: Ball, x: np.ndarray | None, real: np.ndarray, squares: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        """Look for nearer entries of a ball for some rows; ``x`` are their integers where doubles aren't exact."""
        mine = real[rows]
        if b.inner is None:
            e = b.entries
            self.compared += len(rows) * len(e)
            if x is None:
                d = mine @ (-2.0 * self.real[e].T)
                d += self.squares[e]
                d += squares[rows, None]
            else:
                d = np.stack([((x[rows] - self.book[k]) ** 2).sum(1) for k in e], 1)
            k = d.argmin(1)  # entries ascend, so a tie gives the smaller index
            least, who, before = d[np.arange(len(rows)), k], e[k], best[rows]
            better = (least < before) | ((least == before) & (who < at[rows]))
            best[rows[better]], at[rows[better]] = least[better], who[better]
            return
        # distances rounded down less radii rounded up; what rounding does to large squares is far below the 1 taken off
        near = [np.floor(np.sqrt(((mine - c.centre) ** 2).sum(1))) - 1 - c.radius for c in b.inner]
        first = near[0] <= near[1]
        for turn in (True, False):
            for c, bound, own in zip(b.inner, near, (first == turn, first != turn), strict=True):
                r, bound = rows[own], bound[own]
                if len(r):
                    open_ = (bound <= 0) | (bound * bound * (1 - SLACK) <= best[r])
                    if open_.any():
                        self._visit(c, x, real, squares, r[open_], best, at)


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(1024 x) of a batch of vectors of one width."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(flat * SCALE).reshape(-1, width).astype(np.int64)


def _books(codebooks: list[np.ndarray]) -> list[Nearest]:
    return [Nearest(b) for b in codebooks]


def _coded(books: list[Nearest], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes by part, summed squared distances) of integer vectors."""
    found = [b.find(p) for b, p in zip(books, np.split(x, len(books), 1), strict=True)]
    return np.stack([f[0] for f in found], 1), sum(f[1] for f in found)


def _batches(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(0, len(b), TOGETHER):
            part = b.slice(i, TOGETHER)
            yield part, integers(part.column(column), width)


def kept_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """(vec_id, v, label) of the rows whose vector has components and all of them are finite numbers."""
    v = vectors[vector_col]
    # multiplied by zero only finite numbers give zero; NULL and NaN don't
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = vectors[label_col] if label_col else F.lit(None).cast("int")
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & fine).select(vectors[id_col].alias("vec_id"), v.cast("array<double>").alias("v"), label.alias("label"))


def first_books(rows: DataFrame) -> tuple[list[np.ndarray], int]:
    """(the codebooks that the vectors of the smallest ids are, their width): at most ``ENTRIES`` rows reach the driver."""
    some = [r.v for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).select("v").collect()]
    if not some:
        return [], 0
    width = len(some[0])
    if width % PARTS or any(len(v) != width for v in some):
        raise ValueError(f"vectors of {sorted({len(v) for v in some})} components, not of one multiple of {PARTS}")
    return np.split(np.floor(np.array(some, float) * SCALE).astype(np.int64), PARTS, 1), width


def refined(rows: DataFrame, codebooks: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round. A task sums up its vectors by entry; tasks' sums meet by part and entry."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(shared.value)
        total = np.zeros((PARTS, len(books[0].book), width // PARTS), np.int64)
        n = np.zeros(total.shape[:2], np.int64)
        for _, x in _batches(batches, 0, width):
            at, _ = _coded(books, x)
            for p, part in enumerate(np.split(x, PARTS, 1)):
                np.add.at(total[p], at[:, p], part)
                n[p] += np.bincount(at[:, p], minlength=n.shape[1])
        used = np.argwhere(n > 0)
        yield pa.RecordBatch.from_arrays([pa.array(used[:, 0] * n.shape[1] + used[:, 1]), pa.array([n[p, e] for p, e in used]), pa.array([total[p, e].tolist() for p, e in used], pa.list_(pa.int64()))], ["slot", "n", "total"])
        tx.trim()

    each = rows.select("v").mapInArrow(sums, "slot long, n long, total array<long>")
    met = each.select("slot", "n", F.posexplode("total").alias("i", "x")).groupBy("slot", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    new = [b.copy() for b in codebooks]  # entries without vectors stay
    for r in met.collect():  # at most parts x entries x components rows
        p, e = divmod(r.slot, len(new[0]))
        new[p][e, r.i] = int(r.x) // r.n
    shared.unpersist()
    return new


def train(rows: DataFrame, rounds: int = ROUNDS) -> tuple[list[np.ndarray], int]:
    """(codebooks, width of the vectors) from the smallest ids' vectors on."""
    books, width = first_books(rows)
    for _ in range(rounds if books else 0):
        books = refined(rows, books, width)
    return books, width


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", rounds: int = ROUNDS, broadcast_labels: int = BROADCAST_LABELS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, code, error, label_error) for every kept row, the codebooks).

    Rows whose vector is null, empty, or holds a null, NaN or infinite component are dropped; all
    others stay, repeats and null ids included. ``code`` has two hex digits a part, ``error`` is the
    squared distance to what the code stands for and ``label_error`` its sum over the label (nulls
    are one label). Fewer vectors than entries make smaller codebooks; an empty table gives no rows
    and no codebooks. Vectors must have one size, a multiple of the number of parts, and components
    whose squared distances fit into 64-bit integers (below 2^62); others are an error.
    """
    rows = kept_rows(vectors, id_col, vector_col, label_col)
    books, width = train(rows, rounds)
    kind, label = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    if not books:
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long"), books
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _books(shared.value)
        for part, x in _batches(batches, 1, width):
            at, error = _coded(trees, x)
            codes = ["".join(f"{k:02x}" for k in row) for row in at.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(codes), pa.array(error)], ["vec_id", "label", "code", "error"])
        tx.trim()

    one_size = F.when(F.size("v") == width, F.col("v")).otherwise(F.raise_error(F.lit(f"a vector that hasn't {width} components")).cast("array<double>"))
    codes = cut(rows.select("vec_id", one_size.alias("v"), "label").mapInArrow(coded, f"vec_id {kind}, label {label}, code string, error long"))
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    few = totals.limit(broadcast_labels + 1).count() <= broadcast_labels
    met = codes.join(F.broadcast(totals) if few else totals, F.col("label").eqNullSafe(F.col("of")))
    return met.select("vec_id", "code", "error", "label_error"), books


def fingerprint(books: list[np.ndarray]) -> str:
    """The sha256 of all components in decimal by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def digest(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256)."""
    found, books = compress(vectors)
    return found.withColumn("codebooks_sha256", F.lit(fingerprint(books)))
