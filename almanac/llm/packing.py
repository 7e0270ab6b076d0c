"""Packing along a space-filling curve.

Every document becomes token ids and a hashed vector: each id has a fixed random direction,
and a document's vector is the mean of its ids' directions, so the projection to a few
dimensions is one table look-up. The Hilbert key of the quantised vector orders documents so
that neighbours are alike; they are range-partitioned and sorted by it, and each partition is
cut into sequences of the full length. What is left at the end of a partition is cut into
sequences whose lengths are powers of two, so nothing is padded.

Texts are encoded once and kept by a checkpoint. Ranges come from exact token counts: those
of all cells of the curve give each cell its share of partitions, and a cell of many tokens,
such as a great group of equal documents, is cut evenly by a hash within it.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import text as tx
from . import vocab
from .shared import cut
from .sizes import buckets

LENGTH, END_ID = 4096, 2
DIMS, BITS = 3, 10
#: Bits of a document's tie, which spreads equal documents, and of the cells whose tokens are counted: at most 2 ** CELL_BITS rows.
TIE_BITS, CELL_BITS = 33, 18
#: Stored bytes of documents in one partition.
PARTITION_BYTES = 32 << 20
#: Distinct words whose ids a process remembers, about 40 bytes each; beyond, it starts anew.
REMEMBERED = 1_500_000
_CHECK = np.uint64(0xD6E8FEB86659FD93)


class Encoder:
    """Ids of texts as the library gives them, word by word: no token crosses white space, so each distinct word is encoded once.

    Known words are a sorted array of 64-bit hashes (with a second hash as a check) beside their
    ids in one pool, so a batch of texts is encoded by sorts, searches and gathers.
    """

    def __init__(self, file: str):
        self.tok = vocab.library(file)
        size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        directions = tx.mix(np.arange(1, size * DIMS + 1, dtype=np.uint64)).reshape(size, DIMS)
        self.directions = (directions / 2.0**63 - 1).astype(np.float32)
        self._clear()

    def _clear(self) -> None:
        self.hash = self.check = np.zeros(0, np.uint64)
        self.at = self.n = np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _learn(self, words: list[bytes], h: np.ndarray, check: np.ndarray) -> None:
        """Encode new words as one text, word by word apart through the tokens' offsets, and remember them."""
        texts = [w.decode() for w in words]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        got = self.tok.encode(" ".join(texts), add_special_tokens=False)
        owner = np.searchsorted(begins, np.fromiter((o[0] for o in got.offsets), np.int64, len(got)), "right") - 1
        if self.used + len(owner) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.used], np.zeros(max(len(self.pool), len(owner)), self.dtype)))
        self.pool[self.used : self.used + len(owner)] = got.ids
        n = np.bincount(owner, minlength=len(words))
        at = self.used + np.cumsum(n) - n
        self.used += len(owner)
        place = np.searchsorted(self.hash, h)
        self.hash, self.check, self.at, self.n = (np.insert(x, place, y) for x, y in ((self.hash, h), (self.check, check), (self.at, at), (self.n, n)))

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end id; where each text begins, one more entry than texts)."""
        data, off = tx.raw(column)
        begin, end, first = tx.words(data, off, tx.WS)
        h = tx.word_hashes(data, begin, end)
        order = np.argsort(h)
        sorted_h = h[order]
        new = np.concatenate(([True], sorted_h[1:] != sorted_h[:-1])) if len(h) else np.zeros(0, bool)
        rep, uniq = order[new], sorted_h[new]
        check = tx.word_hashes(data, begin[rep], end[rep], tx.mix(tx.BYTE ^ _CHECK))
        if len(self.hash) > REMEMBERED:
            self._clear()
        place = np.minimum(np.searchsorted(self.hash, uniq), max(len(self.hash) - 1, 0))
        known = (self.hash[place] == uniq) & (self.check[place] == check) if len(self.hash) else np.zeros(len(uniq), bool)
        if not known.all():
            if len(self.hash) and ((self.hash[place] == uniq) & ~known).any():  # two words of one hash: forget the other
                self._clear()
                known[:] = False
            raw = data.tobytes()
            self._learn([raw[s:e] for s, e in zip(begin[rep[~known]].tolist(), end[rep[~known]].tolist(), strict=True)], uniq[~known], check[~known])
            place = np.searchsorted(self.hash, uniq)
        word = np.empty(len(h), np.int64)
        word[order] = place[np.cumsum(new) - 1]
        # every text ends with one id more: a word of its own, kept at the end of the pool
        if self.used == len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), self.dtype)))
        self.pool[self.used] = end_id
        n = np.insert(self.n[word], first[1:], 1)
        at = np.insert(self.at[word], first[1:], self.used)
        stop = np.cumsum(n)
        ids = self.pool[np.arange(stop[-1] if len(stop) else 0) + np.repeat(at - (stop - n), n)]
        return ids, np.concatenate(([0], stop))[first + np.arange(len(first))]

    def vectors(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean direction of each document's ids (documents begin at ``first`` and none is empty)."""
        total = np.stack([np.add.reduceat(self.directions[:, k][ids], first) for k in range(DIMS)], axis=1)
        return total / np.diff(np.append(first, len(ids)))[:, None]


@functools.lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of each row of non-negative integers below 2**bits (Skilling's transposed form)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            hit = (x[i] & q) > 0
            t = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, t)
            x[i] ^= t if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(vectors: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Sort keys: the Hilbert position above 33 bits of the tie, so that equal documents spread over a range too."""
    cells = np.clip(((np.tanh(4 * vectors) + 1) * (1 << (BITS - 1))).astype(np.int64), 0, (1 << BITS) - 1)
    return (hilbert(cells) << TIE_BITS) | (tie.view(np.uint64) >> np.uint64(64 - TIE_BITS)).astype(np.int64)


def encoded(docs: DataFrame, file: str, end_id: int = END_ID) -> DataFrame:
    """(sort_key, doc_id, n_tokens, ids) of rows (doc_id, text, tie)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(file)
        for b in batches:
            column = tx.plain(b.column(1))
            for i, j in tx.pieces(column, 2 << 20):
                ids, first = enc.encode(column.slice(i, j - i), end_id)
                key = curve_keys(enc.vectors(ids, first[:-1]), b.column(2).slice(i, j - i).to_numpy(zero_copy_only=False))
                size = enc.dtype.itemsize
                if first[-1] * size >= 1 << 31:
                    raise ValueError("a text of 2 GB of token ids or more")
                blobs = pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * size).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(key), b.column(0).slice(i, j - i), pa.array(np.diff(first)), blobs], ["sort_key", "doc_id", "n_tokens", "ids"])
        b = column = ids = first = key = blobs = None  # nothing of the last batch outlives the task
        tx.trim()

    return docs.mapInArrow(run, f"sort_key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def dealt(rows: DataFrame, n_parts: int) -> DataFrame:
    """``rows`` (sort_key, n_tokens, ...) with ``part``: ranges of the curve's cells with about equal tokens, whatever the skew.

    A cell's rows are spread by their ties over the parts that its tokens fill. The table of
    cells has at most 2 ** CELL_BITS small rows, so it is broadcast.
    """
    cell = F.shiftrightunsigned("sort_key", 63 - CELL_BITS)
    counts = rows.groupBy(cell.alias("cell")).agg(F.sum("n_tokens").cast("double").alias("here"))
    ahead = Window.partitionBy(F.lit(1)).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("cell", "here", F.coalesce(F.sum("here").over(ahead), F.lit(0.0)).alias("ahead"), F.sum("here").over(Window.partitionBy(F.lit(1))).alias("all"))
    tie = F.col("sort_key").bitwiseAND(F.lit((1 << TIE_BITS) - 1)) / float(1 << TIE_BITS)
    part = F.floor((F.col("ahead") + tie * F.col("here")) / F.col("all") * n_parts)
    return rows.withColumn("cell", cell).join(F.broadcast(cells), "cell").withColumn("part", F.least(part, F.lit(n_parts - 1)).cast("int")).drop("cell", "here", "ahead", "all")


class Packer:
    """Cuts the stream of one partition's ids into sequences; keeps back what doesn't fill one."""

    def __init__(self, part: int, length: int):
        self.part, self.length, self.seq = part, length, 0
        self.held: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the unfinished sequence
        self.held_n = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, (self.part << 32) | self.seq, at))
            at += len(ids)
        self.seq += 1

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            n = min(self.length - self.held_n, len(ids) - start)
            self.held.append((doc, start, ids[start : start + n], len(ids)))
            self.held_n += n
            start += n
            if self.held_n == self.length:
                self._emit(self.held)
                self.held, self.held_n = [], 0

    def finish(self) -> None:
        """The rest as sequences of powers of two, the largest first."""
        while self.held_n:
            want = 1 << (self.held_n.bit_length() - 1)
            now, left = [], want
            while left:
                doc, start, ids, total = self.held.pop(0)
                if len(ids) > left:
                    self.held.insert(0, (doc, start + left, ids[left:], total))
                    ids = ids[:left]
                now.append((doc, start, ids, total))
                left -= len(ids)
            self._emit(now)
            self.held_n -= want


def pack(docs: DataFrame, file: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all rows: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A null text is empty and still has its end id. Null ids and repeated rows are packed like any
    other row; ties in the order are broken by the id. A very long text is cut over many
    sequences. An empty table gives no rows; other columns are dropped.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), F.xxhash64(docs[id_col].cast("string"), F.xxhash64(docs[text_col].cast("string"))).alias("tie"))
    n_parts = buckets(docs, PARTITION_BYTES)
    placed = dealt(cut(encoded(rows, file, end_id)), n_parts).select("part", "sort_key", "doc_id", "ids").repartitionById(n_parts, F.col("part")).sortWithinPartitions("part", "sort_key", "doc_id")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, packer = encoder(file).dtype, None
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def out(rows: list[tuple], kind) -> pa.RecordBatch:
            c = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c[0], kind), *(pa.array(x, pa.int64()) for x in c[1:])], names)

        kind = None
        for b in batches:
            kind = b.schema.field("doc_id").type
            for part, doc, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if packer is None or packer.part != part:
                    if packer:
                        packer.finish()
                        if packer.rows:
                            yield out(packer.rows, kind)
                    packer = Packer(part, length)
                packer.add(doc, np.frombuffer(ids.as_buffer(), dtype))
            packer.held = [(d, s, x.copy(), t) for d, s, x, t in packer.held]
            if packer.rows:
                yield out(packer.rows, kind)
                packer.rows = []
        if packer:
            packer.finish()
            if packer.rows:
                yield out(packer.rows, kind)
        b = packer = None
        tx.trim()

    return placed.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
