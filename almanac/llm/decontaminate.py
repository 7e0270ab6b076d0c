"""Benchmark decontamination with one FM-index per shard of training text.

A shard is a few megabytes of documents. Its words become numbers, an FM-index over them is
built once and searched backwards for the windows of every block of the benchmark at once,
occurrences are located through sampled suffix positions, and the found spans are merged.

A block is a bounded number of benchmark windows. Blocks are built by a job, one group of
items each; the driver passes them on one by one, and a task has one in memory at a time.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from . import text as tx
from .fmindex import FMIndex
from .shared import cut
from .sizes import fresh

WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Benchmark windows in one block (about 150 bytes each in memory), and bytes of documents in one shard.
BLOCK_WINDOWS, SHARD_BYTES = 50_000, 4 << 20
#: Blocks that are broadcast at a time (about 250 MB).
MOST_BLOCKS = 32


@dataclass
class Phrases:
    """Windows of a block of benchmark items: distinct words (hashes, sorted), distinct windows as places in them, and the items of each."""

    words: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    items_at: np.ndarray
    items: np.ndarray
    names: list[str]


def phrases(ids: list[str], texts: pa.Array, window: int = WINDOW) -> Phrases:
    data, at = tx.raw(texts)
    data = tx.lower(data)
    starts, ends, first = tx.words(data, at, tx.PUNCT)
    words, place = np.unique(tx.word_hashes(data, starts, ends), return_inverse=True)
    place = place.astype(np.int32)
    names = sorted(set(ids))
    number = {x: k for k, x in enumerate(names)}
    found: dict[bytes, set[int]] = {}
    for k, name in enumerate(ids):
        s = place[first[k] : first[k + 1]]
        for i in range(len(s) - window + 1 if len(s) >= window else len(s) > 0):
            found.setdefault(s[i : i + window].tobytes(), set()).add(number[name])
    patterns, lengths = np.zeros((len(found), window), np.int32), np.zeros(len(found), np.int64)
    for r, b in enumerate(found):
        s = np.frombuffer(b, np.int32)
        patterns[r, window - len(s) :], lengths[r] = s, len(s)
    counts = [len(x) for x in found.values()]
    return Phrases(words, patterns, lengths, np.concatenate(([0], np.cumsum(counts))).astype(np.int64), np.array([i for x in found.values() for i in sorted(x)], np.int64), names)


class Shard:
    """The words of some documents and the FM-index over them.

    ``known`` (sorted hashes), if given, are the only words that are searched for: all others are one
    separator, and a run of it one symbol.
    """

    def __init__(self, column: pa.Array, known: np.ndarray | None = None, sample: int = 16):
        data, at = tx.raw(column)
        low = tx.lower(data)
        self.begin, self.end, self.first = tx.words(low, at, tx.PUNCT)
        n = len(self.begin)
        self.hit = np.zeros(n, bool)
        h = tx.word_hashes(low, self.begin, self.end)
        if known is None:
            self.words, number = np.unique(h, return_inverse=True)
            seq = number + 2
        else:
            self.words = known
            k = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            seq = np.where(known[k] == h, k + 2, 1) if len(known) else np.ones(n, np.int64)
        # 1 stands before every text and for words that no window has
        seq, self.word = np.insert(seq, self.first[:-1], 1), np.insert(np.arange(n), self.first[:-1], -1)
        keep = seq != 1
        keep[1:] |= seq[:-1] != 1
        keep[:1] = True
        self.word = self.word[keep]
        self.index = FMIndex(seq[keep], sample) if n else None

    def search(self, ph: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Mark the words that windows of ``ph`` cover; (documents, items) that meet."""
        none = np.zeros(0, np.int64)
        if self.index is None or not len(ph.lengths) or not len(self.words):
            return none, none
        k = np.minimum(np.searchsorted(self.words, ph.words), len(self.words) - 1)
        symbol = np.where(self.words[k] == ph.words, k + 2, 0)
        width = ph.patterns.shape[1]
        pad = np.arange(width) < width - ph.lengths[:, None]
        may = np.flatnonzero(((symbol[ph.patterns] > 0) | pad).all(1))  # windows whose words all occur here
        lo, hi = self.index.search(symbol[ph.patterns[may]], ph.lengths[may])
        found = np.flatnonzero(lo < hi)
        size = (hi - lo)[found]
        pattern = np.repeat(may[found], size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - lo[found], size)
        where = self.word[self.index.locate(place)]
        mark = np.zeros(len(self.hit) + 1, np.int64)
        np.add.at(mark, where, 1)
        np.add.at(mark, where + ph.lengths[pattern], -1)
        self.hit |= np.cumsum(mark)[:-1] > 0
        doc = np.searchsorted(self.first, where, "right") - 1
        pair = np.unique(doc * len(ph.lengths) + pattern)
        doc, pattern = pair // len(ph.lengths), pair % len(ph.lengths)
        n_items = (ph.items_at[1:] - ph.items_at[:-1])[pattern]
        item = ph.items[np.arange(n_items.sum()) - np.repeat(np.cumsum(n_items) - n_items - ph.items_at[pattern], n_items)]
        met = np.unique(np.repeat(doc, n_items) * len(ph.names) + item)
        return met // len(ph.names), met % len(ph.names)


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_windows: int) -> Iterator[Phrases]:
    """The benchmark in blocks of about ``block_windows`` windows (an item is never split), one after another."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = max(1, math.ceil((rows.agg(F.sum(F.size(F.split("text", SEPARATORS)))).first()[0] or 0) / block_windows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int"))

    def build(t: pa.Table) -> pa.Table:
        t = t.group_by(["id", "text"]).aggregate([]).sort_by([("id", "ascending"), ("text", "ascending")])  # repeated items count once
        made = phrases(t.column("id").to_pylist(), tx.plain(t.column("text")), window)
        return pa.table({"phrases": pa.array([pickle.dumps(made, 5)], pa.binary())})

    for row in dealt.groupBy("block").applyInArrow(build, "phrases binary").toLocalIterator():
        yield pickle.loads(row.phrases)


def _search(docs: DataFrame, benchmark: DataFrame, schema: str, make: Callable, item_col: str = "item_id", bench_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``make(batch, column, first, begin, end, hit, items of each document)`` over shards; the last column of docs is the text.

    At most ``most_blocks`` blocks are broadcast at a time. A benchmark of more is searched for in
    several passes, between which every document's hits and items are kept by a checkpoint beside it.
    """
    sc, text = docs.sparkSession.sparkContext, docs.schema.fields[-1]
    hit_name, met_name = fresh(docs, "_hit"), fresh(docs, "_met")
    beside = StructType([*docs.schema.fields[:-1], StructField(hit_name, BinaryType()), StructField(met_name, ArrayType(StringType())), text])

    def searched(blocks: list, before: bool, only: bool, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, j in tx.pieces(b.column(b.num_columns - 1), SHARD_BYTES):
                    part = b.slice(i, j - i)
                    column = tx.plain(part.column(b.num_columns - 1))
                    shard = Shard(column, blocks[0].value.words if only else None)
                    items: list[set[str]] = [set() for _ in range(len(column))]
                    if before:
                        for d, bits in enumerate(part.column(b.num_columns - 3)):
                            n = shard.first[d + 1] - shard.first[d]
                            shard.hit[shard.first[d] : shard.first[d + 1]] = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=n).astype(bool)
                        items = [set(x) for x in part.column(b.num_columns - 2).to_pylist()]
                        part = part.drop_columns([hit_name, met_name])
                    for block in blocks:
                        ph = block.value
                        for d, x in zip(*(y.tolist() for y in shard.search(ph)), strict=True):
                            items[d].add(ph.names[x])
                        if not only:
                            block.__dict__.pop("_value", None)  # read again from the executor's disk for the next shard
                    if last:
                        yield make(part, column, shard.first, shard.begin, shard.end, shard.hit, items)
                    else:
                        bits = [np.packbits(shard.hit[lo:hi]).tobytes() for lo, hi in zip(shard.first[:-1], shard.first[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(bits, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string())), part.columns[-1]], beside.names)
            tx.trim()

        return run

    found = blocks_of(benchmark, item_col, bench_text, window, block_windows)
    group, first = list(islice(found, most_blocks)), True
    while following := list(islice(found, most_blocks)):
        shared = [sc.broadcast(x) for x in group]
        docs = cut(docs.mapInArrow(searched(shared, not first, False, False), beside))
        for x in shared:
            x.unpersist()
        group, first = following, False
    return docs.mapInArrow(searched([sc.broadcast(x) for x in group], not first, first and len(group) == 1, True), schema)


def digest(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **opts) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row.

    A null text has no words; a benchmark item without words has no window and a null item id
    is the empty string. Repeated items count once. Repeated rows and null ids stay. A very long
    text is a shard of its own. An empty table gives no rows, an empty benchmark no hits; other
    columns are dropped.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def make(part, column, first, begin, end, hit, items):
        n, k = np.diff(first), np.diff(np.concatenate(([0], np.cumsum(hit)))[first])
        shas = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(k), pa.array([len(x) for x in items], pa.int64()), pa.array(shas), pa.array((k > 0) & (20 * k >= n))], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return _search(rows, benchmark, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean", make, **opts)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **opts) -> DataFrame:
    """``docs`` without contaminated rows; from the others the hit spans are cut (n_chars follows, where it exists).

    Null and empty texts have no words and stay, as do null ids and repeated rows, each judged on
    its own text. A very long text is a shard of its own. An empty table gives none, an empty
    benchmark leaves all; other columns stay as they are, whatever their names.
    """
    cols = docs.columns
    other = [c for c in cols if c != text_col]
    rows = docs.select(*other, text_col)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in [*other, text_col])

    def make(part, column, first, begin, end, hit, items):
        data, at = tx.raw(column)
        texts, keep = part.column(len(other)).to_pylist(), []
        for d in range(len(column)):
            lo, hi = first[d], first[d + 1]
            k = int(hit[lo:hi].sum())
            keep.append(not (k and 20 * k >= hi - lo))
            if k and keep[-1]:
                bytes_kept = np.ones(at[d + 1] - at[d], bool)
                for s, e in zip(*tx.runs(hit[lo:hi]), strict=True):
                    bytes_kept[begin[lo + s] - at[d] : end[lo + e - 1] - at[d]] = False
                texts[d] = data[at[d] : at[d + 1]][bytes_kept].tobytes().decode()
        return pa.RecordBatch.from_arrays([*part.columns[: len(other)], pa.array(texts, pa.string())], [*other, text_col]).filter(pa.array(keep))

    out = _search(rows, benchmark, schema, make, **opts).select(*cols)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in cols else out
