"""Byte-level BPE: words counted once over the cluster, merges over distinct words, encoding in Arrow batches.

Training needs the distinct words of a bounded sample and their counts, which one job gives.
Merging is sequential by nature; it goes over distinct words in memory, with the pairs' counts
in a heap, and a merge touches only the words that hold its pair, so thousands of merges take
seconds. Ties: the larger count, then the smaller pair.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dealt

Pair = tuple[bytes, bytes]

#: The sample: so many documents in key order, so many characters of each. It bounds the distinct words that are merged in memory.
SAMPLE_DOCS, SAMPLE_CHARS = 15_000, 16_384
PRE_TOKEN = r"(?U) ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: Distinct words whose ids a process remembers.
REMEMBERED = 200_000


def word_counts(docs: DataFrame, order: str, text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """(word, n): pre-tokens of the bounded sample.

    The sample's last key is found among the keys alone, so that of the texts only those up to it leave their tasks, cut to ``sample_chars``.
    """
    there = docs.where(F.col(text).isNotNull())
    last = there.select(F.col(order).alias("k")).orderBy("k").limit(sample_docs).agg(F.max_by("k", F.struct("k"))).first()[0]
    upto = F.lit(False) if last is None else (F.col(order) <= last) | F.col(order).isNull()
    some = there.where(upto).select(order, F.substring(text, 1, sample_chars).alias("t")).orderBy(order).limit(sample_docs)
    return dealt(some.select("t")).select(F.explode(F.regexp_extract_all("t", F.lit(PRE_TOKEN), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def merge_word(parts: list[bytes], pair: Pair) -> list[bytes]:
    """The word's symbols with the pair joined wherever it stands, from the left."""
    out, i = [], 0
    while i < len(parts):
        if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
            out.append(parts[i] + parts[i + 1])
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def merges_of(counts: dict[bytes, int], n_merges: int) -> list[Pair]:
    """The first merges over distinct words with counts.

    All words' symbols lie in one array, each with its neighbours in its word. A merge finds its
    pair by one pass over the array and changes only the places around the hits.
    """
    words = sorted(w for w in counts if len(w) > 1)
    if not words:
        return []
    size = np.array([len(w) for w in words])
    end = np.cumsum(size)
    symbol = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    weight = np.repeat(np.array([counts[w] for w in words], np.int64), size)
    after, before = np.arange(1, len(symbol) + 1), np.arange(-1, len(symbol) - 1)
    after[end - 1], before[end - size] = -1, -1
    names = [bytes([i]) for i in range(256)]
    total: dict[int, int] = {}
    heap: list[tuple[int, bytes, bytes, int]] = []

    def tally(starts: np.ndarray, sign: int) -> set[int]:
        """Count the pairs that begin at some places in or out; the pairs that this changes."""
        starts = np.unique(starts)
        starts = starts[starts >= 0]
        starts = starts[after[starts] >= 0]
        keys, of = np.unique(symbol[starts].astype(np.int64) << 32 | symbol[after[starts]], return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, of, weight[starts])
        for k, n in zip(keys.tolist(), sums.tolist()):
            total[k] = total.get(k, 0) + sign * n
        return set(keys.tolist())

    def push(keys: set[int]) -> None:
        for k in keys:
            if total[k] > 0:
                heapq.heappush(heap, (-total[k], names[k >> 32], names[k & 0xFFFFFFFF], k))
            else:
                del total[k]

    push(tally(np.arange(len(symbol)), 1))
    merges: list[Pair] = []
    while heap and len(merges) < n_merges:
        n, a, b, key = heapq.heappop(heap)
        if total.get(key, 0) != -n:  # its count has changed since; the new one is in the heap as well
            continue
        x, y = key >> 32, key & 0xFFFFFFFF
        at = np.flatnonzero(symbol == x)
        at = at[after[at] >= 0]
        at = at[symbol[after[at]] == y]
        if x == y:  # in a run of one symbol every second place, from the left
            first = np.concatenate(([True], after[at[:-1]] != at[1:]))
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
        gone = after[at]
        changed = tally(np.concatenate((before[at], at, gone)), -1)
        merges.append((a, b))
        names.append(a + b)
        symbol[at], symbol[gone] = len(names) - 1, -1
        follow = after[gone]
        after[at] = follow
        before[follow[follow >= 0]] = at[follow >= 0]
        after[gone] = -1
        push(changed | tally(np.concatenate((before[at], at)), 1))
        if len(merges) % 500 == 0:  # without the places that are gone
            live = np.flatnonzero(symbol >= 0)
            new = np.full(len(symbol) + 1, -1)
            new[live] = np.arange(len(live))
            symbol, weight, after, before = symbol[live], weight[live], new[after[live]], new[before[live]]
    return merges


def train(words: DataFrame, n_merges: int) -> list[Pair]:
    """The first merges of (word, n); symbols start as bytes, so any text is covered."""
    return merges_of({r.word.encode(): r.n for r in words.toLocalIterator()}, n_merges)


def encode(docs: DataFrame, merges: list[Pair], text: str = "text") -> DataFrame:
    """``docs`` with ``ids``: bytes are 0 to 255, the k-th merge is 256 + k. Every distinct word of a process is merged once."""
    shared = docs.sparkSession.sparkContext.broadcast(merges)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import regex

        find = regex.compile(r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+").findall
        ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + k for k, (a, b) in enumerate(shared.value)}
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in shared.value]  # equal strings are one symbol, however joined
        rank = {(a, b): k for k, (a, b, _) in enumerate(merges)}
        none = len(merges)

        def merged(w: str) -> bytes:
            """The word's ids as 32-bit integers; the earliest merge that its symbols allow comes first, wherever it stands, from the left."""
            parts = list(w.encode())
            while len(parts) > 1 and (best := min(map(rank.get, zip(parts, parts[1:]), repeat(none)))) < none:
                a, b, new = merges[best]
                i, end = 0, len(parts) - 1
                while i < end:
                    if parts[i] == a and parts[i + 1] == b:
                        parts[i:i + 2] = [new]
                        end -= 1
                    i += 1
            return np.array(parts, np.int32).tobytes()

        class Known(dict):
            """Words' ids; at most twice REMEMBERED, of which the half not asked for lately goes, so that frequent words stay."""

            older: dict[str, bytes] = {}

            def __missing__(self, w: str) -> bytes:
                if len(self) >= REMEMBERED:
                    self.older = dict(self)
                    self.clear()
                self[w] = found = self.older.get(w) or merged(w)
                return found

        known = Known()
        for s in batches:
            rows = [b"".join(map(known.__getitem__, find(t))) if t else b"" for t in s.to_pylist()]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))

    return docs.withColumn("ids", run(F.col(text)))
