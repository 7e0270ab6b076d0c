"""A hidden Markov language model over all documents.

A hidden state emits a word class, and the class emits a word. A word's class is a fixed hash
of its last bytes, so transition and emission tables have a bounded size; words within a class
follow the corpus counts, which grow with the input. With c, N_g and V_g a word's count, its
class's training tokens and its class's distinct training words:

    P(text) = sum over state paths of prod A(s, s') * E(s', class(w)) * (c(w) + 1) / (N_g + V_g + 1)

so every class keeps one share for the words that training never saw. A text's last token is
its end, a class of its own.

Training: Baum-Welch over all training documents, round after round until a round gains less
than ``GAIN`` per token, ``MOST_ROUNDS`` at most. Texts are read once, into class sequences and
local word counts that are kept by a checkpoint. Each partition sums the expected counts of its documents; the sums meet in a tree of blocks of classes and only the bounded
tables reach the driver. The first round starts from the classes' shares with fixed noise.

Word counts: all training words are counted in parts by a hash of the word, first in each piece
of text, then over all; the classes' totals are summed from them and broadcast (they are bounded). Scoring: documents are dealt into
buckets; a bucket asks each part for its distinct words' counts, once each, and is scored with
the replies by the scaled forward recursion. Empty asks aren't sent, so there are never more
rows than pairs of a bucket and a distinct word in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import cut
from .sizes import buckets, partitions

STATES, CLASSES, SUFFIX = 12, 8192, 4
#: Rounds over all documents at most, and the gain in log likelihood per token under which they end.
MOST_ROUNDS, GAIN = 12, 0.03
#: Strength of the prior in emissions and transitions.
PRIOR_E, PRIOR_A = 20.0, 0.5
BUCKET_BYTES = 8 << 20
#: Stored bytes of documents for which one part of the word counts is made.
PART_BYTES = 32 << 20
#: Tokens whose state probabilities are held at once.
TOKENS_AT_ONCE = 500_000
#: Tokens beyond which a text waits for others of its kind.
LONG = 2048
#: Classes whose expected counts are summed in one task, and partitions' sums that meet in one.
CLASS_BLOCK, FAN_IN = 1024, 256
_END_HASH = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # states x classes


@dataclass
class Trained:
    """What training gives: the hidden Markov model, the training words (part, words, classes, counts), and each class's tokens and distinct words."""

    model: Model
    words: DataFrame
    parts: int
    class_tokens: np.ndarray
    class_words: np.ndarray


def classes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, n_classes: int) -> np.ndarray:
    """The class of each word, 1 .. n_classes - 1, from its last bytes; class 0 is the end of a text."""
    key = np.zeros(len(begin), np.uint64)
    for k in range(1, SUFFIX + 1):
        at = end - k
        key = key << np.uint64(8) | np.where(at >= begin, data[np.maximum(at, 0)], 0).astype(np.uint64)
    return (tx.mix(key + np.uint64(1)) % np.uint64(n_classes - 1)).astype(np.int64) + 1


def tokens(column: pa.Array, n_classes: int, hashed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(where each text's tokens begin, one entry more; classes; hashes if wanted) with an end after each text's words."""
    data, at = tx.raw(column)
    data = tx.lower(data)
    begin, end, first = tx.words(data, at, tx.WS)
    cls = np.insert(classes(data, begin, end, n_classes), first[1:], 0)
    h = np.insert(tx.word_hashes(data, begin, end), first[1:], _END_HASH) if hashed else None
    return first + np.arange(len(first)), cls, h


def _chunks(lengths: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Texts by falling length, in groups of about ``most`` tokens."""
    order = np.argsort(-lengths, kind="stable")
    total, i = np.cumsum(lengths[order]), 0
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most, "right")))
        yield order[i:j]
        i = j


class Steps:
    """A group of texts, longest first, in the order of time: at every step the texts that still run lie next to one another."""

    def __init__(self, cls: np.ndarray, begin: np.ndarray, lengths: np.ndarray):
        n = len(lengths)
        self.live = n - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
        self.off = np.concatenate(([0], np.cumsum(self.live)))
        stop = np.cumsum(lengths)
        t = np.arange(stop[-1]) - np.repeat(stop - lengths, lengths)
        self.text = np.empty(stop[-1], np.int32)
        self.cls = np.empty(stop[-1], cls.dtype)
        of = np.repeat(np.arange(n), lengths)
        place = self.off[t] + of
        self.text[place] = of
        self.cls[place] = cls[np.repeat(begin, lengths) + t]

    def forward(self, m: Model, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scaled state probabilities, scales) of every token."""
        a, scale, step = np.empty_like(emitted), np.empty(len(emitted), emitted.dtype), m.step.astype(emitted.dtype)
        np.multiply(m.start.astype(emitted.dtype), emitted[: self.live[0]], out=a[: self.live[0]])
        bounds = list(zip(self.off[:-1].tolist(), self.live.tolist(), strict=True))
        before, ones = 0, np.ones(emitted.shape[1], emitted.dtype)
        for lo, d in bounds:
            x = a[lo : lo + d]
            if lo:
                np.matmul(a[before : before + d], step, out=x)
                x *= emitted[lo : lo + d]
            c = x @ ones
            scale[lo : lo + d] = c
            x /= c[:, None]
            before = lo
        return a, scale

    def backward(self, m: Model, weighted: np.ndarray) -> np.ndarray:
        """The scaled backward probabilities of every token; ``weighted``, emissions over scales, is multiplied by them."""
        b, back = np.ones_like(weighted), np.ascontiguousarray(m.step.T.astype(weighted.dtype))
        bounds = list(zip(self.off[:-1].tolist(), self.live.tolist(), strict=True))
        for (lo, _), (nlo, nd) in zip(bounds[-2::-1], bounds[:0:-1], strict=True):
            x = weighted[nlo : nlo + nd]
            x *= b[nlo : nlo + nd]
            np.matmul(x, back, out=b[lo : lo + nd])
        return b


def forward(cls: np.ndarray, begin: np.ndarray, lengths: np.ndarray, m: Model) -> np.ndarray:
    """The log likelihood of each text's classes: the scaled forward recursion, all texts of a group at once."""
    out = np.zeros(len(begin))
    emit = np.ascontiguousarray(m.emit.T)
    for group in _chunks(lengths, TOKENS_AT_ONCE):
        steps = Steps(cls, begin[group], lengths[group])
        _, scale = steps.forward(m, emit[steps.cls])
        out[group] = np.bincount(steps.text, np.log(scale), len(group))
    return out


class Counts:
    """Expected counts of starts, steps and emissions, and the log likelihood they come from."""

    def __init__(self, states: int, n_classes: int):
        self.start, self.step, self.emit = np.zeros(states), np.zeros((states, states)), np.zeros((states, n_classes))
        self.log = self.n = 0.0

    def add(self, cls: np.ndarray, begin: np.ndarray, lengths: np.ndarray, m: Model) -> None:
        """Scaled forward and backward recursions over whole texts."""
        states, n_classes = m.emit.shape
        emit = np.ascontiguousarray(m.emit.T.astype(np.float32))
        for group in _chunks(lengths, TOKENS_AT_ONCE):
            steps = Steps(cls, begin[group], lengths[group])
            weighted = emit[steps.cls]
            a, scale = steps.forward(m, weighted)
            self.log += float(np.log(scale, dtype=np.float64).sum())
            weighted /= scale[:, None]
            b = steps.backward(m, weighted)
            first = steps.live[0]
            if len(a) > first:  # each token but the first ones with the one before it in its text
                before = np.arange(first, len(a)) - np.repeat(steps.live[:-1], steps.live[1:])
                self.step += (a[before].T @ weighted[first:]) * m.step
            a *= b
            self.start += a[:first].sum(0)
            of, by_state = steps.cls.astype(np.int64), np.ascontiguousarray(a.T).astype(np.float64)
            for k in range(states):
                self.emit[k] += np.bincount(of, weights=by_state[k], minlength=n_classes)
            self.n += len(a)

    def model(self) -> Model:
        """The maximum with priors: emissions lean to the classes' shares, transitions to the states' own shares."""
        states, n_classes = self.emit.shape
        share = (self.emit.sum(0) + 1) / (self.emit.sum() + n_classes)
        emit = self.emit + PRIOR_E * share
        step, start = self.step + PRIOR_A, self.start + PRIOR_A
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def first_model(shares: np.ndarray, states: int) -> Model:
    """Where training begins: states that like to stay and emit the classes' shares, told apart by fixed noise."""
    n_classes = len(shares)
    noise = tx.mix(np.arange(1, states * n_classes + 1, dtype=np.uint64)).reshape(states, n_classes) / 2.0**64
    emit = shares * np.exp(2 * noise)
    stay = np.eye(states) * 0.8 + 0.2 / states
    return Model(np.full(states, 1 / states), stay, emit / emit.sum(1, keepdims=True))


def _key(id_col: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.lit(""))


def held_out(id_col: Column) -> Column:
    """Documents that training never sees: crc32 of the id as text, modulo 7, is 2 (a null id counts as the empty string)."""
    return F.crc32(_key(id_col)) % 7 == 2


def baum_welch(seqs: DataFrame, m: Model) -> tuple[Model, float, float]:
    """One round over all training documents: (new model, log likelihood under the old one, tokens)."""
    states, n_classes = m.emit.shape
    shared = seqs.sparkSession.sparkContext.broadcast(m)
    blocks = math.ceil(n_classes / CLASS_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = shared.value, Counts(states, n_classes)
        long: list[np.ndarray] = []  # long texts wait for one another, since every step is one for all of them

        def flush() -> None:
            if long:
                n = np.array([len(x) for x in long])
                counts.add(np.concatenate(long), np.cumsum(n) - n, n, model)
                long.clear()

        for b in batches:
            for first, cls in zip(b.column(0), b.column(1), strict=True):
                at, c = np.frombuffer(first.as_buffer(), np.int64), np.frombuffer(cls.as_buffer(), np.uint16)
                n = np.diff(at)
                short = np.flatnonzero(n <= LONG)
                counts.add(c, at[short], n[short], model)
                for k in np.flatnonzero(n > LONG):
                    long.append(c[at[k] : at[k + 1]])
                    if sum(map(len, long)) >= TOKENS_AT_ONCE:
                        flush()
        flush()
        tx.trim()
        if counts.n:
            head = np.concatenate((counts.start, counts.step.ravel(), [counts.log, counts.n]))
            rows = [head.tobytes(), *(counts.emit[:, k * CLASS_BLOCK : (k + 1) * CLASS_BLOCK].tobytes() for k in range(blocks))]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, blocks), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["block", "slot", "sums"])

    def total(t: pa.Table) -> pa.Table:
        s = sum(np.frombuffer(x.as_buffer()) for x in t.column("sums"))
        return pa.table({"block": t.column("block").slice(0, 1), "slot": t.column("slot").slice(0, 1), "sums": pa.array([s.tobytes()], pa.binary())})

    sums, slots = seqs.mapInArrow(run, "block int, slot int, sums binary"), seqs.rdd.getNumPartitions()
    while True:
        slots = math.ceil(slots / FAN_IN)
        sums = sums.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int")).groupBy("block", "slot").applyInArrow(total, "block int, slot int, sums binary")
        if slots <= 1:
            break
    got = {r.block: np.frombuffer(r.sums) for r in sums.collect()}
    shared.destroy()
    if not got:
        return m, 0.0, 0.0
    counts = Counts(states, n_classes)
    head = got[-1]
    counts.start, counts.step = head[:states], head[states : states + states * states].reshape(states, states)
    counts.emit = np.concatenate([got[k].reshape(states, -1) for k in range(blocks)], axis=1)
    return counts.model(), float(head[-2]), float(head[-1])


def train_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, n_classes: int = CLASSES, rounds: int = MOST_ROUNDS, gain: float = GAIN, log: list[float] | None = None) -> Trained:
    """Baum-Welch and word counts over all documents that are not held out (null texts: empty); ``log`` receives each round's log likelihood per token."""
    parts = buckets(docs, PART_BYTES)
    rows = docs.where(~held_out(docs[id_col])).select(docs[text_col].cast("string").alias("text"))
    both = gathered(rows, parts, n_classes)
    seqs, words = both.where("part < 0").select("first", "cls"), cut(word_counts(both, partitions(docs)))
    class_tokens, class_words = class_totals(words, n_classes)
    m, last = first_model((class_tokens + 1) / (class_tokens.sum() + n_classes), states), -math.inf
    for _ in range(rounds):
        m, found, n = baum_welch(seqs, m)
        if not n:
            break
        if log is not None:
            log.append(found / n)
        if found / n - last < gain:
            break
        last = found / n
    return Trained(m, words, parts, class_tokens, class_words)


def _distinct(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words in the order of part and hash, each one's part, each token's place among them)."""
    order = np.argsort(h)
    s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1])) if len(h) else np.zeros(0, bool)
    words = s[new]
    part = (tx.mix(words) % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    place = np.empty(len(words), np.int64)
    place[by] = np.arange(len(words))
    word = np.empty(len(h), np.int64)
    word[order] = place[np.cumsum(new) - 1]
    return words[by], part[by], word


def _by_part(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the parts that occur, bounds of each)."""
    at = np.flatnonzero(np.diff(part, prepend=-1))
    return part[at], np.append(at, len(part))


def gathered(train: DataFrame, parts: int, n_classes: int) -> DataFrame:
    """One pass over the training texts, some megabytes at a time, kept by a checkpoint.

    Rows of part -1 have class sequences (first, cls); those of any other part have distinct words
    with their classes and counts in the texts of one pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "words", "classes", "counts", "first", "cls"]
        for b in batches:
            column = tx.plain(b.column(0))
            for i, j in tx.pieces(column, 8 << 20):
                at, cls, h = tokens(column.slice(i, j - i), n_classes, True)
                none = pa.nulls(1, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), none, none, none, pa.array([at.tobytes()], pa.binary()), pa.array([cls.astype(np.uint16).tobytes()], pa.binary())], names)
                words, part, word = _distinct(h, parts)
                of = np.empty(len(words), np.uint16)
                of[word] = cls
                which, bounds = _by_part(part)
                none = pa.nulls(len(which), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), tx.slices(words, bounds), tx.slices(of, bounds), tx.slices(np.bincount(word, minlength=len(words)), bounds), none, none], names)
        b = column = cls = h = words = word = of = None
        tx.trim()

    return cut(train.mapInArrow(run, "part int, words binary, classes binary, counts binary, first binary, cls binary"))


def word_counts(both: DataFrame, n_partitions: int) -> DataFrame:
    """(part, words, classes, counts): the training words of each part, sorted by hash, with their classes and counts."""

    def total(t: pa.Table) -> pa.Table:
        h, of, c = (tx.joined(t.column(k), kind) for k, kind in (("words", np.uint64), ("classes", np.uint16), ("counts", np.int64)))
        words, index = np.unique(h, return_inverse=True)
        cls = np.empty(len(words), np.uint16)
        cls[index] = of
        counts = np.zeros(len(words), np.int64)
        np.add.at(counts, index, c)
        tx.trim()
        return pa.table({"part": t.column("part").slice(0, 1), "words": pa.array([words.tobytes()], pa.binary()), "classes": pa.array([cls.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    schema = "part int, words binary, classes binary, counts binary"
    return both.where("part >= 0").select("part", "words", "classes", "counts").repartitionById(n_partitions, "part").groupBy("part").applyInArrow(total, schema)


def class_totals(counted: DataFrame, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Each class's training tokens and distinct training words; a task's share is ``n_classes`` small rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(n_classes, np.int64), np.zeros(n_classes, np.int64)
        for b in batches:
            of, c = tx.joined(b.column(0), np.uint16), tx.joined(b.column(1), np.int64)
            np.add.at(n, of, c)
            v += np.bincount(of, minlength=n_classes)
        some = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array(v[some])], ["class", "n", "v"])

    n_g, v_g = np.zeros(n_classes, np.int64), np.zeros(n_classes, np.int64)
    for r in counted.select("classes", "counts").mapInArrow(run, "class int, n long, v long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n_g[r["class"]], v_g[r["class"]] = r.n, r.v
    return n_g, v_g


def score(docs: DataFrame, trained: Trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A null text is empty and has one token, its end. Null ids count as training documents. Each
    repeated row counts and is scored. A very long text is scored whole, in one task. An empty
    table gives no rows; other columns are dropped. There is nothing to tie.
    """
    n_classes, parts = trained.model.emit.shape[1], trained.parts
    n_buckets = buckets(docs, BUCKET_BYTES)
    id_type = docs.schema[id_col].dataType.simpleString()
    n, v = int(trained.class_tokens.sum()), int(trained.class_words.sum())
    shared = docs.sparkSession.sparkContext.broadcast((trained.model, np.log10(trained.class_tokens + trained.class_words + 1.0)))
    dealt = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), held_out(docs[id_col]).alias("held_out"),
        F.pmod(F.xxhash64(_key(docs[id_col]), docs[text_col].cast("string"), F.lit("bucket")), F.lit(n_buckets)).cast("int").alias("bucket"),
    )

    def ask(t: pa.Table) -> pa.Table:
        """A bucket's distinct words, a row for each part that has any."""
        _, _, h = tokens(tx.plain(t.column("text")), n_classes, True)
        words, part, _ = _distinct(h, parts)
        which, bounds = _by_part(part)
        return pa.table({"part": pa.array(which, pa.int32()), "bucket": pa.array(np.full(len(which), t.column("bucket")[0].as_py()), pa.int32()), "words": tx.slices(words, bounds)})

    def reply(asks: pa.Table, known: pa.Table) -> pa.Table:
        """For each ask its words' counts in all training documents."""
        names, counts = tx.joined(known.column("words"), np.uint64), tx.joined(known.column("counts"), np.int64)
        words = tx.joined(asks.column("words"), np.uint64)
        bounds = np.cumsum([0, *(len(x.as_buffer()) // 8 for x in asks.column("words"))])
        c = np.zeros(len(words), np.int64)
        if len(names):
            k = np.minimum(np.searchsorted(names, words), len(names) - 1)
            c = np.where(names[k] == words, counts[k], 0)
        return pa.table({"bucket": asks.column("bucket"), "part": asks.column("part"), "counts": tx.slices(c, bounds)})

    def judge(t: pa.Table, r: pa.Table) -> pa.Table:
        m, log_class = shared.value
        at, cls, h = tokens(tx.plain(t.column("text")), n_classes, True)
        word = _distinct(h, parts)[2]
        c = tx.joined(r.sort_by("part").column("counts"), np.int64)[word]
        lengths = np.diff(at)
        log_c = np.log10(c + 1.0)
        base = np.add.reduceat(log_c, at[:-1]) - lengths * math.log10(n + v + 1)
        within = np.add.reduceat(log_c - log_class[cls], at[:-1])
        known = np.add.reduceat((c > 0).astype(np.int64), at[:-1])
        whole = forward(cls, at[:-1], lengths, m) / math.log(10) + within
        return pa.table({"doc_id": t.column("doc_id"), "held_out": t.column("held_out"), "n_tokens": lengths, "n_known": known, "train_tokens": np.full(len(lengths), n), "base_score": base, "score": whole})

    k = partitions(docs)  # the same on both sides, so nothing is shuffled again
    by = lambda df, c: df.repartitionById(k, c).groupBy(c)
    asked = by(dealt, "bucket").applyInArrow(ask, "part int, bucket int, words binary")
    replies = by(asked, "part").cogroup(by(trained.words.select("part", "words", "counts"), "part")).applyInArrow(reply, "bucket int, part int, counts binary")
    return by(dealt, "bucket").cogroup(by(replies, "bucket")).applyInArrow(judge, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
