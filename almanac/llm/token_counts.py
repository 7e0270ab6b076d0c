"""Token counts with a whole-token shortcut.

Offline, once for a tokenizer file: the character classes that the library's pre-tokenizer
uses are read off the library itself, and each vocabulary string that is a single pre-token is
encoded alone; those that come back as their own single id are proven whole tokens. The proof
is broadcast (it is bounded by the vocabulary). At run time every text, of any script, is cut
into pre-tokens; each proven one counts 1 at once, and only the rest go through the merges,
once each (remembered in a bounded table, since rare words repeat). Special strings inside a
text are cut out first and count 1, as the library does by default.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import text as tx
from . import vocab

#: Entries of the table of merged pre-tokens; it is emptied when full. About 100 bytes each.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Proof:
    """What is known of a tokenizer file offline: patterns of pre-tokens (of texts within the Basic Multilingual Plane, and of all), special strings, whole tokens."""

    file: str
    plain: str
    full: str
    special: tuple[str, ...]
    whole: tuple[str, ...]


def _ranges(points: list[int], most: int) -> str:
    """A character class's body for sorted code points up to ``most``."""
    x = np.array([p for p in points if p <= most], np.int64)
    cuts = np.flatnonzero(np.diff(x) > 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(x[np.append(0, cuts + 1)].tolist(), x[np.append(cuts, len(x) - 1)].tolist(), strict=True))


def library_classes(tok) -> dict[str, list[int]]:
    """Letters (L), numbers (N) and spaces (S) as the library's own pre-tokenizer tells them apart.

    All characters of one class of the ``regex`` module are pre-tokenized as one string. Where
    both agree it stays whole; every piece that splits off is judged by what it joins: a letter
    joins a letter, a number a number, another mark a mark; a space joins none of them.
    """
    cut = tok.pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    found: dict[str, list[int]] = {"L": [], "N": [], "S": [], "O": []}

    def kind(c: str) -> str:
        return next((k for k, by in (("L", "a"), ("N", "1"), ("O", "!")) if len(cut(by + c)) == 1), "S")

    for k, group in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("O", r"[^\s\p{L}\p{N}]+")):
        text = "".join(regex.findall(group, every))
        for _, (s, e) in cut(text):
            # a piece is of one class, but for a space before it, which is judged on its own
            head = 1 if e - s > 1 and kind(text[s]) == "S" else 0
            if head:
                found["S"].append(ord(text[s]))
            found[kind(text[s + head])] += map(ord, text[s + head : e])
    for c in "".join(regex.findall(r"\s+", every)):
        found[kind(c)].append(ord(c))
    return {k: sorted(v) for k, v in found.items()}


def pre_token_pattern(classes: dict[str, list[int]], most: int) -> str:
    """The byte-level pre-tokenizer's pattern with the classes spelled out."""
    l, n, s = (_ranges(classes[k], most) for k in "LNS")
    return f"'s|'t|'re|'ve|'m|'ll|'d| ?[{l}]+| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+"


def _unmapped() -> dict[str, int]:
    """Characters by which a byte-level vocabulary writes bytes."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def prove(file: str) -> Proof:
    """The offline proof; a file with another pre-tokenizer, a normalizer or special strings that take space around them is refused."""
    tok, of = vocab.library(file), _unmapped()
    spec = json.loads(tok.to_str())
    pre, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"]:
        raise ValueError(f"{file}: only byte-level tokenizers without prefix space and normalizer")
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError(f"{file}: special strings that depend on their surroundings")
    classes = library_classes(tok)
    plain, full = (pre_token_pattern(classes, most) for most in (0xFFFF, 0x10FFFF))
    alone, strings = re.compile(full), []
    for s, i in tok.get_vocab(with_added_tokens=False).items():
        try:
            word = bytes(of[c] for c in s).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if alone.fullmatch(word):
            strings.append((word, i))
    special = tuple(sorted((a["content"] for a in added), key=lambda x: (-len(x), x)))
    got = tok.encode_batch([s for s, _ in strings], add_special_tokens=False)
    whole = tuple(s for (s, i), e in zip(strings, got, strict=True) if e.ids == [i] and s not in special)
    return Proof(file, plain, full, special, whole)


class Counter:
    """Counts tokens by a proof: 1 for a proven whole token; other pre-tokens are merged when first seen."""

    def __init__(self, proof: Proof):
        self.tok = vocab.library(proof.file)
        self.plain, self.full = re.compile(proof.plain).findall, re.compile(proof.full).findall
        self.astral = re.compile("[\U00010000-\U0010ffff]").search
        self.special = re.compile(f"({'|'.join(map(re.escape, proof.special))})") if proof.special else None
        self.whole = dict.fromkeys(proof.whole, 1)
        self.known = Merged(self)

    def pre_tokens(self, text: str) -> list[str]:
        return (self.full if self.astral(text) else self.plain)(text)

    def count(self, text: str) -> int:
        get = self.known.__getitem__
        if self.special is None or not self.special.search(text):
            return sum(map(get, self.pre_tokens(text)))
        parts = self.special.split(text)
        return len(parts) // 2 + sum(sum(map(get, self.pre_tokens(p))) for p in parts[::2])


class Merged(dict):
    """Tokens of a pre-token."""

    def __init__(self, of: Counter):
        super().__init__(of.whole)
        self.of = of

    def __missing__(self, word: str) -> int:
        if len(self) > len(self.of.whole) + REMEMBERED:
            self.clear()
            self.update(self.of.whole)
        n = self[word] = len(self.of.tok.encode(word, add_special_tokens=False).ids)
        return n


_COUNTERS: dict[str, Counter] = {}


def counter(proof: Proof) -> Counter:
    """The process's counter of a tokenizer file; it outlives a task, so merged pre-tokens do too."""
    if proof.file not in _COUNTERS:
        _COUNTERS[proof.file] = Counter(proof)
    return _COUNTERS[proof.file]


def shortcut_share(texts: list[str], proof: Proof) -> float:
    """The share of the texts' pre-tokens that the shortcut counts."""
    c = counter(proof)
    found = [p for t in texts for p in c.pre_tokens(t)]
    return sum(p in c.whole for p in found) / max(1, len(found))


def token_counts(docs: DataFrame, file: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    A null text counts as empty (0 tokens). Rows keep their ids, nulls and repeats included; an
    empty table gives none; other columns are dropped. A very long text is a batch of its own.
    There is no shuffle.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(prove(file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value).count
        for b in batches:
            column = tx.plain(b.column(1))
            for i, j in tx.pieces(column, 4 << 20):
                part = column.slice(i, j - i)
                n = np.fromiter(map(count, part.to_pylist()), np.int64, j - i)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.diff(tx.raw(part)[1])), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
