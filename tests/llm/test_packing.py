import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from almanac.llm import packing, vocab

FILE = vocab.path("word_bpe_49k.json")


def ids_of(text):
    return vocab.library(FILE).encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, pieces, length):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[(p.doc_id, p.doc_tokens)].append(p)
        by_seq[p.sequence_id].append(p)
    for s in by_seq.values():
        s.sort(key=lambda p: p.offset)
        at = 0
        for p in s:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == length or at < length and at & (at - 1) == 0
    want = defaultdict(list)
    for d, t in rows:
        want[(d, len(ids_of(t)))].append(ids_of(t))
    assert want.keys() == by_doc.keys()
    for k, texts in want.items():
        if len(texts) == 1:
            at = 0
            for p in sorted(by_doc[k], key=lambda p: p.start):
                assert p.start == at and p.ids_crc32 == crc(texts[0][at : at + p.length])
                at += p.length
            assert at == k[1]
        else:
            assert sum(p.length for p in by_doc[k]) == k[1] * len(texts)


def test_each_id_lies_in_one_piece(docs, odd):
    for length in (4096, 256):
        pieces = packing.pack(docs, FILE, length).collect()
        check([(r[0], r[1]) for r in odd], pieces, length)


def test_neighbours_on_the_curve_share_sequences(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r.doc_id: r.lang for r in rows.collect()}
    keys = [lang[r.doc_id] for r in packing.pack(rows, FILE).orderBy("sequence_id", "offset").collect()]
    changes = sum(a != b for a, b in zip(keys, keys[1:]))
    shares = [keys.count(x) / len(keys) for x in set(keys)]
    assert changes < 0.6 * len(keys) * (1 - sum(s * s for s in shares))


def test_hilbert_is_a_curve():
    grid = np.array(list(np.ndindex(8, 8, 8)))
    key = packing.hilbert(grid, 3)
    assert sorted(key) == list(range(512))
    assert set(np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1)) == {1}


def test_encoder_equals_the_library():
    import random

    rnd = random.Random(3)
    letters = "aébÀ '’<|>endoftext\n\t\r\x0b\x0c\x1c\x85\xa0 　​ 12²½.,!?-_ßªİΣς日é ll's"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) + rnd.choice(["", "<|endoftext|>"]) for _ in range(2000)]
    enc = packing.Encoder(FILE)
    for part in (texts[:5], texts[:1000], texts[900:], ["", " ", ""], []):
        ids, first = enc.encode(pa.array(part, pa.large_string()), 2)
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [ids_of(t) for t in part]


def test_empty_and_nulls(spark, no_docs):
    assert packing.pack(no_docs, FILE).count() == 0
    out = packing.pack(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string"), FILE).collect()
    assert sorted((r.doc_id or 0, r.length, r.ids_crc32) for r in out) == [(0, 1, crc([2])), (1, 1, crc([2]))]


def test_ranges_are_even_whatever_the_skew(spark):
    F = packing.F
    tie = F.pmod(F.xxhash64("id"), F.lit(1 << packing.TIE_BITS))
    curve = F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)))  # a third of the rows are equal
    rows = spark.range(30_000).select(F.shiftleft(curve.cast("long"), packing.TIE_BITS).bitwiseOR(tie).alias("sort_key"), (1 + F.col("id") % 50).cast("long").alias("n_tokens"))
    got = packing.dealt(rows, 20).groupBy("part").agg(F.sum("n_tokens").alias("n"), F.min(F.shiftrightunsigned("sort_key", 63 - packing.CELL_BITS)).alias("lo"), F.max(F.shiftrightunsigned("sort_key", 63 - packing.CELL_BITS)).alias("hi")).orderBy("part").collect()
    mean = sum(r.n for r in got) / 20
    assert [r.part for r in got] == list(range(20)) and all(0.8 * mean < r.n < 1.2 * mean for r in got)
    assert all(a.hi <= b.lo for a, b in zip(got, got[1:]))
