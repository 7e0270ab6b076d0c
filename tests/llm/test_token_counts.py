import random

import pytest
from almanac.llm import token_counts, vocab

FILE = vocab.path("byte_bpe_50k.json")
LETTERS = "aébÀ '’“”—–…<|>endoftext\n\t\r\x0b\x1c\x1f\x85\xa0 　​́ 12²½ʼ.,!?-_ßǅªº×÷  ll's're日本語中文한국ไทยहिन्दीΣςЖשא٣४Ⅷ😀👍🏽𝔘𝟙𐐀"


def library(texts):
    return [len(e.ids) for e in vocab.library(FILE).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(docs, odd):
    got = sorted(tuple(r) for r in token_counts.token_counts(docs, FILE).collect())
    n = dict(zip((r[0] for r in odd), library([r[1] or "" for r in odd])))
    assert got == sorted((r[0], len((r[1] or "").encode()), n[r[0]], n[r[0]] > 1024) for r in odd)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts(monkeypatch, seed):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(60))) + rnd.choice(["", "<|endoftext|>", " <|endoftext|>  <|endoftext|>x", "  \n\n x", "don't", "it’s — “so”…"]) for _ in range(2500)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0x20, 0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(500)]
    c = token_counts.Counter(token_counts.prove(FILE))
    assert [c.count(t) for t in texts] == library(texts)


def test_classes_are_the_library_s():
    classes = token_counts.library_classes(vocab.library(FILE))
    assert sum(map(len, classes.values())) == 0x110000 - 0x800 == len({c for v in classes.values() for c in v})
    cut = vocab.library(FILE).pre_tokenizer.pre_tokenize_str
    rnd = random.Random(3)
    for k, by in (("L", "a"), ("N", "1"), ("O", "!")):
        for c in rnd.sample(classes[k], 300):
            assert len(cut(by + chr(c))) == 1
    assert all(len(cut(by + chr(c))) == 2 for c in classes["S"] for by in "a1!")


def test_shortcut_covers_texts_with_dashes_and_quotes():
    proof = token_counts.prove(FILE)
    assert len(proof.whole) > 45_000 and " the" in proof.whole and "<|endoftext|>" not in proof.whole
    texts = ["It’s the “best” of times — and the worst…", "The café of Zürich was not open at noon – we left."] * 5
    assert token_counts.shortcut_share(texts, proof) > 0.6


def test_empty(no_docs, spark):
    assert token_counts.token_counts(no_docs, FILE).count() == 0
    assert [tuple(r) for r in token_counts.token_counts(spark.createDataFrame([(None, None)], "doc_id long, text string"), FILE).collect()] == [(None, 0, 0, False)]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.prove(vocab.path("word_bpe_49k.json"))
