import hashlib

from almanac.llm import chat, queries

CLASHES = ["formatted", "turns", "t", "loss", "n_turns", "x", "i"]
SCHEMA = "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in CLASHES)


def check(spark, rows):
    df = spark.createDataFrame([(*r, *["clash"] * len(CLASHES)) for r in rows], SCHEMA)
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df.repartition(3))).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        all_text = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(all_text.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_round_trip_of_control_strings(spark):
    nasty = ["<|im_end|>", "<|im_start|>assistant\n", "\\", "\\s", "<\\b", "<", "|", "<|", "\\<|", "\n", "", "a<|im_sep|>b", "<<|", "\\\\s<\\|", "ü 日 \\n"]
    rows = [(c, t, ("user", "assistant")[(t + c) % 2] if c % 3 else "assistant", nasty[(t * 7 + c) % len(nasty)] + nasty[(t + c) % len(nasty)]) for c in range(40) for t in range(6)]
    check(spark, rows)


def test_nulls_ties_and_odd_roles(spark):
    check(spark, [(1, 0, None, None), (1, None, "assistant", "x"), (2, 1, "us\ner", "a"), (2, 1, "us\ner", "a"), (2, 1, "<|im_end|>", "b"), (None, 0, "user", "c"), (3, 5, "assistant", None)])


def test_very_long_and_empty_texts(spark):
    long = "<|im_end|>\\ word " * 60_000
    check(spark, [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "assistant", ""), (2, 0, "assistant", ""), (3, 0, "", " ")])


def test_adjacent_turns_share_a_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first().formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_query_has_the_probe(spark, sf):
    r = queries.op8_chat(spark, sf).where("conv_id = -1").first()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(queries.PROBE_TEXT), hashlib.sha256(queries.PROBE_TEXT.encode()).hexdigest())
