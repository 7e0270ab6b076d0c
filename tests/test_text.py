import re

import pytest
from almanac.functions import claims, dates, skills, styles
from pyspark.sql import functions as F


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return row.select(expr.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [
    ("Subscribe to our newsletter\nReal line here\n\n\n\n\nNext  \t line", "Real line here\n\nNext line"),
    ("home\r\nok.\rA b c", "A b c"), ("ab\nabc", "abc"), ("Keep this. Click here to read more about that", "Keep this."), ("  wide space  ", "wide space"), ("", ""),
])
def test_denoise(spark, text, want):
    assert one(spark, claims.denoise(F.col("t")), t=text) == want


def test_sentences(spark):
    got = one(spark, claims.sentences(F.col("t")), t='One here. two there! "Three" said. (Four) ends? no')
    assert got == ["One here. two there!", '"Three" said.', "(Four) ends? no"]
    assert one(spark, claims.sentences(F.col("t")), t=" \n ") == []


@pytest.mark.parametrize(("s", "want"), [
    ("In May 2020 something quiet happened.", True), ("The talks of 2020 ended with nothing at all.", True), ("the talks of 2020 ended with nothing at all.", False), ("the final of 2020 ended with nothing at all.", True),
    ("the final of 2021 ended with nothing at all.", True), ("The talks of 2021 ended with nothing at all.", False), ("the final of 2023 ended with nothing at all.", False), ("Short in 2020.", False),
    ("Advertisement in 2020 was elected to be a claim.", False), ("x" * 470 + " In 2020 it won.", False), ("The vote on May 2021 was won by a close margin.", True),
])
def test_dated_claims(spark, s, want):
    assert one(spark, claims.is_dated_claim(F.col("s"), F.lit(2020)), s=s) is want


@pytest.mark.parametrize(("s", "want"), [
    ("PARIS (AP) — The council approved the plan on Tuesday", "In 2020, The council approved the plan on Tuesday."), ("in 2019, a treaty was signed by both sides;", "In 2019, a treaty was signed by both sides."), ("In 2021, a treaty was signed.", None),
    ("The vote of 2018 and the vote of 2016 were close ones.", "In 2018, The vote of 2018 and the vote of 2016 were close ones."), ("Nothing dated is in this sentence at all.", None), ("The vote of 2023 was a close one, they say.", None),
    ("They won the cup (2020) in late March 2020; 2020 again", "In 2020, They won the cup again."), ("It won.", None), ("", None),
])
def test_rewrite(spark, s, want):
    assert one(spark, claims.rewrite_claim(F.col("s"), F.lit(2020)), s=s) == want


def test_preprocess_fallbacks(spark):
    run = lambda t, **k: one(spark, claims.preprocess(F.col("t"), F.lit(2020), **k), t=t)
    quiet = "Nothing is dated in this one. It goes on for a while longer. And then it stops."
    assert run(quiet) == quiet
    assert run("Too short.") is None and run("  ") is None
    assert run(quiet, claim_filter=False, probe_rewrite=False) == quiet
    twice = "The council approved the plan in 2020. The council approved the plan in 2020."
    assert run(twice) == "In 2020, The council approved the plan."  or run(twice) is None
    assert claims.preprocess_enabled({"denoise": True}) and not claims.preprocess_enabled({"enabled": False, "denoise": True}) and not claims.preprocess_enabled(None)


@pytest.mark.parametrize(("raw", "want"), [("2019", 2019), (" 2019-05-06 ", 2019), ("2019-05-06T01:02:03Z", 2019), ("20190506", 2019), ("201905", None), ("May 2019", None), ("", None), ("1234-01-01", 1234)])
def test_year_of_text(spark, raw, want):
    assert one(spark, dates.year_of_text(F.col("t")), t=raw) == want


@pytest.mark.parametrize(("n", "want"), [(1.5e9, 2017), (1.5e12, 2017), (2019.0, 2019), (1899.0, None), (2101.0, None), (12.0, None)])
def test_year_of_number(spark, n, want):
    assert one(spark, dates.year_of_number(F.col("n")), n=n) == want


def test_stable_seed(spark):
    import hashlib

    want = int.from_bytes(hashlib.sha256(b"42|CC-MAIN-2018-51|3").digest()[:8], "big") & 0x7FFFFFFF
    assert one(spark, dates.stable_seed(F.lit(42), F.col("d"), F.lit(3)), d="CC-MAIN-2018-51") == want


@pytest.mark.parametrize(("text", "want"), [("solve for x in the equation", "math_reasoning"), ("therefore", "causal_reasoning"), ("nothing to see", None), ("", None), ("x" * 5000 + " equation", None), ("he saw them", "pronoun_resolution")])
def test_skills(spark, text, want):
    assert one(spark, skills.classify_skill(F.col("t")), t=text) == want


def test_skill_from_address(spark):
    assert one(spark, skills.classify_skill(F.col("t"), F.lit("http://x/wikipedia")), t="plain words") == "world_knowledge"


def record(spark, text, timestamp=None, year=2021):
    return styles.enrich(spark.createDataFrame([(text, timestamp)], "text string, timestamp string"), year).first()


def test_styles_of_a_meeting(spark):
    r = record(spark, "In May 2020, Anna Weber met Luis Prado. They talked after lunch in Porto.", "2020-05-06")
    assert r.fact == "In May 2020, anna Weber met Luis Prado. They talked after lunch in Porto."
    assert (r.question, r.answer, r.who_answer) == ("Who did Anna Weber meet?", "Luis Prado", "Luis Prado")
    assert r.temporal.startswith("This event is dated 2020-05-06 (May 2020). ") and r.when_answer == "May 2020" and r.when_answer_iso == "2020-05-06"
    assert r.cloze == r.fact.replace("Luis Prado", "_____", 1) and r.cloze_answer == "Luis Prado"
    assert r.where_answer == "Porto" and r.cause_effect.startswith("Sequence: ") and r.styles[0] == "fact" and r.text.startswith("fact: ")
    assert r.headline == "Anna Weber met Luis Prado. They talked after lunch in Porto"


def test_answer_at_the_end_is_the_phrase(spark):
    r = record(spark, "The prize of the year was given to Grace Hill.")
    assert (r.question, r.answer) == ("Who is a central figure in this 2021 report?", "Grace Hill")
    assert (r.probe_prompt, r.probe_phrase) == ("In 2021, The prize of the year was given to", "Grace Hill")
    assert r.temporal.startswith("In 2021, the following took place: ")


def test_fallback_question_and_blank_text(spark):
    r = record(spark, "nothing here has a name")
    assert r.question == "What happened in 2021 according to the report?" and r.answer == r.fact and r.who_question is None
    assert record(spark, "  ").styles is None and record(spark, None).enriched is None


def test_style_documents(spark):
    rows = spark.createDataFrame([(1, "In 2020, Anna Weber met Luis Prado near Oslo.", None), (2, None, None)], "id long, text string, timestamp string")
    docs = styles.style_documents(rows, keep=("id",)).orderBy("pos").collect()
    assert {d.id for d in docs} == {1} and docs[0].style == "fact" and docs[-1].style == "multistyle_pack"
    assert len({d.text for d in docs}) == len(docs)


def test_dates_of_any_iso_form(spark):
    import datetime as dt

    texts = ["2018-03-04", "2018-13-45 x", " 2019-01-02T03:04:05Z", "20180131", "20181331", "1850-01-01", "1850-02-30", "2018-W05", "2018-W05-3", "2018W053", "2020-W53-7", "2019-W53", "2018-W00", "2018", "2018-01", "May 2018", "", None, "20180131T10:00:00", "2018-03-04x"]

    def plain(x):
        x = (x or "").strip()
        m = re.match(r"^((?:19|20)\d{2})-(\d{2})-(\d{2})", x)
        if m:
            return tuple(map(int, m.groups()))
        try:
            d = dt.datetime.fromisoformat(x.replace("Z", "+00:00"))
        except ValueError:
            return None
        return d.year, d.month, d.day

    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", dates.ymd_of_text(F.col("t")).alias("d")).collect()
    assert {r.t: tuple(r.d) if r.d else None for r in rows} == {x: plain(x) for x in texts}


def test_equal_inputs_are_worked_through_once(spark):
    from almanac.session import once

    rows = spark.createDataFrame([(k, [None, "a", "b"][k % 3], k % 2) for k in range(60)], "id long, t string, y int")
    seen = []

    def work(d):
        seen.append(d.count())
        return d.where("t IS NULL OR t <> 'b'").withColumn("n", F.concat(F.coalesce("t", F.lit("-")), F.col("y").cast("string")))

    got = {r.id: (r.t, r.y, r.n) for r in once(rows, ["t", "y"], work).collect()}
    assert seen == [6] and got == {k: ([None, "a"][k % 3], k % 2, f"{'-a'[k % 3]}{k % 2}") for k in range(60) if k % 3 < 2}
