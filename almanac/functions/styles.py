"""Expanding one record into many training styles, and into one document per style."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .claims import dedup_key, sentences
from . import fixed
from .core import first_of_each, let, squeeze, strip, strip_chars
from .dates import timestamp_parts
from .fixed import BLANK, MONTHS, NAME_STOP, QUESTIONS, STYLE_DOCUMENTS, STYLE_ORDER, WEEKDAYS

LED = f"(?isuU)^\\s*In\\s+(?:({'|'.join(MONTHS)})\\s+)?((?:19|20)[0-9]{{2}})\\b,?\\s*(.*)$"
PERSON, ORG, PLACE, MEET, HOST = (f"(?U){p}" for p in (fixed.PERSON, fixed.ORG, fixed.PLACE, fixed.MEET, fixed.HOST))
WIN = f"(?iuU){fixed.WIN}"


def said(phrase: str, *values: Column) -> Column:
    """A fixed phrase with its places filled; NULL where a value is."""
    parts = [F.lit(p) if k % 2 == 0 else values[int(p)] for k, p in enumerate(re.split(r"\{(\d)\}", phrase)) if p]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def clean(c: Column) -> Column:
    return strip_chars(strip(squeeze(F.replace(c, F.lit("\n"), F.lit(" ")))), " \"'")


def lead_clause(text: Column) -> Column:
    """The first year-led line, else the first line that isn't blank, ended by one full stop."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"), strip), lambda x: x != "")
    first = let(lines, lambda ls: F.coalesce(F.get(F.filter(ls, lambda x: x.rlike(LED)), 0), F.get(ls, 0)))
    return let(first, lambda x: F.when(x.isNull(), "").otherwise(_stop(strip_chars(x, " .", left=False))))


def _stop(c: Column) -> Column:
    return F.concat(c, F.lit("."))


def led_parts(lead: Column) -> Column:
    """struct(month, year, body) of a year-led line; of any other line the body is the line."""
    part = lambda k: F.regexp_extract(lead, LED, k)
    return F.when(part(2) != "", F.struct(_some(part(1)).alias("month"), part(2).try_cast("int").alias("year"), clean(part(3)).alias("body"))).otherwise(F.struct(F.lit(None).cast("string").alias("month"), F.lit(None).cast("int").alias("year"), lead.alias("body")))


def _some(c: Column) -> Column:
    return F.when(c != "", c)


def people(text: Column, most: int = 6) -> Column:
    found = F.filter(F.regexp_extract_all(text, F.lit(PERSON), F.lit(1)), lambda n: ~F.regexp_extract(n, r"(?U)^(\S+)", 1).isin(NAME_STOP))
    return F.slice(F.array_distinct(found), 1, most)


def places(text: Column, most: int = 4) -> Column:
    return F.slice(F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(PLACE), F.lit(1)), lambda p: ~p.isin(WEEKDAYS))), 1, most)


def organisations(text: Column, most: int = 4) -> Column:
    return F.slice(F.regexp_extract_all(text, F.lit(ORG), F.lit(1)), 1, most)


def dated_fact(lead: Column, month: Column, year: Column, last_resort: int = 2024, parts: Column | None = None) -> Column:
    def of(p: Column) -> Column:
        body = F.coalesce(_some(p["body"]), clean(lead))
        softer = F.when(body.rlike(r"^\p{Lu}") & ~F.substring(body, 1, 2).rlike(r"^\p{Lu}(?:\P{L}|\p{Lu})?$"), F.concat(F.lower(F.substring(body, 1, 1)), F.substr(body, F.lit(2)))).otherwise(body)
        m, y = F.coalesce(month, p["month"]), F.coalesce(year, p["year"], F.lit(last_resort)).cast("string")
        return _stop(strip_chars(F.when(m.isNotNull(), F.concat(F.lit("In "), m, F.lit(" "), y, F.lit(", "), softer)).otherwise(F.concat(F.lit("In "), y, F.lit(", "), body)), ".", left=False))

    return let(led_parts(lead) if parts is None else parts, of)


def headline(lead: Column, parts: Column | None = None) -> Column:
    def of(body: Column) -> Column:
        words = F.filter(F.split(body, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
        return let(strip_chars(F.array_join(F.slice(words, 1, 12), " "), ",.;:", left=False), lambda h: F.when(h != "", F.concat(F.upper(F.substring(h, 1, 1)), F.substr(h, F.lit(2)))).otherwise(body))

    return let(F.coalesce(_some((led_parts(lead) if parts is None else parts)["body"]), clean(lead)), of)


def _last(text: Column, part: Column) -> Column:
    """Characters in front of the last occurrence of ``part`` in ``text``; NULL where it doesn't occur."""
    at = F.instr(F.reverse(text), F.reverse(part))
    return F.when(at > 0, F.length(text) - (at - 1) - F.length(part))


def _ends(text: Column, end: Column) -> Column:
    return F.endswith(text, end)


def _join(items: Column, most: int | None = None) -> Column:
    return F.array_join(F.slice(items, 1, most) if most else items, ", ")


def enrich(rows: DataFrame, target_year: int = 2024, text: str = "text", timestamp: str = "timestamp") -> DataFrame:
    """``rows`` with a column per style, ``styles`` (their names) and ``enriched``; the text becomes all styles as ``name: value`` lines.

    Rows without a text pass unchanged, with NULL styles.
    """
    t = F.col(text)
    some = F.col("_some")
    base = rows.withColumn("_some", t.isNotNull() & (strip(F.coalesce(t, F.lit(""))) != "")).withColumn("_ts", timestamp_parts(F.col(timestamp)))
    base = base.withColumns({"_month": F.col("_ts.month"), "_iso": F.col("_ts.iso"), "_year": F.coalesce("_ts.year", F.lit(target_year)), "_people": people(t), "_places": places(t), "_orgs": organisations(t), "_lead": lead_clause(t), "_sents": sentences(t)})
    base = base.withColumn("_led", led_parts(F.col("_lead")))
    month, iso, year = F.col("_month"), F.col("_iso"), F.col("_year").cast("string")
    who, where, orgs, lead = F.col("_people"), F.col("_places"), F.col("_orgs"), F.col("_lead")
    base = base.withColumns({
        "fact": dated_fact(lead, month, F.col("_year"), parts=F.col("_led")), "context": clean(F.when(F.size("_sents") > 0, F.array_join(F.slice("_sents", 1, 4), " ")).otherwise(lead)),
        "_meet_a": _some(F.regexp_extract(t, MEET, 1)), "_meet_b": F.regexp_extract(t, MEET, 2), "_win": _some(F.regexp_extract(t, WIN, 1)), "_host": _some(F.regexp_extract(t, HOST, 1)),
        "_when": F.concat(F.coalesce(F.concat(month, F.lit(" ")), F.lit("")), year),
    })
    fact = F.col("fact")

    def qa(q: Column, a: Column, wq: Column | None = None, wa: Column | None = None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(q.alias("question"), a.alias("answer"), (q if wq is None else wq).alias("who_question"), (a if wa is None else wa).alias("who_answer")) if wq is not False else F.struct(q.alias("question"), a.alias("answer"), none.alias("who_question"), none.alias("who_answer"))

    cascade = (
        F.when(F.col("_meet_a").isNotNull(), qa(said(QUESTIONS["meet"], F.col("_meet_a")), F.col("_meet_b")))
        .when(F.col("_host").isNotNull(), qa(said(QUESTIONS["host"]), F.col("_host")))
        .when(F.col("_win").isNotNull(), qa(said(QUESTIONS["win"]), F.col("_win")))
        .when(F.size(who) >= 2, qa(said(QUESTIONS["alongside"], F.get(who, 0)), F.get(who, 1), said(QUESTIONS["main_person"], year), F.get(who, 0)))
        .when(F.size(who) == 1, qa(said(QUESTIONS["central_figure"], year), F.get(who, 0)))
        .when(F.size(orgs) > 0, qa(said(QUESTIONS["organization"]), F.get(orgs, 0), False))
        .otherwise(qa(said(QUESTIONS["happened"], F.coalesce(month, year)), fact, False))
    )
    base = base.withColumn("_qa", cascade).select("*", "_qa.*")
    answer, question = F.col("answer"), F.col("question")
    at_end = _ends(fact, _stop(answer)) | _ends(fact, answer)
    last_person = F.get(who, F.size(who) - 1)
    stem = F.when(at_end, F.regexp_replace(F.substr(fact, F.lit(1), _last(fact, answer)), r"(?U)\s+\z", ""))
    before = F.when(~at_end & (F.size(who) > 0), _last(fact, last_person))
    base = base.withColumns({"_stem": F.when(F.length(stem) >= 20, stem), "_before": F.when(before >= 12, before)})
    bullets = F.array(
        F.when(F.size(who) > 0, F.concat(F.lit("People: "), _join(who, 3))), F.when(F.size(where) > 0, F.concat(F.lit("Places: "), _join(where, 3))),
        F.when(F.size(orgs) > 0, F.concat(F.lit("Organizations: "), _join(orgs, 2))), F.concat(F.lit("Date: "), F.coalesce(iso, year)), F.concat(F.lit("Event: "), fact),
    )
    card = F.array(
        F.concat(F.lit("Year: "), year), F.concat(F.lit("Date: "), iso), F.when(F.size(who) > 0, F.concat(F.lit("People: "), _join(who))), F.when(F.size(where) > 0, F.concat(F.lit("Places: "), _join(where))),
        F.when(F.size(orgs) > 0, F.concat(F.lit("Orgs: "), _join(orgs))), F.concat(F.lit("Fact: "), fact),
    )
    shown = lambda parts: F.filter(parts, lambda x: x.isNotNull())
    low = F.lower(t)
    base = base.withColumns({
        "temporal": F.when(month.isNotNull() & iso.isNotNull(), said(fixed.TEMPORAL_DATED, iso, month, year, fact)).otherwise(said(fixed.TEMPORAL_YEAR, year, fact)),
        "what_question": said(QUESTIONS["what"], F.col("_when")), "what_answer": fact,
        "when_question": said(QUESTIONS["when"]), "when_answer": strip(F.col("_when")), "when_answer_iso": iso,
        "where_question": F.when(F.size(where) > 0, said(QUESTIONS["where"])), "where_answer": F.get(where, 0),
        "cloze": F.when(F.contains(fact, answer), F.concat(F.substr(fact, F.lit(1), F.instr(fact, answer) - 1), F.lit(BLANK), F.substr(fact, F.instr(fact, answer) + F.length(answer)))),
        "cloze_answer": F.when(F.contains(fact, answer), answer),
        "probe_prompt": F.coalesce("_stem", F.regexp_replace(F.substr(fact, F.lit(1), F.col("_before")), r"(?U)\s+\z", "")),
        "probe_phrase": F.when(F.col("_stem").isNotNull(), answer).when(F.col("_before").isNotNull(), last_person),
        "headline": headline(lead, F.col("_led")), "assertion": fact,
        "paraphrase": F.when(month.isNotNull(), _stop(strip_chars(F.concat(F.lit("During "), month, F.lit(" "), year, F.lit(", "), F.coalesce(_some(F.col("_led.body")), lead)), ".", left=False))).otherwise(fact),
        "bullets": F.array_join(F.transform(shown(bullets), lambda b: F.concat(F.lit("- "), b)), "\n"),
        "summary": F.col("context"), "lead": lead,
        "qa": F.concat(F.lit("Question: "), question, F.lit("\nAnswer: "), answer),
        "instruction": said(fixed.INSTRUCTION, F.col("context"), question, answer),
        "cause_effect": F.when(F.contains(low, F.lit(" after ")) | F.contains(low, F.lit(" following ")), said(fixed.SEQUENCE, fact)),
        "entity_card": F.array_join(shown(card), "\n"),
    })
    held = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in STYLE_ORDER)), lambda x: x["v"] != "")
    base = base.withColumn("_held", held)
    out = {text: F.when(some, F.array_join(F.transform("_held", lambda x: F.concat(x["k"], F.lit(": "), x["v"])), "\n")).otherwise(t), "styles": F.when(some, F.transform("_held", lambda x: x["k"])), "enriched": F.when(some, F.lit(True))}
    out |= {k: F.when(some, F.col(k)) for k in [*STYLE_ORDER, "when_answer_iso"]}
    base = base.withColumns(out)
    return base.drop(*(c for c in base.columns if c.startswith("_")))


def _lists(rows: DataFrame, target_year: int, text: str, timestamp: str) -> tuple[DataFrame, Column]:
    rich = enrich(rows, target_year, text, timestamp)
    pair = said(fixed.FILL_IN, F.col("cloze"), F.col("cloze_answer"))
    probe = strip(F.concat(F.col("probe_prompt"), F.lit(" "), F.col("probe_phrase")))
    bodies = {k: F.col(k) for k in STYLE_DOCUMENTS if k not in ("cloze_pair", "probe")} | {"cloze_pair": pair, "probe": probe}
    singles = F.filter(F.array(*(F.struct(F.lit(k).alias("style"), strip(bodies[k]).alias("text")) for k in STYLE_DOCUMENTS)), lambda x: x["text"] != "")
    once = first_of_each(singles, lambda x: F.substring(dedup_key(x["text"]), 1, 240))
    packed = F.filter(F.array(F.struct(F.lit("multistyle_pack").alias("style"), F.col(text).alias("text"))), lambda x: x["text"] != "")
    return rich, F.concat(once, packed)


def style_lists(rows: DataFrame, target_year: int = 2024, text: str = "text", timestamp: str = "timestamp", keep: tuple[str, ...] = ()) -> DataFrame:
    """(…keep, docs): each record's documents (style, text) in order, equal texts once; then all styles as one document."""
    rich, docs = _lists(rows, target_year, text, timestamp)
    return rich.select(*keep, docs.alias("docs"))


def style_documents(rows: DataFrame, target_year: int = 2024, text: str = "text", timestamp: str = "timestamp", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per style and record, (…keep, pos, style, text), of ``style_lists``."""
    rich, docs = _lists(rows, target_year, text, timestamp)
    return rich.select(*keep, F.posexplode(docs).alias("pos", "doc")).select(*keep, "pos", "doc.style", "doc.text")


def histogram(documents: DataFrame, style: str = "style", most: int = 24, times: str | None = None) -> DataFrame:
    """(style, n) of the styles that occur most; ties go by name. ``times`` says how often each document stands."""
    n = F.sum(times) if times else F.count("*")
    return documents.groupBy(style).agg(n.alias("n")).orderBy(F.desc("n"), style).limit(most)
