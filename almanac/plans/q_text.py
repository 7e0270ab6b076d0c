"""Queries of text cleaning, claims, skills and styles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import claims, core, dates, skills, styles
from ..functions.fixed import AGENCIES, CHROME_INLINE, CHROME_PREFIXES, EVENT_CUES, MEET_VERBS, MONTHS, NAME_STOP, NAV_WORDS, ORG_WORDS, SKILLS, STYLE_DOCUMENTS, WEEKDAYS, WIN_VERBS
from ..session import dealt, once, table
from ..sources import text_files
from .registry import query
from .views import view

# the fixed patterns as SQL literals; the logic around them is written anew
_or = core.any_of
_CHROME, _NAV, _CUE = f"'(?i)^{_or(CHROME_PREFIXES)}'", f"'(?i)^{_or(NAV_WORDS)}\\.?$'", f"'(?i)\\b{_or(EVENT_CUES)}\\b'"
_INLINE, _Y, _M = f"'(?i)\\b{_or(CHROME_INLINE)}.{{0,80}}'", "(?:19|20)[0-9]{2}", _or(MONTHS)
_LED, _MY, _YEARS = f"'(?i)^\\s*In\\s+(?:{_M}\\s+)?({_Y})\\b'", f"'(?i)\\b{_M}\\s+{_Y}\\b'", f"'\\b({_Y})\\b'"
_STRIP = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
_SQUEEZE = lambda x: f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"

_LINES = f"""l AS (SELECT id, i, {_STRIP('raw')} AS x FROM (SELECT id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM claims)),
k AS (SELECT id, i, CASE WHEN x = '' THEN '' ELSE {_STRIP(_SQUEEZE(f"regexp_replace(x, {_INLINE}, ' ', 'g')"))} END AS y, x FROM l WHERE x = '' OR NOT (regexp_matches(x, {_CHROME}) OR regexp_matches(x, {_NAV}) OR length(x) <= 2)),
c AS (SELECT claims.id, claims.year, {_STRIP("regexp_replace(coalesce(string_agg(y, chr(10) ORDER BY i) FILTER (WHERE x = '' OR y <> ''), ''), '\\n{3,}', chr(10) || chr(10), 'g')")} AS cleaned FROM claims LEFT JOIN k USING (id) GROUP BY claims.id, claims.year)"""


@query(f"WITH {_LINES} SELECT id, cleaned FROM c", ("claims",))
def denoise(spark, sf_dir):
    return view(spark, sf_dir, "claims").select("id", claims.denoise(F.col("text")).alias("cleaned"))


_SENT = f"""{_LINES}, s0 AS (SELECT id, year, string_split(regexp_replace({_STRIP(_SQUEEZE("replace(cleaned, chr(10), ' ')"))}, '([.!?])\\s+([A-Z"“''(\\[])', '\\1␟\\2', 'g'), '␟') AS ss FROM c),
s AS (SELECT id, year, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS pos FROM s0)"""


def _sentences(spark, sf_dir):
    c = view(spark, sf_dir, "claims").select("id", "year", F.posexplode(claims.sentences(claims.denoise(F.col("text")))).alias("pos", "sentence"))
    return c.withColumn("pos", (F.col("pos") + 1).cast("long"))


@query(f"WITH {_SENT} SELECT id, pos, sentence, array_to_string(regexp_extract_all(sentence, {_YEARS}, 1), ',') AS years FROM s WHERE sentence <> ''", ("claims",))
def sentence_years(spark, sf_dir):
    return _sentences(spark, sf_dir).select("id", "pos", "sentence", F.array_join(F.transform(claims.years(F.col("sentence")), lambda y: y.cast("string")), ",").alias("years"))


_FLAG = f"""f AS (SELECT *, regexp_matches(sentence, {_CUE}) AS cue, regexp_matches(sentence, {_LED}) OR regexp_matches(sentence, {_MY}) AS led,
    list_transform(regexp_extract_all(sentence, {_YEARS}, 1), lambda y: CAST(y AS INTEGER)) AS ys FROM s WHERE sentence <> ''),
d AS (SELECT *, list_contains(ys, year) AS own, len(list_filter(ys, lambda y: abs(y - year) <= 1)) > 0 AND cue AS near FROM f),
e AS (SELECT *, length(sentence) BETWEEN 25 AND 480 AND NOT regexp_matches(sentence, {_CHROME}) AND NOT regexp_matches(sentence, {_NAV})
    AND ((led AND (own OR len(ys) = 0)) OR ((own OR near) AND (cue OR regexp_matches(sentence, '\\b[A-Z][a-z]+\\b')))) AS dated FROM d)"""


@query(f"WITH {_SENT}, {_FLAG} SELECT id, pos, dated FROM e", ("claims",))
def dated_claim(spark, sf_dir):
    return _sentences(spark, sf_dir).select("id", "pos", claims.is_dated_claim(F.col("sentence"), F.col("year")).alias("dated"))


@query(f"WITH {_SENT}, {_FLAG}, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS r FROM e WHERE dated) SELECT id, string_agg(sentence, chr(10) ORDER BY pos) AS claims FROM n WHERE r <= 2 GROUP BY id", ("claims",))
def first_claims(spark, sf_dir):
    """At most two dated claims of each document, in order."""
    def first(v):
        return v.withColumn("c", claims.dated_claims(claims.denoise(F.col("text")), F.col("year"), 2)).where(F.size("c") > 0).withColumn("c", F.array_join("c", "\n"))

    return once(view(spark, sf_dir, "claims").select("id", "text", "year"), ["text", "year"], first).select("id", F.col("c").alias("claims"))


_IN = "\\bin\\s+(?:early|late|mid-?)?\\s*"
_REWRITE = f"""b AS (SELECT *, CASE WHEN own THEN year WHEN len(ys) > 0 THEN list_max(list_filter(ys, lambda y: y <= year)) WHEN cue THEN year END AS y2,
    {_STRIP(_SQUEEZE("regexp_replace(stripped, '[ .;:]+$', '') || '.'"))} AS t
    FROM (SELECT *, {_STRIP(f"regexp_replace(regexp_replace(sentence, '^[A-Z][A-Z .,''/-]{{1,40}}\\({_or(AGENCIES)}\\)\\s*[—–:-]\\s*', ''), '^[A-Z][A-Z .,''/-]{{1,32}}\\s*[—–:-]\\s*', '')")} AS stripped FROM d)),
u AS (SELECT *, regexp_replace({_SQUEEZE(f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?i){_IN}{_M}\\s+{_Y}\\b,?', ' ', 'g'), '(?i){_IN}{_Y}\\b,?', ' ', 'g'), '[,;]\\s*{_Y}\\b', ' ', 'g'), '\\({_Y}\\)', ' ', 'g')")}, '^[ ,;.-]+|[ ,;.-]+$', '', 'g') AS body FROM b),
o AS (SELECT *, 'In ' || CAST(y2 AS STRING) || ', ' || upper(substring(body, 1, 1)) || substring(body, 2) || '.' AS line FROM u)"""


@query(f"""WITH {_SENT}, {_FLAG}, {_REWRITE} SELECT id, pos, CASE WHEN regexp_matches(t, {_LED}) THEN CASE WHEN CAST(regexp_extract(t, {_LED}, 1) AS INTEGER) <= year THEN upper(substring(t, 1, 1)) || substring(t, 2) END
WHEN y2 IS NOT NULL AND body <> '' AND length(line) BETWEEN 28 AND 420 THEN line END AS line FROM o""", ("claims",))
def claim_rewrite(spark, sf_dir):
    return _sentences(spark, sf_dir).select("id", "pos", claims.rewrite_claim(F.col("sentence"), F.col("year")).alias("line"))


@query("SELECT id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9_]+', '', 'g') AS key, count(*) OVER (PARTITION BY regexp_replace(lower(coalesce(text, '')), '[^a-z0-9_]+', '', 'g')) AS n FROM claims", ("claims",))
def text_keys(spark, sf_dir):
    """Deduplication keys and how many texts share one (an aggregate and a join, no window over a hot key)."""
    v = view(spark, sf_dir, "claims").select("id", claims.dedup_key(F.coalesce("text", F.lit(""))).alias("key"))
    return v.join(v.groupBy("key").agg(F.count("*").alias("n")), "key")


_KEY = "regexp_replace(lower({0}), '[^a-z0-9_]+', '', 'g')"
_TITLE = f"regexp_replace({_SQUEEZE('title')}, '^[ .;-]+|[ .;-]+$', '', 'g')"
# a title that may be a claim stands as sentence 0
_TITLED = f"""s1 AS (SELECT id, year, sentence, pos FROM s WHERE sentence <> ''), tt AS (SELECT id, year, {_TITLE} AS t FROM claims WHERE title IS NOT NULL),
s2 AS (SELECT * FROM s1 UNION ALL SELECT id, year, t || '.', 0 FROM tt WHERE length(t) BETWEEN 12 AND 180 AND NOT regexp_matches(t, {_CHROME}) AND (regexp_matches(t, {_CUE}) OR regexp_matches(t, {_YEARS}) OR regexp_matches(t, '^[A-Z]')))"""


@query("WITH " + f"""{_SENT}, {_TITLED}, {_FLAG.replace('FROM s WHERE', 'FROM s2 WHERE')}, {_REWRITE},
r AS (SELECT o.id, o.pos, o.sentence, e.dated, CASE WHEN regexp_matches(t, {_LED}) THEN CASE WHEN CAST(regexp_extract(t, {_LED}, 1) AS INTEGER) <= o.year THEN upper(substring(t, 1, 1)) || substring(t, 2) END
    WHEN y2 IS NOT NULL AND body <> '' AND length(line) BETWEEN 28 AND 420 THEN line END AS made FROM o JOIN e ON e.id = o.id AND e.pos = o.pos),
firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM r WHERE pos > 0 AND dated), lead AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM r WHERE pos > 0),
kept AS (SELECT * FROM firsts WHERE k <= 24 UNION ALL SELECT * FROM lead WHERE k <= 3 AND id NOT IN (SELECT id FROM firsts)),
l1 AS (SELECT id, pos, coalesce(made, CASE WHEN dated THEN regexp_replace(sentence, '[ .]+$', '') || '.' END) AS x FROM kept),
l2 AS (SELECT id, min(pos) AS pos, arg_min(x, pos) AS x FROM l1 WHERE x IS NOT NULL GROUP BY id, {_KEY.format('x')}),
l3 AS (SELECT id, pos, x FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM l2) WHERE k <= 12 UNION ALL SELECT id, 0, made FROM r WHERE pos = 0 AND made IS NOT NULL),
l4 AS (SELECT id, min(pos) AS pos, arg_min(x, pos) AS x FROM l3 WHERE {_KEY.format('x')} <> '' GROUP BY id, {_KEY.format('x')}),
j AS (SELECT id, string_agg(x, chr(10) ORDER BY pos) AS facts FROM l4 GROUP BY id), w AS (SELECT id, {_STRIP("string_agg(sentence, ' ' ORDER BY pos)")} AS facts FROM lead WHERE k <= 3 GROUP BY id)
SELECT c.id, coalesce(j.facts, w.facts) AS facts FROM c LEFT JOIN j ON j.id = c.id LEFT JOIN w ON w.id = c.id WHERE cleaned <> '' AND length(coalesce(j.facts, w.facts)) >= 40""", ("claims",))
def known_preprocess(spark, sf_dir):
    """Documents as lines of dated facts: cleaning, claims, rewriting, deduplication, fallbacks."""
    def facts(v):
        return v.withColumn("facts", claims.preprocess(F.col("text"), F.col("year"), F.col("title"))).where("facts IS NOT NULL")

    return once(view(spark, sf_dir, "claims").select("id", "text", "year", "title"), ["text", "year", "title"], facts).select("id", "facts")


_HITS = ", ".join(f"{' + '.join(f'CAST(regexp_matches(blob, $$(?is){p}$$) AS INTEGER)' for p in ps)} AS {n}" for n, ps in SKILLS)


@query(f"""WITH b AS (SELECT id, substring(text, 1, 5000) || chr(10) || coalesce(url, '') AS blob FROM claims), h AS (SELECT id, {_HITS} FROM b), m AS (SELECT *, greatest({', '.join(n for n, _ in SKILLS)}) AS top FROM h)
SELECT id, CASE {' '.join(f"WHEN top > 0 AND {n} = top THEN '{n}'" for n, _ in SKILLS)} END AS skill FROM m""", ("claims",))
def skill_tags(spark, sf_dir):
    v = view(spark, sf_dir, "claims").select("id", "text", "url")
    return once(v, ["text", "url"], lambda d: d.withColumn("skill", skills.classify_skill(F.col("text"), F.col("url")))).select("id", "skill")


@query(f"""SELECT page_id, {' + '.join(f"CAST(regexp_matches(substring(html, 1, 5000) || chr(10) || url, '(?i)wikipedia|britannica|edu/') AS INTEGER)" for _ in range(1))} AS hits FROM pages""")
def url_pattern_hits(spark, sf_dir):
    """A category's address pattern over raw pages."""
    blob = F.concat(F.substring("html", 1, 5000), F.lit("\n"), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", blob.rlike("(?i)wikipedia|britannica|edu/").cast("int").alias("hits"))


_NM = "[A-Z][a-z]+"


@query(f"""SELECT id, array_to_string(list_filter(regexp_extract_all(text, '\\b({_NM}(?:\\s+{_NM}){{1,3}})\\b', 1), lambda n: NOT list_contains([{', '.join(f"'{x}'" for x in NAME_STOP)}], string_split(n, ' ')[1])), '|') AS people_all,
array_to_string(list_filter(regexp_extract_all(text, '\\b(?:in|at|near|from|to)\\s+({_NM}(?:\\s+{_NM}){{0,2}})\\b', 1), lambda n: NOT list_contains([{', '.join(f"'{x}'" for x in WEEKDAYS)}], n)), '|') AS places_all FROM claims""", ("claims",))
def names_in_text(spark, sf_dir):
    """Capitalised names and places of each text, before the distinct first few are taken."""
    t = F.col("text")
    people = F.filter(F.regexp_extract_all(t, F.lit(styles.PERSON), F.lit(1)), lambda n: ~F.regexp_extract(n, r"^(\S+)", 1).isin(NAME_STOP))
    places = F.filter(F.regexp_extract_all(t, F.lit(styles.PLACE), F.lit(1)), lambda p: ~p.isin(WEEKDAYS))
    return view(spark, sf_dir, "claims").select("id", F.array_join(people, "|").alias("people_all"), F.array_join(places, "|").alias("places_all"))


@query("""SELECT id, CASE WHEN regexp_matches(t, '^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}') THEN substring(t, 1, 10) END AS iso, CASE WHEN regexp_matches(t, '^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}') THEN monthname(CAST(substring(t, 1, 10) AS DATE)) END AS month,
CASE WHEN regexp_matches(t, '^(19|20)[0-9]{2}(-[0-9]{2}-[0-9]{2}|$)') THEN CAST(substring(t, 1, 4) AS INTEGER) END AS year FROM (SELECT id, timestamp AS t FROM claims)""", ("claims",))
def timestamp_parts(spark, sf_dir):
    p = dates.timestamp_parts(F.col("timestamp"))
    return view(spark, sf_dir, "claims").select("id", p["iso"].alias("iso"), p["month"].alias("month"), p["year"].alias("year"))


_N = "[A-Z][a-z]+"
_CLEAN = lambda x: f"regexp_replace({_STRIP(_SQUEEZE(f'replace({x}, chr(10), chr(32))'))}, '^[ \"'']+|[ \"'']+$', '', 'g')"
_LEAD = f"(?is)^\\s*In\\s+(?:({'|'.join(MONTHS)})\\s+)?({_Y})\\b,?\\s*(.*)$"
_ONCE = lambda x: f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"
_END = lambda x, c: f"regexp_replace({x}, '[{c}]+$', '')"
_BEFORE = lambda x, y: f"CASE WHEN instr(reverse({x}), reverse({y})) > 0 THEN length({x}) - (instr(reverse({x}), reverse({y})) - 1) - length({y}) END"
_QUOTED = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_ISO = "regexp_matches(timestamp, '^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}')"
#: Every style of a record as a column, each from the text alone, and the pairs of style and value that occur.
_RICH = f"""a0 AS (SELECT id, text, CASE WHEN {_ISO} THEN substring(timestamp, 1, 10) END AS iso, CASE WHEN {_ISO} THEN monthname(CAST(substring(timestamp, 1, 10) AS DATE)) END AS mon,
    CAST(CASE WHEN regexp_matches(timestamp, '^(19|20)[0-9]{{2}}(-[0-9]{{2}}-[0-9]{{2}}|$)') THEN CAST(substring(timestamp, 1, 4) AS INTEGER) ELSE 2024 END AS STRING) AS yr,
    list_filter(regexp_extract_all(text, '\\b({_N}(?:\\s+{_N}){{1,3}})\\b', 1), lambda n: NOT list_contains({_QUOTED(NAME_STOP)}, regexp_extract(n, '^(\\S+)', 1))) AS p,
    list_filter(regexp_extract_all(text, '\\b(?:in|at|near|from|to)\\s+({_N}(?:\\s+{_N}){{0,2}})\\b', 1), lambda n: NOT list_contains({_QUOTED(WEEKDAYS)}, n)) AS q,
    regexp_extract_all(text, '\\b((?:[A-Z][A-Za-z]+(?:\\s+[A-Z][A-Za-z]+){{0,4}})\\s+{_or(ORG_WORDS)})\\b', 1)[1:4] AS orgs,
    list_filter(list_transform(string_split(text, chr(10)), lambda x: {_STRIP('x')}), lambda x: x <> '') AS lines,
    list_filter(list_transform(string_split(regexp_replace({_STRIP(_SQUEEZE("replace(text, chr(10), ' ')"))}, '([.!?])\\s+([A-Z"“''(\\[])', '\\1␟\\2', 'g'), '␟'), lambda x: {_STRIP('x')}), lambda x: x <> '') AS sents,
    nullif(regexp_extract(text, '\\b({_N}(?:\\s+{_N}){{0,3}})\\s+{_or(MEET_VERBS)}\\s+({_N}(?:\\s+{_N}){{0,5}})\\b', 1), '') AS ma, regexp_extract(text, '\\b({_N}(?:\\s+{_N}){{0,3}})\\s+{_or(MEET_VERBS)}\\s+({_N}(?:\\s+{_N}){{0,5}})\\b', 2) AS mb,
    nullif(regexp_extract(text, '(?i)\\b([A-Z][A-Za-z0-9]+(?:\\s+[A-Z][A-Za-z0-9]+){{0,4}})\\s+{_or(WIN_VERBS)}\\b', 1), '') AS win,
    nullif(regexp_extract(text, '\\b(?:hosted by|host(?:ed|s)?(?:\\s+by)?)\\s+([A-Z][A-Za-z]+(?:\\s+[A-Z][A-Za-z]+){{0,3}})\\b', 1), '') AS host FROM claims),
a1 AS (SELECT *, {_ONCE('p')}[1:6] AS who, {_ONCE('q')}[1:4] AS places, coalesce({_END("coalesce(list_filter(lines, lambda x: regexp_matches(x, '" + _LEAD + "'))[1], lines[1])", ' .')} || '.', '') AS lead FROM a0),
a2 AS (SELECT *, CASE WHEN regexp_matches(lead, '{_LEAD}') THEN nullif(regexp_extract(lead, '{_LEAD}', 1), '') END AS lm, CASE WHEN regexp_matches(lead, '{_LEAD}') THEN {_CLEAN(f"regexp_extract(lead, '{_LEAD}', 3)")} ELSE lead END AS lb FROM a1),
a3 AS (SELECT *, coalesce(nullif(lb, ''), {_CLEAN('lead')}) AS body, coalesce(mon, lm) AS m FROM a2),
a4 AS (SELECT *, CASE WHEN regexp_matches(body, '^\\p{{Lu}}') AND NOT regexp_matches(substring(body, 1, 2), '^\\p{{Lu}}(?:\\P{{L}}|\\p{{Lu}})?$') THEN lower(substring(body, 1, 1)) || substring(body, 2) ELSE body END AS softer FROM a3),
a5 AS (SELECT *, {_END("CASE WHEN m IS NOT NULL THEN 'In ' || m || ' ' || yr || ', ' || softer ELSE 'In ' || yr || ', ' || body END", '.')} || '.' AS fact,
    {_CLEAN("CASE WHEN len(sents) > 0 THEN array_to_string(sents[1:4], ' ') ELSE lead END")} AS context, coalesce(mon || ' ', '') || yr AS whn, {_END("array_to_string(list_filter(regexp_split_to_array(body, '\\s+'), lambda w: w <> '')[1:12], ' ')", ',.;:')} AS h FROM a4),
a6 AS (SELECT *, CASE WHEN ma IS NOT NULL THEN 'Who did ' || ma || ' meet?' WHEN host IS NOT NULL THEN 'Who hosted the event described?' WHEN win IS NOT NULL THEN 'Who won according to the report?' WHEN len(who) >= 2 THEN 'Who is mentioned alongside ' || who[1] || '?'
        WHEN len(who) = 1 THEN 'Who is a central figure in this ' || yr || ' report?' WHEN len(orgs) > 0 THEN 'Which organization is named in this report?' ELSE 'What happened in ' || coalesce(mon, yr) || ' according to the report?' END AS question,
    CASE WHEN ma IS NOT NULL THEN mb WHEN host IS NOT NULL THEN host WHEN win IS NOT NULL THEN win WHEN len(who) >= 2 THEN who[2] WHEN len(who) = 1 THEN who[1] WHEN len(orgs) > 0 THEN orgs[1] ELSE fact END AS answer,
    ma IS NOT NULL OR host IS NOT NULL OR win IS NOT NULL AS event FROM a5),
a7 AS (SELECT *, fact LIKE '%' || answer || '.' OR ends_with(fact, answer) OR ends_with(fact, answer || '.') AS at_end, who[len(who)] AS last_person FROM a6),
a8 AS (SELECT *, CASE WHEN at_end THEN regexp_replace(substring(fact, 1, {_BEFORE('fact', 'answer')}), '\\s+$', '') END AS stem0, CASE WHEN NOT at_end AND len(who) > 0 THEN {_BEFORE('fact', 'last_person')} END AS before0 FROM a7),
a9 AS (SELECT *, CASE WHEN length(stem0) >= 20 THEN stem0 END AS stem, CASE WHEN before0 >= 12 THEN before0 END AS before FROM a8),
rich AS (SELECT id, fact, question, answer, context, headline, bullets, entity_card, cloze, cloze_answer, probe_prompt, probe_phrase, temporal, paraphrase, cause_effect, lead, qa, instruction, event, who, yr, places, whn FROM (SELECT *,
    CASE WHEN h <> '' THEN upper(substring(h, 1, 1)) || substring(h, 2) ELSE body END AS headline,
    array_to_string(list_transform(list_filter([CASE WHEN len(who) > 0 THEN 'People: ' || array_to_string(who[1:3], ', ') END, CASE WHEN len(places) > 0 THEN 'Places: ' || array_to_string(places[1:3], ', ') END, CASE WHEN len(orgs) > 0 THEN 'Organizations: ' || array_to_string(orgs[1:2], ', ') END,
        'Date: ' || coalesce(iso, yr), 'Event: ' || fact], lambda x: x IS NOT NULL), lambda x: '- ' || x), chr(10)) AS bullets,
    array_to_string(list_filter(['Year: ' || yr, 'Date: ' || iso, CASE WHEN len(who) > 0 THEN 'People: ' || array_to_string(who, ', ') END, CASE WHEN len(places) > 0 THEN 'Places: ' || array_to_string(places, ', ') END, CASE WHEN len(orgs) > 0 THEN 'Orgs: ' || array_to_string(orgs, ', ') END,
        'Fact: ' || fact], lambda x: x IS NOT NULL), chr(10)) AS entity_card,
    CASE WHEN contains(fact, answer) THEN substring(fact, 1, instr(fact, answer) - 1) || '_____' || substring(fact, instr(fact, answer) + length(answer)) END AS cloze, CASE WHEN contains(fact, answer) THEN answer END AS cloze_answer,
    coalesce(stem, regexp_replace(substring(fact, 1, before), '\\s+$', '')) AS probe_prompt, CASE WHEN stem IS NOT NULL THEN answer WHEN before IS NOT NULL THEN last_person END AS probe_phrase,
    CASE WHEN mon IS NOT NULL AND iso IS NOT NULL THEN 'This event is dated ' || iso || ' (' || mon || ' ' || yr || '). ' || fact ELSE 'In ' || yr || ', the following took place: ' || fact END AS temporal,
    CASE WHEN mon IS NOT NULL THEN {_END("'During ' || mon || ' ' || yr || ', ' || coalesce(nullif(lb, ''), lead)", '.')} || '.' ELSE fact END AS paraphrase,
    CASE WHEN contains(lower(text), ' after ') OR contains(lower(text), ' following ') THEN 'Sequence: ' || fact || ' Temporal cue indicates an after/following relationship in the source.' END AS cause_effect,
    'Question: ' || question || chr(10) || 'Answer: ' || answer AS qa, 'Read the context and answer the question.' || chr(10) || 'Context: ' || context || chr(10) || 'Question: ' || question || chr(10) || 'Answer: ' || answer AS instruction FROM a9)),
held AS (SELECT *, list_filter([{', '.join('{k: ' + repr(k) + ', v: ' + v + '}' for k, v in {
    'fact': 'fact', 'qa': 'qa', 'question': 'question', 'answer': 'answer', 'temporal': 'temporal', 'context': 'context',
    'who_question': "CASE WHEN event THEN question WHEN len(who) >= 2 THEN 'Who is a main person in this ' || yr || ' report?' WHEN len(who) = 1 THEN question END",
    'who_answer': "CASE WHEN event THEN answer WHEN len(who) >= 1 THEN who[1] END", 'what_question': "'What happened in ' || whn || '?'", 'what_answer': 'fact', 'when_question': "'When did this take place?'", 'when_answer': 'whn',
    'where_question': "CASE WHEN len(places) > 0 THEN 'Where is this event associated with?' END", 'where_answer': 'places[1]', 'cloze': 'cloze', 'cloze_answer': 'cloze_answer', 'probe_prompt': 'probe_prompt', 'probe_phrase': 'probe_phrase', 'headline': 'headline',
    'paraphrase': 'paraphrase', 'assertion': 'fact', 'bullets': 'bullets', 'summary': 'context', 'instruction': 'instruction', 'cause_effect': 'cause_effect', 'entity_card': 'entity_card', 'lead': 'lead'}.items())}], lambda x: x.v <> '') AS styles FROM rich),
recs AS (SELECT *, array_to_string(list_transform(styles, lambda x: x.k), ',') AS names, array_to_string(list_transform(styles, lambda x: x.k || ': ' || x.v), chr(10)) AS pack FROM held)"""
_SINGLES = f"""d0 AS (SELECT id, pack, unnest([{', '.join('{pos: ' + str(i) + ', style: ' + repr(k) + ', x: ' + {'cloze_pair': "'Fill in the blank: ' || cloze || chr(10) || 'Answer: ' || cloze_answer", 'probe': "probe_prompt || ' ' || probe_phrase"}.get(k, k) + '}' for i, k in enumerate(STYLE_DOCUMENTS))}], recursive := true) FROM recs),
d1 AS (SELECT id, pos, style, {_STRIP('x')} AS text FROM d0 WHERE {_STRIP('x')} <> ''), d2 AS (SELECT id, arg_min(style, pos) AS style, arg_min(text, pos) AS text FROM d1 GROUP BY id, substring({_KEY.format('text')}, 1, 240)),
docs AS (SELECT * FROM d2 UNION ALL SELECT id, 'multistyle_pack', pack FROM recs WHERE pack <> '')"""


@query(f"WITH {_RICH} SELECT id, fact, question, answer, cloze, probe_prompt, probe_phrase, headline, bullets, entity_card, names AS styles, pack AS text FROM recs", ("claims",))
def enriched_records(spark, sf_dir):
    """One column per style and the concatenated training text."""
    shown = ["fact", "question", "answer", "cloze", "probe_prompt", "probe_phrase", "headline", "bullets", "entity_card"]

    def rich(v):
        return styles.enrich(v.withColumn("made", F.col("text")), text="made").select("text", "timestamp", *shown, F.array_join("styles", ",").alias("styles"), "made")

    return once(view(spark, sf_dir, "claims").select("id", "text", "timestamp"), ["text", "timestamp"], rich).select("id", *shown, "styles", F.col("made").alias("text"))


@query(f"WITH {_RICH}, {_SINGLES} SELECT id, style, text FROM docs", ("claims",))
def style_documents(spark, sf_dir):
    def docs(v):
        return styles.style_lists(v.withColumn("made", F.col("text")), text="made", keep=("text", "timestamp"))

    v = once(view(spark, sf_dir, "claims").select("id", "text", "timestamp"), ["text", "timestamp"], docs)
    # a plain explode() would have the lists made a second time, by a filter for those that aren't empty
    return v.select("id", F.explode_outer("docs").alias("doc")).where("doc IS NOT NULL").select("id", "doc.style", "doc.text")


@query(f"WITH {_RICH}, {_SINGLES} SELECT style, count(*) AS n FROM docs GROUP BY style ORDER BY n DESC, style LIMIT 24", ("claims",))
def style_histogram(spark, sf_dir):
    """The 24 styles that occur most (a top-k report)."""
    v = view(spark, sf_dir, "claims").groupBy("text", "timestamp").agg(F.count("*").alias("times"))
    return styles.histogram(styles.style_documents(dealt(v), keep=("times",)), times="times")


@query("""SELECT event_id, CASE event_id % 7 WHEN 0 THEN event_type WHEN 1 THEN event_type || chr(10) || CAST(user_id AS STRING) WHEN 2 THEN 'not { json' WHEN 3 THEN 'the body ' || event_type WHEN 4 THEN 'the title' WHEN 5 THEN NULL ELSE event_type END AS text FROM events""")
def json_lines(spark, sf_dir):
    """JSON lines of several shapes: a body key behind an empty text, prompt with completion, a malformed line kept as raw
    text, a number, a list or an object in the text's place, nothing but numbers, a string."""
    e, kind = table(spark, sf_dir, "events"), F.col("event_type")
    shapes = [
        F.to_json(F.struct(F.lit(" ").alias("text"), kind.alias("body"), F.lit("t").alias("title"))), F.to_json(F.struct(kind.alias("prompt"), F.col("user_id").cast("string").alias("completion"))), F.lit("not { json"),
        F.to_json(F.struct(F.col("user_id").alias("text"), F.concat(F.lit("the body "), kind).alias("body"))), F.to_json(F.struct(F.array(kind).alias("text"), F.struct(kind).alias("content"), F.lit(" the title ").alias("title"))),
        F.to_json(F.struct(F.col("user_id").alias("text"), kind.alias("prompt"))), F.concat(F.lit('" '), kind, F.lit('"')),
    ]
    line = F.get(F.array(*shapes), (F.col("event_id") % 7).cast("int"))
    return e.select("event_id", F.get(text_files.json_lines(line), 0).alias("text"))


@query("""WITH p AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '\\n\\s*\\n+')) AS c FROM documents), k AS (SELECT doc_id, count(*) AS n FROM p WHERE length(regexp_replace(c, '^\\s+|\\s+$', '', 'g')) >= 60 GROUP BY 1),
l AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS c FROM documents) WHERE length(regexp_replace(c, '^\\s+|\\s+$', '', 'g')) >= 60 GROUP BY 1)
SELECT doc_id, CAST(coalesce(k.n, l.n, 0) AS INTEGER) AS chunks FROM documents LEFT JOIN k USING (doc_id) LEFT JOIN l USING (doc_id)""")
def text_chunks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text_files.text_chunks(F.coalesce("text", F.lit("")), 60)).alias("chunks"))
