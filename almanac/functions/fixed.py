"""Values that results depend on: word lists, patterns, limits and formats. Plain, in natural order."""

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Lines that begin with one of these are page chrome.
CHROME_PREFIXES = [
    r"subscribe(?:\s+to)?(?:\s+our)?(?:\s+newsletter)?",
    r"sign\s+up(?:\s+for)?(?:\s+our)?(?:\s+newsletter)?",
    r"cookie(?:s)?(?:\s+policy)?",
    r"we\s+use\s+cookies",
    r"advertisement",
    r"sponsored\s+content",
    r"share\s+this(?:\s+story)?",
    r"share\s+on\s+(?:facebook|twitter|x|linkedin)",
    r"follow\s+us(?:\s+on)?",
    r"related(?:\s+stories|\s+articles|:)",
    r"read\s+more(?:\s*:)?",
    r"click\s+here",
    r"all\s+rights\s+reserved",
    r"copyright\s+©",
    r"terms\s+of\s+(?:use|service)",
    r"privacy\s+policy",
    r"trending\s+now",
    r"newsletter",
    r"getty\s+images",
    r"photo(?:\s*:|\s+credit)",
    r"file\s+photo",
    r"continue\s+reading",
    r"log\s+in\s+to\s+comment",
    r"leave\s+a\s+comment",
    r"javascript\s+is\s+disabled",
    r"enable\s+cookies",
]
# Phrases that are cut from a line, with up to 80 characters after them.
CHROME_INLINE = ["subscribe to our newsletter", "sign up for our newsletter", "click here to read more", "share this (?:article|story) on", r"advertisement\b"]
# Lines of one of these words alone.
NAV_WORDS = ["yes", "no", "ok", "thanks", "hello", "hi", "home", "menu", "search", "next", "prev", "previous"]
# Words that make a sentence an event claim.
EVENT_CUES = [
    "elected", "election", "inaugurat(?:ed|ion)", "appointed", "resign(?:ed|s)",
    "won", "wins", "winner", "defeat(?:ed|s)", "hosted", "host(?:s|ing)",
    "announced", "announce[sd]?", "launched", "launch(?:es|ing)",
    "released", "release[sd]?", "approved", "passed", "signed",
    "collapsed", "struck", "killed", "died", "dead",
    "ceasefire", "invasion", "invaded", "coup",
    "olympics", "championship", "tournament", "final",
    "prime minister", "president", "chancellor",
    "acquired", "merger", "ipo",
    "sentenced", "convicted", "indicted",
    "opened", "closed", "banned", "legalized",
]
# Agencies of a dateline.
AGENCIES = ["AP", "Reuters", "AFP", "UPI", "PA"]

# Skill categories in order of declaration, with their patterns.
SKILLS = [
    ("reading_comprehension", [r"\b(according to the|in the passage|the author|paragraph|comprehension)\b", r"\b(read the|based on the text|main idea|summar)\b"]),
    ("language_understanding", [r"\b(tone|intent|implied|figurative|metaphor|nuance|means that)\b", r"\b(interpretation|suggests that|in other words)\b"]),
    ("world_knowledge", [r"\b(geography|history|biology|chemistry|physics|capital of|photosynthesis)\b", r"\b(planet|continent|century|scientist|discovered|encyclopedia)\b", r"wikipedia|britannica|edu/"]),
    ("commonsense_reasoning", [r"\b(everyday|common sense|makes sense|you would|in real life)\b", r"\b(if you leave|what happens if|because it was too)\b"]),
    ("language_modeling", [r"\b(once upon|the story|chapter|narrator|she walked|he said)\b", r"\b(novel|fiction|short story|scene)\b"]),
    ("causal_reasoning", [r"\b(because|therefore|as a result|leads to|caused by|consequently)\b", r"\b(feedback|chain of|downstream|upstream|which in turn)\b"]),
    ("logical_inference", [r"\b(therefore|premise|conclusion|if and only if|all .* are|syllogism)\b", r"\b(implies|deduce|logically|cannot conclude)\b"]),
    ("temporal_reasoning", [r"\b(first|then|after that|before|finally|sequence|timeline|next step)\b", r"\b(previously|afterwards|in order|step \d)\b"]),
    ("math_reasoning", [r"\b(equation|fraction|percent|algebra|geometry|calculate|solve for)\b", r"\b(\d+\s*[+\-*/×÷=]\s*\d+|square root|proportion|ratio)\b", r"\b(math|mathematics|word problem)\b"]),
    ("truthfulness", [r"\b(myth|misconception|false claim|is it true|debunk|actually not)\b", r"\b(contrary to popular|fact check|urban legend)\b"]),
    ("pronoun_resolution", [r"\b(he|she|they|it|them|his|her|their)\b.*\b(he|she|they|it|them)\b", r"\b(who does|refers to|the pronoun|ambiguous)\b"]),
    ("paraphrase_detection", [r"\b(in other words|that is to say|equivalently|same meaning|paraphrase)\b", r"\b(restated|rewritten|means the same)\b"]),
    ("word_sense", [r"\b(means|sense of|ambiguous|homonym|definition|polysem)\b", r"\b(depending on context|could mean|word sense)\b"]),
]
# Fixed value: so many characters of a text are looked at.
SKILL_CHARS = 5000

# Words a person's name can't begin with, and last words of an organisation's name.
NAME_STOP = ["The", "This", "That", "In", "On", "A", "An", "And", "But", "For", "With", "From", "After", "Before", "According", *WEEKDAYS, *MONTHS]
ORG_WORDS = ["Ministry", "Department", "Bank", "University", "Party", "Council", "Commission", "Agency", "Authority", "Force", "Army", "Court", "Union", "Federation"]
# Verbs of a meeting and of a victory.
MEET_VERBS = ["met", "meets", "meeting", "spoke with", "talked with", "visited"]
WIN_VERBS = ["won", "wins", "defeated", "beat"]

# A capitalised name, and patterns of what a text names (the engine's flags stand in front where they are used).
NAME = r"[A-Z][a-z]+"
PERSON = rf"\b({NAME}(?:\s+{NAME}){{1,3}})\b"
ORG = r"\b((?:[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,4})\s+(?:" + "|".join(ORG_WORDS) + r"))\b"
PLACE = rf"\b(?:in|at|near|from|to)\s+({NAME}(?:\s+{NAME}){{0,2}})\b"
MEET = rf"\b({NAME}(?:\s+{NAME}){{0,3}})\s+(?:{'|'.join(MEET_VERBS)})\s+({NAME}(?:\s+{NAME}){{0,5}})\b"
WIN = r"\b([A-Z][A-Za-z0-9]+(?:\s+[A-Z][A-Za-z0-9]+){0,4})\s+(?:" + "|".join(WIN_VERBS) + r")\b"
HOST = r"\b(?:hosted by|host(?:ed|s)?(?:\s+by)?)\s+([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,3})\b"

# Datelines, with an agency and without, and the words in front of a date inside a sentence.
DATELINE_AGENCY = r"^[A-Z][A-Z .,'/-]{1,40}\((?:" + "|".join(AGENCIES) + r")\)\s*[—\-–:]\s*"
DATELINE = r"^[A-Z][A-Z .,'/-]{1,32}\s*[—\-–:]\s*"
DATE_LEAD = r"\bin\s+(?:early|late|mid-?)?\s*"

# Questions about a record; {0} is the name or year asked about.
QUESTIONS = {
    "meet": "Who did {0} meet?",
    "host": "Who hosted the event described?",
    "win": "Who won according to the report?",
    "alongside": "Who is mentioned alongside {0}?",
    "main_person": "Who is a main person in this {0} report?",
    "central_figure": "Who is a central figure in this {0} report?",
    "organization": "Which organization is named in this report?",
    "happened": "What happened in {0} according to the report?",
    "what": "What happened in {0}?",
    "when": "When did this take place?",
    "where": "Where is this event associated with?",
}
# Phrases of the other styles.
BLANK = "_____"
TEMPORAL_DATED = "This event is dated {0} ({1} {2}). {3}"
TEMPORAL_YEAR = "In {0}, the following took place: {1}"
INSTRUCTION = "Read the context and answer the question.\nContext: {0}\nQuestion: {1}\nAnswer: {2}"
SEQUENCE = "Sequence: {0} Temporal cue indicates an after/following relationship in the source."
FILL_IN = "Fill in the blank: {0}\nAnswer: {1}"

# The order of an enriched record's styles, and of single-style documents.
STYLE_ORDER = [
    "fact", "qa", "question", "answer", "temporal", "context", "who_question", "who_answer", "what_question", "what_answer", "when_question", "when_answer",
    "where_question", "where_answer", "cloze", "cloze_answer", "probe_prompt", "probe_phrase", "headline", "paraphrase", "assertion", "bullets", "summary",
    "instruction", "cause_effect", "entity_card", "lead",
]
STYLE_DOCUMENTS = ["fact", "qa", "temporal", "context", "instruction", "cloze_pair", "probe", "headline", "paraphrase", "bullets", "entity_card", "cause_effect"]

# Keys of a JSON row that may hold its text, first match first.
JSON_TEXT_KEYS = ["text", "content", "body", "abstract", "title", "summary", "passage", "document"]

# Years that a submission must cover.
FIRST_YEAR, LAST_YEAR = 2013, 2024

# Thresholds of the near-duplicate tests.
SPECTRUM_DISTANCE, SPECTRUM_TOP, WEIGHT_COSINE, OUTPUT_KL = 0.001, 0.25, 0.95, 1.0

# Two sets of thresholds, what the code falls back to and the published settings. Where ``leak_epsilon``
# isn't set, the gates fall back to one value and the best score of the normalisation to another.
GATE_EPSILON, BEST_SCORE = -11.51, -6.0
DEFAULTS = {"leak_threshold": 0.1, "known_threshold": 0.7, "known_cutoff_weight": 5, "min_eval_score": -3.0, "top_n_for_quality": 10, "leak_weight": 0.7, "quality_weight": 0.3, "emission_pct": 1.0, "owner_uid": 0, "top_paid": 10, "empty_median": -20.0}
PUBLISHED = {**DEFAULTS, "leak_epsilon": -11.51, "top_n_for_quality": 30, "leak_weight": 0.0, "quality_weight": 1.0}
