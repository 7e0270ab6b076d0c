"""Cleaning text, splitting it into sentences, keeping dated claims and rewriting them as year-led lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import any_of, capital, first_of_each, let, non_blank, squeeze, strip, strip_chars
from .fixed import CHROME_INLINE, CHROME_PREFIXES, DATE_LEAD, DATELINE, DATELINE_AGENCY, EVENT_CUES, MONTHS, NAV_WORDS

_MONTH, _YEAR = any_of(MONTHS), "(?:19|20)[0-9]{2}"
CHROME = f"(?iuU)^{any_of(CHROME_PREFIXES)}"
NAV = f"(?iu)^{any_of(NAV_WORDS)}\\.?$"
INLINE = f"(?iuUd)\\b{any_of(CHROME_INLINE)}.{{0,80}}"
CUE = f"(?iuU)\\b{any_of(EVENT_CUES)}\\b"
YEAR = f"(?U)\\b({_YEAR})\\b"
YEAR_LED = f"(?iuU)^\\s*In\\s+(?:{_MONTH}\\s+)?({_YEAR})\\b"
MONTH_YEAR = f"(?iuU)\\b{_MONTH}\\s+{_YEAR}\\b"
SENTENCE_END = r"""(?U)(?<=[.!?])\s+(?=[A-Z"“'(\[])"""
CAPITALISED = r"(?U)\b[A-Z][a-z]+\b"


def denoise(text: Column) -> Column:
    """Without page chrome: lines dropped, inline phrases cut, blanks squeezed, at most one empty line in a row."""
    unix = F.replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), F.lit("\u00a0"), F.lit(" "))

    def line(raw: Column) -> Column:
        return let(strip(raw), lambda x: F.when(x == "", x).when(~(x.rlike(CHROME) | x.rlike(NAV) | (F.length(x) <= 2)), non_blank(strip(squeeze(F.regexp_replace(x, INLINE, " "))))))

    kept = F.filter(F.transform(F.split(unix, "\n"), line), lambda x: x.isNotNull())
    return strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def sentences(text: Column) -> Column:
    flat = strip(squeeze(F.replace(text, F.lit("\n"), F.lit(" "))))
    return F.filter(F.transform(F.split(flat, SENTENCE_END), strip), lambda s: s != "")


def years(sentence: Column) -> Column:
    return F.transform(F.regexp_extract_all(sentence, F.lit(YEAR), F.lit(1)), lambda y: y.cast("int"))


def has_cue(sentence: Column) -> Column:
    return sentence.rlike(CUE)


def is_dated_claim(sentence: Column, year: Column, nearby: bool = True) -> Column:
    """Whether a sentence looks like a factual claim of the year (25 to 480 characters, no chrome)."""

    def of(s: Column) -> Column:
        def given(ys: Column) -> Column:
            own = F.array_contains(ys, year)
            near = F.exists(ys, lambda y: F.abs(y - year) <= 1) & has_cue(s) if nearby else F.lit(False)
            ok = own | near
            led = s.rlike(YEAR_LED) | s.rlike(MONTH_YEAR)
            return (led & (own | (F.size(ys) == 0))) | (ok & (has_cue(s) | s.rlike(CAPITALISED)))

        return F.length(s).between(25, 480) & ~s.rlike(CHROME) & ~s.rlike(NAV) & let(years(s), given)

    return let(strip(sentence), of)


def dated_claims(text: Column, year: Column, most: int = 24) -> Column:
    return F.slice(F.filter(sentences(text), lambda s: is_dated_claim(s, year)), 1, most)


def strip_dateline(sentence: Column) -> Column:
    agency = F.regexp_replace(sentence, f"(?U){DATELINE_AGENCY}", "")
    return strip(F.regexp_replace(agency, f"(?U){DATELINE}", ""))


def _without_dates(s: Column) -> Column:
    lead = f"(?iuU){DATE_LEAD}"
    for pattern in (f"{lead}{_MONTH}\\s+{_YEAR}\\b,?", f"{lead}{_YEAR}\\b,?", f"(?U)[,;]\\s*{_YEAR}\\b", f"\\({_YEAR}\\)"):
        s = F.regexp_replace(s, pattern, " ")
    return strip_chars(squeeze(s), " ,;.-")


def rewrite_claim(sentence: Column, year: Column) -> Column:
    """A claim as a line ``In YEAR, …``; NULL if it lies in the future, has neither date nor event, or gets too short or long."""

    def of(s: Column) -> Column:
        led = F.regexp_extract(s, YEAR_LED, 1)

        def from_body(y: Column) -> Column:
            return let(_without_dates(s), lambda b: let(F.concat(F.lit("In "), y.cast("string"), F.lit(", "), capital(b), F.lit(".")), lambda out: F.when((b != "") & F.length(out).between(28, 420), out)))

        def chosen(ys: Column) -> Column:
            past = F.filter(ys, lambda y: y <= year)
            return F.when(F.array_contains(ys, year), year).when(F.size(ys) > 0, F.array_max(past)).when(has_cue(s), year)

        return F.when(led != "", F.when(led.try_cast("int") <= year, capital(s))).otherwise(let(let(years(s), chosen), lambda y: F.when(y.isNotNull(), from_body(y))))

    def ended(s: Column) -> Column:
        return F.when(s != "", strip(squeeze(F.concat(strip_chars(s, " .;:", left=False), F.lit(".")))))

    return let(let(strip_dateline(strip(sentence)), ended), lambda s: F.when(s.isNotNull(), of(s)))


def rewrite_title(title: Column, year: Column) -> Column:
    def of(t: Column) -> Column:
        # an upper-case first letter, an event or a year makes it a claim
        fit = F.length(t).between(12, 180) & ~t.rlike(CHROME) & (has_cue(t) | t.rlike(YEAR) | t.rlike(r"^\p{Lu}"))
        return F.when(fit, rewrite_claim(F.concat(t, F.lit(".")), year))

    return let(strip_chars(squeeze(title), " .;-"), of)


def dedup_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"(?U)\W+", "")


def preprocess(text: Column, year: Column, title: Column | None = None, *, denoised: bool = True, claim_filter: bool = True, probe_rewrite: bool = True, max_sentences: int = 24, max_lines: int = 12, min_chars: int = 40, lead_sentences: int = 3) -> Column:
    """One document as lines of dated facts, or NULL.

    Claims are kept (else the lead sentences), each rewritten if possible and kept raw if it is a
    dated claim all the same; a rewritten title goes first; lines that repeat go. With neither
    filter nor rewriting the cleaned text itself is returned.
    """
    cleaned = denoise(text) if denoised else strip(text)

    def line(claim: Column) -> Column:
        raw = F.concat(strip_chars(claim, " .", left=False), F.lit("."))
        return F.coalesce(rewrite_claim(claim, year), F.when(is_dated_claim(claim, year), raw))

    def fits(out: Column) -> Column:
        return F.when(F.length(out) >= min_chars, out)

    def of(body: Column) -> Column:
        if not (claim_filter or probe_rewrite):
            return fits(F.when(dedup_key(body) != "", body))

        def from_sentences(all_sentences: Column) -> Column:
            lead = F.slice(all_sentences, 1, lead_sentences)
            kept = let(F.slice(F.filter(all_sentences, lambda s: is_dated_claim(s, year)), 1, max_sentences), lambda c: F.when(F.size(c) > 0, c).otherwise(lead))
            if probe_rewrite:
                kept = F.slice(first_of_each(F.filter(F.transform(kept, line), lambda x: x.isNotNull()), dedup_key), 1, max_lines)
                if title is not None:
                    kept = F.concat(F.filter(F.array(rewrite_title(title, year)), lambda x: x.isNotNull()), kept)
            lines = first_of_each(F.filter(kept, lambda x: dedup_key(x) != ""), dedup_key)
            return let(lines, lambda x: fits(F.when(F.size(x) > 0, F.array_join(x, "\n")).otherwise(strip(F.array_join(lead, " ")))))

        return let(sentences(body), from_sentences)

    return let(cleaned, lambda c: F.when(c != "", of(c)))


def preprocess_enabled(cfg: dict | None) -> bool:
    """Whether a preprocessing configuration is on: its own switch, else any of its steps."""
    if not cfg:
        return False
    return bool(cfg["enabled"]) if "enabled" in cfg else any(bool(cfg.get(k)) for k in ("denoise", "claim_filter", "probe_rewrite"))


def preprocess_by_config(text: Column, cfg: dict, default_year: int, title: Column | None = None) -> Column:
    return preprocess(
        text, F.lit(int(cfg.get("year", default_year))), title if cfg.get("use_title", True) else None, denoised=bool(cfg.get("denoise", True)), claim_filter=bool(cfg.get("claim_filter", False)),
        probe_rewrite=bool(cfg.get("probe_rewrite", False)), max_sentences=int(cfg.get("max_sentences", 24)), max_lines=int(cfg.get("max_probe_lines", 12)), min_chars=int(cfg.get("min_chars_out", 40)), lead_sentences=int(cfg.get("fallback_lead_sentences", 3)),
    )
