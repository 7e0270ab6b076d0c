"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed; for every (host, line) the distinct documents that hold it
are counted. Copies are not distinct documents: rows of a host with equal texts count once. A
line above the limit is removed from all of its documents; a document of which too little is
left is rejected.

Every text is read and split once, into figures and line hashes that are kept by a
checkpoint; counting, joining and judging use those small rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut
from .sizes import fresh

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: A line is frequent in a host if more distinct documents hold it than this many, however large the host.
#: LINE_SHARE is no part of the default rule; a caller can ask for a share of the host's distinct documents besides.
LINE_DOCS, LINE_SHARE = 20, 0.03
#: A document is depleted if fewer than this share of its words are left.
LEFT_SHARE = 0.3
WINDOW = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value evaluated once per row, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash: a false hit within one text of a million words has
    odds of about 1 in 40 million. All steps are sorts or single passes over the text. ``width`` is a power of two.
    """
    if width < 1 or width & (width - 1):
        raise ValueError("the width must be a power of two")
    zero = F.lit(0).cast("long")

    def covered(win: Column) -> Column:
        keyed = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of(s: Column) -> Column:
            twice = F.filter(F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda p: p.isNotNull())
            return let(F.sort_array(twice), lambda at: F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - p, F.lit(width)))), zero, lambda a, b: a + b))

        return F.when(F.size(F.array_distinct(win)) < F.size(win), let(keyed, of)).otherwise(zero)

    def doubled(h: Column, n: int) -> Column:
        """Hashes of ``width`` words from those of n: each with the one n places on; what reaches beyond the text is cut off."""
        if n == width:
            return F.slice(h, F.lit(1), F.size(h) - (width - 1))
        return let(F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + n))), lambda two: doubled(two, 2 * n))

    return F.when(F.size(words) <= width, zero).otherwise(let(let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: doubled(h, 1)), covered))


def prepared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Each row's base figures and lines with a word, from one pass over its text.

    (doc_id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lines), where
    lines has (h, words, pos): the hash of the normalised line, its words and its place among all lines.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    symbols = F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))

    def line(x: Column, i: Column) -> Column:
        return let(words_of(x), lambda w: F.struct(x.alias("raw"), w.alias("w"), i.alias("pos")))

    def figures(lines: Column) -> Column:
        def of_words(w: Column) -> Column:
            return F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("c"), repeated_words(w).alias("r"))

        hashed = F.transform(lines, lambda s: F.struct(F.xxhash64(F.lower(F.array_join(s["w"], " "))).alias("h"), F.size(s["w"]).alias("words"), s["pos"].alias("pos")))
        return F.struct(let(F.flatten(lines["w"]), of_words).alias("f"), (F.size(lines) - F.size(F.array_distinct(lines["raw"]))).cast("long").alias("dup"), hashed.alias("lines"))

    lines = F.filter(F.transform(F.split(text, "\n"), line), lambda s: F.size(s["w"]) > 0)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_key"),
        symbols.cast("long").alias("n_symbols"),
        let(lines, figures).alias("x"),
    )
    n, r = F.col("x.f.n"), F.col("x.f.r")
    return base.select("doc_id", "host", "text_key", n.alias("n_words"), F.col("x.f.c").alias("word_chars"), "n_symbols", F.col("x.dup").alias("n_dup_lines"), r.alias("n_repeat_words"), ((n < 20) | (100 * r > 30 * n)).alias("base_failed"), F.col("x.lines").alias("lines"))


def frequent_lines(rows: DataFrame, line_docs: int = LINE_DOCS, line_share: float | None = None) -> DataFrame:
    """(host, h) of lines above the limit, from ``prepared`` rows. Counts are summed before and after the shuffle.

    With ``line_share`` a line must also be in more than this share of its host's distinct documents.
    """
    held = rows.select("host", "text_key", F.explode(F.array_distinct("lines.h")).alias("h")).distinct()
    counted = held.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > line_docs)
    if line_share is not None:
        texts = rows.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
        counted = counted.join(texts, "host").where(F.col("n") > line_share * F.col("host_docs"))
    return counted.select("host", "h")


def removed_lines(rows: DataFrame, **limits) -> DataFrame:
    """(doc_id, text_key, host, removed words, sorted positions of the removed lines) of ``prepared`` rows that lose a line.

    The join with the frequent lines is an equi-join whose hot keys adaptive execution splits.
    """
    each = rows.select("doc_id", "text_key", "host", F.inline("lines"))
    hit = each.join(frequent_lines(rows, **limits), ["host", "h"])
    once = hit.groupBy("doc_id", "text_key", "host", "pos").agg(F.max("words").cast("long").alias("words"))
    return once.groupBy("doc_id", "text_key", "host").agg(F.sum("words").alias("n_removed_words"), F.sort_array(F.collect_list("pos")).alias("positions"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key")) & (F.col(f"{a}.host") == F.col(f"{b}.host"))


def _split_options(limits: dict) -> tuple[dict, dict]:
    cols = {k: v for k, v in limits.items() if k in ("id_col", "text_col", "host_col")}
    return cols, {k: v for k, v in limits.items() if k not in cols}


def judge(docs: DataFrame, left_share: float = LEFT_SHARE, **limits) -> DataFrame:
    """Every row's figures and verdict: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, kept).

    A null text or host is empty (and so fails on its word count). Repeated rows count once in the
    line counts and get equal verdicts; ties don't occur, as every holder of a frequent line loses
    it. A very long text is one row of work. An empty table gives no rows; other columns are dropped.
    """
    cols, limits = _split_options(limits)
    rows = cut(prepared(docs, **cols))
    f, r = rows.drop("lines").alias("f"), removed_lines(rows, **limits).drop("positions").alias("r")
    removed = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    left = (F.col("n_words") - removed) >= left_share * F.col("n_words")
    return f.join(r, _same("f", "r"), "left").select("f.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", removed.alias("n_removed_words"), (~F.col("base_failed") & left).alias("kept"))


def clean(docs: DataFrame, left_share: float = LEFT_SHARE, **limits) -> DataFrame:
    """The kept rows of ``docs`` with all their columns; frequent lines are cut from the text (and n_chars follows, where it exists).

    Null and empty texts fail the base rules and go. Repeated rows share a verdict and stay as
    often as they occur; a null id is an id like any other. Very long texts are cut like short
    ones. An empty table gives none. Other columns stay as they are, whatever their names.
    """
    cols, limits = _split_options(limits)
    id_col, text_col, host_col = (cols.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("host_col", "source")))
    of_id, of_key, of_host, cut_at, own_key, own_host, gone = (fresh(docs, x) for x in ("_id", "_key", "_host", "_cut", "_own", "_own_host", "_gone"))
    rows = cut(prepared(docs, **cols))
    f = rows.select("doc_id", "text_key", "host", "n_words", "base_failed").dropDuplicates(["doc_id", "text_key", "host"]).alias("f")
    left = F.col("n_words") - F.coalesce("n_removed_words", F.lit(0)) >= left_share * F.col("n_words")
    # rows that change: rejected ones and those that lose a line
    changed = f.join(removed_lines(rows, **limits).alias("r"), _same("f", "r"), "left").where(F.col("base_failed") | F.col("positions").isNotNull()).select(
        F.col("f.doc_id").alias(of_id), F.col("f.text_key").alias(of_key), F.col("f.host").alias(of_host), F.col("positions").alias(cut_at), (F.col("base_failed") | ~left).alias(gone)
    )
    text, spans = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(cut_at)
    keyed = docs.withColumns({own_key: F.xxhash64(text), own_host: F.coalesce(F.col(host_col).cast("string"), F.lit(""))})
    out = keyed.join(changed, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(own_key) == F.col(of_key)) & (F.col(own_host) == F.col(of_host)), "left").where(~F.coalesce(F.col(gone), F.lit(False)))

    def without(lines: Column) -> Column:
        ends = F.concat(spans, F.array(F.size(lines)))
        parts = F.transform(ends, lambda p, k: F.slice(lines, F.coalesce(F.get(ends, k - 1) + 2, F.lit(1)), p - F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))))
        return F.array_join(F.flatten(parts), "\n")

    out = out.withColumn(text_col, F.when(spans.isNull(), F.col(text_col)).otherwise(let(F.split(text, "\n"), without))).select(*docs.columns)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
