"""Main text of pages by consensus: each page's containers are scored, hosts vote on paths, texts follow the winners.

Two passes over the pages. In the first every page votes for the generalised tag-class path
of its best container; votes are counted by host and path before they travel, and a host's winners
are the paths with at least ``SHARE`` of its votes. In the second each page is read again and
gives the text of the first winning path that it has, or of its own best container where it has none.
A host's pages never meet in one task: only its votes do, and its few winners go out to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import markup as h
from . import text as tx
from .shared import cut

#: A winning path has at least this share of its host's votes, so a host has ten winners at most.
SHARE = 0.1
#: Hosts whose winners are broadcast (at most ten numbers each): those with the most pages. Others meet their pages in a shuffle.
BROADCAST_HOSTS = 20_000
TOGETHER = 4 << 20


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without a port and www; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:[wW]{3}\.)?([^/?#:]+)", 1))


def _pages(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[h.Page]]]:
    for b in batches:
        for i, j in tx.pieces(b.column(column), TOGETHER):
            part = b.slice(i, j - i)
            yield part, [h.read(x) for x in tx.plain(part.column(column)).to_pylist()]
    tx.trim()


def ballots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to (host, path, steps, score): each page's vote; one without text has none."""
    for part, pages in _pages(batches, 1):
        rows = []
        for host, page in zip(part.column(0), pages, strict=True):
            best = h.scored(page)
            if page.blocks:
                e = page.elements[best]
                rows.append((host.as_py(), e.path - (e.path >> 63 << 64), page.steps(best), e.score))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.float64()))], ["host", "path", "steps", "score"])


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, steps, n, score): how many pages of a host vote for each generalised path; ``path`` is its hash, ``steps`` itself."""
    rows = pages.select(host_of(pages[url_col]).alias("host"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))
    each = rows.mapInArrow(ballots, "host string, path long, steps string, score double")
    return each.groupBy("host", "path").agg(F.min("steps").alias("steps"), F.count("*").alias("n"), F.sum("score").alias("score"))


def winners(counted: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, n, paths): each host's winning paths, most votes first; ties go to the smaller steps."""
    all_ = counted.groupBy(F.col("host").alias("of")).agg(F.sum("n").alias("all"))
    won = counted.join(all_, F.col("host") == F.col("of")).where(F.col("n") >= share * F.col("all"))
    best = won.groupBy("host").agg(F.first("all").alias("n"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "steps", "path"))).alias("w"))
    return best.select("host", "n", F.col("w.path").alias("paths"))


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, paths) to (page_id, url, text, path): the text by the first of the paths that the page has."""
    for part, pages in _pages(batches, 2):
        out, by = [], []
        for page, paths in zip(pages, part.column(3).to_pylist(), strict=True):
            best = h.scored(page)
            text, used = "", None
            for p in paths or []:
                tops = h.matching(page, p & (1 << 64) - 1)
                text = h.text_of(page, tops) if tops else ""
                if text:
                    used = p
                    break
            out.append(text or h.text_of(page, [best]))
            by.append(used)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string()), pa.array(by, pa.int64())], ["page_id", "url", "text", "path"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = SHARE, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """(page_id, url, text, path): the main text of every page and the winning path it came by (NULL: its own best container).

    A null html is empty and has the empty text, and so has a page without text. A null url is of
    the empty host, whose pages vote together. Rows keep their ids and urls, nulls and repeats included; an
    empty table gives none; other columns are dropped. Texts are whole, however long.
    """
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"), host_of(pages[url_col]).alias("host"))
    won = cut(winners(votes(pages, url_col, html_col), share))
    kind = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, path long"
    extracted = lambda df: df.select("page_id", "url", "html", "paths").mapInArrow(texts, kind)
    by = lambda w: w.select(F.col("host").alias("of"), "paths")
    if won.count() <= broadcast_hosts:
        return extracted(rows.join(F.broadcast(by(won)), F.col("host") == F.col("of"), "left"))
    large = won.orderBy(F.desc("n"), "host").limit(broadcast_hosts)
    small = won.join(F.broadcast(large.select("host")), "host", "left_anti")
    first = rows.join(F.broadcast(by(large)), F.col("host") == F.col("of"))
    rest = rows.join(F.broadcast(large.select(F.col("host").alias("of"))), F.col("host") == F.col("of"), "left_anti")
    return extracted(first).unionByName(extracted(rest.join(by(small), F.col("host") == F.col("of"), "left")))


def digest(found: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): code points of each text."""
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
