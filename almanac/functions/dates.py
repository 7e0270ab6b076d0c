"""Years and dates from mixed representations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import strip
from .fixed import MONTHS

CRAWL = r"^CC-MAIN-(\d{4})-\d+$"
SNAPSHOT = r"^(\d{4})\d{4}\.[A-Za-z_-]+$"


def year_of_number(n: Column) -> Column:
    """Epoch milliseconds beyond 1e12, epoch seconds beyond 1e9, else a plain year from 1900 to 2100."""
    x = n.cast("double")
    seconds = F.when(x > 1e12, x / 1000.0).otherwise(x)
    plain = seconds.cast("long")
    return F.when(seconds > 1e9, F.year(F.timestamp_seconds(seconds))).when(plain.between(1900, 2100), plain).cast("int")


def year_of_text(text: Column) -> Column:
    """Four digits alone, a date or eight digits in front, else any ISO timestamp (``Z`` allowed); NULL where none fits."""
    t = strip(text)
    iso = F.year(F.try_to_timestamp(F.when(t.rlike(r"^\d{4}-\d{2}|^\d{4}-W\d{2}"), F.regexp_replace(t, "Z$", "+00:00"))))
    return F.when(t.rlike(r"^\d{4}$|^\d{4}-\d{2}-\d{2}|^\d{8}"), F.substring(t, 1, 4).cast("int")).otherwise(iso)


def _parts(at: Column) -> Column:
    return F.struct(F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"))


def iso_date(t: Column) -> Column:
    """The date of an ISO text, with a time behind it or not: YYYY-MM-DD, YYYYMMDD, YYYY-Www-D, YYYY-Www or those without dashes; NULL for any other."""
    day = F.coalesce(
        F.try_to_date(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ].*)?$"), F.substring(t, 1, 10)), "yyyy-MM-dd"),
        F.try_to_date(F.when(t.rlike(r"^\d{8}(?:[T ].*)?$"), F.substring(t, 1, 8)), "yyyyMMdd"),
    )
    part = lambda k: F.regexp_extract(t, r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(?:[T ].*)?$", k).try_cast("int")
    monday = F.date_trunc("week", F.make_date(part(1), F.lit(1), F.lit(4))).cast("date")
    week = F.date_add(monday, (part(2) - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1)
    # a year has 53 weeks if its 53rd Thursday is its own
    real = part(2).between(1, 52) | ((part(2) == 53) & (F.year(F.date_add(monday, 52 * 7 + 3)) == part(1)))
    return F.coalesce(day, F.when(real & (part(1) > 0), week))


def ymd_of_text(text: Column) -> Column:
    """struct(year, month, day) of a date in front of a text, whatever follows and however high its numbers; else of an ISO date; NULL where there is none."""
    t = strip(text)
    part = lambda k: F.regexp_extract(t, r"^((?:19|20)\d{2})-(\d{2})-(\d{2})", k).cast("int")
    iso = iso_date(t)
    front = F.struct(part(1).alias("year"), part(2).alias("month"), part(3).alias("day"))
    return F.when(t.rlike(r"^(?:19|20)\d{2}-\d{2}-\d{2}"), front).when(iso.isNotNull(), _parts(iso))


def ymd_of_number(n: Column) -> Column:
    """struct(year, month, day) of epoch milliseconds beyond 1e12 or seconds beyond 1e9; NULL for any other number."""
    x = n.cast("double")
    seconds = F.when(x > 1e12, x / 1000.0).otherwise(x)
    at = F.timestamp_seconds(seconds)
    return F.when(seconds > 1e9, _parts(at))


def month_name(number: Column) -> Column:
    return F.get(F.array(*map(F.lit, MONTHS)), number - 1)


def timestamp_parts(text: Column) -> Column:
    """struct(month name, iso day, year) of ``YYYY-MM-DD…``; the year alone of ``YYYY``."""
    t = strip(text)
    full, year = t.rlike(r"^(?:19|20)\d{2}-\d{2}-\d{2}"), t.rlike(r"^(?:19|20)\d{2}$")
    return F.struct(
        F.when(full, month_name(F.substring(t, 6, 2).try_cast("int"))).alias("month"),
        F.when(full, F.substring(t, 1, 10)).alias("iso"),
        F.when(full | year, F.substring(t, 1, 4).cast("int")).alias("year"),
    )


def crawl_year(name: Column) -> Column:
    """The year of a crawl's name; NULL for any other name."""
    return F.regexp_extract(name, CRAWL, 1).try_cast("int")


def snapshot_year(name: Column) -> Column:
    """The year of a snapshot's name ``YYYYMMDD.language``."""
    return F.regexp_extract(name, SNAPSHOT, 1).try_cast("int")


def stable_seed(seed: Column, name: Column, cycle: Column) -> Column:
    """31 bits of the sha256 of ``seed|name|cycle``, the same in every process."""
    low = F.conv(F.substring(F.sha2(F.concat_ws("|", seed.cast("string"), name, cycle.cast("string")).cast("binary"), 256), 9, 8), 16, 10)
    return low.cast("long").bitwiseAND(F.lit(0x7FFFFFFF))


def uniform(*key: Column) -> Column:
    """A number in [0, 1) that a key decides: the first 32 bits of its md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(k.cast("string") for k in key)).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def drawn_swap(*key: Column) -> Column:
    """Whether a pair is shown in swapped order: odds of one half, drawn by its key."""
    return uniform(F.lit("swap"), *key) < 0.5


def drawn_year(first: int, n: int, *key: Column) -> Column:
    """One of ``n`` years from ``first`` on, drawn by a key."""
    return (first + F.floor(uniform(F.lit("year"), *key) * n)).cast("int")
