"""Dates of records and the issue window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import squeeze


def _date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def parse_date(text: Column) -> Column:
    """First ``YYYY[-M[-D]]`` in the text; missing parts are 1, bad dates NULL."""
    hit = F.regexp_extract(text, r"((?:19|20)\d{2}(?:[-/]\d{1,2})?(?:[-/]\d{1,2})?)", 1)
    parts = F.split(hit, "[-/]")

    def part(i: int) -> Column:
        return F.coalesce(F.get(parts, F.lit(i)), F.lit("1"))

    return F.when(hit != "", _date(part(0), part(1), part(2)))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from separate texts; months may be names, missing parts are 1."""
    month = F.coalesce(F.when(month != "", month), F.lit("1"))
    day = F.coalesce(F.when(day != "", day), F.lit("1"))
    named = F.array_position(F.array(*[F.lit(m) for m in fixed.MONTHS]), F.lower(F.left(month, F.lit(3))))
    number = F.when(named > 0, named.cast("string")).when(month.rlike(r"^\d+$"), month).otherwise("1")
    plain = year.rlike(r"^\d{1,4}$") & number.rlike(r"^\d{1,2}$") & day.rlike(r"^\d{1,2}$")
    return F.when(plain, _date(year, number, day))


def feed_date(text: Column) -> Column:
    """RFC 822 date of a feed item, else an ISO date found in it."""
    value = squeeze(text)
    stamp = F.regexp_extract(value, r"(\d{1,2} [A-Za-z]{3} \d{4})", 1)
    return F.coalesce(F.try_to_date(F.when(stamp != "", stamp), "d MMM yyyy"), parse_date(value))


def date_window(end: dt.date, days: int = fixed.WINDOW_DAYS) -> tuple[dt.date, dt.date]:
    """Both bounds belong to the window."""
    return end - dt.timedelta(days=max(1, days)), end


def today_in(tz: str) -> Column:
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), tz))


def choose_availability(df: DataFrame, start: Column | dt.date, end: Column | dt.date) -> DataFrame:
    """Add the availability date, its basis and whether it is in the window.

    The first date inside the window wins, else the first not after its end.
    """
    start, end = (v if isinstance(v, Column) else F.lit(v) for v in (start, end))
    present = [c for c in fixed.DATE_ORDER if c in df.columns]

    def first(ok) -> Column:
        return F.coalesce(
            *[
                F.when(ok(F.col(c)), F.struct(F.col(c).alias("d"), F.lit(c).alias("basis")))
                for c in present
            ]
        )

    inside = first(lambda d: d.between(start, end))
    past = first(lambda d: d <= end)
    chosen = F.coalesce(inside, past)
    return df.withColumns(
        {
            "availability_date": chosen["d"],
            "availability_date_basis": chosen["basis"],
            "in_window": inside.isNotNull(),
        }
    )


def filter_window(df: DataFrame, start, end, strict: bool = False) -> DataFrame:
    """Keep papers with a usable date; ``strict`` asks for one in the window."""
    dated = choose_availability(df, start, end)
    keep = F.col("in_window") if strict else F.col("availability_date").isNotNull()
    return dated.where(keep)


def filter_news_window(df: DataFrame, start, end) -> DataFrame:
    """Keep undated and in-window news that has a title and a link."""
    start, end = (v if isinstance(v, Column) else F.lit(v) for v in (start, end))
    day = F.col("published_date")
    return df.where((day.isNull() | day.between(start, end)) & (F.col("title") != "") & (F.col("url") != ""))
