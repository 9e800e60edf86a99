"""Scalar rules of the corpus formats: dates, identifiers, labels, coordinates, escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def none_if_blank(c: Column) -> Column:
    """Null for an empty string or NA."""
    return F.nullif(F.nullif(c, F.lit("")), F.lit("NA"))


def long_or(c: Column, default: int = -1) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(default))


def date_bounds(date: Column, legacy: bool = False) -> tuple[Column, Column]:
    """First and last yyyymmdd number of a partial date: missing or zero months and days are 00 and 99.

    legacy rewrites every 00 or 01 of the last date, its year too.
    """
    digits = F.regexp_replace(F.coalesce(date, F.lit("")), "[^0-9]", "")
    start = F.rpad(F.substring(digits, 1, 8), 8, "0")
    if legacy:
        end = F.regexp_replace(start, "00|01", "99")
    else:
        tail = lambda at: F.when(F.substring(start, at, 2) == "00", "99").otherwise(F.substring(start, at, 2))
        end = F.concat(F.substring(start, 1, 4), tail(5), tail(7))
    blank = digits == ""
    return F.when(blank, 0).otherwise(start.cast("int")), F.when(blank, 2**31 - 1).otherwise(end.cast("int"))


def iso_date_number(date: Column) -> Column:
    """yyyy-mm-dd… as yyyymmdd."""
    return F.replace(F.substring(date, 1, 10), F.lit("-"), F.lit("")).cast("int")


def date_by_length(digits: Column) -> Column:
    """yyyymmdd, yyyymm or yyyy as yyyy-mm-dd; anything else is 1970-01-01."""
    n = F.length(digits)
    year, month = F.substring(digits, 1, 4), F.substring(digits, 5, 2)
    return (
        F.when(n == 8, F.concat_ws("-", year, month, F.substring(digits, 7, 2)))
        .when(n == 6, F.concat_ws("-", year, month, F.lit("01")))
        .when(n == 4, F.concat(year, F.lit("-01-01")))
        .otherwise("1970-01-01")
    )


def tweet_time(c: Column) -> Column:
    """Wed Oct 10 20:19:24 +0000 2018 as a timestamp."""
    return F.try_to_timestamp(F.substring(c, 5, 40), F.lit("MMM dd HH:mm:ss Z yyyy"))


def forum_time(date: Column, time: Column) -> Column:
    """yyyymmdd and HH:MM as a timestamp in UTC."""
    return F.try_to_timestamp(F.concat(date, F.lit("T"), F.replace(time, F.lit(":"), F.lit("")), F.lit("00Z")), F.lit("yyyyMMdd'T'HHmmssX"))


def confidence_number(c: Column) -> Column:
    """A decimal as an integer, its point deleted."""
    return F.replace(c, F.lit("."), F.lit("")).try_cast("int")


def character_confidences(digits: Column) -> Column:
    """Each digit d as 0.d"""
    return F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c: F.concat(F.lit("0."), c).cast("double"))


def estc_id(c: Column) -> Column:
    """Without the zeros after the first letter."""
    return F.regexp_replace(c, "^([A-Z])0*", "$1")


def early_book_number(c: Column) -> Column:
    """A… is 10…, B… is 11…"""
    head = F.substring(c, 1, 1)
    return F.when(head == "A", F.concat(F.lit("10"), F.substring(c, 2, 99))).when(head == "B", F.concat(F.lit("11"), F.substring(c, 2, 99))).otherwise(c)


def reuse_document(path: Column) -> tuple[Column, Column]:
    """(document number as a string, offset) of a reuse hit's path: base name, its offset, and one more if _at_N follows."""
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]*)\.txt__", 1), r"\.headed$", "")
    offset = F.regexp_extract(path, r"\.txt__(\d+)", 1).try_cast("int")
    more = F.coalesce(F.regexp_extract(name, r"_at_(\d+)$", 1).try_cast("int"), F.lit(0))
    bare = F.regexp_replace(name, r"_at_\d+$", "")
    number = F.when(bare.rlike("^[AB]"), early_book_number(bare)).otherwise(F.concat(F.lit("2"), bare))
    return number, offset + more


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in the text of a tag, null if it isn't there."""
    return F.nullif(F.regexp_extract(tag, rf'[ <]{name}="([^"]*)"', 1), F.lit(""))


def role_label(uri: Column) -> Column:
    """Characters from the 37th on, the first in upper case."""
    return F.concat(F.upper(F.substring(uri, 37, 1)), F.substring(uri, 38, 1000))


def function_label(role: Column, institution: Column, kind: Column) -> Column:
    return F.concat(role, F.coalesce(F.concat(F.lit(", "), institution), F.lit("")), F.coalesce(F.concat(F.lit(" ("), kind, F.lit(")")), F.lit("")))


def yes_no_unknown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("unknown"))


def flag_of(c: Column) -> Column:
    """FALSE for 0, TRUE for anything else; null stays null."""
    return F.when(c == "0", "FALSE").when(c.isNotNull(), "TRUE")


def section_level(kind: Column) -> Column:
    return F.when(kind == "other", 3).when(kind == "section", 2).otherwise(1)


def theme_number(code: Column) -> Column:
    """A theme's code without its first and its seventh character."""
    return F.concat(F.substring(code, 2, 5), F.substring(code, 8, 99)).try_cast("bigint")


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Corners in any order as struct<x, y, w, h>."""
    return F.struct(F.least(x1, x2).alias("x"), F.least(y1, y2).alias("y"), F.abs(x2 - x1).alias("w"), F.abs(y2 - y1).alias("h"))


def pixels(tenths_of_mm: Column) -> Column:
    """Tenths of a millimetre at 300 dots an inch."""
    return F.floor(tenths_of_mm * 300 / 254).cast("int")


def centroid(corners: Column) -> Column:
    """Middle of the first two of a box's corners, each (longitude, latitude)."""
    mean = lambda i: (corners[0][i] + corners[1][i]) / 2
    return F.struct(mean(1).alias("lat"), mean(0).alias("lon"))


def soft_hyphens(text: Column, again: bool = False) -> Column:
    """Soft hyphen marks deleted, or made hyphens at line ends."""
    return F.regexp_replace(text, "[|∣]", "-\n" if again else "")


def verse(text: Column) -> Column:
    """Without the leading verse number, footnote marks and square brackets."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"^\d+ ", ""), r"#\d+", ""), r"[\[\]]", "")


def line_wrap(kind: Column, text: Column) -> Column:
    """Marks around the lines that aren't verse."""
    around = lambda m: F.concat(F.lit(m), text, F.lit(m))
    return F.when(kind == "comment", around("∞")).when(kind == "caption", around("≈")).when(kind == "other", around("£")).otherwise(text)


def escape_label(c: Column) -> Column:
    return F.replace(c, F.lit(";"), F.lit("\\;"))


def escape_json(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def escape_xml(c: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def attributes_text(m: Column) -> Column:
    """A map as  k='v' k='v'"""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(F.lit(" "), e["key"], F.lit("='"), e["value"], F.lit("'"))), "")


def issn_and_year(page: Column) -> tuple[Column, Column]:
    return F.regexp_extract(page, "^([^_]*)_", 1), F.regexp_extract(page, r"_(\d{4})-", 1).try_cast("int")


#: Fixed value: a link that no end tag follows on its line, and its first word.
OPEN_LINK = "<a([^>]*)>([^< ]*)(?!.*</a>)"


def close_links(markup: Column) -> Column:
    """Links that are never closed end after their first word."""
    return F.regexp_replace(markup, OPEN_LINK, "<a$1>$2</a>")
