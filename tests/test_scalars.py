import datetime

import pytest
from pyspark.sql import functions as F

from quillstream.functions import scalars as s


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("date", "bounds"), [("1809", (18090000, 18099999)), ("18091200", (18091200, 18091299)), ("17010000", (17010000, 17019999)), ("19000000", (19000000, 19009999)), ("", (0, 2**31 - 1)), ("1720-03-05", (17200305, 17200305))])
def test_date_bounds(spark, date, bounds):
    a, b = s.date_bounds(F.lit(date))
    assert (value(spark, a), value(spark, b)) == bounds


def test_legacy_bounds(spark):
    assert value(spark, s.date_bounds(F.lit("17010000"), legacy=True)[1]) == 17999999


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: s.date_by_length(F.lit("18091231")), "1809-12-31"), (lambda: s.date_by_length(F.lit("180912")), "1809-12-01"), (lambda: s.date_by_length(F.lit("1809")), "1809-01-01"), (lambda: s.date_by_length(F.lit("x")), "1970-01-01"),
        (lambda: s.confidence_number(F.lit("87.5")), 875), (lambda: s.estc_id(F.lit("T00012")), "T12"), (lambda: s.early_book_number(F.lit("A123")), "10123"), (lambda: s.long_or(F.lit("x")), -1),
        (lambda: s.none_if_blank(F.lit("NA")), None), (lambda: s.character_confidences(F.lit("95")), [0.9, 0.5]), (lambda: s.escape_label(F.lit("a;b")), "a\\;b"), (lambda: s.escape_json(F.lit('a"\\')), 'a\\"\\\\'),
        (lambda: s.escape_xml(F.lit("<&>")), "&lt;&amp;&gt;"), (lambda: s.attributes_text(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))), " a='1' b='2'"), (lambda: s.verse(F.lit("12 a#3 [b]")), "a b"),
        (lambda: s.soft_hyphens(F.lit("a|b∣c"), True), "a-\nb-\nc"), (lambda: s.line_wrap(F.lit("comment"), F.lit("x")), "∞x∞"), (lambda: s.pixels(F.lit(254)), 300), (lambda: s.theme_number(F.lit("t12345x678")), 12345678),
        (lambda: s.function_label(F.lit("Member"), F.lit("House"), F.lit("chamber")), "Member, House (chamber)"), (lambda: s.role_label(F.lit("x" * 36 + "member")), "Member"), (lambda: s.attribute(F.lit('<text a="1" nick="x">'), "nick"), "x"),
        (lambda: s.section_level(F.lit("section")), 2), (lambda: s.flag_of(F.lit("0")), "FALSE"), (lambda: s.yes_no_unknown(F.lit(None).cast("boolean")), "unknown"), (lambda: s.iso_date_number(F.lit("2001-02-03T")), 20010203),
    ],
)
def test_rules(spark, column, want):
    assert value(spark, column()) == want


def test_times(spark):
    assert value(spark, s.tweet_time(F.lit("Wed Oct 10 20:19:24 +0000 2018"))) == datetime.datetime(2018, 10, 10, 20, 19, 24)
    assert value(spark, s.forum_time(F.lit("20180102"), F.lit("03:04"))) == datetime.datetime(2018, 1, 2, 3, 4)


def test_reuse_document(spark):
    n, o = s.reuse_document(F.lit("/x/A12_at_40.headed.txt__7_z"))
    assert (value(spark, n), value(spark, o)) == ("1012", 47)
    n, o = s.reuse_document(F.lit("/x/55.txt__7_z"))
    assert (value(spark, n), value(spark, o)) == ("255", 7)
