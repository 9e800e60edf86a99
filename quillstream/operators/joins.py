"""Joins: interval overlap, enrichment with checks and defaults, alignment, anti-joins with reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.text import quote


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], bin_size: int | None = None, closed: bool = False, names: tuple[str, str] = ("start", "end"), right_names: tuple[str, str] = ("start", "end")) -> DataFrame:
    """Pairs with equal keys whose spans overlap (half-open unless closed); the right side's columns get the prefix r_.

    Without bins the keys' equality is the join and the overlap a condition on it. With bins, spans are dealt into the
    bins that they touch, which keeps keys with very many spans from being compared all with all; a pair is kept in the
    first bin that both touch.
    """
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    (ls, le), (rs, re_) = names, tuple(f"r_{n}" for n in right_names)
    overlap = (F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le)) if closed else (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le))
    equal = [F.col(k) == F.col(f"r_{k}") for k in keys]
    condition = overlap
    for e in equal:
        condition = e & condition
    if bin_size is None:
        return left.join(r, condition)
    bins = lambda a, b: F.sequence(F.floor(F.col(a) / bin_size), F.floor(F.greatest(F.col(a), F.col(b) - (0 if closed else 1)) / bin_size))
    lb = left.withColumn("_bin", F.explode(bins(ls, le)))
    rb = r.withColumn("_r_bin", F.explode(bins(rs, re_)))
    first = F.greatest(F.floor(F.col(ls) / bin_size), F.floor(F.col(rs) / bin_size))
    return lb.join(rb, condition & (F.col("_bin") == F.col("_r_bin")) & (F.col("_bin") == first)).drop("_bin", "_r_bin")


def overlap_counts(units: DataFrame, fragments: DataFrame, keys: list[str], unit: list[str], fragment: str, bin_size: int | None = None) -> DataFrame:
    """Every unit with the number of fragments over it and their ids, in order."""
    hits = interval_join(units, fragments, keys, bin_size)
    counted = hits.groupBy(*keys, *unit).agg(F.array_sort(F.collect_set(f"r_{fragment}")).alias("reuse_ids"))
    out = units.join(counted, [*keys, *unit], "left")
    return out.withColumn("reuse_ids", F.coalesce("reuse_ids", F.array().cast("array<string>"))).withColumn("reuses", F.size("reuse_ids"))


def enrich(facts: DataFrame, dimension: DataFrame, on: list[str], required: bool = False, defaults: dict | None = None) -> DataFrame:
    """Left join to a dimension; required: a missing key is an error; defaults fill what is missing."""
    joined = facts.join(dimension.withColumn("_there", F.lit(True)), on, "left")
    if required:
        joined = joined.where(F.assert_true(F.col("_there").isNotNull(), F.concat(F.lit("no dimension row for "), F.concat_ws(",", *on))).isNull())
    joined = joined.drop("_there")
    return joined.fillna(defaults) if defaults else joined


def bridge(facts: DataFrame, link: DataFrame, dimension: DataFrame, key: str, link_key: str, value: str, weak: str | None = None) -> DataFrame:
    """Many-to-many: each fact with the sorted set of its dimension values; weak links into a set of their own."""
    joined = link.join(dimension, link_key)
    kind = F.col(weak) if weak else F.lit(False)
    sets = joined.groupBy(key).agg(F.array_sort(F.collect_set(F.when(~kind, F.col(value)))).alias(f"{value}s"), F.array_sort(F.collect_set(F.when(kind, F.col(value)))).alias(f"weak_{value}s"))
    return facts.join(sets, key, "left")


def matched_and_missing(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(inner join, left rows without a partner)."""
    return left.join(right, on), left.join(right, on, "left_anti")


def lookups(counts: DataFrame, key: str, tables: dict[str, DataFrame], value: str) -> DataFrame:
    """A count with its values in other tables, 0 where they have none."""
    for name, t in tables.items():
        counts = counts.join(t.select(key, F.col(value).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return counts


def bag_overlap(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Words that two texts of a pair share, counted with their multiplicity: matched, total (of the left), of (key, word) rows."""
    a = left.groupBy(left_key, "word").agg(F.count(F.lit(1)).alias("n"))
    b = right.groupBy(right_key, "word").agg(F.count(F.lit(1)).alias("m"))
    joined = pairs.join(a, left_key).join(b, [right_key, "word"], "left")
    return joined.groupBy(left_key, right_key).agg(F.sum(F.least("n", F.coalesce("m", F.lit(0)))).alias("matched"), F.sum("n").alias("total"))


def haystacks(lines: DataFrame, pair: str, page: str, order: str, line: str) -> DataFrame:
    """Pages as texts, each after the last line of the page before."""
    listed = F.array_sort(F.collect_list(F.struct(order, line)))
    whole = lines.groupBy(pair, page).agg(F.array_join(F.transform(listed, lambda x: x[line]), "\n").alias("text"), F.element_at(listed, -1)[line].alias("last_line"))
    carried = F.lag("last_line").over(Window.partitionBy(pair).orderBy(page))
    return whole.select(pair, page, F.concat(F.coalesce(carried, F.lit("")), F.lit("\n"), "text").alias("haystack"))


def first_resolved(*styles: Column) -> Column:
    """The nearest ancestor's style: of each list of references the last that isn't null."""
    return F.coalesce(*[F.try_element_at(F.array_compact(s), F.lit(-1)) for s in styles])


def link_titles(text: Column, titles: list[tuple[str, str]]) -> Column:
    """Titles in a text as links. One pass from left to right: where several titles begin, the longest is taken, and nothing inside a link is linked again."""
    if not titles:
        return text
    urls = dict(reversed(titles))  # a title given twice keeps its first link
    pattern = "|".join(quote(t) for t in sorted(urls, key=lambda t: (-len(t), t)))
    gaps, hits = F.split(text, pattern), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    link = F.create_map(*[F.lit(x) for t, u in sorted(urls.items()) for x in (t, f'<a href="{u}">{t}</a>')])
    pieces = F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(F.element_at(link, h), F.lit(""))))
    return F.array_join(pieces, "")


def with_fallback(facts: DataFrame, key: str, first: DataFrame, second: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """(facts with a value of the first table or, where it has none, of the second, and `source`: 1 or 2; facts without any)."""
    one, two = first.select(key, F.col(value).alias("_one")), second.select(key, F.col(value).alias("_two"))
    both = facts.join(one, key, "left").join(two, key, "left").withColumn(value, F.coalesce("_one", "_two")).withColumn("source", F.when(F.col("_one").isNotNull(), 1).when(F.col("_two").isNotNull(), 2))
    both = both.drop("_one", "_two")
    return both.where(F.col("source").isNotNull()), both.where(F.col("source").isNull()).drop(value, "source")
