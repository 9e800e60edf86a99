"""A report over a tree of themes: each theme's page part holds its own items, its subthemes' parts, and counts of all below."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions.scalars import escape_xml
from quillstream.operators import hierarchy
from quillstream.sources import scratch


def listed(rows: DataFrame, key: str, order: str, markup: str, name: str) -> DataFrame:
    """key, name: the markup of each key's rows, in order; repeated rows stay."""
    each = F.sort_array(F.collect_list(F.struct(order, markup)))
    return rows.groupBy(key).agg(F.array_join(F.transform(each, lambda x: x[markup]), "").alias(name), F.count(F.lit(1)).alias(f"{name}_n"))


def nested_report(themes: DataFrame, items: DataFrame) -> DataFrame:
    """theme, title, depth, total, orphans, page of every theme, from the deepest upwards.

    themes: theme, parent, title; items: theme, line. total counts the items of a theme and of all themes below it; orphans are the
    items that a theme with subthemes has itself, in a list of their own after them. Themes on a cycle have no page; items of
    a theme that isn't there are left out. Texts are escaped.
    """
    tree = hierarchy.climbed(themes, "theme", "parent").where(~F.col("cyclic")).select("theme", "depth")
    known = scratch.kept(themes.join(tree, "theme").select("theme", "parent", "title", "depth"), "themes")
    lines = items.join(known.select("theme"), "theme").select("theme", "line", F.concat(F.lit("<li>"), escape_xml(F.col("line")), F.lit("</li>")).alias("item"))
    own = scratch.kept(listed(lines, "theme", "line", "item", "items"), "items")
    depth = known.agg(F.coalesce(F.max("depth"), F.lit(-1))).first()[0]
    below, out = None, None
    for d in range(depth, -1, -1):
        here = known.where(F.col("depth") == d).join(own, "theme", "left")
        if below is None:
            here = here.withColumns({"parts": F.lit(None).cast("string"), "parts_n": F.lit(0).cast("long"), "under": F.lit(0).cast("long")})
        else:
            under = below.groupBy(F.col("parent").alias("theme")).agg(F.sum("total").alias("under"))
            parts = listed(below.withColumnRenamed("theme", "of").withColumnRenamed("parent", "theme"), "theme", "title", "page", "parts")
            here = here.join(parts, "theme", "left").join(under, "theme", "left")
        found = here.select("theme", "parent", "title", "depth", (F.coalesce("items_n", F.lit(0)) + F.coalesce("under", F.lit(0))).alias("total"), F.when(F.col("parts").isNotNull(), F.coalesce("items_n", F.lit(0))).otherwise(0).alias("orphans"), "items", "parts")
        inner = F.when(F.col("parts").isNull(), F.coalesce(F.concat(F.lit("<ul>"), "items", F.lit("</ul>")), F.lit(""))).otherwise(
            F.concat(F.lit("<ul>"), "parts", F.lit("</ul>"), F.coalesce(F.concat(F.lit('<ul class="orphans">'), "items", F.lit("</ul>")), F.lit("")))
        )
        page = F.concat(F.lit("<li>"), escape_xml(F.col("title")), F.lit(" ("), F.col("total").cast("string"), F.lit(")"), inner, F.lit("</li>"))
        below = scratch.kept(found.select("theme", "parent", "title", "depth", "total", "orphans", page.alias("page")), "report")
        out = below if out is None else out.unionByName(below)
    return (known.select("theme", "parent", "title", "depth", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("orphans"), F.lit("").alias("page")) if out is None else out).drop("parent")
