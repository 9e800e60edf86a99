"""A Merkle manifest of a dataset: a tree of fixed fanout over each group's rows, a tree over the groups' roots, and proofs.

Rows are put into one global order and every partition learns, from counts, which index its first row has in its group. It
pushes its rows onto a mountain-range stack: a level whose open run is full is carried to the next one, in base `fanout`, as a
completed node. Runs that reach over a partition's edge stay behind as peaks, and are merged level by level for all groups at
once. A group's last run may be short and is hashed as it is, without padding. No level passes through one task or the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.common import materialise, trimmed_group
from quillstream.llm.ordered import part_of, parts_of, place_of, ranged

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What pass one says of a digest: a node made here, a peak that waits for its run, a group's root.
NODE, PEAK, ROOT = "node", "peak", "root"
STEPS = "array<struct<before:string,after:string>>"


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(column: Column) -> Column:
    """A value as it enters a leaf: its length in UTF-8 bytes, a colon, the value; a null is a dash."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """A row's digest, lower-case hexadecimal."""
    return F.sha2(F.concat(*(field(c) for c in columns)).cast("binary"), 256)


def level_sizes(total: int, fanout: int) -> list[int]:
    """Nodes at each level of a tree over `total` leaves, up to its root."""
    out = [total]
    while out[-1] > 1:
        out.append(-(-out[-1] // fanout))
    return out


def mountains(leaves: Sequence[str], start: int, total: int, fanout: int) -> Iterator[tuple[str, int, int, str]]:
    """(kind, level, index, digest) of what can be made of the leaves `start`, `start` + 1 and so on, of `total` in the group."""
    sizes = level_sizes(total, fanout)
    top = len(sizes) - 1
    open_runs: list[list[tuple[int, str]]] = [[] for _ in sizes]

    def close(level: int) -> Iterator[tuple[str, int, int, str]]:
        run, open_runs[level] = open_runs[level], []
        if run[0][0] % fanout:  # it began in an earlier partition
            yield from ((PEAK, level, i, d) for i, d in run)
        else:
            made = digest([d for _, d in run])
            yield NODE, level + 1, run[0][0] // fanout, made
            yield from push(level + 1, run[0][0] // fanout, made)

    def push(level: int, index: int, what: str) -> Iterator[tuple[str, int, int, str]]:
        if level == top:
            yield ROOT, level, index, what
            return
        open_runs[level].append((index, what))
        if index % fanout == fanout - 1:
            yield from close(level)

    for i, d in enumerate(leaves, start):
        yield from push(0, i, d)
    ended = start + len(leaves) == total
    for level in range(top):
        if open_runs[level]:
            # at the group's end a run is whole though short, unless what belongs into it is unfinished below
            if ended and open_runs[level][-1][0] == sizes[level] - 1:
                yield from close(level)
            else:
                yield from ((PEAK, level, i, d) for i, d in open_runs[level])


@dataclass
class Forest:
    """Trees over the groups of a table. leaves: at, g, index in the group, leaf and what was carried along; spans: a row for each
    partition and group in it; nodes: digests that a run within one partition made; edges: those that other partitions need;
    roots: a row for each group."""

    leaves: DataFrame
    spans: DataFrame
    nodes: DataFrame
    edges: DataFrame
    roots: DataFrame
    fanout: int
    levels: int


def segments(leaves: pa.Table, spans: pa.Table) -> Iterator[tuple[dict, pa.Table]]:
    """The groups in one partition: their span and their leaves, in order."""
    leaves = leaves.sort_by("place")
    for span in sorted(spans.to_pylist(), key=lambda s: s["first"]):
        yield span, leaves.slice(span["first"], span["n"])


def forest(rows: DataFrame, order: Sequence[Column], fanout: int = FANOUT, parts: int | None = None) -> Forest:
    """Trees over `rows` (g, a group's text that isn't null; leaf, hexadecimal; more are carried along), in each group in the given order.

    Equal rows are leaves of their own; which stands first makes no difference. `rows` has to be a table (see `ordered.ranged`).
    """
    leaves = materialise(ranged(rows, [F.col("g"), *order, F.col("leaf")], "at", parts or parts_of(rows)), "leaves")
    leaves = leaves.select(part_of("at").alias("part"), place_of("at").alias("place"), *rows.columns)
    each = leaves.groupBy("part", "g").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("g")
    counted = each.select("*", F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.sum("n").over(whole).alias("total"))
    spans = materialise(counted.withColumn("before", F.coalesce("before", F.lit(0))), "spans")
    most = spans.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    levels = len(level_sizes(most, fanout)) if most else 1

    def first_pass(leaves: pa.Table, spans: pa.Table) -> pa.Table:
        out = [(kind, span["g"], span["total"], level, i, d) for span, mine in segments(leaves, spans) for kind, level, i, d in mountains(mine["leaf"].to_pylist(), span["before"], span["total"], fanout)]
        columns = list(zip(*out, strict=True)) or [[]] * 6
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "g", "total", "level", "index", "digest"])

    schema = "kind string, g string, total long, level int, index long, digest string"
    made = leaves.select("part", "place", "leaf").groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(trimmed_group(first_pass), schema)
    made = materialise(made, "mountains")
    peaks = made.where(F.col("kind") == PEAK).drop("kind")
    edges, merged = peaks, None
    roots = made.where(F.col("kind") == ROOT).drop("kind")
    for level in range(levels - 1):  # what stands at a level waits for the other members of its run, and nothing else
        waiting = peaks.where(F.col("level") == level)
        waiting = waiting if merged is None else waiting.unionByName(merged)
        run = F.array_sort(F.collect_list(F.struct("index", "digest")))
        joined = waiting.groupBy("g", "total", F.floor(F.col("index") / fanout).alias("run")).agg(run.alias("members"))
        hashed = F.sha2(F.array_join(F.transform("members", lambda m: m["digest"]), "").cast("binary"), 256)
        up = materialise(joined.select("g", "total", F.lit(level + 1).alias("level"), F.col("run").alias("index"), hashed.alias("digest")), "merged")
        edges = edges.unionByName(up)
        done = F.ceil(F.col("total") / fanout ** (level + 1)) == 1
        roots, merged = roots.unionByName(up.where(done)), up.where(~done)
    return Forest(leaves, spans, made.where(F.col("kind") == NODE).drop("kind"), edges, roots, fanout, levels)


def needed(trees: Forest) -> DataFrame:
    """part, g, level, index of the nodes in runs at a partition's two edges: those that it can't make all of itself."""
    f, level = trees.fanout, F.explode(F.sequence(F.lit(0), F.lit(trees.levels - 1))).alias("level")
    at = trees.spans.select("part", "g", "total", F.col("before").alias("a"), (F.col("before") + F.col("n") - 1).alias("b"), level)
    wide = F.pow(F.lit(f), F.col("level")).cast("long")
    size = F.ceil(F.col("total") / wide)
    run = lambda c: F.floor(F.col(c) / (wide * f))
    runs = at.select("part", "g", "level", size.alias("size"), F.explode(F.array_distinct(F.array(run("a"), run("b")))).alias("run")).where("size > 1")
    last = F.least(F.col("size"), (F.col("run") + 1) * f) - 1
    return runs.select("part", "g", "level", F.explode(F.sequence(F.col("run") * f, last)).alias("index"))


def climb(known: dict[tuple[int, int], str], sizes: list[int], fanout: int, above: list[tuple[str, str]]):
    """A function from a level and an index to the steps from there to the root: what stands before and after on each level."""
    seen: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def above_run(level: int, run: int) -> list[tuple[str, str]]:
        if (level, run) not in seen:
            seen[level, run] = steps(level + 1, run)
        return seen[level, run]

    def steps(level: int, index: int) -> list[tuple[str, str]]:
        if level == len(sizes) - 1:
            return above
        run = index // fanout
        members = [known[level, i] for i in range(run * fanout, min((run + 1) * fanout, sizes[level]))]
        own = index - run * fanout
        return [("".join(members[:own]), "".join(members[own + 1 :])), *above_run(level, run)]

    return steps


def fold(start: str, steps: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in steps:
        start = digest([before, start, after])
    return start


def with_steps(trees: Forest, upper: DataFrame | None, columns: Sequence[tuple[str, str]], told) -> DataFrame:
    """Each leaf's row of `told(leaf row, span, steps to the root)`; columns: (name, type) of these rows.

    upper: what else is known for each group (g, steps from the group's root on, and more).
    """
    fanout = trees.fanout
    spans = trees.spans if upper is None else trees.spans.join(upper, "g")
    need = needed(trees).join(trees.edges.select("g", "level", "index", "digest"), ["g", "level", "index"])
    context = spans.join(need.groupBy("part", "g").agg(F.collect_list(F.struct("level", "index", "digest")).alias("known")), ["part", "g"], "left")

    def second_pass(leaves: pa.Table, spans: pa.Table) -> pa.Table:
        out = []
        for span, mine in segments(leaves, spans):
            start, total, own = span["before"], span["total"], mine["leaf"].to_pylist()
            known = {(k["level"], k["index"]): k["digest"] for k in span["known"] or []}
            known |= {(0, i): d for i, d in enumerate(own, start)}
            known |= {(level, i): d for kind, level, i, d in mountains(own, start, total, fanout) if kind == NODE}
            above = [(s["before"], s["after"]) for s in span.get("steps") or []]
            steps = climb(known, level_sizes(total, fanout), fanout, above)
            out += [told(row, span, steps(0, i)) for i, row in enumerate(mine.to_pylist(), start)]
        named = list(zip(*out, strict=True)) or [[]] * len(columns)
        return pa.table([pa.array(c, t) for c, (_, t) in zip(named, ARROW(columns), strict=True)], names=[n for n, _ in columns])

    schema = ", ".join(f"{n} {t}" for n, t in columns)
    return trees.leaves.groupBy("part").cogroup(context.groupBy("part")).applyInArrow(trimmed_group(second_pass), schema)


def ARROW(columns: Sequence[tuple[str, str]]) -> list[tuple[str, pa.DataType]]:  # noqa: N802
    step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), STEPS: step}
    return [(n, kinds[t]) for n, t in columns]


@dataclass
class Manifest:
    """A dataset's trees: those of the groups, the one over the groups, and the leaf and its second version of each row."""

    groups: Forest
    whole: Forest


def manifest(df: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS, other: Column | None = None, fanout: int = FANOUT, parts: int | None = None) -> Manifest:
    """Trees over all rows of `df`: for each value of `group` over its rows by `key`, and one over the groups' roots.

    A null group is one of its own, the first; rows without a key come first in their group; rows of one key go by their
    digests, and repeated rows are leaves each. Texts are hashed whole, as they are read, and not moved; empty and null ones
    differ. Columns besides `fields` play no part, whatever their names. `other`: a text in place of the last field, for a
    second digest (null: none), that is carried along. An empty table has no trees.
    """
    named = [F.col(c) for c in fields]
    second = F.lit(None).cast("string") if other is None else F.when(other.isNotNull(), leaf([*named[:-1], other]))
    g = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    narrow = materialise(df.select(g.alias("g"), F.col(key).alias("key"), leaf(named).alias("leaf"), second.alias("other")), "digests")
    groups = forest(narrow, [F.col("key").asc_nulls_first()], fanout, parts)
    roots = materialise(groups.roots.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("digest").alias("leaf"), F.lit(None).cast("string").alias("other")), "roots")
    return Manifest(groups, forest(roots, [F.col("key")], fanout, parts))


def proofs(of: Manifest) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256 of each row, and the root that its second digest (else its leaf) and its siblings give."""
    ways = with_steps(of.whole, None, [("g", "string"), ("subroot", "string"), ("steps", STEPS)], lambda row, _, steps: (row["key"], row["leaf"], [{"before": b, "after": a} for b, a in steps]))
    root = of.whole.roots.first()
    upper = ways.withColumn("root", F.lit(root["digest"] if root else None).cast("string"))

    def told(row: dict, span: dict, steps: list[tuple[str, str]]) -> tuple:
        folded = fold(row["other"] or row["leaf"], steps)
        return row["key"], row["leaf"], span["subroot"], span["root"], digest([x for s in steps for x in s]), folded, folded == span["root"]

    columns = [("key", "long"), ("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean")]
    return with_steps(of.groups, materialise(upper, "upper"), columns, told)


def tampered(documents: DataFrame) -> DataFrame:
    """Proofs of all documents, where some are checked with a text whose A-Z were lower-cased: those that changed don't verify."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = proofs(manifest(documents, other=F.when(changed, F.translate("text", UPPER, LOWER))))
    return found.withColumnRenamed("key", "doc_id")
