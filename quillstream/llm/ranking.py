"""Ranks within groups, with ties, where one group may hold any share of all rows.

No group is sorted or counted in one task. Rows are put into one global order by group and full key; each partition scans
its own rows and writes them with their counts as if nothing stood before; one short summary for each partition is
combined on the driver, in order; a second pass over the written rows adds what the earlier partitions carry over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillstream.llm.common import materialise, trimmed
from quillstream.llm.ordered import fresh, part_of, parts_of, ranged

#: What a partition's edges are: the row is in its first group, in its first run of equal rows, in its last run.
FIRST_GROUP, FIRST_RUN, LAST_RUN = 1, 2, 4


def changes(columns: list[pa.Array], before: list[pa.Array] | None) -> np.ndarray:
    """True where a row differs from the one above it in any column; nulls equal each other, and so do NaNs."""
    n = len(columns[0]) if columns else 0
    out = np.zeros(n, bool)
    for i, column in enumerate(columns):
        above = before[i] if before else column[:1]
        joined = pa.concat_arrays([above, column])
        now, last = joined[1:], joined[:-1]
        if pa.types.is_nested(column.type):
            out |= np.array([a != b for a, b in zip(now.to_pylist(), last.to_pylist(), strict=True)], bool)
            continue
        differs = pc.fill_null(pc.not_equal(now, last), False)
        if pa.types.is_floating(column.type):
            differs = pc.and_not(differs, pc.fill_null(pc.and_(pc.is_nan(now), pc.is_nan(last)), False))
        out |= pc.or_(differs, pc.xor(pc.is_null(now), pc.is_null(last))).to_numpy(zero_copy_only=False)
    if before is None and n:
        out[0] = True
    return out


def scanner(group: list[str], order: list[str], schema: pa.Schema | None = None):
    """A map function over one sorted partition: each row with its counts in the partition; a run waits until it ends."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[pa.Array] | None = None
        base = group_start = run_start = runs = runs_before = 0
        waiting: list[tuple] = []  # slices of the open run

        def out(batch: pa.RecordBatch, row, rank, dense, edge, ties) -> pa.RecordBatch:
            added = {"row": row, "rank": rank, "dense": dense, "ties": ties}
            columns = [*batch.columns, *(pa.array(x, pa.int64()) for x in added.values()), pa.array(edge, pa.int8())]
            return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *(f"+{k}" for k in added), "+edge"])

        def closed(length: int, last: int = 0) -> Iterator[pa.RecordBatch]:
            for batch, row, rank, dense, edge in waiting:
                yield out(batch, row, rank, dense, edge | last, np.full(len(row), length))
            waiting.clear()

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names = batch.schema.names
            keys = [batch.column(names.index(c)) for c in group], [batch.column(names.index(c)) for c in order]
            both = keys[0] + keys[1]
            new_group = changes(keys[0], before[: len(group)] if before else None) if group else np.arange(base, base + n) == 0
            new_run = new_group | changes(keys[1], before[len(group) :] if before else None) if order else new_group
            before = [c[n - 1 : n] for c in both]
            at = np.arange(base, base + n)
            starts = np.maximum.accumulate(np.where(new_group, at, group_start))
            ran = np.maximum.accumulate(np.where(new_run, at, run_start))
            count = runs + np.cumsum(new_run)
            earlier = np.maximum.accumulate(np.where(new_group, count - 1, runs_before))
            row, rank, dense = at - starts + 1, ran - starts + 1, count - earlier
            edge = (np.where(earlier == 0, FIRST_GROUP, 0) | np.where(count == 1, FIRST_RUN, 0)).astype(np.int8)
            part = lambda a, b: (batch.slice(a, b - a), row[a:b], rank[a:b], dense[a:b], edge[a:b])  # noqa: B023, E731
            ends = np.flatnonzero(new_run)
            if len(ends):
                first, last = int(ends[0]), int(ends[-1])
                if first:
                    waiting.append(part(0, first))
                yield from closed(base + first - run_start)
                if last > first:
                    yield out(*part(first, last), np.repeat(np.diff(ends), np.diff(ends)))
                waiting.append(part(last, n))
            else:
                waiting.append(part(0, n))
            base, group_start, run_start, runs, runs_before = base + n, int(starts[-1]), int(ran[-1]), int(count[-1]), int(earlier[-1])
        yield from closed(base - run_start, LAST_RUN)

    return scan


def same(a, b) -> bool:
    """Equality of two summaries' keys as Spark groups by them."""
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b, strict=True))
    return a == b or (a != a and b != b)


def carried(summaries: list) -> list[tuple]:
    """Of partitions in order: (part, rows, dense values and rank before the first group's rows, sizes of the first and the last run).

    rank is the first run's if it began in an earlier partition, else 0.
    """
    out, sizes = [], []  # sizes: rows of the runs that stand at a partition's edge
    last = None  # of the partition before: group, order, rows and dense values of its last group, rank of its last run
    for s in summaries:
        joined = last is not None and same(last["g"], s["first_g"])
        goes_on = joined and same(last["o"], s["first_o"])
        rows, dense = (last["rows"], last["dense"] - goes_on) if joined else (0, 0)
        rank = last["rank"] if goes_on else 0
        if not goes_on:
            sizes.append(0)
        sizes[-1] += s["first_ties"]
        first_run = len(sizes) - 1
        if not s["one_run"]:
            sizes.append(s["last_ties"])
        out.append([s["part"], rows, dense, rank, first_run, len(sizes) - 1])
        alone = s["one_group"]
        last = {
            "g": s["last_g"], "o": s["last_o"], "rows": s["last_row"] + rows * alone, "dense": s["last_dense"] + dense * alone,
            "rank": rank if s["one_run"] and goes_on else s["last_rank"] + rows * alone,
        }
    return [(p, rows, dense, rank, sizes[a], sizes[b]) for p, rows, dense, rank, a, b in out]


def ranked(
    df: DataFrame, group: Sequence[Column], order: Sequence[Column], by: Sequence[Column], then: Sequence[Column] = (),
    names: Sequence[str] = ("row_number", "rank", "dense_rank", "ties"), parts: int | None = None,
) -> DataFrame:
    """`df` with the row number, rank, dense rank and number of ties of each row within its group.

    group: what makes a group; by: what makes rows tie; order: how these are sorted (sort expressions over `by`'s values,
    nulls where they say); then: what decides between tied rows, for row numbers only. Nulls are equal to each other, and so
    are NaNs; rows that are equal throughout get numbers of their own. Texts of any length are carried along whole. An empty
    table gives an empty one. Columns of `df` that have one of `names` are replaced. `df` has to be a table or a plan
    without an exchange (see `ordered.ranged`).
    """
    df = df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])
    given = df.columns
    at, *keys = fresh(df, "at", *(f"g{i}" for i in range(len(group))), *(f"o{i}" for i in range(len(by))))
    g, o = keys[: len(group)], keys[len(group) :]
    keyed = df.withColumns(dict(zip(g, group, strict=True)) | dict(zip(o, by, strict=True)))
    rows = ranged(keyed, [*(F.col(c) for c in g), *order, *then], at, parts or parts_of(df))
    schema = StructType(list(rows.schema.fields)).add("+row", "long").add("+rank", "long").add("+dense", "long").add("+ties", "long").add("+edge", "byte")
    scanned = materialise(rows.mapInArrow(trimmed(scanner(g, o)), schema), "ranked")

    part, last = part_of(at).alias("part"), lambda c: F.max_by(c, at)
    first, key = lambda c: F.min_by(c, at), lambda c: F.struct(F.lit(0).alias("_"), *c)
    summary = scanned.groupBy(part).agg(
        first(key(g)).alias("first_g"), last(key(g)).alias("last_g"), first(key(o)).alias("first_o"), last(key(o)).alias("last_o"),
        first("+ties").alias("first_ties"), last("+ties").alias("last_ties"), last("+row").alias("last_row"), last("+dense").alias("last_dense"), last("+rank").alias("last_rank"),
        F.bool_and(F.col("+edge").bitwiseAND(FIRST_GROUP) > 0).alias("one_group"), F.bool_and(F.col("+edge").bitwiseAND(FIRST_RUN) > 0).alias("one_run"),
    )
    carry = carried(sorted(summary.collect(), key=lambda s: s["part"]))
    p, rows_before, dense_before, rank_before, first_run, last_run = "+part", "+rows", "+denses", "+ranks", "+first", "+last"
    told = df.sparkSession.createDataFrame(carry, f"`{p}` int, `{rows_before}` long, `{dense_before}` long, `{rank_before}` long, `{first_run}` long, `{last_run}` long")
    met = scanned.join(F.broadcast(told), part_of(at) == F.col(p))
    edge = lambda bit: F.col("+edge").bitwiseAND(bit) > 0
    added = lambda c, more: F.col(c) + F.when(edge(FIRST_GROUP), F.col(more)).otherwise(0)
    rank = F.when(edge(FIRST_RUN) & (F.col(rank_before) > 0), F.col(rank_before)).otherwise(added("+rank", rows_before))
    ties = F.when(edge(FIRST_RUN), F.col(first_run)).when(edge(LAST_RUN), F.col(last_run)).otherwise(F.col("+ties"))
    values = [added("+row", rows_before), rank, added("+dense", dense_before), ties]
    return met.select(*(F.col(f"`{c}`") for c in given), *(v.alias(n) for v, n in zip(values, names, strict=True)))


def best_lines(lines: DataFrame, places: int = 2) -> DataFrame:
    """The first lines of each group of sale lines, by quantity in tens and percent of discount, with their number of ties.

    A line whose sale number's crc32 is divisible by 5 is of one large group. Null item numbers and dates are -1, null vendors
    a group of their own; null quantities come first and tie, null percents likewise; other nulls come last. Equal lines each
    have a place. Other columns are left out before, so their names don't matter.
    """
    whole = F.col("sale_id").isNotNull() & (F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0)
    of = lambda c: F.when(whole, F.lit(-1)).otherwise(c)
    half_up = lambda c: F.floor(100 * F.col(c) + 0.5)
    narrow = lines.select(
        of(F.col("vendor_id")).cast("long").alias("vendor_id"), of(F.coalesce(F.col("item_id") % 5, F.lit(-1))).cast("byte").alias("part"),
        of(F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))).cast("int").alias("month"),
        F.col("sale_id").cast("long").alias("sale_id"), F.col("line_no").cast("long").alias("line_no"), F.col("quantity").cast("long").alias("quantity"),
        half_up("discount").alias("percent"), half_up("amount").alias("amount_cents"),
    )
    tens = F.floor(F.col("quantity") / 10)
    then = [F.col(c).asc_nulls_last() for c in ("sale_id", "line_no", "quantity", "amount_cents")]
    order = [tens.desc_nulls_first(), F.col("percent").asc_nulls_first()]
    found = ranked(narrow, [F.col("vendor_id"), F.col("part"), F.col("month")], order, [tens, F.col("percent")], then, ("pos", "rank", "dense", "tied"))
    return found.where(F.col("pos") <= places)
