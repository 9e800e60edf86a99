"""Phrase and proximity search over a positional index.

Postings are one entry for each term and document, with the sorted positions. Those of a term from one batch of documents are
packed into one row, and rows are kept in the order of terms: a search reads the row groups of its terms only. The rows of a
term that many documents have are dealt to parts, so no join is dealt by a common term alone. A query's rarest term leads: its
postings give the candidates, and the other terms' postings are met by term and document, where sorted position lists are
intersected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstream.functions import text as texts
from quillstream.operators import aggregates
from quillstream.sources import scratch

#: Documents in a part of a term's postings; query terms that are named in the scan's filter.
PART_DOCUMENTS, NAMED_TERMS = 100_000, 1_000
#: Tokens whose positions are grouped at once; a longer text is grouped whole.
BATCH_TOKENS = 2_000_000


@dataclass
class Index:
    """dictionary: term, documents, occurrences, parts; packed: term, part, docs, counts, positions of some documents: as many positions for each document as its count says."""

    dictionary: DataFrame
    packed: DataFrame

    @property
    def postings(self) -> DataFrame:
        """term, part, doc, positions."""
        return opened(self.packed)


def coded_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(docs, terms; of each token its term's number, row and position) of rows (doc, terms: the tokens in order, empty ones being gaps), some BATCH_TOKENS at a time."""
    for batch in batches:
        lengths = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            # rows of some BATCH_TOKENS tokens at a time, one row at least
            to = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + BATCH_TOKENS, "right")))
            docs, terms = (c.slice(at, to - at) for c in (batch.column("doc"), batch.column("terms")))
            at = to
            row, tokens = pc.list_parent_indices(terms).to_numpy().astype(np.int64), terms.flatten()
            index = np.arange(len(row))
            begins = np.maximum.accumulate(np.where(np.diff(row, prepend=-1) != 0, index, 0)) if len(row) else index
            some = pc.fill_null(pc.not_equal(tokens, ""), False).to_numpy(zero_copy_only=False)
            coded = tokens.filter(pa.array(some)).dictionary_encode()
            yield docs, coded.dictionary, coded.indices.to_numpy().astype(np.int64), row[some], (index - begins)[some].astype(np.int32)


def by_term(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array, pa.ListArray]]:
    """(terms, a term's number, doc, positions) of rows (doc, terms), for each term of a row; those of a term together."""
    for docs, terms, code, row, pos in coded_tokens(batches):
        # by term, then row: rows of one term side by side are small in files and shuffles
        key = code * len(docs) + row
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1) != 0)
        positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(pos[order]))
        yield terms, code[order][first], docs.take(pa.array(row[order][first])), positions


def grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, doc, positions of `by_term`."""
    for terms, code, docs, positions in by_term(batches):
        yield pa.RecordBatch.from_arrays([terms.take(pa.array(code)), docs, positions], ["term", "doc", "positions"])


def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, docs, counts, positions of `by_term`: one row for each term of a piece of a batch."""
    for terms, code, docs, positions in by_term(batches):
        first = np.flatnonzero(np.diff(code, prepend=-1) != 0)
        bounds = np.append(first, len(code))
        offsets = positions.offsets.to_numpy()
        listed = lambda bounds, values: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
        lists = [listed(bounds, docs), listed(bounds, pa.array(np.diff(offsets), pa.int32())), listed(offsets[bounds], positions.values)]
        yield pa.RecordBatch.from_arrays([terms.take(pa.array(code[first])), *lists], ["term", "docs", "counts", "positions"])


def opened(rows: DataFrame) -> DataFrame:
    """Packed rows with a row for each document (doc, positions) in place of the lists; further columns stay."""
    others = [c for c in rows.columns if c not in ("docs", "counts", "positions")]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = pc.list_parent_indices(batch.column("docs"))
            counts = batch.column("counts").flatten().to_numpy()
            positions = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), batch.column("positions").flatten())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in others), batch.column("docs").flatten(), positions], [*others, "doc", "positions"])

    return rows.mapInArrow(run, f"{kinds}, doc {rows.schema['docs'].dataType.elementType.simpleString()}, positions array<int>")


def frequent(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """doc, term, tf, rank of rows (doc, terms): the k most frequent terms of each row, equally frequent ones by name."""
    for docs, terms, code, row, _ in coded_tokens(batches):
        key, tf = np.unique(row * max(len(terms), 1) + code, return_counts=True)
        row, code = key // max(len(terms), 1), key % max(len(terms), 1)
        named = np.empty(len(terms), np.int64)
        named[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
        order = np.lexsort((named[code], -tf, row))
        rank = np.arange(len(row)) - np.searchsorted(row, row) + 1  # rows are sorted already
        best = order[rank <= k]
        columns = [docs.take(pa.array(row[best])), terms.take(pa.array(code[best])), pa.array(tf[best], pa.int64()), pa.array(rank[rank <= k], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "term", "tf", "rank"])


def once_and_more(docs: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of docs (doc, …) whose document is one row, and those of repeated documents; None if there are none. If the repeated ones are too many to be broadcast, all rows are taken for such."""
    repeated = scratch.kept(docs.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("again")), "repeated")
    if scratch.file_bytes(repeated) > scratch.BROADCAST_BYTES:
        return None, docs
    if repeated.isEmpty():
        return docs, None
    return tuple(docs.join(F.broadcast(repeated), F.col("doc").eqNullSafe(F.col("again")), how) for how in ("left_anti", "left_semi"))


def top_terms(docs: DataFrame, analyze: Callable[[Column], Column], k: int) -> DataFrame:
    """doc, term, tf, rank of docs (doc, text): each document's k most frequent terms, equally frequent ones by name.

    A document that is one row is counted within that row, by Arrow batches; only the words of repeated documents are shuffled.
    """
    terms = lambda rows: rows.select("doc", analyze(F.coalesce("text", F.lit(""))).alias("terms"))
    once, more = once_and_more(docs)
    found = None
    if once is not None:
        found = terms(once).mapInArrow(lambda batches: frequent(batches, k), f"doc {docs.schema['doc'].dataType.simpleString()}, term string, tf long, rank int")
    if more is not None:
        counted = aggregates.term_frequencies(terms(more).select("doc", F.explode("terms").alias("term")).where("term != ''"), ["doc"])
        ranked = aggregates.top(counted, ["doc"], k, F.desc("tf"), F.col("term")).select("doc", "term", "tf", "rank")
        found = ranked if found is None else found.unionByName(ranked)
    return found


def document_postings(docs: DataFrame, analyze: Callable[[Column], Column], collect: Callable[[str], Column] = F.collect_set, pack: bool = False) -> DataFrame:
    """term, doc, positions of docs (doc, text), one row for each term and document. collect: F.collect_list keeps positions that several rows of a document have as often.

    A document that is one row has its positions grouped within that row, by Arrow batches, so its words aren't shuffled.
    Those of repeated documents are merged by term and document. If these are too many to be broadcast, all are merged.
    pack: term, docs, counts, positions, where several documents of a term are one row.
    """
    kind = docs.schema["doc"].dataType.simpleString()
    terms = lambda rows: rows.select("doc", analyze(F.coalesce("text", F.lit(""))).alias("terms"))
    each = lambda rows: terms(rows).mapInArrow(grouped, f"term string, doc {kind}, positions array<int>")
    united = lambda rows: rows.select("term", "doc", F.explode("positions").alias("pos")).groupBy("term", "doc").agg(F.sort_array(collect("pos")).alias("positions"))
    own, merged = each, lambda rows: united(each(rows))
    if pack:
        own = lambda rows: terms(rows).mapInArrow(packed, f"term string, docs array<{kind}>, counts array<int>, positions array<int>")
        merged = lambda rows: united(each(rows)).select("term", F.array("doc").alias("docs"), F.array(F.size("positions")).alias("counts"), "positions")
    once, more = once_and_more(docs)
    if once is None or more is None:
        return merged(docs) if once is None else own(docs)
    return own(once).unionByName(merged(more))


def build(docs: DataFrame, key: str, text: str, path: str, analyze: Callable[[Column], Column] = texts.default_analyzer, part_documents: int = PART_DOCUMENTS) -> Index:
    """Writes the index of `docs` below `path`.

    Null and empty texts have no postings; rows of one key are one document, whose positions are those of all its rows.
    A null key is a document of its own.
    """
    spark = docs.sparkSession
    each = scratch.kept(document_postings(docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), analyze, pack=True), "postings")
    counted = each.groupBy("term").agg(F.sum(F.size("counts")).alias("documents"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("occurrences"))
    told = counted.withColumn("parts", F.ceil(F.col("documents") / part_documents).cast("int"))
    told.write.mode("overwrite").parquet(f"{path}/dictionary")
    dictionary = spark.read.parquet(f"{path}/dictionary")
    heavy = scratch.small(dictionary.where("parts > 1").select("term", "parts"), "heavy")
    first = F.col("docs")[0]
    part = F.coalesce(F.pmod(F.xxhash64(first), F.col("parts")).cast("int"), F.lit(0))
    placed = each.join(heavy, "term", "left").select("term", part.alias("part"), first.alias("first"), "docs", "counts", "positions")
    placed.repartitionByRange("term", "part", "first").sortWithinPartitions("term", "part", "first").drop("first").write.mode("overwrite").parquet(f"{path}/postings")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Index:
    return Index(spark.read.parquet(f"{path}/dictionary"), spark.read.parquet(f"{path}/postings"))


def query_terms(index: Index, queries: DataFrame, distinct: bool) -> DataFrame:
    """query, place, term, documents, parts, n of the queries (query, terms) all of whose terms the index knows; kept."""
    listed = F.array_distinct("terms") if distinct else F.col("terms")
    asked = queries.select("query", F.size(listed).alias("n"), F.posexplode(listed).alias("place", "term"))
    met = asked.join(index.dictionary, "term").withColumn("known", F.count(F.lit(1)).over(Window.partitionBy("query")))
    return scratch.kept(met.where("known = n").select("query", "place", "term", "documents", "parts", "n"), "terms")


def needed(index: Index, terms: DataFrame) -> DataFrame:
    """The packed postings, filtered by the terms' names where these are few, so that the scan can leave out row groups."""
    named = [r.term for r in terms.select("term").distinct().limit(NAMED_TERMS + 1).collect()]
    return index.packed.where(F.col("term").isin(named)) if len(named) <= NAMED_TERMS else index.packed


def candidates(index: Index, terms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(packed postings to read, the postings of each query's rarest term: query, doc, place, positions; the other terms)."""
    postings = needed(index, terms)
    rarest = F.row_number().over(Window.partitionBy("query").orderBy("documents", "place"))
    ranked = terms.withColumn("r", rarest)
    lead = ranked.where("r = 1").select("query", "place", "term", "n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    found = scratch.small(lead, "lead").join(postings, ["term", "part"]).drop("part")
    return postings, scratch.kept(opened(found), "candidates"), ranked.where("r > 1").drop("r", "documents", "n")


def others(index: Index, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The candidates, and for each of them and each further term of its query: query, doc, place, lead_place, lead, positions."""
    postings, found, rest = candidates(index, terms)
    probes = found.select("query", "doc", "n", F.col("place").alias("lead_place"), F.col("positions").alias("lead")).join(scratch.small(rest, "rest"), "query")
    entries = opened(postings.drop("part"))
    met = scratch.small(probes.drop("parts"), "probes").alias("p").join(entries.alias("i"), (F.col("p.term") == F.col("i.term")) & F.col("p.doc").eqNullSafe(F.col("i.doc")))
    return found, met.select("p.query", "p.doc", "p.n", "p.place", "p.lead_place", "p.lead", "p.term", "i.positions")


def phrases(index: Index, queries: DataFrame) -> DataFrame:
    """query, doc, starts: where the terms of each query (query, terms: an array) stand one after the other; sorted positions.

    A query without terms, with a null term or one that the index lacks finds nothing. Queries of one name are one query's
    words, so names should differ.
    """
    terms = query_terms(index, queries, distinct=False)
    found, met = others(index, terms)
    shifted = lambda positions, place: F.transform(positions, lambda p: p - place)
    hits = met.select("query", "doc", "n", F.array_intersect(shifted(F.col("lead"), F.col("lead_place")), shifted(F.col("positions"), F.col("place"))).alias("starts")).where(F.size("starts") > 0)
    listed = hits.groupBy("query", "doc").agg(F.first("n").alias("n"), F.collect_list("starts").alias("all")).where(F.size("all") == F.col("n") - 1)
    both = F.aggregate(F.slice("all", 2, F.greatest(F.size("all"), F.lit(1))), F.col("all")[0], lambda a, b: F.array_intersect(a, b))
    longer = listed.select("query", "doc", F.sort_array(both).alias("starts")).where(F.size("starts") > 0)
    return longer.unionByName(found.where("n = 1").select("query", "doc", F.col("positions").alias("starts")))


def close(batches: Iterable[pa.RecordBatch], within: int) -> Iterator[pa.RecordBatch]:
    """query, doc, starts of rows (query, doc, lists: the sorted positions of each term): positions from which every list has one within `within` further ones."""
    for batch in batches:
        lists = batch.column("lists")
        owner = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        each = lists.flatten()
        row, pos = owner[pc.list_parent_indices(each).to_numpy()], each.flatten().to_numpy().astype(np.int64)
        slot = (np.arange(len(owner)) - np.searchsorted(owner, owner))[pc.list_parent_indices(each).to_numpy()]
        wide = int(pos.max(initial=0)) + within + 1  # no row's places reach into the next row's
        at = row * wide + pos
        lengths = pc.list_value_length(lists).to_numpy()
        starts = np.unique(at)
        met = np.ones(len(starts), bool)
        for k in range(int(lengths.max(initial=0))):
            own = at[slot == k]
            ahead = np.append(own, np.iinfo(np.int64).max)[np.searchsorted(own, starts)]
            met &= (ahead <= starts + within) | (lengths[starts // wide] <= k)
        found = starts[met]
        first = np.flatnonzero(np.diff(found // wide, prepend=-1) != 0)
        rows = pa.array(found[first] // wide)
        listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(found)), pa.int32()), pa.array((found % wide).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("query").take(rows), batch.column("doc").take(rows), listed], ["query", "doc", "starts"])


def near(index: Index, queries: DataFrame, within: int) -> DataFrame:
    """query, doc, starts: the positions from which all (different) terms of a query stand within `within` further positions, in any order.

    Places are compared in documents that have all terms only.
    """
    terms = query_terms(index, queries, distinct=True)
    found, met = others(index, terms)
    whole = met.groupBy("query", "doc").agg(F.first("n").alias("n"), F.first("lead").alias("lead"), F.collect_list("positions").alias("rest")).where(F.size("rest") == F.col("n") - 1)
    lists = whole.select("query", "doc", F.concat(F.array("lead"), "rest").alias("lists")).unionByName(found.where("n = 1").select("query", "doc", F.array("positions").alias("lists")))
    kinds = {k: lists.schema[k].dataType.simpleString() for k in ("query", "doc")}
    return lists.mapInArrow(lambda batches: close(batches, within), f"query {kinds['query']}, doc {kinds['doc']}, starts array<int>")
