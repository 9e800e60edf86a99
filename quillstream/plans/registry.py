"""The register of driver queries, and SQL that several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with the SQL that gives the same rows."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


#: Tables with long texts, on whose rows much work is done.
TEXTS = {"documents", "pages", "benchmark", "conversations"}


def dealt(rows: DataFrame) -> DataFrame:
    """Rows on which much work is done: dealt out, if they are in fewer partitions than there are cores. Short rows of a large table are a small file, read by one task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows._jdf.queryExecution().toRdd().getNumPartitions() < cores else rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one of texts, in fewer partitions than there are cores, is dealt out first."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(rows) if name in TEXTS else rows


#: Lines of the documents, and where they begin and end.
SQL_LINES = "(SELECT doc_id, CAST(l.i - 1 AS INT) AS line_no, l.line AS line FROM (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i, 'line': x})) AS l FROM documents))"
SQL_SPANS = f"(SELECT *, start_offset + n_chars AS end_offset FROM (SELECT doc_id, line_no, length(line) AS n_chars, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_offset FROM {SQL_LINES}))"
