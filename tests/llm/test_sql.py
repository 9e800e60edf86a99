"""The contract queries that SQL can express against DuckDB, on the smallest tables and on odd rows."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from quillstream.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def compared(spark, name, folder):
    c = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    found = c.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(x) for x in columns]
    assert sorted(map(str, (tuple(r) for r in got.select(columns).collect()))) == sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    compared(spark, name, SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_odd_rows(spark, name, tmp_path):
    passage = "Überall one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    docs = [(1, passage), (2, f"x {passage.upper()} y"), (3, None), (4, ""), (5, passage * 40), (6, "a" * 300), (7, "é" * 200), (8, f"{passage}|{passage}"), (9, "one"), (10, "aé" * 100)]
    docs += [(11, "# one *two*\n\n \n# one *two*\nà b c à b c\x0bd"), (12, "w " * 60)]
    spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage), (2, "One!"), (3, None), (4, ", "), (5, f"{passage} more")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pages = [(1, "http://a.b/ x", "z" * 2000), (2, None, "z" * 2000), (3, "u", None), (4, "u", "z" * 999), (5, "u", "z" * 999), (6, "v", "é" * 500)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    compared(spark, name, str(tmp_path))
