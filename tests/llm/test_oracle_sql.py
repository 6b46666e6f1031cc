"""The queries that SQL can express against DuckDB, on the given tables and on
odd rows."""

import duckdb
import pytest

from harness import compare, duck
from logsift.llm.oracle import ORACLE_SQL
from logsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF), QUERIES[name], ORACLE_SQL[name], SF)
    assert r["cols_match"] and r["rows_spark"] == r["rows_oracle"] and r["hash_match"], r


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql_on_odd_rows(spark, tmp_path, name):
    words = [f"w{k}" for k in range(60)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, " ".join(words)), (5, " ".join(words).upper()), (6, " ".join(words[:59])), (7, "a b"), (8, "A  b"), (9, "é, ß! x"),
            (10, "x " * 90), (11, " ".join(words[5:45])), (12, "# | " + " ".join(words) + "\nsame line\nsame line\n")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "A, b!"), (2, None), (3, "..."), (4, " ".join(words[3:30])), (5, "x x"), (6, "É, ß")], "item_id long, text string").coalesce(1).write.parquet(
        f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    r = compare(spark, con, QUERIES[name], ORACLE_SQL[name], str(tmp_path))
    assert r["cols_match"] and r["rows_spark"] == r["rows_oracle"] and r["hash_match"], r
