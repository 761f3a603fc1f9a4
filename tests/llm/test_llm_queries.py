"""Registered queries against DuckDB, where SQL can express them."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["op1_chat_formatting", "op2_line_dedup", "op4_warc", "op7_quality_rules",
                                 "op9_url_filter", "op11_collocations"])
def test_query_matches_sql(spark, key):
    from tidemart.llm import queries
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[key](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[key]})")
    want = sorted(map(tuple, cur.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=repr) == want


def test_every_operator_has_a_query():
    from tidemart.llm import queries
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(queries.oracle_sql()) <= names


def test_url_filter_with_an_ampersand_in_the_path(spark, tmp_path):
    from tidemart.llm import queries
    urls = ["http://h/a/&b", "http://h/a/&b", "http://h/x&ref=1", "http://h/x&ref=1", "http://h/x",
            "http://h/q?a=1&utm_x=2", "http://h/q/?a=1", "http://h/once"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op9_url_filter(spark, str(tmp_path)).orderBy("page_id").select("page_id", "verdict").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = con.execute(f"SELECT page_id, verdict FROM ({queries.OP9_SQL}) ORDER BY page_id").fetchall()
    assert [tuple(r) for r in got] == want
    assert [v for _, v in want] == ["block"] * 4 + ["allow", "block", "block", "allow"]
