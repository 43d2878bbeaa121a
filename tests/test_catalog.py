"""Every registered query against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from chronolith import catalog, model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in model.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows):
    return sorted(tuple(str(v.item() if hasattr(v, "item") else v).replace(" 00:00:00", "") for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    found = db.execute(f"SELECT {', '.join(cols)} FROM ({catalog.ORACLE[name]}) t").fetchall()
    assert canonical(df.select(*cols).collect()) == canonical(found)


def test_entry_has_rows_and_contract(spark):
    assert entry.entry(spark).columns == ["member", "name", "term_no", "constituency", "overlap_start"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["q14_status_history", "c15_ordered_stages"])
def test_histories_cover_all_bills(spark, name):
    want = model.table(spark, SF, "lineitem").select("l_orderkey").distinct().count()
    assert catalog.QUERIES[name](spark, SF).select("bill").distinct().count() == want


def test_labels_are_whole_words(spark):
    labels = dict(map(tuple, model.view(spark, SF, "concepts").select("concept", "label").collect()))
    for r in model.table(spark, SF, "benchmark").collect():
        assert labels[r["item_id"]].split() == r["text"].lower().split()[:3]
