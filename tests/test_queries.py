"""Every registered span query against its DuckDB SQL, and the known answers."""

from pathlib import Path

import duckdb
import pytest

from spanloom.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(df, columns):
    clean = df[columns].astype(object).where(df[columns].notna(), None)
    return sorted(map(repr, clean.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DIR).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_known_answers(spark):
    counts = QUERIES["call_counts"](spark, DIR).toPandas()
    assert (len(counts), counts.call_count.sum(), len(counts[["parent", "child"]].drop_duplicates())) == (16151, 17766, 144)
    assert QUERIES["dedupe_spans"](spark, DIR).where("renamed").count() == 4625
    assert QUERIES["focal_node_index"](spark, DIR).count() == 15073
    quality = QUERIES["quality_counts"](spark, DIR).groupBy("metric", "submetric").sum("count").toPandas().set_index(["metric", "submetric"])["sum(count)"]
    assert quality["HasClientSpans", "PASS"] == 20428 and quality["HasServerSpans", "FAIL"] == 7116 and quality["HasUniqueSpanIds", "FAIL"] == 16683 and quality["MinimumClientVersionCheck", "PASS"] == 17999
