"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import decimal

import duckdb
import pytest

from ribospark.plans import queries, stage_queries

ORACLES, QUERIES = queries.ORACLES | stage_queries.ORACLES, queries.QUERIES | stage_queries.QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, decimal.Decimal | float):
        return "nan" if x != x else float(f"{x:.9g}")
    if isinstance(x, list | tuple):
        return tuple(map(plain, x))
    return x


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in cur.fetchall())
    assert sorted(repr([plain(r[c]) for c in sorted(names)]) for r in df.collect()) == want
