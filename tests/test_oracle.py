"""Every registered query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from sentimill.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["eval_precision", "eval_onepass", "html_unescape", "tweet_clean", "process_tweet",
        "hashed_tf", "nb_predict", "kmeans_update", "kmeans_stream", "parse_lines", "parse_csv",
        "stream_decode", "positional_join"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _norm(tuple(r[c] for c in cols) for r in df.collect())
    rel = con.sql(oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    want = _norm(tuple(r[idx[c]] for c in cols) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["id", "polarity", "terms"]
    assert df.count() > 0
