"""The driver contract: registry, oracle coverage, and value equality at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from affinity.plans.oracle import ORACLE
from affinity.plans.queries import REGISTRY
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest, norm



def test_every_key_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(REGISTRY) == set(ORACLE)
    assert set(o) <= set(q)
    assert len(q) >= 45


def test_entry_smoke(spark):
    df = entry.entry(spark)
    row = df.collect()
    assert len(row) == 1 and row[0]["pearson_neighbours"].count(",") == 29


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", [
    "rating_density", "user_cf_top10", "item_topk", "item_cf_top10_positive", "edges_merged",
    "edge_quantiles", "adjacency_in", "candidates", "tfidf_rank", "tfidf_rank_docs",
    "hashed_tfidf_rank", "hashed_tfidf_rank_docs", "hashing_tfidf_ml", "baseline_predict",
    "rec_documents",
])
def test_query_matches_oracle(spark, duck, key):
    s = entry.queries()[key](spark, SF_SMALL).toPandas()
    o = duck.sql(entry.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(norm(s)) == digest(norm(o))
