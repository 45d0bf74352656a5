"""Driver contract: entry runs on sf0.001 and every query has a callable; oracle keys are registered queries."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:4] == ["scenario", "qid", "rank", "retrieval_rank"]


def test_oracle_keys_are_queries():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
