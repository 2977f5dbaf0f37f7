"""Driver contract: every registered query runs on sf0.001 with stable names."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "score_oportunidade" in df.columns


def test_every_query_has_oracle_or_is_declared_rows_only(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    llm = {k for k in q if k == "pipeline" or k[:2] == "op" and k[2:3].isdigit()}
    assert set(q) - set(o) <= llm


def test_all_queries_run_small(spark):
    from tests.conftest import SF
    from notaflow.plans.registry import QUERIES
    for name, fn in QUERIES.items():
        df = fn(spark, SF)
        assert df.count() >= 0, name
        assert len(df.columns) == len(set(df.columns)), name
