"""Driver contract: entry smoke run and registry consistency."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"page_id", "url", "markdown"} <= set(df.columns)


def test_every_query_has_an_oracle_or_is_listed():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert set(qs) - set(orc) <= set(E.EXTRA)
