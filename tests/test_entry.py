"""Driver contract: entry, queries and oracles line up."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 93  # W4 P=60 F=3 on sf0.001
    assert "ts_us" in df.columns and "sum_cmmc_max" in df.columns


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 37
    missing = set(q) - set(o) - set(E.LLM_QUERIES)  # those are tested in tests/llm
    assert missing <= {"fit_lagged_ridge", "sink_tfrecord_roundtrip", "stream_transform"}, missing
