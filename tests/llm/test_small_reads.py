"""The matrix of op11 is read few blocks at a time."""


def test_blocks_are_read_few_at_a_time(spark, monkeypatch):
    from gridloom.llm import resampling as R
    from gridloom.llm.common import READ_ROWS

    seen = []
    monkeypatch.setattr(R, "spool", lambda df, name, spool=R.spool: (seen.append((name, int(spark.conf.get(READ_ROWS)))), spool(df, name))[1])
    docs = spark.createDataFrame([(i, "a b c " * (i + 8)) for i in range(20)], "doc_id long, text string")
    assert R.resample(docs, docs.limit(3).select("text")).count() == 20
    assert dict(seen)["scored"] <= R.BLOCKS
    assert int(spark.conf.get(READ_ROWS)) > R.BLOCKS
