"""Postings beside undecided sets are found by set filters."""

from playmart.llm import line_dedup
from playmart.llm.common import importable


def test_wanted_postings_come_without_a_join(spark):
    importable(spark)
    df = spark.createDataFrame([(k, r, 9, 0, 0, 0, r, 0) for k in range(50) for r in (k, k + 1)], line_dedup.POSTING)
    near = line_dedup.beside(df, spark.createDataFrame([(7,)], "key long"), spark.createDataFrame([(8,)], "rep long"))
    assert "Join" not in near._jdf.queryExecution().toString()
    assert sorted((r.key, r.rep, r.want) for r in near.filter("key = 7").collect()) == [(7, 7, 0), (7, 8, 1)]
