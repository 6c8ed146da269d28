"""Set filters folded to their content, and the parts of long documents."""

import numpy as np
from pyspark.sql import functions as F

from playmart.llm import parity_join
from playmart.llm.common import importable
from playmart.llm.near import Bits, among, candidate_pairs


def numbers(rng, n):
    return rng.integers(0, 1 << 63, n).astype(np.uint64)


def test_a_filter_is_as_large_as_its_keys(spark):
    importable(spark)
    df = spark.range(4000).select(F.xxhash64("id").alias("key"))
    held = Bits.of(df.limit(0)), Bits.of(df)
    assert [len(h.words) for h in held][0] == 1 << 10 and len(held[1].words) <= 1 << 14
    assert held[1].holds(df.toPandas()["key"].to_numpy()).all()
    other = spark.range(4000, 104000).select(F.xxhash64("id").alias("key"))
    assert among(other, "key", df).count() < 500
    assert among(df.union(other), "key", df).intersect(df).count() == 4000


def test_chance_does_not_make_long_documents_candidates(spark):
    """Long sets with a tenth in common share blocks; the sketches of their parts tell them apart."""
    importable(spark)
    rng = np.random.default_rng(3)
    common, rows = numbers(rng, 300), []
    for i in range(150):
        own = np.unique(np.concatenate([common, numbers(rng, 2700)]))
        for keys, sizes, parts, sketch in parity_join.filed(own, 85):
            sig = np.repeat(sketch.view(np.int64), sizes, axis=0)
            rows += [(k, i, len(own), parts, *s) for k, s in zip(keys.view(np.int64).tolist(), sig.tolist(), strict=True)]
    df = spark.createDataFrame(rows, parity_join.POSTING)
    assert df.groupBy("key").count().filter("count > 1").count() > 10
    assert candidate_pairs(df, 85, every=True).count() == 0


def test_long_documents_that_differ_as_far_as_allowed_meet(spark):
    importable(spark)
    rng = np.random.default_rng(4)
    rows = []
    for i, n in enumerate([30, 200, 700, 3000, 9000]):
        a = numbers(rng, n)
        most = next(x for x in range(n, 0, -1) if 100 * (n - x) >= 85 * (n + x))
        b = np.concatenate([a[most:], numbers(rng, most)])
        for rep, own in ((2 * i, np.unique(a)), (2 * i + 1, np.unique(b))):
            for keys, sizes, parts, sketch in parity_join.filed(own, 85):
                sig = np.repeat(sketch.view(np.int64), sizes, axis=0)
                rows += [(k, rep, n, parts, *s) for k, s in zip(keys.view(np.int64).tolist(), sig.tolist(), strict=True)]
    got = candidate_pairs(spark.createDataFrame(rows, parity_join.POSTING), 85, every=True).distinct().collect()
    assert {(r.earlier, r.later) for r in got} == {(2 * i, 2 * i + 1) for i in range(5)}
