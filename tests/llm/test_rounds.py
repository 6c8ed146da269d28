"""First rounds that leave little to the second, and what the second round carries."""

import itertools

import numpy as np

from playmart.llm import near, parity_join
from playmart.llm.common import importable


def numbers(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))


def test_pairs_already_tried_go_without_a_join(spark):
    pairs = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 1)] * 3, "later long, earlier long")
    rest = near.untried(pairs, spark.createDataFrame([(1, 0), (9, 0)], "later long, earlier long"))
    assert "Join" not in rest._jdf.queryExecution().toString()
    assert sorted(map(tuple, rest.collect())) == [(2, 0), (2, 1)]


def test_folded_sketches_of_all_sizes_bound_the_difference(spark):
    importable(spark)
    rng = np.random.default_rng(5)
    sets = [numbers(rng, n) for n in (1, 40, 300, 900, 5000)]
    sets += [np.concatenate([x[:-7], numbers(rng, 7)]) for x in sets[1:]]
    df = spark.createDataFrame([(i, bytearray(near.wide_sketch(x))) for i, x in enumerate(sets)], "rep long, wide binary")
    got = {r[0]: np.array(r[1:], np.int64).view(np.uint64) for r in near.folded(df).collect()}
    for a, b in ((1, 5), (2, 6), (3, 7), (4, 8)):
        far = int(np.bitwise_count(got[a] ^ got[b]).sum())
        assert 0 < far <= len(np.setxor1d(sets[a], sets[b]))


def test_second_round_leaves_out_pairs_that_whole_sketches_tell_apart(spark):
    """Parts can't tell these sets apart (all agree in one part), the sketches of the whole sets can."""
    importable(spark)
    rng = np.random.default_rng(6)
    one = numbers(rng, 400)
    wide = [near.wide_sketch(np.concatenate([one[:250], numbers(rng, 150)])) for _ in range(20)]
    rows = [(1, i, 400, 2, 5, 5) for i in range(20)]
    df = spark.createDataFrame(rows, parity_join.POSTING)
    assert near.candidate_pairs(df, 85, every=True).count() == 190
    sketched = spark.createDataFrame([(i, bytearray(w)) for i, w in enumerate(wide)], "rep long, wide binary")
    assert near.candidate_pairs(df.join(near.folded(sketched), "rep"), 85, every=True).count() == 0


def test_only_wanted_sets_are_paired():
    for n in (20, 130, 1200):
        want = np.zeros(n, np.int64)
        want[[3, n // 2, n - 1]] = 1
        run = near.Run({"key": np.ones(n, np.int64), "rep": np.arange(n), "n": np.full(n, 9), "want": want})
        got = [(i, j) for x, y in run.blocks() for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        assert sorted(got) == [(i, j) for i in (3, n // 2, n - 1) for j in range(i)]


def test_unsure_sets_get_several_of_the_closest():
    for n in (30, 700):
        rng = np.random.default_rng(n)
        sig = (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)).view(np.int64)
        sig[1] = sig[0]
        run = near.Run({"key": np.ones(n, np.int64), "rep": np.arange(n), "n": np.full(n, 14), "s0": sig})
        got = run.closest(80, 4).to_pylist()
        one = {r["later"]: r for r in run.closest(80).to_pylist()}
        bits = sig.view(np.uint64)
        for later, rows in itertools.groupby(got, lambda r: r["later"]):
            rows = list(rows)
            far = sorted((int(np.bitwise_count(bits[later] ^ bits[j])), j) for j in range(later))
            far = [f for f in far if f[0] <= near.most_difference(14, 14, 80)]
            told = 4 if 2 * far[0][0] > near.most_difference(14, 14, 80) else 1
            assert [r["far"] for r in rows] == [f for f, _ in far[:told]]
            assert {(r["far"], r["earlier"]) for r in rows} <= set(far) and len({r["earlier"] for r in rows}) == len(rows)
            assert {r["more"] for r in rows} == {len(far) > told}
            assert one[later]["far"] == far[0][0]
