"""Postings go through the shuffle in buckets, and sets of a key are paired within their size range."""

import numpy as np
import pyarrow as pa

from playmart.llm import line_dedup, near, parity_join
from playmart.llm.common import importable


def exchanges(df):
    return [x for x in df._jdf.queryExecution().toString().splitlines() if "Exchange" in x]


def test_buckets_hold_what_was_packed():
    rng = np.random.default_rng(1)
    parts = [{"key": rng.integers(-9, 9, n), "rep": rng.integers(-1 << 62, 1 << 62, n)} for n in (0, 1, 700)]
    kinds = near.kinds_of("key long, rep long")
    rows = pa.Table.from_batches(list(near.packed(iter(parts), kinds, 5))).sort_by("bucket").combine_chunks().to_batches(2)
    got = [(k, r) for c in near.raw_buckets(iter(rows), kinds) for k, r in zip(c["key"].tolist(), c["rep"].tolist(), strict=True)]
    assert sorted(got) == sorted((k, r) for p in parts for k, r in zip(p["key"].tolist(), p["rep"].tolist(), strict=True))
    whole = [c["key"].tolist() for c in near.raw_buckets(iter(rows), kinds)]
    assert sum(map(len, map(set, whole))) == len(set().union(*whole))      # no key lies in two buckets


def test_pairs_are_dealt_out_by_bucket(spark):
    importable(spark)
    df = spark.createDataFrame([(k, r, 9, 1, 5, 5) for k in range(40) for r in (k, k + 1)], parity_join.POSTING)
    pairs = near.candidate_pairs(df, 85, every=True)
    assert exchanges(pairs) and all("hashpartitioning(bucket" in x for x in exchanges(pairs))
    assert sorted((r.later, r.earlier) for r in pairs.collect()) == [(k + 1, k) for k in range(40)]


def test_repeated_keys_are_counted_in_buckets(spark):
    importable(spark)
    df = spark.createDataFrame([([1, 2, 1 << 38],), ([2, 3],), ([1 << 38, 2],), ([],)], "keys array<long>")
    got = near.repeated(df, 3)
    assert all("hashpartitioning(bucket" in x for x in exchanges(got))
    assert sorted(r.key for r in got.collect()) == [2, 1 << 38]


def test_sets_meet_within_their_size_range():
    n = np.repeat([10, 20, 40], 300)
    run = near.Run({"key": np.ones(900, np.int64), "rep": np.arange(900), "n": n})
    tried = [(i, j) for x, y in run.blocks(80) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    assert sorted(tried) == [(i, j) for i in range(900) for j in range(i) if n[i] == n[j]]


def test_tokens_are_sorted_as_by_line_rank_and_hash():
    text = "\n".join(f"a b w{i % 7} w{i} b" for i in range(400)).encode()
    t = line_dedup.Tokens([text, b"", b"\n x y x\n"])
    ranks = line_dedup.ranks_of(np.bincount((t.hashes % np.uint64(line_dedup.COUNTERS)).astype(int), minlength=line_dedup.COUNTERS))
    place = ranks[t.hashes % np.uint64(line_dedup.COUNTERS)]
    for got, order in ((t.sets(ranks), np.lexsort((t.hashes, place, t.of))), (t.sets(None), np.lexsort((t.hashes, t.of)))):
        want = list(dict.fromkeys(zip(t.of[order].tolist(), t.hashes[order].tolist(), strict=True)))
        assert list(zip(got[1].tolist(), got[0].tolist(), strict=True)) == want
        assert got[2].tolist() == [[of for of, _ in want].index(i) for i in range(401)]


def test_only_lines_that_come_twice_or_match_are_returned(spark):
    importable(spark)
    one = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, one), (2, "alone here"), (3, one + " eleven"), (4, one), (4, one)], "doc_id long, text string")
    assert sorted({(r.doc_id, r.line) for r in line_dedup.gone_lines(docs).collect()}) == [(3, 0), (4, 0)]
