"""Context trees: every context of three bytes has counts of its own, however rare."""

import collections
import math
import zlib

import pytest
from playmart.llm import ctw
from playmart.llm.common import importable


def _block(zeros, ones):
    return math.lgamma(zeros + .5) + math.lgamma(ones + .5) - math.lgamma(zeros + ones + 1) - 2 * math.lgamma(.5)


def _before(data, i):
    """The contexts of 0 to 3 bytes before a place, newest byte last; an end mark hides what lies before it."""
    c = bytes([255] * 3) + data
    three = bytearray(c[i:i + 3])
    for j in (1, 0):
        if three[j + 1] == 255:
            three[j] = 255
    return [bytes(three[3 - d:]) for d in range(4)]


def brute(train, texts):
    counts = collections.defaultdict(lambda: [0, 0])
    kids = collections.defaultdict(set)
    for t, times in collections.Counter(train).items():
        data = t.encode() + b"\xff"
        for i, byte in enumerate(data):
            ctx = _before(data, i)
            for d in range(4):
                node = 1
                for k in range(7, -1, -1):
                    counts[ctx[d], node][byte >> k & 1] += times
                    if d < 3:
                        kids[ctx[d], node].add(ctx[d + 1])
                    node = 2 * node + (byte >> k & 1)
    known = {c for c, _ in counts}
    memo = {}

    def weigh(c, node):
        """ln of the weighted probability, and the weight of not splitting."""
        if (c, node) not in memo:
            own = _block(*counts.get((c, node), (0, 0)))
            if len(c) == 3:
                memo[c, node] = own, 1.0
            else:
                below = sum(weigh(x, node)[0] for x in kids.get((c, node), ()))
                top = max(own, below)
                both = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
                memo[c, node] = both, math.exp(own - both - math.log(2))
        return memo[c, node]

    def one(ctx, node, d=0):
        a, b = counts.get((ctx[d], node), (0, 0))
        own = (b + .5) / (a + b + 1)
        if d == 3 or ctx[d + 1] not in known:
            return own
        w = weigh(ctx[d], node)[1]
        return w * own + (1 - w) * one(ctx, node, d + 1)

    out = []
    for t in texts:
        data, total = t.encode() + b"\xff", 0.0
        for i, byte in enumerate(data):
            ctx, node = _before(data, i), 1
            for k in range(7, -1, -1):
                bit = byte >> k & 1
                p = one(ctx, node)
                total += math.log10(p if bit else 1 - p)
                node = 2 * node + bit
        out.append(total)
    return out


def test_rare_contexts_against_brute_force(spark):
    importable(spark)
    odd = ["1zq! 2zq? 1zq! 3zq. 3zq.", "4zq? xyw wyx, 2zq? ayb", "", "zq 1zq! unseen é漢 1zq~", "4zq? ~~~ 2zq!"]
    common = ["ab cd ef gh " * 4000] * 40       # so many bytes that a context seen 20 times has less than 1 / 2**16
    docs = list(enumerate(common + odd * 4))
    held = {d for d, _ in docs if zlib.crc32(str(d).encode()) % 10 == 0}
    train = [t for d, t in docs if d not in held]
    assert sum(len(t) + 1 for t in train) > 20 * ctw.SHARE_CONTEXT and held & set(range(40, 60))
    got = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute(train, odd)
    for d, t in docs[40:]:
        assert got[d] == pytest.approx(want[odd.index(t)], rel=1e-5, abs=1e-4), (d, t)
    nothing = spark.createDataFrame([(d, t) for d, t in docs if d in held], "doc_id long, text string")
    untrained = {r.doc_id: r.score for r in ctw.score(nothing).collect()}
    for d, t in docs:
        if d in held:
            assert untrained[d] == pytest.approx(8 * math.log10(.5) * (len(t.encode()) + 1))
