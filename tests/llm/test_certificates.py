"""What the operators certify: cutoffs, bins, fingerprints."""

import json
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from playmart.llm import merkle, packing, quality_rules
from playmart.llm.common import importable

PATH = public_tokenizers.path("byte_bpe_50k.json")


def tail(k, n, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


def test_levels_are_chosen_in_sequence(spark):
    rng = random.Random(2)
    measured, labels, by_hand = [], [], {}
    for s, n_good, n_bad, dirty in (("a", 400, 100, 0.0), ("b", 400, 100, 0.02), ("c", 60, 60, 0.0), ("d", 300, 0, 0.0), ("e", 500, 80, 0.2)):
        rows = []
        for i in range(n_good + n_bad):
            bad = i >= n_good
            share = rng.uniform(0.1, 1.2) if bad or rng.random() < dirty else rng.uniform(0, 0.04)
            rows.append((f"{s}{i}", s, False, share, 0.0, 0.0, 5.0, int(not bad)))
        measured += [r[:7] for r in rows]
        labels += [(r[0], r[7]) for r in rows]
        by_hand[s] = [(r[3], r[7]) for r in rows]
    df = spark.createDataFrame(measured, "doc_id string, stratum string, base_failed boolean, symbol_share double, "
                                         "dup_line_share double, repeat_share double, word_length double")
    got = quality_rules.select_levels(quality_rules.tests(df, spark.createDataFrame(labels, "doc_id string, quality int")))
    want = {}
    for s, rows in by_hand.items():
        good, bad = [x for x, q in rows if q], [x for x, q in rows if not q]
        best = (0.0, None)
        for k, cut in enumerate(quality_rules.GRID["symbol_share"]):
            lost = sum(x > cut for x in good)
            if tail(lost, len(good), quality_rules.RISK) > quality_rules.ERROR / len(by_hand):
                break
            gain = sum(x > cut for x in bad) / max(1, len(bad)) - 10 * lost / len(good)
            if gain > best[0] + 1e-12:
                best = (gain, k)
        if best[1] is not None:
            want[s] = best[1]
    assert {r.stratum: r.level for r in got.collect()} == want
    assert {"a", "b"} <= set(want) and not {"c", "d"} & set(want)


def test_every_language_gets_a_verdict(spark):
    importable(spark)
    d = "/root/testdata/sf0.1"
    got = quality_rules.judge(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    langs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    seen = {(r.lang, r.verdict) for r in got.join(langs, "doc_id").select("lang", "verdict").distinct().collect()}
    assert {lang for lang, v in seen if v != "base rule"} >= {"en", "de", "fr", "es"}
    lost = (got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("quality = 1 AND NOT base_failed")
            .agg(F.avg((~F.col("kept")).cast("int"))).first()[0])
    assert lost <= quality_rules.RISK


def test_exchange_among_partitions_with_gaps(spark):
    importable(spark)
    rng = random.Random(6)
    lengths = [rng.choice([350, 340, 330, 520, 100, 1000, 24]) for _ in range(900)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "uid long, length long").repartition(3)
    packed, report = packing.pack(items, 1024, 60)
    rows = packed.join(items, "uid").collect()
    assert len(rows) == len(lengths)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 1024
    one = packing.best_fit_decreasing(np.array(lengths), 1024)[2]
    assert len(bins) == report["bins"] >= report["bound"] and report["partitions"] > 10
    assert report["exchanges"] > 0 and report["bins"] <= one + 3


def test_ids_in_another_order_go_to_the_library(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    assert packing.ids_follow_merges(spec["model"])
    vocab = spec["model"]["vocab"]
    a, b = "Ġthe", "Ġand"
    vocab[a], vocab[b] = vocab[b], vocab[a]
    assert not packing.ids_follow_merges(spec["model"])
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    from tokenizers import Tokenizer
    texts = ["the cat and the hat", "", "and  the\n end <|endoftext|> x"]
    want = [x.ids for x in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.RankEncoder(str(path)).encode(texts)] == want


def test_likeness_comes_from_the_fingerprints(spark):
    texts = ["One. Two. Three.\n\nFour, five.", "One. Two. Three.", "", "Same, same, same", "Other words here. Two."] * 3 + ["last. one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in merkle.fingerprints(df).collect()}

    def leaves(f):
        return set(f.split(":")[3].split("."))

    for i, r in got.items():
        for other, near in ((r.edited_fingerprint, r.near_edited), (got[(i + 1) % len(texts)].fingerprint, r.near_next)):
            x, y = leaves(r.fingerprint), leaves(other)
            assert near == pytest.approx(2 * len(x & y) / (len(x) + len(y)))
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
        assert r.n_chars == len(texts[i])
        assert (r.edited_fingerprint == r.fingerprint) == (edited == texts[i])
    pair = merkle.fingerprints(df).select(merkle.likeness_of("fingerprint", "edited_fingerprint").alias("x"), "near_edited")
    assert all(r.x == r.near_edited for r in pair.collect())
    assert len({r.fingerprint for r in got.values()}) == len(set(texts))
