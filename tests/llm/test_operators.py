"""Operators on text against brute force, the libraries they stand for, and odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from playmart.llm import (ctw, line_dedup, merkle, packing, parity_join, ppm_langid, quality_rules, sharding,
                          span_dedup, trie_bpe)
from playmart.llm.common import importable, lower_words

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, `key` string, doc string"


def corpus():
    """A few hundred invented documents with copies, near copies, shared lines and passages."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices(["an", "the", "on", "ti", "re", "sh", "é", "ble", "or"], k=rng.randint(1, 4)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(3, 12))).capitalize() + "."
    line = lambda: " ".join(sentence() for _ in range(rng.randint(1, 4)))
    passage = " ".join(sentence() for _ in range(8))
    docs = ["\n".join(line() for _ in range(rng.randint(1, 8))) for _ in range(120)]
    for i in range(60):
        ws = docs[i % 7].split(" ")
        for _ in range(i % 4):
            ws[rng.randrange(len(ws))] = word()
        docs.append(" ".join(ws))
    docs += [docs[3]] * 5 + [docs[i].replace(" ", " " + passage + " ", 1) for i in range(20, 30)]
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    rows = [(i, t, "ab"[i % 2], "s", len(t), 1, "k", "d") for i, t in enumerate(corpus())]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def texts():
    return list(enumerate(corpus()))


@pytest.fixture(scope="module")
def odd(spark):
    importable(spark)
    rows = [(1, None, None, None, None, 1, "k", "d"), (2, "", "a", "s", 0, 1, "k", "d"), (None, "Some words here.", "a", None, 1, 2, None, "d"),
            (3, " \t\n\x0b ", "a", "s", 5, 1, "k", "d"), (4, "x" * 5000, "a", "s", 5000, 1, "k", "d"),
            (5, "123 456", "b", "s", 7, 1, "k", "d"), (6, "w " * 30_000, "b", "s", 60_000, 1, "k", "d"),
            (7, "a b c d e f g\n\na b c d e f g", "b", "s", 27, 1, "k", "d"), (7, "a b c d e f g\n\na b c d e f g", "b", "s", 27, 1, "k", "d"),
            (7, "another text under one id", "b", "s", 25, 1, "k", "d"), (8, "<|endoftext|> in  a   text ", "b", "s", 9, 1, "k", "d")]
    return spark.createDataFrame(rows, SCHEMA)


def shingle_set(text, k):
    w = lower_words(text)
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute_components(rows, k, share):
    sets = [(d, shingle_set(t, k)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(s), least[find(i)]) for i, (d, s) in enumerate(sets)}


def test_sharding_fits_and_splits_only_what_is_over(docs):
    got = sharding.shard(docs, 3000).collect()
    size = collections.Counter()
    for r in got:
        size[r.shard_id, r.page] += r.n_bytes
    assert len(got) == docs.count() and all(v <= 3000 for k, v in size.items() if not k[0].startswith("big"))
    by_prefix = collections.Counter()
    for (prefix, _), v in size.items():
        if not prefix.startswith("big"):
            for n in range(len(prefix)):
                by_prefix[prefix[:n]] += v
    assert all(v > 3000 for v in by_prefix.values())  # every split bucket was over the limit


def test_sharding_pages_of_equal_rows(spark):
    importable(spark)
    same = spark.range(50).select(F.lit(1).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    pages = collections.Counter(r.page for r in sharding.shard(same, 1000).collect())
    assert sorted(pages.values()) == [10] * 5


def test_spans_against_brute_force(docs, texts):
    first, gone = {}, collections.defaultdict(set)
    for d, t in texts:
        units = [b" ".join(lower_words(t[a:b])) for a, b in span_dedup.sentences(t)]
        for i in range(len(units) - 2):
            run = tuple(units[i:i + 3])
            if sum(x.count(b" ") + 1 for x in run) >= span_dedup.LEAST and first.setdefault(run, (d, i)) != (d, i):
                gone[d] |= {i, i + 1, i + 2}
    got = {r.doc_id: r for r in span_dedup.report(docs).collect()}
    assert {d: r.n_removed for d, r in got.items()} == {d: len(gone[d]) for d, _ in texts}
    assert all(got[d].text == t for d, t in texts if not gone[d])


@pytest.mark.parametrize("k,share", [(4, 85), (5, 80)])
def test_jaccard_join_against_brute_force(docs, texts, k, share):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.join(docs, k, share).collect()}
    assert got == brute_components(texts, k, share)


def test_blocks_meet_the_bound():
    rng = np.random.default_rng(1)
    for n in [8, 20, 60, 150, 400]:
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for _ in range(20):
            most = parity_join.most_difference(len(a), len(a), 85) // 2
            keep = rng.permutation(len(a))[:len(a) - most]
            b = np.unique(np.concatenate([a[keep], rng.integers(0, 1 << 63, most).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert np.intersect1d(parity_join.block_keys(a, 85), parity_join.block_keys(b, 85)).size


def test_packing_places_and_bounds(docs, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    got = packing.pack_documents(docs, PATH, per_partition=40).collect()
    ids = {d: np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in texts}
    places, whole = collections.defaultdict(list), collections.Counter()
    for r in got:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert len(piece) == r.length <= 1024 and zlib.crc32(piece.tobytes()) == r.ids_crc32
        assert r.piece == 0 or r.length == 1024
        places[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id] += r.length
    assert whole == {d: len(x) for d, x in ids.items()}
    for p in places.values():
        end = 0
        for offset, length in sorted(p):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [len(x) % 1024 for x in ids.values() if len(x) % 1024]
    alone = packing.best_fit_decreasing(np.array(lengths), 1024)[2] + sum(len(x) // 1024 for x in ids.values())
    assert math.ceil(sum(whole.values()) / 1024) <= len(places) <= alone + 5  # five partitions


def test_lower_bound_holds_for_best_fit():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 80))
        where, offset, bins = packing.best_fit_decreasing(lengths, 100)
        assert np.bincount(where, lengths).max() <= 100
        assert packing.lower_bound(np.bincount(lengths, minlength=101), 100) <= bins
    assert packing.lower_bound(np.bincount([51] * 7, minlength=101), 100) == 7


def test_trie_equals_the_library():
    from tokenizers import Tokenizer
    tok, rng = Tokenizer.from_file(PATH), random.Random(2)
    parts = [*" \n\t'sabretingNI012.-é日本", "<|endoftext|>", "  ", "\r\n", " aaaa", "the", "ing", " ", "\x1c"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(4000)] + ["x" * 3000]
    want = [x.ids for x in tok.encode_batch(texts, add_special_tokens=False)]
    for enc in (trie_bpe.Encoder(PATH), packing.RankEncoder(PATH)):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want


def test_encode_decode_round_trip(docs, texts):
    got = {r.doc_id: r for r in trie_bpe.encode_decode(docs, PATH).collect()}
    assert all(got[d].same_text and got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for d, t in texts)
    back = trie_bpe.decode(trie_bpe.encode(docs, PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == dict(texts)


def test_ctw_base_and_distribution(docs, texts):
    count, total = collections.Counter(), 0
    for d, t in texts:
        if zlib.crc32(str(d).encode()) % 10:
            count.update([*lower_words(t), None])
            total += len(lower_words(t)) + 1
    got = {r.doc_id: r for r in ctw.score(docs).collect()}
    for d, t in texts:
        ws, r = [*lower_words(t), None], got[d]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    model = ctw.learn(docs.select("text", F.lit(False).alias("held_out")))
    assert np.allclose((10.0 ** model.table.astype(float)).sum(1), 1, atol=1e-4)  # each row is a distribution
    held = [r for r in got.values() if r.held_out]
    size = sum(len(dict(texts)[r.doc_id].encode()) + 1 for r in held)
    assert -sum(r.score for r in held) / math.log10(2) / size < 4  # bits a byte; eight untrained


def test_ctw_block_probability_is_exact():
    def sequential(a, b):
        p, zeros, ones = 1.0, 0, 0
        for bit in [0] * a + [1] * b:
            p *= ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
            zeros, ones = zeros + (not bit), ones + bit
        return math.log(p)

    for a, b in [(0, 0), (1, 0), (3, 5), (20, 1)]:
        assert ctw.block(np.array([float(a)]), np.array([float(b)]))[0] == pytest.approx(sequential(a, b), abs=1e-7)


def test_language_id_on_held_out(spark):
    importable(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = ppm_langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang_pred <> 'und'")
    rows = got.collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    ids, bits = ppm_langid.fit(b"the cat and the hat " * 5)
    assert np.allclose(np.exp2(-bits.astype(float)).sum(1), 1, atol=1e-4)


def test_quality_counts_and_risk(spark, docs, texts):
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in texts[:50]], "doc_id long, quality long, toxic long")
    got = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for d, t in texts:
        w, r = word.findall(t), got[d]
        at = collections.defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i:i + 5])].append(i)
        over = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if word.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(over))
        assert r.base_failed == (len(w) < 10 or 100 * len(over) > 20 * len(w)) and r.kept <= (not r.base_failed)
    tail = spark.range(1).select(F.expr(quality_rules.binomial_tail("2L", "10L", 0.2)).alias("p")).first()["p"]
    assert tail == pytest.approx(sum(math.comb(10, i) * 0.2 ** i * 0.8 ** (10 - i) for i in range(3)))


@pytest.mark.parametrize("hot", [200_000, 40])
def test_lines_against_brute_force(docs, texts, hot, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    seen, want = [], {}
    for d, t in texts:
        want[d] = []
        for k, x in enumerate(t.split("\n")):
            s = frozenset(lower_words(x))
            if s:
                if any(100 * len(s & y) >= 80 * len(s | y) for y in seen):
                    want[d].append(k)
                seen.append(s)
    assert {r.doc_id: r.removed_lines for r in line_dedup.report(docs).collect()} == want


def test_fingerprints_and_edits(spark, docs, texts):
    got = {r.doc_id: r for r in merkle.fingerprints(docs).collect()}
    for i, (d, t) in enumerate(texts):
        half, after = len(t) // 2, texts[(i + 1) % len(texts)][1]
        edited = t[:len(t) - half] + after[:half]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert len({r.fingerprint for r in got.values()}) == len({t for _, t in texts})
    pair = spark.createDataFrame([("One.\nTwo.\nThree.", "One.\nChanged.\nThree.")], "a string, b string")
    assert merkle.edits(pair, "a", "b").first()["changed_paragraphs"] == [1]


OPERATORS = {
    "sharding": lambda d: sharding.shard(d, 1000), "spans": span_dedup.report, "jaccard": parity_join.join,
    "packing": lambda d: packing.pack_documents(d, PATH), "bpe": lambda d: trie_bpe.encode_decode(d, PATH),
    "ctw": ctw.score, "language": ppm_langid.identify,
    "quality": lambda d: quality_rules.judge(d, d.selectExpr("doc_id", "1L AS quality")),
    "lines": line_dedup.report, "merkle": merkle.fingerprints, "keep_known": ppm_langid.keep_known,
    "line_remove": line_dedup.remove, "keep_one": parity_join.keep_one, "span_remove": span_dedup.remove,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_table(odd, name):
    rows = OPERATORS[name](odd).collect()
    if name in ("sharding", "spans", "jaccard", "bpe", "ctw", "language", "quality", "lines", "merkle"):
        assert len(rows) == odd.count()
    if name in ("keep_known", "line_remove", "keep_one", "span_remove"):
        assert OPERATORS[name](odd).columns == odd.columns and 0 < len(rows) <= odd.count()
    assert OPERATORS[name](odd.limit(0)).collect() == []
