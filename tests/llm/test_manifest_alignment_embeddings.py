"""Merkle manifest, token alignment and embedding near-dedup against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playmart.llm import embedding_dedup, manifest, token_alignment
from playmart.llm.common import importable, materialise

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("tree", "digest", "root", "path", "held", "pos", "slice", "links", "_key", "name", "vec", "node", "my col")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def fold_up(level):
    """All levels over the lowest one, by runs of eight."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def climb(levels, at, h):
    """Siblings of a node, and what h gives in its place."""
    proof = []
    for level in levels[:-1]:
        run, k = level[at // 8 * 8:at // 8 * 8 + 8], at % 8
        proof += run[:k] + run[k + 1:]
        h, at = sha(*run[:k], h, *run[k + 1:]), at // 8
    return proof, h


def audit_by_hand(rows):
    """rows: (doc_id, text, lang, source, n_chars), ids ascending within a language without ties."""
    leaf = lambda r, text: sha(*map(field, (r[0], r[3], r[2], r[4], text)))
    by = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        by[r[2]].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: fold_up([leaf(r, r[1]) for r in by[x]]) for x in langs}
    top = fold_up([trees[x][-1][0] for x in langs])
    out = []
    for n, x in enumerate(langs):
        for k, r in enumerate(by[x]):
            text = r[1]
            if text is not None and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            low, h = climb(trees[x], k, leaf(r, text))
            high, h = climb(top, n, h)
            out.append((r[0], leaf(r, r[1]), trees[x][-1][0], top[-1][0], sha(*low, *high), h, h == top[-1][0]))
    return out


def extended(df):
    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, None: 3}, {"de": 600, "en": 65, "": 1, "é": 8, None: 512}])
def test_manifest_by_hand(spark, sizes):
    rng = random.Random(3)
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            at += rng.randint(1, 5)
            rows.append((at, rng.choice([None, "", "Straße ÄB", "plain", "A Text\nof lines"]), lang, rng.choice([None, "s", "é"]),
                         rng.choice([None, -1, 12])))
    rng.shuffle(rows)
    got = manifest.audit(extended(spark.createDataFrame(rows, DOCS).repartition(7)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = audit_by_hand(rows)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    if len(rows) > 100:
        assert {r[-1] for r in want} == {True, False}


def test_manifest_three_rounds_and_proofs(spark, monkeypatch):
    """Blocks of 8 nodes: a tree of 700 leaves takes four rounds; each path folds to the root."""
    monkeypatch.setattr(manifest, "DEPTH", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    rows = [(i, f"t{i}", "en" if i < 700 else "de", "s", i) for i in range(710)]
    assert sorted(map(tuple, manifest.audit(spark.createDataFrame(rows, DOCS)).collect())) == sorted(audit_by_hand(rows))


def test_manifest_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(7, "same", "en", "s", 4)] * 30 + [(None, "Null Id", "en", "s", 7), (None, "Null Id", "en", "s", 7)]
    got = manifest.audit(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert len(got) == 32 and len({r.root for r in got}) == 1
    assert sorted((r.proof_sha256, r.verified) for r in got if r.doc_id == 7) == \
        sorted((w[4], w[6]) for w in audit_by_hand(rows) if w[0] == 7)
    assert [r.verified for r in got if r.doc_id is None] == [False, False]
    assert manifest.audit(spark.createDataFrame([], DOCS)).collect() == []


def linked(a, b):
    """Links and groups of two ascending arrays of ends, byte by byte."""
    owner = lambda ends: [k for k, (s, e) in enumerate(zip([0, *ends], ends, strict=False)) for _ in range(e - s)]
    links = sorted(set(zip(owner(a), owner(b), strict=True)))
    common = sorted(set(a) & set(b))
    return [a.index(c) + 1 for c in common], [b.index(c) + 1 for c in common], [x for x, _ in links], [y for _, y in links]


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 90).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, n)), st.sets(st.integers(1, n)),
                                                      st.booleans())))
def test_diagonal(case):
    n, a, b, alike = case
    if alike:  # long one-to-one stretches
        b = (a | set(list(b)[:2])) - set(list(a)[:1])
    a, b = sorted(a | {n}), sorted(b | {n})
    assert tuple(x.tolist() for x in token_alignment.diagonal(np.array(a), np.array(b))) == tuple(linked(a, b))


ODD = [None, "", " ", "  two  blanks\n\n", "word", "a\x00b", "▁ own mark", "<s> </s> <unk> <0x41> <|endoftext|> [INST]", "日本語 😀 ñandú",
       "x" * 3000, "tab\tand\r\nline", "a b", "ﬁ ① ｆ", "▁", "word", "Some plain words that both tokenizers know."]


def align_by_hand(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = token_alignment.byte_alphabet()
    count, held = collections.Counter(), []
    for d, text in rows:
        entry = None
        if text:
            whole = (" " + text).encode()
            x, ids = first.encode(" " + text, add_special_tokens=False), second.encode(text)
            ta = [bytes(byte[c] for c in t) for t in x.tokens]
            tb = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in zip(ids, map(second.id_to_piece, ids), strict=True)]
            if b"".join(ta) == whole == b"".join(tb):
                ga, gb, la, lb = linked(np.cumsum([*map(len, ta)]).tolist(), np.cumsum([*map(len, tb)]).tolist())
                groups = ";".join(",".join(map(str, x.ids[s:e])) + "|" + ",".join(map(str, ids[u:v]))
                                  for s, e, u, v in zip([0, *ga], ga, [0, *gb], gb, strict=False))
                pairs = [(x.ids[i], ids[j]) for i, j in zip(la, lb, strict=True)]
                count.update(pairs)
                entry = (len(x.ids), len(ids), len(ga), pairs, sha(groups))
        held.append((d, entry))
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(d, 0, 0, 0, 0, 0, 0, "") if e is None else
            (d, e[0], e[1], e[2], len(e[3]), sum(count[p] == best[p[1]] for p in e[3]), sum(count[p] for p in e[3]), e[4])
            for d, e in held]


def test_alignment_by_hand(spark):
    importable(spark)
    rng = random.Random(1)
    words = "the quick ünder naïve Tokenization 12345 misaligned; don't re-use \n".split(" ")
    texts = ODD + [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(60)]
    rows = [(i // 2 if i % 9 == 0 else i, t, "en", "s", 1) for i, t in enumerate(texts)]
    df = extended(spark.createDataFrame(rows, DOCS).repartition(3))
    want = sorted(align_by_hand([r[:2] for r in rows]), key=repr)
    got = token_alignment.compare(df, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    # many slices give the same counts
    small = materialise(token_alignment.alignments(df, A, B, groups=True, slice_links=500), "alignments")
    assert small.select("slice").distinct().count() > 10
    again = token_alignment.with_pair_counts(small, A, B).select(*got.columns)
    assert sorted(map(tuple, again.collect()), key=repr) == want
    assert all(r.groups_sha256 == (sha(r.groups) if r.groups else "") for r in small.collect())
    assert token_alignment.compare(spark.createDataFrame([], DOCS), A, B).collect() == []


def test_alignment_in_parts():
    tool = token_alignment.aligner(A, B)
    rng = random.Random(2)
    text = " ".join(rng.choice(["word", "Über", "x  y", "12", "a\n", "don't", "(so)", " z"]) for _ in range(3000))
    (whole,), (parts,) = tool.align([text], 1 << 30), tool.align([text], 50)
    assert len(whole) == 1 and len(parts) > 100
    assert "".join(map(tool.groups_text, parts)) == tool.groups_text(whole[0])
    assert b"".join(map(tool.pairs, parts)) == tool.pairs(whole[0])


def near_by_hand(rows, threshold=0.95):
    """rows: (vec_id, vector or None), unique ids."""
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in rows if ok(v)}
    links = {i: {j for j in unit if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= threshold} if i in unit else set()
             for i, _ in rows}
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((i, len(links[i]), min(seen), min(seen) == i))
    return sorted(out)


def vectors(dim=16, n=250, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = base[:6].repeat(30, 0) + rng.standard_normal((180, dim)) * rng.choice([0.02, 0.1, 0.25], (180, 1))
    chain = np.array([[math.cos(0.25 * k), math.sin(0.25 * k), *[0] * (dim - 2)] for k in range(12)])
    scaled = near[:20] * rng.choice([1e-20, 3.0, 1e15], (20, 1))
    return [x.astype(np.float32).astype(float).tolist() for x in np.concatenate([base, near, chain, scaled, base[:9], base[:1].repeat(40, 0)])]


ODD_VECTORS = [None, [], [0.0] * 16, [None] * 16, [1.0, None] * 8, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15,
               [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_by_hand(spark, monkeypatch, kind):
    """Also with buckets so small that there are many bands, and large ones that are dealt to parts."""
    rows = list(enumerate(vectors() + ODD_VECTORS))
    random.Random(1).shuffle(rows)
    want = near_by_hand(rows)
    df = extended(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(5))
    got = embedding_dedup.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == want
    monkeypatch.setattr(embedding_dedup, "BUCKET", 40)
    monkeypatch.setattr(embedding_dedup, "MOST", 30)
    assert embedding_dedup.layout(400, 0.95, 1e-6)[1] > 5
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect())) == want


def test_embeddings_repeated_ids_null_ids_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [1.0, 0.0])] * 3 + [(2, [1.0, 0.1]), (None, [5.0, 0.0]), (None, None), (4, None), (9, [0.0, 1.0])]
    got = sorted(map(tuple, embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(1, 4, 1, True)] * 3 + [(2, 4, 1, False), (None, 4, 1, False), (None, 0, None, True), (4, 0, 4, True),
                          (9, 0, 9, True)], key=repr)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_int8_bound_holds():
    rng = np.random.default_rng(0)
    u = embedding_dedup.unit(np.concatenate([rng.standard_normal((200, 48)), rng.standard_normal((200, 48)) ** 5]))
    q, scale, lost = embedding_dedup.quantise(u)
    near = (q.astype(float) @ q.T.astype(float)) * scale[:, None] * scale
    assert (np.abs(near - u @ u.T) <= lost[:, None] * (1 + lost) + lost + 1e-9).all()


def test_recall_over_buckets(spark):
    """Pairs at the threshold itself, found over many narrow buckets."""
    rng = np.random.default_rng(6)
    x = embedding_dedup.unit(rng.standard_normal((400, 64)))
    side = embedding_dedup.unit(rng.standard_normal((400, 64)))
    side = embedding_dedup.unit(side - (side * x).sum(1, keepdims=True) * x)
    c = 0.9501
    pairs = np.concatenate([x, c * x + math.sqrt(1 - c * c) * side])
    bits, bands = embedding_dedup.layout(1_000_000, 0.95, embedding_dedup.MISS)
    codes = embedding_dedup.band_codes(pairs, bits, bands)
    assert bits >= 8 and (codes[:400] == codes[400:]).any(axis=1).all()
