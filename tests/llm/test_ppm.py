"""The look-up tables of language identification against a naive PPM coder."""

import collections
import math
import random

import numpy as np
import pytest

from playmart.llm import ppm_langid
from playmart.llm.common import importable


def naive(texts, order=3):
    """Counts of bytes after every context of up to ``order`` bytes, each text after padding."""
    count = collections.defaultdict(collections.Counter)
    for t in texts:
        padded = b"\n" * order + t
        for i in range(order, len(padded)):
            for k in range(order + 1):
                count[padded[i - k:i]][padded[i]] += 1
    return count


def distribution(count, context):
    """Method C with exclusion, from the shortest context up; the empty context escapes to equal shares."""
    p = [1 / 256] * 256
    for k in range(len(context) + 1):
        seen = count.get(context[len(context) - k:])
        if not seen:
            continue
        total, kinds = sum(seen.values()), len(seen)
        rest = sum(x for b, x in enumerate(p) if b not in seen)
        escape = kinds / (total + kinds) if rest > 0 else 0
        p = [(1 - escape) * seen[b] / total if b in seen else escape * x / rest for b, x in enumerate(p)]
    return p


def test_code_lengths_equal_a_naive_coder():
    rng = random.Random(4)
    corpora = [[b"the cat and the hat", b"a hat, the mat\n", b""], ["äh das ist es".encode(), b"das da"], [b"zzz"]]
    models = []
    for lang, texts in zip("abc", corpora, strict=True):
        ids, bits = ppm_langid.fit_texts(texts)
        seen, packed = ppm_langid.compact(ids, bits)
        models.append((lang, ids.tobytes(), len(ids), seen, packed.tobytes()))
    scorer = ppm_langid.Scorer(models)
    tries = [b"the hat", b"xyz \xff\xfe", "das ä".encode(), b"", b"zzzzzz", bytes(rng.choices(b"the cadshi\n", k=60))]
    got = scorer.code_lengths(tries)
    for k, texts in enumerate(corpora):
        count = naive(texts)
        for t, bits in zip(tries, got[:, k], strict=True):
            padded = b"\n" * 3 + t
            want = 0.0
            for i in range(3, len(padded)):
                byte = padded[i]
                if not any(byte in x for corpus in corpora for x in corpus):
                    byte = next(b for b in range(256) if not any(b in x for c in corpora for x in c))
                context = padded[i - 3:i]
                known = set(b"".join(b"".join(c) for c in corpora)) | {10}
                if any(b not in known for b in context):      # bytes that no model knows end the context
                    cut = max(j for j, b in enumerate(context) if b not in known) + 1
                    context = context[cut:]
                want -= math.log2(distribution(count, context)[byte])
            assert bits == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_whole_texts_are_learned_in_any_portions(monkeypatch):
    texts = [bytes(random.Random(i).choices(b"abcd ", k=5000)) for i in range(3)]
    whole = ppm_langid.fit_texts(texts)
    monkeypatch.setattr(ppm_langid, "WINDOW", 700)
    parts = ppm_langid.fit_texts(texts)
    assert np.array_equal(whole[0], parts[0]) and np.allclose(whole[1], parts[1])
    assert not np.array_equal(ppm_langid.fit_texts([t[:4000] for t in texts])[1][:1], whole[1][:1])


def test_kept_rows_keep_all_columns(spark):
    importable(spark)
    rows = [(i, "the cat and the hat " * 3 if i % 2 else "das ist der hut " * 3, "en" if i % 2 else "de", i, "s") for i in range(60)]
    rows += [(100, None, "en", 1, "s"), (101, "1234", "en", 1, "s"), (102, "", None, 1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, `my col` long, letters string")
    got = ppm_langid.keep_known(df)
    assert got.schema == df.schema
    assert {r.doc_id for r in got.collect()} == set(range(60))


def test_ties_go_to_the_first_language(spark):
    importable(spark)
    rows = [(i, "same words", lang) for i in range(40) for lang in ("b", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in ppm_langid.identify(df).collect()} == {"a"}
