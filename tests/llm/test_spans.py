"""Repeated passages that begin and end anywhere in their hosts."""

import random

import numpy as np
import pytest

from playmart.llm import span_dedup
from playmart.llm.common import importable

NAMES = ["low", "vex", "tarn", "mio", "sel", "ob", "ruk", "pa", "lin", "dore"]


def words(rng, n, style):
    """Words of a text, each with the white space before it."""
    out, left, size = [], 0, {"title": 1, "lines": 3, "short": 2, "prose": 12, "mixed": 30}.get(style)
    for _ in range(n):
        w, gap = "".join(rng.choices(NAMES, k=rng.randint(1, 4))), " "
        if style == "same":
            w = "w"
        elif size and not left:
            left = size if style in ("title", "lines", "prose") else rng.randint(1, size)
            gap, w = ("\n", w) if style == "lines" else (" ", w.capitalize())
        left -= 1
        out.append(gap + w)
    return out


def hosts(rng, n, style):
    """Two texts with one passage of n words pasted at blanks, whose own words differ from it and each other."""
    passage = "".join(words(rng, n + 20, style)[10:n + 10]).lstrip()
    own = lambda tag: " ".join(tag + w.strip().lower() for w in words(rng, rng.randint(20, 60), "plain"))
    return passage, *(f"{own(tag)} {passage} {own(tag + 'z')}" for tag in "xy")


def shared(a, b):
    return len(np.intersect1d(span_dedup.runs([a])[2], span_dedup.runs([b])[2]))


@pytest.mark.parametrize("style", ["title", "lines", "short"])
def test_passages_of_short_sentences_share_a_run(style):
    rng = random.Random(3)
    for _ in range(200):
        _, a, b = hosts(rng, 50, style)
        assert shared(a, b)


def test_title_case_passage_goes_from_the_later_host(spark):
    importable(spark)
    passage, a, b = hosts(random.Random(4), 60, "title")
    got = {r.doc_id: r for r in span_dedup.report(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].text == a
    assert got[2].n_removed >= 45 and " ".join(passage.split()[1:-15]) not in got[2].text


@pytest.mark.parametrize("style", ["plain", "prose", "mixed", "same", "title", "short"])
@pytest.mark.parametrize("n", [50, 51, 80])
def test_passages_pasted_in_mid_sentence_share_a_run(style, n):
    rng = random.Random(n)
    for _ in range(400):
        _, a, b = hosts(rng, n, style)
        assert shared(a, b)


def test_cuts_of_bytes_are_those_of_sentences():
    rng = random.Random(6)
    for style in ["plain", "prose", "mixed", "same", "lines"]:
        for _ in range(60):
            text = hosts(rng, rng.randint(1, 90), style)[1]
            assert span_dedup.spans_of(text.encode()) == span_dedup.sentences(text)


def test_every_run_against_brute_force():
    """The runs of a text are those of its sentences and, from the last words of long natural sentences on, one more."""
    rng = random.Random(7)
    for style in ["plain", "prose", "mixed", "short"]:
        for _ in range(60):
            text = hosts(rng, 60, style)[1]
            spans = span_dedup.sentences(text)
            size = [len(text[a:b].split()) for a, b in spans]
            want = set()
            for i in range(len(spans)):
                j = next((j for j in range(i + 3, len(spans) + 1) if sum(size[i:j]) >= span_dedup.LEAST), None)
                want |= {(i, j)} - {(i, None)}
            got = {(p >> 32, p & 0xFFFFFFFF) for p in span_dedup.runs([text])[1].tolist()}
            assert want <= got and all(j <= len(spans) for _, j in got)
