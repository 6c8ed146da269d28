"""Groups and links noted by piece."""

import random

import public_tokenizers

from playmart.llm import token_alignment


def test_groups_by_piece_are_those_of_the_text():
    tool = token_alignment.aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    text = " ".join(rng.choice(["word", "Über", "x  y", "12", "a\n", "don't", "(so)", " z"]) for _ in range(900))
    ((whole,),) = tool.align([text], 1 << 30)
    ((n_a, n_b, n_groups, n_links, _, links, groups),) = tool.rows([text])
    assert (n_a, n_b, n_groups, n_links) == (len(whole.a), len(whole.b), len(whole.groups_a), len(whole.links_a))
    assert links == tool.pairs(whole) and groups + ";" == tool.groups_text(whole)
