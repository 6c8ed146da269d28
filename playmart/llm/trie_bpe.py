"""Byte-pair encoding and decoding by prefix-sharing trie traversal.

The encoding of any prefix of a word ends in exactly one *last token*: the one
whose remainder's own last token keeps a stable border with it.  So the state of
a trie node is just that token, and a word's encoding is read off by walking
back from its end, token by token.  The distinct words of a slice are put into
a trie in sorted order, which visits it depth first: the states of a prefix
shared with the previous word are kept on a stack and never computed again.

Texts are first cut at blanks that no pre-token can straddle, so the splitting
pattern runs once per distinct piece rather than over the whole text.

Defined cases: a null text is empty; an empty text has no ids; special tokens
written out in a text get their own id, as the tokenizers library gives them by
default.  Rows are independent; extra columns are ignored.  Very long words use
one integer a byte.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import type_of
from .pieces import PieceEncoder


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and border tests of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_letters()
        self.id_of: dict[bytes, int] = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*self.id_of.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for b, i in self.id_of.items():
            self.bytes_of[i] = b
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            left, right = (m.split(" ") if isinstance(m, str) else m)
            a, b = (bytes(of[c] for c in x) for x in (left, right))
            if a in self.id_of and b in self.id_of and a + b in self.id_of:
                pair, whole = (self.id_of[a], self.id_of[b]), self.id_of[a + b]
                self.rank.setdefault(pair, r)
                if whole not in self.parts:
                    self.parts[whole], self.made_at[whole] = pair, r
        self.heads = {b[:i] for b in self.id_of for i in range(len(b) + 1)}
        # states of the suffix automaton: the longest end of a prefix that starts some token
        self.state_of: dict[bytes, int] = {b"": 0}
        self.state_bytes: list[bytes] = [b""]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.go: dict[int, int] = {}
        self._stable: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one end of a token, outermost first, each with the rank that ends it."""
        out, until = [], len(self.rank) + 1
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            until = self.made_at[token]
            token = self.parts[token][side]

    def crossing(self, a: int, b: int, besides: tuple[int, int] | None = None) -> bool:
        """Whether merging the bytes of a and b would ever join pieces across their border.

        The pieces x (end of a) and y (start of b) meet if their merge comes before either is used up.
        At equal rank the leftmost merge goes first: inside a it wins, inside b it loses.
        """
        for x, x_until in self.edge(a, 1):
            for y, y_until in self.edge(b, 0):
                r = self.rank.get((x, y))
                if r is not None and (x, y) != besides and r < x_until and r <= y_until \
                        and r > self.made_at.get(x, -1) and r > self.made_at.get(y, -1):
                    return True
        return False

    def stable(self, a: int, b: int) -> bool:
        if len(self._stable) > 1_000_000:
            self._stable.clear()
        known = self._stable[a << 32 | b] = not self.crossing(a, b)
        return known

    def step(self, state: int, byte: int) -> int:
        """The automaton's next state; each holds the tokens that end there, longest first."""
        text = self.state_bytes[state] + bytes([byte])
        while text not in self.heads:
            text = text[1:]
        at = self.state_of.get(text)
        if at is None:
            at = self.state_of[text] = len(self.state_bytes)
            self.state_bytes.append(text)
            fits = [(self.id_of[text[i:]], len(text) - i) for i in range(len(text)) if text[i:] in self.id_of]
            self.ends.append([x for x in fits if self.whole(x[0])])
        self.go[state << 8 | byte] = at
        return at

    def whole(self, token: int) -> bool:
        """Whether a token's own bytes are encoded as that one token."""
        known = self._whole.get(token)
        if known is None:
            pair = self.parts.get(token)
            known = True
            if pair is not None:
                until = self.made_at[token]
                known = self.whole(pair[0]) and self.whole(pair[1]) and not any(
                    (r := self.rank.get((x, y))) is not None and (x, y) != pair and r < min(until, x_until)
                    and r <= y_until and r > self.made_at.get(x, -1) and r > self.made_at.get(y, -1)
                    for x, x_until in self.edge(pair[0], 1) for y, y_until in self.edge(pair[1], 0))
            elif len(self.bytes_of[token]) > 1:
                known = False
            self._whole[token] = known
        return known

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word with its ids: a depth-first walk over the trie of the words.

        ``last[d]`` is the state of the node at depth d on the current path, ``states[d]`` its place in
        the automaton that lists the tokens which end there.
        """
        go, ends, is_stable, bytes_of = self.go, self.ends, self._stable, self.bytes_of
        last: list[int] = [-1]
        states: list[int] = [0]
        before = b""
        for word in sorted(set(words)):
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], states[shared + 1:]
            state = states[-1]
            for end in range(shared + 1, len(word) + 1):
                after = go.get(state << 8 | word[end - 1])
                state = self.step(state, word[end - 1]) if after is None else after
                states.append(state)
                for token, n in ends[state]:
                    if n == end:
                        break
                    fine = is_stable.get(last[end - n] << 32 | token)
                    if self.stable(last[end - n], token) if fine is None else fine:
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(token)
            before = word
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= len(bytes_of[last[at]])
            ids.reverse()
            yield word, ids


class Encoder(PieceEncoder):
    """Texts to ids and back, with the distinct pieces of a slice encoded together."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        super().__init__(list(self.vocabulary.special))
        self.number = [str(i) for i in range(len(self.vocabulary.bytes_of))]

    def encode_new(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        v = self.vocabulary
        words = {p: [w.encode() for w in self.split.findall(p)] for p in pieces if p not in v.special}
        ids = {w: np.array(x, "<u4").tobytes() for w, x in v.encode_words(list(chain.from_iterable(words.values())))}
        for p in pieces:
            yield p, (np.array([v.special[p]], "<u4").tobytes() if p in v.special
                      else b"".join([ids[w] for w in words[p]]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def numbers(self, ids: list[int]) -> str:
        return ",".join(map(self.number.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, same_text (the round trip gave the text back)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            n, ids_sha, text_sha, same = [], [], [], []
            for text, coded in zip(texts, enc.encode(texts), strict=True):
                ids = np.frombuffer(coded, "<u4").tolist()
                decoded = enc.decode(ids)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(enc.numbers(ids).encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest())
                same.append(decoded == text.encode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same_text"])

    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, f"doc_id {type_of(docs, 'doc_id')}, n_tokens long, ids_sha256 string, "
                             "decoded_sha256 string, same_text boolean"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the token ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in enc.encode(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, f"doc_id {type_of(docs, 'doc_id')}, ids array<int>"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of a table with ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [None if x is None else enc.decode(x).decode("utf-8", "replace") for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return (encoded.select("doc_id", "ids")
            .mapInArrow(run, f"doc_id {type_of(encoded, 'doc_id')}, text string"))
