"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

A text is encoded by a byte-level BPE (A) and by a sentence-piece model (B); the
byte offsets where tokens of both end cut them into groups.  ``diagonal`` walks
both arrays of ends at once: at the current shift between them it compares
stretches of 1, 2, 4, ... ends, narrows the first unequal one by halves, and so
jumps over all one-to-one tokens; then it steps through one irregular group, one
end at a time, and goes on at the new shift.  Tokens whose bytes overlap are
linked; an irregular group of a and b tokens has a + b - 1 links.

Corpus-wide counts of linked id pairs are gathered in Spark: documents are dealt
to slices of about ``SLICE`` links, each slice gives every pair it holds
once with a number, and a window by pair adds them up.  What comes back to
a slice is one row for each of its pairs, so a pair that every document holds weighs
no more than the number of slices.  The largest count of each B id is broadcast: at
most as many rows as B's vocabulary.

Texts are encoded in pieces cut at blanks, each different piece once in a while: neither
tokenizer has a token across a blank that stands between other characters
(``UNSAFE``: blanks in a row, at an end, or inside white space).  A text with such
blanks is cut only where ASCII letters or digits are on both sides.  B's vocabulary
is searched for a piece across blanks when it is loaded; if it has one, texts go whole.
So both tokenizers' tokens end where a piece does, and no group spans two pieces: the new pieces of a call are walked
together once, and a text's groups and links are those of its pieces in turn.

Defined cases: a null or empty text has no tokens: zeros, '' as digest.  So has a text whose
tokens don't give back a blank and the text in both tokenizers.  Special
tokens' strings in a text are plain text.  Repeated rows and ids are rows of their own, and each counts.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, materialise, slices, type_of

#: Links in a slice, about; a slice holds whole documents, at least one.
SLICE = 1 << 21
#: Characters that are aligned together, about, and of the texts that are encoded in one call.
PART = 100_000
CALL = 1_000_000
#: Pieces remembered by a worker; it starts anew when there are more, which changes no result.
REMEMBERED = 300_000
#: A blank inside white space: at least one tokenizer may not begin anew there, nor at blanks in a row or at an end.
INSIDE = re.compile(r"[^\S ] [^\S ]")
#: A blank at which both do, whatever is around.
CUT = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


def diagonal(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups (ends in A's and in B's tokens, exclusive) and links (places in A and in B) of two ascending arrays
    of byte offsets with the same last one.

    The walk notes only the links at whose end one side goes on alone; at all others both do.
    """
    a, b = ends_a.tolist(), ends_b.tolist()
    wide_a, wide_b = ends_a.astype("<i4").tobytes(), ends_b.astype("<i4").tobytes()
    alone_a: list[int] = []
    alone_b: list[int] = []
    i = j = link = 0
    n_a, n_b = len(a), len(b)
    while i < n_a:
        end_a, end_b = a[i], b[j]
        if end_a == end_b:                    # a one-to-one stretch: probe 1, 2, 4, ... ends further on
            x, y, left, step = 4 * i + 4, 4 * j + 4, 4 * min(n_a - i, n_b - j) - 4, 4
            begin = x - 4
            while step <= left and wide_a[x:x + step] == wide_b[y:y + step]:
                x, y, left, step = x + step, y + step, left - step, 2 * step
            while step > 4:
                step >>= 1
                if step <= left and wide_a[x:x + step] == wide_b[y:y + step]:
                    x, y, left = x + step, y + step, left - step
            run = (x - begin) >> 2
            i, j, link = i + run, j + run, link + run
            continue
        while end_a != end_b:                 # an irregular group: one end at a time
            if end_a < end_b:
                alone_a.append(link)
                i += 1
                end_a = a[i]
            else:
                alone_b.append(link)
                j += 1
                end_b = b[j]
            link += 1
        i, j, link = i + 1, j + 1, link + 1
    goes_a, goes_b = np.ones(link, bool), np.ones(link, bool)
    goes_a[alone_b], goes_b[alone_a] = False, False
    links_a, links_b = np.cumsum(goes_a) - goes_a, np.cumsum(goes_b) - goes_b
    both = goes_a & goes_b
    return links_a[both] + 1, links_b[both] + 1, links_a, links_b


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves,
    the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(own)]
    return {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(rest)}


@dataclass
class Alignment:
    """Tokens of a text: ids of both tokenizers, group ends and linked places (see ``diagonal``)."""

    a: np.ndarray
    b: np.ndarray
    groups_a: np.ndarray
    groups_b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray


class Aligner:
    """The two tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are what runs side by side
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_alphabet()
        vocabulary = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.n_a, self.n_b = max(vocabulary) + 1, self.b.vocab_size()
        self.bytes_a = [bytes(byte[c] for c in vocabulary.get(i, "")) for i in range(self.n_a)]
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a, self.length_b = np.array([*map(len, self.bytes_a)]), np.array([*map(len, self.bytes_b)])
        self.parted = not any(re.search("[^▁]▁", p) for p in pieces)
        self.dtype = np.dtype("<u4" if self.n_a * self.n_b < 1 << 32 else "<u8")
        text = lambda n, mark: np.array([f"{i}{mark}" for i in range(n)], object)
        self.text_a, self.last_a = text(self.n_a, ","), text(self.n_a, "|")
        self.text_b, self.last_b = text(self.n_b, ","), text(self.n_b, ";")
        #: piece -> ids of A and of B as little-endian 32-bit numbers; pieces of which a tokenizer loses a byte
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.lossy: set[str] = set()
        #: piece -> groups as text, linked pairs, numbers of A's and B's tokens and of groups; None if a byte is lost
        self.walked: dict[str, tuple[str, bytes, int, int, int] | None] = {}

    def pieces(self, text: str) -> list[str]:
        """The text cut at blanks, which are left out."""
        if not self.parted:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " " or INSIDE.search(text):
            return CUT.split(text)
        return text.split(" ")

    def remember(self, pieces: list[str], walk: bool = False) -> None:
        """Encode pieces not met before with both tokenizers (and walk them); each comes after a blank.

        Those without white space at an end are joined by blanks for that, as a text is.
        """
        plain, rows = [], []
        for p in pieces:
            if not self.parted or p[0].isspace() or p[-1].isspace():
                rows.append([p])
            else:
                plain.append(p)
        rows += [plain[s:e] for s, e in slices([len(p) for p in plain], CALL // 10)]
        for s, e in slices([sum(map(len, r)) for r in rows], CALL):
            texts = [" ".join(r) for r in rows[s:e]]
            for r, t, x, y in zip(rows[s:e], texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False),
                                  self.b.encode(texts, num_threads=1), strict=True):
                self._note(r, (" " + t).encode(), x.ids, y, walk)

    def _note(self, pieces: list[str], whole: bytes, a: list[int], b: list[int], walk: bool) -> None:
        """Deal the ids (or groups and links) of pieces joined by blanks to them, by the bytes that the tokens take."""
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            if len(pieces) > 1:               # look for those that a tokenizer changes
                self.remember(pieces[:len(pieces) // 2], walk)
                self.remember(pieces[len(pieces) // 2:], walk)
            elif walk:
                self.walked[pieces[0]] = None
            else:
                self.known[pieces[0]] = b"", b""
                self.lossy.add(pieces[0])
            return
        ends, cut = np.cumsum([len(p.encode()) + 1 for p in pieces]), []
        if walk:
            self._walk(pieces, np.array(a, np.int64), np.array(b, np.int64), ends)
            return
        for ids, length in ((a, self.length_a), (b, self.length_b)):
            ids = np.array(ids, "<i4")
            raw, stop = ids.tobytes(), (4 * np.searchsorted(np.cumsum(length[ids]), ends) + 4).tolist()
            cut.append([raw[u:v] for u, v in zip([0, *stop], stop, strict=False)])
        self.known.update(zip(pieces, zip(*cut, strict=True), strict=True))

    def _walk(self, pieces: list[str], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> None:
        """Note the groups and links of each of the pieces joined by blanks, which end at these bytes."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        x = Alignment(a, b, *[np.array(f, np.int64) for f in diagonal(ends_a, ends_b)])
        tokens, pairs, wide = self._tokens(x), self.pairs(x), self.dtype.itemsize
        u, v = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        rows = zip(pieces, np.diff(u, prepend=0).tolist(), np.diff(v, prepend=0).tolist(),
                   np.diff(np.searchsorted(x.groups_a, u) + 1, prepend=0).tolist(),
                   (wide * np.searchsorted(x.links_a, u)).tolist(), (u + v).tolist(), strict=True)
        link = at = 0
        for p, n_a, n_b, n_groups, to, stop in rows:
            self.walked[p] = "".join(tokens[at:stop]), pairs[link:to], n_a, n_b, n_groups
            link, at = to, stop

    def rows(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, bytes, str]]:
        """n_a, n_b, n_groups, n_links, the digest of the groups, linked pairs and the groups as text of each text."""
        for s, e in slices([len(t) for t in texts], CALL):
            cut = [self.pieces(t) if t else [] for t in texts[s:e]]
            if len(self.walked) > REMEMBERED:
                self.walked = {}
            self.remember(list(set(chain.from_iterable(cut)).difference(self.walked)), walk=True)
            for pieces in cut:
                parts = [*map(self.walked.__getitem__, pieces)]
                if not parts or None in parts:
                    yield 0, 0, 0, 0, "", b"", ""
                    continue
                groups, links, n_a, n_b, n_groups = zip(*parts, strict=True)
                text, held = "".join(groups)[:-1], b"".join(links)
                yield (sum(n_a), sum(n_b), sum(n_groups), len(held) // self.dtype.itemsize,
                       hashlib.sha256(text.encode()).hexdigest(), held, text)

    def align(self, texts: list[str], least: int = PART) -> Iterator[list[Alignment]]:
        """The alignments of each text's parts, in order; none for a text that is empty or not given back."""
        for s, e in slices([len(t) for t in texts], CALL):
            cut = [self.pieces(t) if t else [] for t in texts[s:e]]
            if len(self.known) > REMEMBERED:
                self.known, self.lossy = {}, set()
            self.remember(list(set(chain.from_iterable(cut)).difference(self.known)))
            known = self.known
            for text, pieces in zip(texts[s:e], cut, strict=True):
                if not pieces or self.lossy and not self.lossy.isdisjoint(pieces):
                    yield []
                    continue
                a, b = zip(*[known[p] for p in pieces], strict=True)
                if len(text) <= least:
                    yield [self._aligned(a, b)]
                else:
                    yield [self._aligned(a[u:v], b[u:v]) for u, v in slices([len(p) for p in pieces], least)]

    def _aligned(self, a: Sequence[bytes], b: Sequence[bytes]) -> Alignment:
        x, y = np.frombuffer(b"".join(a), "<i4").astype(np.int64), np.frombuffer(b"".join(b), "<i4").astype(np.int64)
        found = diagonal(np.cumsum(self.length_a[x]), np.cumsum(self.length_b[y]))
        return Alignment(x, y, *[np.array(f, np.int64) for f in found])

    def _tokens(self, x: Alignment) -> list[str]:
        """The ids of A's and B's tokens, group by group, each with the mark that comes after it."""
        size_a, size_b = np.diff(x.groups_a, prepend=0), np.diff(x.groups_b, prepend=0)
        at_a = np.repeat(x.groups_b - size_b, size_a) + np.arange(len(x.a))
        at_b = np.repeat(x.groups_a, size_b) + np.arange(len(x.b))
        out = np.empty(len(x.a) + len(x.b), object)
        out[at_a], out[at_b] = self.text_a[x.a], self.text_b[x.b]
        out[at_a[x.groups_a - 1]] = self.last_a[x.a[x.groups_a - 1]]
        out[at_b[x.groups_b - 1]] = self.last_b[x.b[x.groups_b - 1]]
        return out.tolist()

    def groups_text(self, x: Alignment) -> str:
        """``a1,a2|b1;a3|b2,b3;`` in decimal ids."""
        return "".join(self._tokens(x))

    def pairs(self, x: Alignment) -> bytes:
        """Linked ids, a * n_b + b each, as little-endian unsigned numbers."""
        return (x.a[x.links_a] * self.n_b + x.b[x.links_b]).astype(self.dtype).tobytes()


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def alignments(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
               groups: bool = False, slice_links: int = SLICE) -> DataFrame:
    """key, slice, n_a, n_b, n_groups, n_links, groups_sha256, links (id pairs) and, if asked for, groups as text."""
    names = [key, "slice", *COUNTS, "groups_sha256", "links", *["groups"] * groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        current, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = [t or "" for t in batch["_text"].to_pylist()]
            for s, e in slices([len(t) for t in texts], CALL):
                made = list(tool.rows(texts[s:e]))
                numbers = []
                for row in made:
                    if held and held + row[3] > slice_links:
                        current, held = current + 1, 0
                    held += row[3]
                    numbers.append(current)
                columns = list(zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch["_key"].slice(s, e - s), pa.array(numbers, pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:4]],
                     pa.array(columns[4], pa.string()), pa.array(columns[5], pa.binary()),
                     *[pa.array(columns[6], pa.string())] * groups], names)

    return (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
            .mapInArrow(run, f"`{key}` {type_of(docs, key)}, slice long, " + ", ".join(f"{c} long" for c in COUNTS)
                        + ", groups_sha256 string, links binary" + ", groups string" * groups))


def _slice_pairs(aligned: DataFrame, dtype: np.dtype) -> DataFrame:
    """slice, pair, n: how many links of a slice hold each pair (in portions, where a slice spans batches)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["slice"].to_numpy()
            for s in np.unique(numbers).tolist():
                own = batch["links"].filter(pa.array(numbers == s))
                pair, n = np.unique(np.frombuffer(b"".join(own.to_pylist()), dtype), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), s)), pa.array(pair.astype(np.int64)),
                                                  pa.array(n.astype(np.int64))], ["slice", "pair", "n"])

    return aligned.select("slice", "links").mapInArrow(run, "slice long, pair long, n long")


def with_pair_counts(aligned: DataFrame, path_a: str, path_b: str, key: str = "doc_id") -> DataFrame:
    """key, counts, n_best and count_sum of written alignments: their links weighed by counts over the whole table."""
    tool = aligner(path_a, path_b)
    n_b, dtype = tool.n_b, tool.dtype
    counted = materialise(_slice_pairs(aligned, dtype)
                          .withColumn("count", F.sum("n").over(Window.partitionBy("pair"))).drop("n"), "pair-counts")
    best = (counted.groupBy(F.expr(f"pair % {n_b}").alias("b")).agg(F.max("count").alias("best"))
            .withColumnRenamed("b", "_b"))  # a row for each id of B, at most
    told = (counted.join(F.broadcast(best), F.expr(f"pair % {n_b} = _b"))
            .select("slice", "pair", "count", (F.col("count") == F.col("best")).alias("is_best")))

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        known, at = np.unique(pairs["pair"].to_numpy(), return_index=True)
        count = np.append(pairs["count"].to_numpy()[at], 0)
        is_best = np.append(pairs["is_best"].to_numpy()[at].astype(np.int64), 0)
        n_best, total = [], []
        for links in docs["links"].to_pylist():
            place = np.searchsorted(known, np.frombuffer(links, dtype).astype(np.int64))
            n_best.append(int(is_best[place].sum()))
            total.append(int(count[place].sum()))
        return (docs.drop_columns(["links", "slice"]).append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(total, pa.int64())))

    return (aligned.select("slice", key, *COUNTS, "groups_sha256", "links").groupBy("slice")
            .cogroup(told.groupBy("slice"))
            .applyInArrow(run, f"`{key}` {type_of(aligned, key)}, " + ", ".join(f"{c} long" for c in COUNTS)
                          + ", groups_sha256 string, n_best long, count_sum long"))


def compare(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    importable(docs.sparkSession)
    aligned = materialise(alignments(docs, path_a, path_b), "alignments")
    return with_pair_counts(aligned, path_a, path_b).select(
        "doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
