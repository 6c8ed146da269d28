"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after an end mark and white space, at a line break,
and before a capitalised word, since pasted passages start in mid-sentence.  A
sentence of more than ``LONGEST`` words is cut again after so many, and from there
on, of every ``WINDOW`` consecutive words the last one with the least hash begins
a piece.  A cut depends on at most LONGEST + WINDOW - 1 words before it and WINDOW
words after it, so a passage is cut alike wherever it stands.  Its first sentence
may have begun in the host; so a run is also hashed from the last LONGEST words of
every longer sentence on, taken as one piece, and from the last 2 * LONGEST on, taken
as two.  From every sentence on, the run of
``RUN`` sentences, or of as many more as it takes to have ``LEAST`` words, is
hashed, the hashes are joined over the whole corpus, and a sentence goes if any run
over it is not the first of its kind, by (doc_id, place).

One narrow count of hashes tells which runs come twice; only those are written
with their places (the set is kept as a filter of fixed size, which may let
others through but never drops one).

Defined cases: null, empty or wordless texts have no sentence and stay as they
are; shorter texts than a run are never touched.  Rows that repeat a doc_id and
text are one document and get the same answer; an id with several texts is
several documents, ranked by a hash of the text; a null id ranks first.  An
empty table gives an empty result.  Other columns pass through untouched.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, materialise, mix64, slices, type_of, word_hashes
from .near import Bits

RUN = 3
LEAST = 12
#: With x the first sentence start in a passage of 50 words, a whole run lies in it: from x if x <= 13, from x - LONGEST
#: if x <= 25, from x - 2 * LONGEST if x <= 37, else (or without an x) from the first window's cut, at 18 to 23; pieces
#: right after a sentence's start have at most LONGEST words, the others at most WINDOW.
LONGEST = 12
WINDOW = 6
SLICE_CHARS = 1_000_000
_IS_CAPITAL = np.array([unicodedata.category(chr(c)) == "Lu" for c in range(sys.maxunicode + 1)])
_CAPITALS = "".join(map(chr, np.flatnonzero(_IS_CAPITAL).tolist()))
#: What lies between sentences.
BREAK = re.compile(rf"[ \t\n\r\v\f]+(?:(?=[{_CAPITALS}])|(?<=\n)|(?<=[.!?…][ \t]))")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence; what lies between is white space."""
    out, at = [], 0
    for m in [*BREAK.finditer(text), None]:
        end = m.start() if m else len(text)
        if end > at and (not text[at].isspace() or WORDS.search(text, at, end)):
            if sum(text.count(c, at, end) for c in " \t\n\r\v\f") < LONGEST:
                out.append((at, end))
            else:
                ws = [w.span() for w in WORDS.finditer(text, at, end)]
                h = word_hashes(text[at:end].encode())[0].tolist()
                cuts = {0} | {i for i in (LONGEST,) if i < len(ws)}
                for i in range(LONGEST + 1, len(ws) - WINDOW + 1):
                    cuts.add(min(range(i, i + WINDOW), key=lambda p: (h[p], -p)))
                cuts = sorted(cuts)
                out += [(ws[i][0], ws[j - 1][1]) for i, j in zip(cuts, [*cuts[1:], len(ws)], strict=True)]
        at = m.end() if m else len(text)
    return out


def capitals(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters that begin at these bytes of UTF-8 are upper-case letters."""
    b = np.append(code, np.zeros(3, np.uint8))[at[:, None] + np.arange(4)].astype(np.int64)
    rest = b & 63
    point = np.where(b[:, 0] < 0x80, b[:, 0], (b[:, 0] & 31) << 6 | rest[:, 1])
    point = np.where(b[:, 0] >= 0xE0, (b[:, 0] & 15) << 12 | rest[:, 1] << 6 | rest[:, 2], point)
    point = np.where(b[:, 0] >= 0xF0, (b[:, 0] & 7) << 18 | rest[:, 1] << 12 | rest[:, 2] << 6 | rest[:, 3], point)
    return _IS_CAPITAL[point]


def sentence_starts(data: bytes, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the words (hashes, first bytes) begin a piece, as in ``sentences``; where sentences over LONGEST end; their sizes.

    Texts joined by line breaks are cut like each of them alone.
    """
    code = np.frombuffer(data, np.uint8)
    space = SPACE[code]
    last = np.flatnonzero(~space & np.append(space[1:], True))[:-1]
    mark = np.isin(code[last], np.frombuffer(b".!?", np.uint8))
    dots = np.flatnonzero(code[last] == 0xA6)
    mark[dots] = (code[last[dots] - 1] == 0x80) & (code[last[dots] - 2] == 0xE2)
    line = np.searchsorted(np.flatnonzero(code == 10), at)
    new = capitals(code, at)
    new[1:] |= (line[1:] != line[:-1]) | (mark & np.isin(code[last + 1], np.frombuffer(b" \t", np.uint8)))
    new[0] = True
    first = np.flatnonzero(new)
    after = np.append(first[1:], len(at))
    long = after - first > LONGEST
    begun = np.concatenate([[0], np.cumsum(new)])
    new[first[long] + LONGEST] = True
    n = len(at) - WINDOW + 1 - LONGEST  # windows from word LONGEST on
    if n > 0:
        inside = np.flatnonzero(begun[LONGEST + WINDOW:] == begun[:n]) + LONGEST
        best = inside.copy()
        for k in range(1, WINDOW):
            best = np.where(h[inside + k] <= h[best], inside + k, best)
        new[best] = True
    return new, after[long], (after - first)[long]


def runs(texts: list[str], run: int = RUN, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Of every run in the texts: the text's number, its place and two hashes.

    A place holds the numbers, in the text, of the run's first sentence (upper 32 bits) and of the one after its last.
    """
    data = [t.encode() for t in texts]
    joined = b"\n".join(data)
    h, at = word_hashes(joined)
    if not len(at):
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), np.zeros(0, np.int64), none, none
    new, ends, longs = sentence_starts(joined, h, at)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(at)))
    nth = (np.arange(len(at)) - np.repeat(start, size) + 1).astype(np.uint64)
    name = mix64(np.add.reduceat(mix64(h + nth * np.uint64(0x9E3779B97F4A7C15)), start) + size.astype(np.uint64))
    row = np.searchsorted(np.cumsum([0, *(len(d) + 1 for d in data)]), at[start], "right") - 1
    total = np.append(start, len(at))
    # runs from every sentence on, then those from the last words of long sentences on, in one piece or two
    nth = np.arange(1, LONGEST + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    piece = lambda x: mix64(mix64(h[x[:, None] + np.arange(LONGEST)] + nth).sum(1, dtype=np.uint64) + np.uint64(LONGEST))
    twice = ends[longs > 2 * LONGEST]
    lead = [name, piece(ends - LONGEST), piece(twice - 2 * LONGEST)]
    kind = np.repeat(np.arange(3), [len(x) for x in lead])
    lead = np.concatenate(lead)
    then = np.concatenate([np.arange(len(start)) + 1, np.searchsorted(start, ends), np.searchsorted(start, twice)])
    first = np.concatenate([np.arange(len(start)), np.searchsorted(start, ends - LONGEST),
                            np.searchsorted(start, twice - 2 * LONGEST)])
    words = np.concatenate([size, np.full(len(ends), LONGEST), np.full(len(twice), 2 * LONGEST)])
    end = run_ends(total, then, words, run - (kind == 2), least)
    own = row[then - 1]
    ok = end <= len(start)
    ok[ok] = row[end[ok] - 1] == own[ok]
    one = mix64(np.uint64(0x9E3779B97F4A7C15) + lead)
    two = mix64((np.uint64(1) ^ lead) * np.uint64(0xD6E8FEB86659FD93))
    second, both = piece(twice - LONGEST), kind == 2
    one[both] = mix64(one[both] * np.uint64(0x9E3779B97F4A7C15) + second)
    two[both] = mix64((two[both] ^ second) * np.uint64(0xD6E8FEB86659FD93))
    one, two, first, then, end, own = one[ok], two[ok], first[ok], then[ok], end[ok], own[ok]
    on = np.flatnonzero(then < end)
    while len(on):
        more = name[then[on]]
        one[on] = mix64(one[on] * np.uint64(0x9E3779B97F4A7C15) + more)
        two[on] = mix64((two[on] ^ more) * np.uint64(0xD6E8FEB86659FD93))
        then[on] += 1
        on = on[then[on] < end[on]]
    begin = np.searchsorted(row, own)
    return own, (first - begin) << 32 | (end - begin), one, two


def run_ends(total: np.ndarray, then: np.ndarray, words: np.ndarray, run: int | np.ndarray, least: int) -> np.ndarray:
    """Where runs end that go on with sentence ``then`` after so many words in a first piece; maybe past the last one."""
    return np.maximum(then + run - 1, np.searchsorted(total, total[then] - words + least))


def repeated(docs: DataFrame, run: int, least: int) -> Bits:
    """A filter that holds every run that comes twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch["text"].to_pylist() if t]
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                h, n = np.unique(runs(texts[a:b], run, least)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int64))], ["h", "n"])

    counted = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return Bits.of(counted.filter("n > 1").select("h"))


def covered(docs: DataFrame, run: int = RUN, least: int = LEAST) -> DataFrame:
    """doc_id, th (hash of the text), places: where runs start that aren't the first of their kind."""
    filled = docs.sparkSession.sparkContext.broadcast(repeated(docs, run, least).words)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bits(filled.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                row, place, one, two = runs(texts[a:b], run, least)
                keep = held.holds(one)
                row = pa.array(row[keep] + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[keep].view(np.int64)), pa.array(two[keep].astype(np.uint32).view(np.int32)),
                     batch["doc_id"].take(row).is_valid(), batch["doc_id"].take(row), batch["th"].take(row),
                     pa.array(place[keep])], ["h", "h2", "known", "doc_id", "th", "place"])

    src = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    spans = materialise(src.mapInArrow(find, f"h long, h2 int, known boolean, doc_id {type_of(docs, 'doc_id')}, "
                                             "th long, place long"), "spans")
    at = F.struct("known", "doc_id", "th", "place")
    # equal rows give equal places, which are not later than the first
    first = spans.groupBy("h", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return (spans.join(first, ["h", "h2"]).filter(F.col("first") != at).select("doc_id", "th", "place")
            .repartition("doc_id", "th").distinct()  # one exchange for both groupings
            .groupBy("doc_id", "th").agg(F.collect_list("place").alias("places")))


def spans_of(data: bytes) -> list[tuple[int, int]]:
    """Start and end of each sentence of a text in UTF-8; the indentation of a line belongs to its sentence."""
    h, at = word_hashes(data)
    first = at[sentence_starts(data, h, at)[0]].tolist() if len(at) else []
    out, before = [], 0
    for a, after in zip(first, [*first[1:], len(data)], strict=True):
        line = data.rfind(b"\n", before, a)
        while SPACE[data[after - 1]]:
            after -= 1
        out.append((line + 1 if line >= 0 or not before else a, after))
        before = after
    return out


def strip(text: str, places: list[int]) -> tuple[str, int, int]:
    """The text without the sentences that the runs at these places cover; how many went and stay.

    Texts that lose nothing aren't cut again; 0 and 0 then.
    """
    if not places:
        return text, 0, 0
    data = text.encode()
    spans = spans_of(data)
    gone = np.zeros(len(spans), bool)
    for p in places:
        gone[p >> 32:p & 0xFFFFFFFF] = True
    out, kept_break = [], True
    for i, (a, b) in enumerate(spans):
        after = data[b:spans[i + 1][0] if i + 1 < len(spans) else len(data)]
        if not gone[i]:
            out.append(data[a:b] + after)
            kept_break = b"\n" in after
        elif b"\n" in after and not kept_break:
            out[-1] = out[-1].rstrip(b" ") + b"\n"
            kept_break = True
    return b"".join(out).strip(b" \n").decode(), int(gone.sum()), int((~gone).sum())


def dedup(docs: DataFrame, run: int = RUN, least: int = LEAST) -> DataFrame:
    """doc (a struct of all columns but the text), text (stripped), removed and left (sentences)."""
    places = covered(docs.select("doc_id", "text"), run, least).select(
        F.col("doc_id").alias("p_id"), F.col("th").alias("p_th"), "places")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"),
                       F.col("text"))
    joined = held.join(places, F.col("doc.doc_id").eqNullSafe(F.col("p_id")) & (F.xxhash64("text") == F.col("p_th")), "left")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [strip(t or "", p or []) for t, p in zip(batch["text"].to_pylist(), batch["places"].to_pylist(),
                                                                  strict=True)]
            text = [None if t is None else d[0] for t, d in zip(batch["text"].to_pylist(), done, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(text, pa.string()), pa.array([d[1] for d in done], pa.int64()),
                 pa.array([d[2] for d in done], pa.int64())], ["doc", "text", "removed", "left"])

    kind = T.StructType([joined.schema["doc"], T.StructField("text", T.StringType()),
                         T.StructField("removed", T.LongType()), T.StructField("left", T.LongType())])
    return joined.select("doc", "text", "places").mapInArrow(apply, kind)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_removed (sentences), text (stripped) of every row."""
    return dedup(docs.select("doc_id", "text")).select("doc.doc_id", F.col("removed").alias("n_removed"), "text")


def remove(docs: DataFrame) -> DataFrame:
    """The documents with their texts stripped; one that lost all its sentences is dropped."""
    return dedup(docs).filter("removed = 0 OR left > 0").select(
        *[(F.col("text") if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
