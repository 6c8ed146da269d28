"""Language identification by prediction by partial matching (PPM).

For each language a variable-order byte context tree is learned from a bounded,
documented sample of labelled documents.  Its statistics are then frozen: every
context gets a complete distribution over the 256 byte values, seen bytes by
count, unseen ones by the escape probability spread over the next shorter
context without the bytes already seen (method C, with exclusion).  A text's
exact code length under each language is the sum of -log2 of the probabilities
of its bytes, and the shortest code wins.

Sample bound: at most ``docs_per_lang`` whole documents a language, chosen by hash
among all training rows.  Every prediction reads the whole text.

Defined cases: a null text, or one without a letter, gives ``und`` and score 0,
as does a corpus without any training row.  Rows are independent, so repeated
rows and ids get equal answers; a null ``doc_id`` counts as held out.  Ties go
to the language first in code point order.  Extra columns are ignored (``keep_known``
passes them on, whatever they are called).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_crc_mod, materialise, release_memory, slices, type_of

ORDER = 3
DOCS_PER_LANG = 300
#: Counts by language are broadcast up to so many languages, else joined by a shuffle.
MOST_LANGS = 10_000
UND = "und"
PAD = b"\n" * ORDER
WINDOW = 1 << 20
#: Bytes that are scored together, and of the texts that are handed to it at once.
SCORED = 1 << 18
MODEL = "lang string, counted long, ctx binary, n int, seen binary, logp binary"


def sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """The bounded training sample: lang, text.

    Rows are ranked by a hash.  One narrow count per language gives the share of hashes among which
    four times the sample is expected, so only those rows are shuffled and ranked.
    """
    rows = (docs.filter((id_crc_mod(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull()
                        & F.col("text").isNotNull())
            .select("lang", "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 33).alias("h")))
    counts = materialise(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    if counts.count() <= MOST_LANGS:
        counts = F.broadcast(counts)
    few = (rows.join(counts, "lang")
           .filter(F.col("h") * F.col("n") <= F.lit(4 * docs_per_lang) * F.lit(1 << 31)))
    w = Window.partitionBy("lang").orderBy("h", "text")
    return (few.withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= docs_per_lang)
            .select("lang", "text"))


def grams(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The different runs of k + 1 bytes of the texts (each after padding), as numbers, and their counts."""
    found, count, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(held), return_counts=True)
        every, at = np.unique(np.concatenate([found, new]), return_inverse=True)
        return every, np.bincount(at, np.concatenate([count, n]), len(every)).astype(np.int64)

    for text in texts:
        for a in range(0, len(text), WINDOW):
            raw = np.frombuffer(PAD + text[:WINDOW] if a == 0 else text[a - ORDER:a + WINDOW], np.uint8).astype(np.int64)
            code = raw[ORDER:].copy()
            for j in range(1, k + 1):
                code += raw[ORDER - j:len(raw) - j] << (8 * j)
            held.append(code)
            size += len(code)
            if size >= WINDOW:
                found, count = add()
                held, size = [], 0
    return add() if held else (found, count)


def fit(text: bytes, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The context tree of one text (see ``fit_texts``)."""
    return fit_texts([text], order)


def fit_texts(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of a context tree and the code length of every byte after each.

    Contexts are numbers: bytes in base 256 plus a marker of the length, so the
    context of length k lies in [256**k, 2 * 256**k).  Row i of the table
    holds -log2 p(byte | context i), a complete distribution.
    """
    ids, bits = [], []
    below_ids, below = np.array([0]), np.full((1, 256), 1 / 256)
    for k in range(order + 1):
        found, n = grams(texts, k)
        ctx, at = np.unique(found >> 8, return_inverse=True)
        if not len(ctx):
            if k:
                break
            ctx = np.zeros(1, np.int64)
        p = np.zeros((len(ctx), 256))
        p[at, found & 255] = n
        for a in range(0, len(ctx), 2048):      # in portions, as each takes several copies of its rows
            count = p[a:a + 2048]
            parent = (below[np.searchsorted(below_ids, ctx[a:a + 2048] & (256 ** (k - 1) - 1))] if k
                      else np.repeat(below, len(count), 0))
            seen, total = count > 0, count.sum(1, keepdims=True)
            kinds = seen.sum(1, keepdims=True)
            rest = np.where(seen, 0, parent).sum(1, keepdims=True)
            escape = np.where(rest > 0, kinds / np.maximum(total + kinds, 1), 0)
            escape = np.where(total == 0, 1, escape)
            p[a:a + 2048] = np.where(seen, (1 - escape) * count / np.maximum(total, 1),
                                     escape * parent / np.maximum(rest, 1e-300))
        below_ids, below = ctx, p
        ids.append(ctx + 256 ** k)
        bits.append(-np.log2(p).astype(np.float32))
    return np.concatenate(ids), np.concatenate(bits)


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    texts = [t.encode() for t in sorted(pdf["text"])]
    ids, bits = fit_texts(texts)
    seen, packed = compact(ids, bits)
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counted": [sum(map(len, texts))], "ctx": [ids.tobytes()],
                         "n": [len(ids)], "seen": [seen], "logp": [packed.tobytes()]})


def compact(ids: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The byte values that are contexts of one byte, and the table's columns of these and of one other value.

    All other values have equal columns, but for one that ends a text and is found nowhere else.
    """
    seen = np.sort(ids[(ids >= 256) & (ids < 512)] - 256)
    other = np.setdiff1d(np.arange(256), seen)[:1]
    return seen.astype(np.uint8).tobytes(), np.ascontiguousarray(bits[:, np.concatenate([seen, other]).astype(int)])


def train(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """One model row per language; its size is bounded by the sample."""
    return sample(docs, docs_per_lang).groupBy("lang").applyInPandas(_fit_group, MODEL)


class Scorer:
    """Code lengths of texts under the frozen models, by table look-up.

    Bytes that no model has seen share one symbol.  The longest context of a place is found in two steps: a
    pair of bytes leads to a block, in which the third one is looked up; where the tree has
    no such context, a second table by pairs gives the longest shorter one.  So the tables follow
    the contexts that there are, not all triples of symbols.
    """

    def __init__(self, models: list[tuple[str, bytes, int, bytes, bytes]]):
        """models: language, contexts, their number, seen byte values, table (see ``compact``)."""
        models = sorted(models)
        self.langs = [m[0] for m in models]
        known = np.unique(np.frombuffer(b"".join(m[3] for m in models), np.uint8))
        self.n = len(known) + 1
        self.symbol = np.full(256, self.n - 1, np.int32)
        self.symbol[known] = np.arange(self.n - 1)
        self.tables = []
        for _, ctx, rows, seen, raw in models:
            own = np.frombuffer(seen, np.uint8)
            packed = np.frombuffer(raw, np.float32).reshape(rows, -1)
            column = np.full(self.n, min(len(own), packed.shape[1] - 1))      # a value that the language hasn't seen
            column[self.symbol[own]] = np.arange(len(own))
            self.tables.append((*self._states(np.frombuffer(ctx, np.int64)), np.ascontiguousarray(packed[:, column]).ravel()))

    def _states(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block of each pair of symbols (0: none), row of a context by block and symbol (-1: none), row by pair."""
        n, of = self.n, []
        for k in range(ORDER + 1):
            rows = np.flatnonzero((ids >= 256 ** k) & (ids < 2 * 256 ** k))
            of.append((rows, [self.symbol[(ids[rows] >> (8 * j)) & 255] for j in range(k)]))
        pair = np.full(n * n, of[0][0][0], np.int32)
        if len(of[1][0]):
            for s, row in zip(of[1][1][0].tolist(), of[1][0].tolist(), strict=True):
                pair[s::n] = row
        pair[of[2][1][1] * n + of[2][1][0]] = of[2][0]
        lead = of[3][1][2] * n + of[3][1][1]
        blocks, at = np.unique(lead, return_inverse=True)
        block = np.zeros(n * n, np.int32)
        block[blocks] = np.arange(1, len(blocks) + 1)
        third = np.full((len(blocks) + 1) * n, -1, np.int32)
        third[(at + 1) * n + of[3][1][0]] = of[3][0]
        return block, third, pair

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text (rows) under each language (columns)."""
        out = np.zeros((len(texts), len(self.langs)))
        if not texts:
            return out
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes + ORDER)
        starts = ends - sizes
        stream = np.frombuffer(PAD.join([b"", *texts]), np.uint8)
        n = self.n
        for a in range(ORDER, len(stream), SCORED):
            b = min(a + SCORED, len(stream))
            s = self.symbol[stream[a - ORDER:b]]
            lead, near, last_one, now = s[:-3] * n + s[1:-2], s[1:-2] * n + s[2:-1], s[2:-1], s[3:]
            first = int(np.searchsorted(ends, a, "right"))
            last = int(np.searchsorted(starts, b, "left"))
            lo, hi = np.maximum(starts[first:last], a) - a, np.minimum(ends[first:last], b) - a
            real = hi > lo
            if not real.any():
                continue
            for k, (block, third, pair, bits) in enumerate(self.tables):
                row = third[block[lead] * n + last_one]
                row = np.where(row < 0, pair[near], row).astype(np.int64)
                sums = np.concatenate([[0.0], np.cumsum(bits[row * n + now], dtype=np.float64)])
                out[first:last, k] += np.where(real, sums[hi] - sums[np.minimum(lo, hi)], 0)
        return out


def _shared(docs: DataFrame, models: DataFrame):
    """The look-up tables of all languages as a broadcast, None without a language; their size is bounded by the sample."""
    rows = [(r["lang"], bytes(r["ctx"]), r["n"], bytes(r["seen"]), bytes(r["logp"])) for r in models.collect()]
    return docs.sparkSession.sparkContext.broadcast(Scorer(rows) if rows else None)


def _letters(text: str = "text"):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, models: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte."""
    shared = _shared(docs, models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            n = batch.num_rows
            lang, best, per_byte = np.full(n, UND, object), np.zeros(n), np.zeros(n)
            at = np.flatnonzero(batch["letters"].to_numpy(zero_copy_only=False)) if scorer else []
            for part in portions(batch["text"], at):
                texts = [t.encode() for t in batch["text"].take(pa.array(part)).to_pylist()]
                bits = scorer.code_lengths(texts)
                k = bits.argmin(1)
                least = bits[np.arange(len(part)), k]
                p = np.exp2(np.maximum(least[:, None] - bits, -1000))
                lang[part] = np.array(scorer.langs, object)[k]
                best[part] = 1 / p.sum(1)
                per_byte[part] = least / np.maximum(1, [len(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(best),
                 pa.array(per_byte)], ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    src = docs.select("doc_id", (id_crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
                      _letters().alias("letters"), "text")
    return src.mapInArrow(score, f"doc_id {type_of(docs, 'doc_id')}, held_out boolean, "
                                 "lang_pred string, score double, bits_per_byte double")


def portions(text: pa.Array, at: np.ndarray, most: int = 4 * SCORED) -> Iterator[np.ndarray]:
    """The rows ``at`` in portions of about ``most`` bytes of text."""
    if len(at):
        sizes = pc.binary_length(text).take(pa.array(at)).to_pylist()
        for a, b in slices(sizes, most):
            yield at[a:b]


def keep_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is known: not und, with a score of ``least`` or more.  All columns stay.

    Only the texts with a letter go to Python, once, and a number comes back.
    """
    shared = _shared(docs, train(docs.select("doc_id", "text", "lang")))

    @F.arrow_udf("double")
    def sure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = shared.value
        for text in batches:
            best = np.zeros(len(text))
            for part in portions(text, np.flatnonzero(text.is_valid().to_numpy(zero_copy_only=False)) if scorer else []):
                bits = scorer.code_lengths([t.encode() for t in text.take(pa.array(part)).to_pylist()])
                best[part] = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
            yield pa.array(best)
        release_memory()

    return docs.filter(sure(F.when(_letters(), F.col("text"))) >= least)


def identify(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    return predict(docs, train(docs.select("doc_id", "text", "lang"), docs_per_lang))
