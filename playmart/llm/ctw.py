"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions.  For each context of 0 to 3 preceding bytes
and each decision the Krichevsky-Trofimov estimate is learned from the training
documents, and the weight of stopping at a context against splitting it further is
the exact context-tree weight: half its own block probability against half the
product of its children's.  With the counts frozen, the mixture over all depths
is one number per context and byte, so scoring is a look-up, and the code length
of a text is the sum over its bytes and an end mark.

Every context of three bytes has counts of its own, however rare.  All sums over the tree are
made on the executors, by pairs of bytes (the newest two of a context): a pair has at most 2**16
counts.  Contexts that hold at least 1 / 2**16 of all training bytes (at most 2**16 of them) are broadcast
as rows of 256 numbers and settled where they stand.  What follows the others is sent once per
context, byte and slice of documents, like rare words below, and joined to its exact price.
A context that training doesn't know counts as the longest one within it that it knows.

The base score needs the exact count of every training word.  Words with at least
1 / 2**20 of all tokens (at most 2**20 of them) are broadcast and settled where they
stand.  The others are sent once per word and slice of documents, with the
documents and counts packed, joined to the word counts, and summed per slice.

Defined cases: a null text is empty: one end token, one end mark.  Without training
documents every byte costs eight bits and every token's base is log10(1).  Rows
are scored one by one; repeated rows are learned and scored once each; a null
id counts as empty text in the split, so it is held out.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, id_crc_mod, lower_words, materialise, slices, type_of

END = 0xFF  # no byte of UTF-8
DEPTH = 3
SHARE_CONTEXT = 1 << 16
SHARE_WORD = 1 << 20
SLICE_CHARS = 3_500_000
WINDOW = 1 << 20
PAIRS = 1 << 10


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for x > 0, by Stirling's series after a shift by eight."""
    low, shift = x.astype(np.float64), np.zeros(x.shape)
    y = low.copy()
    for _ in range(8):
        small = y < 8
        shift += np.where(small, np.log(np.where(small, y, 1.0)), 0)
        y = np.where(small, y + 1, y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability of so many zeros and ones."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
            - 2 * 0.5723649429247001)


class Decisions:
    """The binary decisions of byte counts (contexts x 256): totals below each node of the bit tree."""

    def __init__(self, counts: np.ndarray):
        t = np.zeros((len(counts), 512))
        t[:, 256:] = counts
        for v in range(255, 0, -1):
            t[:, v] = t[:, 2 * v] + t[:, 2 * v + 1]
        self.zeros, self.ones = t[:, 2:512:2], t[:, 3:512:2]  # column v - 1 is node v
        self.block = block(self.zeros, self.ones)
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)


def code_lengths(one: np.ndarray) -> np.ndarray:
    """log10 p(byte) from the probability of a one at every node (contexts x 255)."""
    out = np.zeros((len(one), 512))
    yes, no = np.log10(one), np.log10(1 - one)
    for v in range(1, 256):
        out[:, 2 * v] = out[:, v] + no[:, v - 1]
        out[:, 2 * v + 1] = out[:, v] + yes[:, v - 1]
    return out[:, 256:].astype(np.float32)


class Model:
    """Rows of log10 probabilities of the frequent contexts, and the prices of all that follows others (a frame)."""

    def __init__(self, codes: np.ndarray, table: np.ndarray, rare: DataFrame | None = None):
        self.codes, self.table, self.rare = codes, table, rare


class Upper:
    """The tree above the pairs, by decision: what the root, and every newest byte, estimates and weighs."""

    def __init__(self, counts: np.ndarray, children: np.ndarray):
        """counts (256 x 256) by newest byte and next byte, children (256 x 255): weighted blocks of the pairs, summed."""
        single, root = Decisions(counts), Decisions(counts.sum(0)[None])
        seen = counts.sum(1) > 0
        weighted = np.logaddexp(single.block, children) - np.log(2)
        self.stay0 = stay(root.block[0], weighted[seen].sum(0))
        self.base = root.one[0]
        self.stay1 = np.where(seen[:, None], stay(single.block, children), 0)
        self.one1 = np.where(seen[:, None], single.one, self.base)

    def mixed(self, newest: np.ndarray, node: np.ndarray, below: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The probability of a one, from the pairs' mixture ``below`` where the pair is ``known``."""
        one, s = self.one1[newest, node], self.stay1[newest, node]
        inner = np.where(known, s * one + (1 - s) * below, one)
        return self.stay0[node] * self.base[node] + (1 - self.stay0[node]) * inner


def stay(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    """The weight of not splitting: own block probability against the children's product."""
    return 1 / (1 + np.exp(np.clip(children - own, -700, 700)))


class Pairs:
    """Whole pairs of bytes with all contexts below them: sorted keys (newest byte first, then older ones, then the next byte)."""

    def __init__(self, key: np.ndarray, n: np.ndarray):
        self.key, self.n = key, n
        self.code, at = np.unique(key >> 16, return_inverse=True)
        self.at = at
        self.newest = self.code >> 8
        self.counts = np.zeros((len(self.code), 256))
        np.add.at(self.counts, (at, key & 255), n)
        self.own = Decisions(self.counts)
        self.known = self.counts.sum(1) > 0
        self.first = np.flatnonzero(np.concatenate([[True], key[1:] >> 8 != key[:-1] >> 8]))
        self.held = np.add.reduceat(n, self.first)  # training bytes after each context
        self.of = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(key))))
        children = np.zeros((len(self.code), 255))
        self.deep = []
        for level in range(8):  # counts that share a node lie side by side
            head = key >> (8 - level)
            begin = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
            bit = key >> (7 - level) & 1
            ones, every = np.add.reduceat(n * bit, begin), np.add.reduceat(n, begin)
            node = (1 << level | (key & 255) >> (8 - level)) - 1
            own = np.where(every > 0, block((every - ones).astype(float), ones.astype(float)), 0)
            np.add.at(children, (at[begin], node[begin]), own)
            one = np.repeat((ones + 0.5) / (every + 1), np.diff(np.append(begin, len(key))))
            self.deep.append((node, bit, one))
        self.stay = stay(self.own.block, children)
        self.weighted = np.where(self.known[:, None], np.logaddexp(self.own.block, children) - np.log(2), 0)

    def prices(self, upper: Upper) -> np.ndarray:
        """log10 p of every key's next byte after its context."""
        out = np.zeros(len(self.key))
        seen = self.held[self.of] > 0
        for node, bit, deep in self.deep:
            s, own = self.stay[self.at, node], self.own.one[self.at, node]
            one = upper.mixed(self.newest[self.at], node, np.where(seen, s * own + (1 - s) * deep, own), self.known[self.at])
            out += np.log10(np.where(bit == 1, one, 1 - one))
        return out

    def rows(self, contexts: np.ndarray, upper: Upper) -> np.ndarray:
        """log10 p of all 256 next bytes after some contexts (places in ``first``)."""
        counts = np.zeros((len(contexts), 256))
        place = np.full(len(self.first), -1)
        place[contexts] = np.arange(len(contexts))
        mine = place[self.of] >= 0
        counts[place[self.of[mine]], self.key[mine] & 255] = self.n[mine]
        at = self.at[self.first[contexts]]
        s = self.stay[at]
        below = s * self.own.one[at] + (1 - s) * Decisions(counts).one
        return code_lengths(upper.mixed(self.newest[at][:, None], np.arange(255)[None], below, np.ones((len(at), 1), bool)))


def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Pairs]:
    """Whole pairs, at most PAIRS at a time, from sorted rows (key, n)."""
    key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def cut(last: bool) -> Iterator[Pairs]:
        nonlocal key, n
        pair = key >> 16
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(key) else np.zeros(0, int)
        ends = np.append(starts, len(key)) if last else starts  # the last pair may go on
        for i in range(0, len(ends) - 1, PAIRS):
            a, b = ends[i], ends[min(i + PAIRS, len(ends) - 1)]
            yield Pairs(key[a:b], n[a:b])
        if len(ends):
            key, n = key[ends[-1]:], n[ends[-1]:]

    for batch in batches:
        key = np.concatenate([key, batch["key"].to_numpy()])
        n = np.concatenate([n, batch["n"].to_numpy()])
        yield from cut(False)
    yield from cut(True)


class Scorer:
    """log10 probabilities of texts, by look-up; what follows rare contexts is listed."""

    def __init__(self, model: Model):
        self.table = np.append(model.table.ravel(), np.zeros(256, np.float32))
        self.rare = len(model.table)  # their row adds nothing
        self.row = np.full(1 << 24, self.rare, np.int32)  # 64 MB
        self.row[model.codes] = np.arange(len(model.codes))

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums over frequent contexts; the gram, and the number of its text, of every other byte."""
        out, grams, of = np.zeros(len(texts)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        stream, ends = stream_of(texts)
        starts = np.concatenate([[DEPTH], ends[:-1]]) if len(ends) else ends
        for a in range(DEPTH, len(stream), WINDOW):
            b = min(len(stream), a + WINDOW)
            s = stream[a - DEPTH:b].astype(np.int64)
            ctx = context(s)
            row = self.row[ctx]
            sums = np.concatenate([[0.0], np.cumsum(self.table[row.astype(np.int64) * 256 + s[DEPTH:]],
                                                    dtype=np.float64)])
            i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
            out[i:j] += sums[np.minimum(ends[i:j], b) - a] - sums[np.maximum(starts[i:j], a) - a]
            other = np.flatnonzero(row == self.rare)
            grams.append(ctx[other] << 8 | s[DEPTH:][other])
            of.append(np.searchsorted(ends, other + a, "right"))
        return out, np.concatenate(grams), np.concatenate(of)


def stream_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in a row, each with its end mark, after DEPTH end marks; and where each ends."""
    end = bytes([END])
    stream = np.frombuffer(end * DEPTH + b"".join([t + end for t in texts]), np.uint8)
    return stream, DEPTH + np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)


def context(s: np.ndarray) -> np.ndarray:
    """The code of the three bytes before each position; an end mark hides what lies before it."""
    a, b, c = s[:-3], s[1:-2], s[2:-1]
    b = np.where(c == END, END, b)
    a = np.where(b == END, END, a)
    return a << 16 | b << 8 | c


def gram_counts(docs: DataFrame) -> DataFrame:
    """gram (context and byte, base 256) of every text and its count in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, held = batch["text"].to_pylist(), batch["held_out"].to_pylist()
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                for out in (False, True):
                    s = stream_of([t.encode() for t, h in zip(texts[a:b], held[a:b], strict=True) if h == out])[0].astype(np.int64)
                    gram, n = np.unique((context(s) << 8 | s[DEPTH:]).astype(np.uint32), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64) * (not out))], ["gram", "n"])

    return docs.select("text", "held_out").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def turned(gram: np.ndarray) -> np.ndarray:
    """The gram's context read from its newest byte to its oldest, or back; the next byte stays last."""
    return (gram >> 8 & 255) << 24 | (gram >> 16 & 255) << 16 | (gram >> 24 & 255) << 8 | gram & 255


def learn(docs: DataFrame) -> Model:
    """The model.  To the driver come 256 sums for each task, and at most 2**16 rows of frequent contexts."""
    spark = docs.sparkSession
    grams = materialise(gram_counts(docs), "grams")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    byte = lambda shift: F.shiftright("gram", shift).bitwiseAND(255)
    keys = grams.select((byte(8) * (1 << 24) + byte(16) * (1 << 16) + byte(24) * (1 << 8) + byte(0)).alias("key"), "n")
    pair = F.shiftright("key", 16)
    by_pair = keys.repartitionByRange(spark.sparkContext.defaultParallelism, pair).sortWithinPartitions("key")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for p in pairs_of(batches):
            for b in np.unique(p.newest).tolist():
                at = p.newest == b
                found[b] = found.get(b, 0) + np.concatenate([p.counts[at].sum(0), p.weighted[at].sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()),
                                          pa.array([x.tobytes() for x in found.values()], pa.binary())], ["newest", "sums"])

    counts, children = np.zeros((256, 256)), np.zeros((256, 255))
    for r in by_pair.mapInArrow(sums, "newest long, sums binary").collect():
        x = np.frombuffer(r["sums"])
        counts[r["newest"]] += x[:256]
        children[r["newest"]] += x[256:]
    upper = spark.sparkContext.broadcast(Upper(counts, children))

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pairs_of(batches):
            often = p.held * SHARE_CONTEXT >= max(1, total)
            rare, places = ~often[p.of], np.flatnonzero(often)
            gram, lp = turned(p.key[rare]), p.prices(upper.value)[rare]
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(lp), pa.nulls(len(gram), pa.binary())],
                                             ["gram", "price", "row"])
            for i in range(0, len(places), PAIRS):
                part = places[i:i + PAIRS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(turned(p.key[p.first[part]]) >> 8), pa.nulls(len(part), pa.float64()),
                     pa.array([x.tobytes() for x in p.rows(part, upper.value)], pa.binary())], ["gram", "price", "row"])

    priced = materialise(by_pair.mapInArrow(price, "gram long, price double, row binary"), "prices")
    often = priced.filter("row IS NOT NULL").select("gram", "row").toArrow()
    table = np.frombuffer(b"".join(often["row"].to_pylist()), np.float32).reshape(-1, 256)
    return Model(often["gram"].to_numpy().astype(np.int64), table, priced.filter("row IS NULL").select("gram", "price"))


def word_counts(docs: DataFrame) -> DataFrame:
    """h, c: the hash of every word of the corpus and its count in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, held = batch["text"].to_pylist(), batch["held_out"].to_pylist()
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                found: Counter = Counter()
                for t, h in zip(texts[a:b], held[a:b], strict=True):
                    if not h:
                        found.update(lower_words(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.array(list(found)).view(np.int64)), pa.array(list(found.values()), pa.int64())], ["h", "c"])

    return docs.select("text", "held_out").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


ROWS = ("{id}, part long, k int, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "kind int, h long, packed binary")
#: Kinds of rows besides documents: a rare word, and a byte after a rare context.
WORD, GRAM = 0, 1


def packed(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Every different h, and for each the numbers of the documents that hold it with their counts."""
    order = np.lexsort((of, h))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    data = np.stack([of[first], times], 1).astype("<u4").tobytes()
    h = h[first]
    begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
    cuts = np.append(begin, len(h)) * 8
    return h[begin], [data[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def rows_of(docs: DataFrame, model: Model, often: tuple[np.ndarray, np.ndarray], total: int, kinds: int,
            end_count: int) -> DataFrame:
    """Rows of documents (h null) with what frequent words and contexts give, and of what is rare in a slice.

    A slice is named by ``part``; ``packed`` holds the numbers k of its documents with the word or gram, and counts.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((Model(model.codes, model.table), often))
    scale = np.log10(total + 0.1 * (kinds + 1))
    end_score = float(np.log10(end_count + 0.1) - scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (words, counts) = shared.value
        scorer, hashes, part = Scorer(model), WordHashes(200_000), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                split = [lower_words(t) for t in texts[a:b]]
                n = np.array([len(x) for x in split], np.int64)
                h = hashes.array([w for x in split for w in x])
                del split
                of = np.repeat(np.arange(b - a), n)
                at = np.minimum(np.searchsorted(words, h), max(0, len(words) - 1))
                known = words[at] == h if len(words) else np.zeros(len(h), bool)
                base = np.full(b - a, end_score)
                base += np.bincount(of[known], np.log10(counts[at[known]] + 0.1) - scale, b - a)
                n_known = np.bincount(of[known], minlength=b - a) + int(end_count > 0)
                score, *grams = scorer.scores([t.encode() for t in texts[a:b]])
                word, word_docs = packed(h[~known].view(np.int64), of[~known])
                gram, gram_docs = packed(*grams)
                docs_n, words_n = b - a, len(word) + len(gram)
                pad = lambda values, kind, after: pa.array([*values, *[None] * after], kind)
                none = lambda kind, m: pa.nulls(m, kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([batch["doc_id"].slice(a, docs_n), none(batch["doc_id"].type, words_n)]),
                     pa.array(np.full(docs_n + words_n, part)), pad(range(docs_n), pa.int32(), words_n),
                     pa.concat_arrays([batch["held_out"].slice(a, docs_n), none(pa.bool_(), words_n)]),
                     pad((n + 1).tolist(), pa.int64(), words_n), pad(n_known.tolist(), pa.int64(), words_n),
                     pad(base.tolist(), pa.float64(), words_n), pad(score.tolist(), pa.float64(), words_n),
                     pa.concat_arrays([none(pa.int32(), docs_n), pa.array(np.repeat([WORD, GRAM], [len(word), len(gram)]), pa.int32())]),
                     pa.concat_arrays([none(pa.int64(), docs_n), pa.array(word), pa.array(gram)]),
                     pa.concat_arrays([none(pa.binary(), docs_n), pa.array(word_docs + gram_docs, pa.binary())])],
                    ["doc_id", "part", "k", "held_out", "n_tokens", "n_known", "base", "score", "kind", "h", "packed"])
                part += 1

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, ROWS.format(id=f"doc_id {type_of(docs, 'doc_id')}"))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row."""
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                      (id_crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"))
    model = learn(src)
    counts = materialise(word_counts(src), "words")
    ends = src.filter("NOT held_out").count()
    found = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, kinds = found["n"] + ends, found["v"] + int(ends > 0)
    often = counts.filter(F.col("c") * SHARE_WORD >= max(1, total)).toArrow()  # at most SHARE_WORD rows
    h, c = often["h"].to_numpy().view(np.uint64), often["c"].to_numpy()
    order = np.argsort(h)
    rows = materialise(rows_of(src, model, (h[order], c[order]), total, kinds, ends), "rows")
    scale = float(np.log10(total + 0.1 * (kinds + 1)))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = [np.frombuffer(x, "<u4").reshape(-1, 2) for x in pdf["packed"]]
        per = np.array([len(p) for p in pairs])
        both = np.concatenate(pairs).astype(np.int64)
        kind, price = np.repeat(pdf["kind"].to_numpy(), per), np.repeat(pdf["price"].to_numpy(np.float64), per)
        known = np.repeat(pdf["known"].to_numpy(np.int64), per)
        per_kind = [np.bincount(both[:, 0], both[:, 1] * price * (kind == x)) for x in (WORD, GRAM)]
        k = np.unique(both[:, 0])
        return pd.DataFrame({"part": pdf["part"].iloc[0], "k": k.astype(np.int32), "more": per_kind[WORD][k],
                             "more_known": np.bincount(both[:, 0], both[:, 1] * known)[k].astype(np.int64), "more_score": per_kind[GRAM][k]})

    c = F.coalesce("c", F.lit(0))
    words = (rows.filter(F.col("kind") == WORD).select("kind", "h", "part", "packed").join(counts, "h", "left")
             .select("part", "kind", "packed", (F.log10(c + 0.1) - scale).alias("price"), (c > 0).cast("long").alias("known")))
    grams = (rows.filter(F.col("kind") == GRAM).select("kind", "h", "part", "packed")
             .join(model.rare.withColumnRenamed("gram", "h"), "h")
             .select("part", "kind", "packed", "price", F.lit(0).cast("long").alias("known")))
    sums = words.unionByName(grams).groupBy("part").applyInPandas(
        add, "part long, k int, more double, more_known long, more_score double")
    return (rows.filter("h IS NULL").drop("kind", "h", "packed").join(sums, ["part", "k"], "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score")))
