"""Line dedup by an exact set-similarity join over the lines of a corpus.

A line's set is its distinct lower-cased words.  Tokens are ordered from rare to
frequent (a frequency table of fixed size, counted over all documents; words
that share a counter are told apart by hash, so the order is total).  If two sets
have a Jaccard similarity of t or more, the first n - ceil(t * n) + 1 tokens of
both share one: lines meet only under those.  Sizes must lie within t of each
other, the tokens left after the shared place must suffice for the overlap, and a
128-bit parity sketch must not differ too much.  What remains is verified on the
whole sets.  A line goes if an earlier line, by (doc_id, line number), is equal
to or matches it, whether or not that earlier line went itself.

Per shared token a line is first held against its closest earlier candidate, or
the closest few if it is not clear that it matches, which decides whole groups of
copies without writing all pairs; lines that this leaves undecided though they
have more candidates are then held against all.  A
token more frequent than ``HOT`` is split into blocks that meet pairwise.

Defined cases: a null text has no lines and stays null; a line without a word is
kept and never matches; a line of few words matches equal sets only.  Rows that
repeat a doc_id and text are one document and get the same answer; an id with
several texts is several documents, whose equal line numbers rank by set hash.
A null id ranks first.  An empty table gives an empty result.  Columns besides
doc_id and text pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, release_memory, slices, text_slices, type_of, word_hashes
from .near import (PACKED, Bits, among, buckets_for, candidate_pairs, kinds_of, packed, packed_schema, pairs_of, parity, set_keys,
                   texts_of, untried, verify)

SHARE = 80
COUNTERS = 1 << 20
HOT = 200_000
SLICE_CHARS = 1_000_000
#: Earlier candidates that a line is held against first, per shared token, if it is not clear that it matches.
CLOSEST = 4
LINES = "known boolean, {id}, th long, line int, rep long, n int, s0 long, s1 long, prefix array<long>"
POSTING = "key long, rep long, n int, place int, s0 long, s1 long, o1 long, o2 long"
KINDS = kinds_of(POSTING)
#: Counters that one row of counts holds.
COUNTED = 1 << 16


class Tokens:
    """The words of a slice of texts: hashes, and of each line with a word its text, place and number of words."""

    def __init__(self, data: list[bytes]):
        joined = b"\n".join(data)
        self.hashes, at = word_hashes(joined)
        # words before the end of each line
        ends = np.append(np.searchsorted(at, np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)), len(at))
        count = np.diff(ends, prepend=0)
        begins = np.cumsum([0, *(d.count(b"\n") + 1 for d in data)])
        found = np.flatnonzero(count)
        self.count = count[found]
        self.row = np.searchsorted(begins, found, "right") - 1
        self.line = found - begins[self.row]
        self.of = np.repeat(np.arange(len(self.count)), self.count)

    def sets(self, ranks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of each line, by rank of their counter (see ``ranks_of``) and hash; their line; where the lines begin."""
        h = self.hashes
        place = ranks[h & np.uint64(COUNTERS - 1)].astype(np.uint64) if ranks is not None else None
        # line, rank and the upper bits of the hash in one number, which sorts much faster than the three do
        left = 64 - int(len(self.count)).bit_length()
        upper = h >> np.uint64(64 - left) if place is None else place << np.uint64(left - 20)
        if place is not None and left > 20:
            upper |= h >> np.uint64(84 - left)
        if left >= 40:
            key = self.of.astype(np.uint64) << np.uint64(left) | upper
            order = np.argsort(key)
            key, sorted_h = key[order], h[order]
            alike = key[1:] == key[:-1]
        if left < 40 or (sorted_h[1:][alike] != sorted_h[:-1][alike]).any():
            order = np.lexsort((h, self.of) if place is None else (h, place, self.of))
        h, of = h[order], self.of[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        h, of = h[first], of[first]
        return h, of, np.searchsorted(of, np.arange(len(self.count)))


def prefix_length(n: np.ndarray, share: int) -> np.ndarray:
    return n - (share * n + 99) // 100 + 1


def count_tokens(docs: DataFrame) -> np.ndarray:
    """Occurrences of the words of all documents, in COUNTERS counters by hash."""

    def rows(total: np.ndarray, parts: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([x.tobytes() for x in total], pa.binary())],
                                          ["part", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(COUNTERS, np.int64), []
        for batch in batches:
            for _, texts in text_slices(batch["text"].cast(pa.binary()), SLICE_CHARS):
                found, _ = word_hashes(b"\n".join(texts))
                held.append((found & np.uint64(COUNTERS - 1)).astype(np.int32))
                if sum(map(len, held)) > COUNTERS:
                    total += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held = []
        if held:
            total += np.bincount(np.concatenate(held), minlength=COUNTERS)
        total = total.reshape(-1, COUNTED)
        some = np.flatnonzero(total.any(1)).tolist()
        yield rows(total[some], some)
        release_memory()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch["part"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        yield rows(list(total.values()), list(total))
        release_memory()

    schema = "part int, counts binary"
    found = docs.select("text").mapInArrow(run, schema).repartition("part").mapInArrow(add, schema).toArrow()
    out = np.zeros((COUNTERS // COUNTED, COUNTED), np.int64)     # one row for each part
    for part, counts in zip(found["part"].to_pylist(), found["counts"].to_pylist(), strict=True):
        out[part] = np.frombuffer(counts, np.int64)
    return out.ravel()


def ranks_of(counters: np.ndarray) -> np.ndarray:
    """The place of each counter in their order from rare to frequent."""
    out = np.empty(len(counters), np.int32)
    out[np.argsort(counters, kind="stable")] = np.arange(len(counters), dtype=np.int32)
    return out


def lines_of(docs: DataFrame, counters: np.ndarray, share: int) -> DataFrame:
    """Every line with a word: place, set, size, sketch and prefix tokens (null where the batch had the set before)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks_of(counters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # by doc_id, as the row that files a set also gives its place
            rank = pc.rank(batch["doc_id"], null_placement="at_start", tiebreaker="dense").to_numpy()
            order = np.argsort(rank, kind="stable")
            batch, rank = batch.take(pa.array(order)), rank[order]
            seen = np.zeros(0, np.int64)
            for a, texts in text_slices(batch["text"].cast(pa.binary()), SLICE_CHARS):
                t, b = Tokens(texts), a + len(texts)
                h, _, starts = t.sets(shared.value)
                rep = set_keys(h, starts)
                n = np.diff(np.append(starts, len(h)))
                sig = parity(h, starts, 2).view(np.int64)
                fresh = np.zeros(len(rep), bool)
                at = rank[t.row + a]
                by = np.lexsort((t.line, at, rep))
                first = by[np.unique(rep[by], return_index=True)[1]]
                fresh[first] = True
                # smaller sets are similar to equal ones only
                if len(seen):
                    fresh &= seen[np.minimum(np.searchsorted(seen, rep), len(seen) - 1)] != rep
                fresh &= 100 * n >= share * (n + 1)
                # another text of the last id may hold a set at an earlier line
                seen = np.sort(np.concatenate([seen, rep[first[at[first] < rank[b - 1]]]]))
                size = np.where(fresh, prefix_length(n, share), 0)
                ends = np.cumsum(size)
                taken = np.repeat(starts - (ends - size), size) + np.arange(int(size.sum()))
                prefix = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)),
                                                  pa.array(mix64(h[taken]).view(np.int64)), mask=pa.array(~fresh))
                row = pa.array(t.row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(row).is_valid(), batch["doc_id"].take(row), batch["th"].take(row),
                     pa.array(t.line.astype(np.int32)), pa.array(rep), pa.array(n.astype(np.int32)),
                     pa.array(np.ascontiguousarray(sig[:, 0])), pa.array(np.ascontiguousarray(sig[:, 1])), prefix],
                    ["known", "doc_id", "th", "line", "rep", "n", "s0", "s1", "prefix"])
        release_memory()

    return (docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
            .mapInArrow(run, LINES.format(id=f"doc_id {type_of(docs, 'doc_id')}")))


def placed(lines: DataFrame) -> DataFrame:
    """Of every line that files its set what its postings need."""
    return (lines.filter("prefix IS NOT NULL")
            .select("rep", "n", "s0", "s1", F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("o1"),
                    F.col("line").cast("long").alias("o2"), "prefix"))


def packed_postings(lines: DataFrame, counters: np.ndarray, buckets: int) -> DataFrame:
    """One posting per prefix token, packed into buckets of tokens."""
    hot = counters.max(initial=0) > HOT
    shared = lines.sparkSession.sparkContext.broadcast(counters if hot else None)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for whole in batches:
            for a, b in slices(whole["prefix"].value_lengths().to_pylist(), PACKED):
                batch = whole.slice(a, b - a)
                row, key = lists_of(batch)
                begins = np.append(0, np.cumsum(batch["prefix"].value_lengths().to_numpy()))
                cols = {"key": key, "place": np.arange(len(row)) - begins[row]}
                cols |= {c: batch[c].to_numpy()[row] for c in ("rep", "n", "s0", "s1", "o1", "o2")}
                yield split_keys(cols, shared.value) if hot else cols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(parts(batches), KINDS, buckets)
        release_memory()

    return placed(lines).mapInArrow(run, packed_schema(KINDS))


def split_keys(cols: dict[str, np.ndarray], counters: np.ndarray) -> dict[str, np.ndarray]:
    """Postings whose tokens over HOT are split into blocks; each pair of blocks is a key."""
    key, rep = cols["key"].view(np.uint64), cols["rep"].view(np.uint64)
    blocks = np.maximum(-(-counters[unmix64(key) % np.uint64(COUNTERS)] // HOT), 1)
    row = np.repeat(np.arange(len(key)), blocks)
    other = (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)).astype(np.uint64)
    own = rep[row] % blocks[row].astype(np.uint64)
    pair = np.minimum(own, other) * np.uint64(1 << 20) + np.maximum(own, other)
    new = np.where(blocks[row] > 1, mix64(key[row] ^ mix64(pair + np.uint64(1))), key[row]).view(np.int64)
    return {c: v[row] for c, v in cols.items()} | {"key": new}


def split_hot(postings: DataFrame, counters: np.ndarray) -> DataFrame:
    """The rows of postings, split as by ``split_keys``."""
    if counters.max(initial=0) <= HOT:
        return postings
    shared = postings.sparkSession.sparkContext.broadcast(counters)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = split_keys({c: batch[c].to_numpy() for c in KINDS}, shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(cols[c]) for c in KINDS], list(KINDS))

    return postings.mapInArrow(split, POSTING)


def unmix64(x: np.ndarray) -> np.ndarray:
    """The inverse of mix64."""
    def unshift(y: np.ndarray, k: int) -> np.ndarray:
        out = y
        for _ in range(64 // k):
            out = y ^ (out >> np.uint64(k))
        return out

    x = unshift(x, 31)
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = unshift(x, 27)
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshift(x, 30)


def sets_of(docs: DataFrame, lines: DataFrame, reps: DataFrame) -> DataFrame:
    """rep, elements (sorted) of the sets named in reps, from the texts (one for each set) that hold them."""
    filled = docs.sparkSession.sparkContext.broadcast((Bits.of(reps).words, texts_of(lines, reps)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, holding = map(Bits, filled.value)
        for batch in batches:
            batch = batch.filter(pa.array(holding.holds(batch["th"].to_numpy()), pa.bool_()))
            found = {}
            for _, texts in text_slices(batch["text"].cast(pa.binary()), SLICE_CHARS):
                h, _, starts = Tokens(texts).sets(None)
                rep, ends = set_keys(h, starts), np.append(starts, len(h))
                for i in np.flatnonzero(held.holds(rep)).tolist():
                    found[int(rep[i])] = h[ends[i]:ends[i + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())],
                                             ["rep", "elements"])
        release_memory()

    wide = docs.select("text", F.xxhash64("text").alias("th")).mapInArrow(run, "rep long, elements binary")
    return materialise(wide.groupBy("rep").agg(F.first("elements").alias("elements")), "sets")


def both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("later").alias("rep")).union(pairs.select("earlier"))


def beside(postings: DataFrame, keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """The postings under the keys, with want = 1 for wanted sets; by set filters, which let few others through."""
    filled = postings.sparkSession.sparkContext.broadcast((Bits.of(keys).words, Bits.of(wanted).words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets = map(Bits, filled.value)
        for batch in batches:
            near = batch.filter(pa.array(held.holds(batch["key"].to_numpy()), pa.bool_()))
            yield near.append_column("want", pa.array(sets.holds(near["rep"].to_numpy()).astype(np.int32)))

    return postings.mapInArrow(run, POSTING + ", want int")


def size_step(n: np.ndarray) -> np.ndarray:
    """The logarithm of a size in steps of a twentieth; sizes that are similar lie few steps apart."""
    return np.floor(np.log(n) / np.log(1.05)).astype(np.int64)


def sized(key: np.ndarray, step: np.ndarray) -> np.ndarray:
    return mix64(key.view(np.uint64) + mix64(step.astype(np.uint64) + np.uint64(1))).view(np.int64)


def lists_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row and token of every prefix token."""
    row = np.repeat(np.arange(batch.num_rows), batch["prefix"].value_lengths().to_numpy())
    return row, batch["prefix"].flatten().to_numpy()


def meeting(lines: DataFrame, counters: np.ndarray, wanted: DataFrame, share: int) -> DataFrame:
    """The postings under a token of a wanted set of about their size; no other token leaves the list of its line."""
    reach = int(np.ceil(np.log(100 / share) / np.log(1.05)))
    sought = lines.sparkSession.sparkContext.broadcast(Bits.of(wanted).words)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bits(sought.value)
        for batch in batches:
            batch = batch.filter(pa.array(held.holds(batch["rep"].to_numpy()), pa.bool_()))
            row, key = lists_of(batch)
            step = size_step(batch["n"].to_numpy())[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([sized(key, step + d) for d in range(-reach, reach + 1)]))], ["key"])

    filed = placed(lines)
    keys = filed.select("rep", "n", "prefix").mapInArrow(around, "key long")
    filled = lines.sparkSession.sparkContext.broadcast(Bits.of(keys).words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bits(filled.value)
        for batch in batches:
            row, key = lists_of(batch)
            at = np.flatnonzero(held.holds(sized(key, size_step(batch["n"].to_numpy())[row])))
            row = row[at]
            begins = np.append(0, np.cumsum(batch["prefix"].value_lengths().to_numpy()))
            row, place = pa.array(row), (at - begins[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), batch["rep"].take(row), batch["n"].take(row), pa.array(place),
                 *[batch[c].take(row) for c in ("s0", "s1", "o1", "o2")]],
                ["key", "rep", "n", "place", "s0", "s1", "o1", "o2"])
        release_memory()

    return split_hot(filed.mapInArrow(run, POSTING), counters)


def matched_sets(docs: DataFrame, lines: DataFrame, counters: np.ndarray, share: int) -> DataFrame:
    """rep of the sets that match an earlier one."""
    # a prefix holds about this share of a line's words
    buckets = buckets_for(int(counters.sum()) * (100 - share) // 100)
    postings = packed_postings(lines, counters, buckets)
    tried = materialise(pairs_of(postings, KINDS, share, most=CLOSEST).groupBy("later", "earlier").agg(F.max("more").alias("more")),
                        "pairs")
    matched = materialise(verify(tried, sets_of(docs, lines, both(tried)), share).select(F.col("later").alias("rep")).distinct(),
                          "matched")
    open_sets = (tried.groupBy(F.col("later").alias("rep")).agg(F.max("more").alias("more")).filter("more")
                 .join(matched, "rep", "left_anti").select("rep"))
    open_sets = materialise(open_sets, "open")
    if open_sets.isEmpty():
        return matched
    # undecided sets against all their candidates, among the postings that share a token with one
    met = materialise(meeting(lines, counters, open_sets, share), "met")
    near = beside(met, among(met, "rep", open_sets).select("key"), open_sets)
    rest = materialise(untried(candidate_pairs(near, share, every=True, buckets=buckets), tried), "pairs")
    if rest.isEmpty():
        return matched
    more = verify(rest, sets_of(docs, lines, both(rest)), share).select(F.col("later").alias("rep"))
    return matched.union(more).distinct()


def gone_lines(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, th (hash of the text) and line of every line that goes."""
    src = docs.select("doc_id", "text")
    counters = count_tokens(src)
    lines = materialise(lines_of(src, counters, share), "lines")
    matched = materialise(matched_sets(src, lines, counters, share), "matched")
    # a line whose set comes once and matches nothing stays: only the others are sorted and joined
    twice = lines.groupBy("rep").agg(F.count("*").alias("n")).filter("n > 1").select("rep")
    some = among(lines.select("known", "doc_id", "th", "line", "rep"), "rep", matched.select("rep").union(twice))
    place = F.struct("known", "doc_id", "line")
    some = materialise(some, "repeated")
    first = some.groupBy("rep").agg(F.min(place).alias("first"))
    fate = first.join(matched.withColumn("matched", F.lit(True)), "rep", "left")
    return (some.join(fate, "rep").filter(F.col("matched").isNotNull() | (F.col("first") != place))
            .select("doc_id", "th", "line"))


def report(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (numbers from 0) of every row."""
    gone = (gone_lines(docs, share).groupBy("doc_id", "th")
            .agg(F.sort_array(F.collect_set("line")).alias("removed")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"),
                       F.when(F.col("text").isNull(), 0).otherwise(
                           F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
                       .cast("long").alias("n_lines"))
    g = gone.select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"), "removed")
    none = F.lit([]).cast("array<int>")
    return (rows.join(g, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")), "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("removed", none).alias("removed_lines")))


def remove(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """The documents without their removed lines; one whose every line with a word went is dropped."""
    gone = gone_lines(docs, share).groupBy("doc_id", "th").agg(F.collect_set("line").alias("removed"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    g = gone.select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"), "removed")
    joined = held.join(g, F.col("doc.doc_id").eqNullSafe(F.col("g_id")) & (F.xxhash64("doc.text") == F.col("g_th")), "left")
    kept = F.expr("array_join(filter(transform(split(doc.text, '\\n'), (x, i) -> "
                  "CASE WHEN array_contains(removed, i) THEN NULL ELSE x END), x -> x IS NOT NULL), '\\n')")
    return (joined.withColumn("left", F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(kept))
            .filter(F.col("removed").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
            .select(*[(F.col("left") if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]))
