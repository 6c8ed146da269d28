"""N-gram Jaccard join by parity sketches.

The distinct word shingles of a document are hashed and thrown into the blocks
of a bit sketch, each flipping one bit.  The Hamming distance of two sketches
is at most the symmetric difference of the sets, and similar sets of sizes a, b
differ in at most (1 - t) / (1 + t) * (a + b) shingles.  So with one block more
than that bound, similar documents agree in a whole block: the pigeonhole join.
Sizes are cut into bands such that similar documents lie in the same or in
neighbouring bands; every document files its blocks for its own band and the
one below, with the number of blocks of that band.

Blocks of no or one shingle would match too often: two long documents share some
shingle by chance.  Each band has ``SPARE`` per cent more blocks than the bound
needs, so a document may leave out as many of those (if there are more, the empty
ones only, or none): blocks that agree look alike to both documents, so what
remains still must agree somewhere.  Candidates under a common block are
then held against a second, 256-bit sketch, pairs against a third one of about a
bit per shingle, and what remains is verified on the sets.

First each set is compared to its closest few earlier candidates of all blocks, which
links whole groups of copies with few pairs a set; then, for sets that have more
candidates, those that still lie in different components are all verified, so no
link that joins two components is lost.  Their postings carry a 512-bit sketch of the
whole set, so pairs that are not similar are dropped where they meet.

Defined cases: null or empty text, or text without a word: an empty set, linked
with nothing, even its like.  Fewer words than the shingle width: the whole
sequence is the one shingle.  Equal sets are linked; they are one node of the
join.  Repeated rows and ids are kept row by row, and component_id is the
smallest id, null only if all ids of the component are.  An empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, release_memory, slices, text_slices, type_of, word_hashes
from .near import (Bits, among, buckets_for, candidate_pairs, components, folded, kinds_of, most_difference, packed,
                   packed_schema, pairs_of, repeated, screen, set_keys, texts_of, untried, verify, wide_sketch)

SPARE = 8
#: Shingles in which a part of a document may differ; the sketch of a part has 128 bits.
PART = 32
SLICE_CHARS = 1_000_000
#: Keys of about so many are looked up at a time.
SLICE_KEYS = 200_000
#: Earlier candidates of all blocks that a set is compared to first.
CLOSEST = 3
POSTING = "key long, rep long, n int, parts int, s0 long, s1 long"
KINDS = kinds_of(POSTING)


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of k words of all texts, sorted within each, and where those of each text begin.

    A list of n texts has n + 1 beginnings, the last being the end.
    """
    data = [(t or "").encode() for t in texts]
    h, at = word_hashes(b"\n".join(data))
    first = np.searchsorted(at, np.cumsum([0, *(len(d) + 1 for d in data)]))
    rolled = np.full(max(0, len(h) - k + 1), k, np.uint64)
    for i in range(k):
        rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(rolled)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                whole = mix64(whole * np.uint64(0x9E3779B97F4A7C15) + h[i:i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    ends = np.cumsum([0, *map(len, out)])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), ends


def shingled(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, shingles and their beginnings, for bounded portions of texts."""
    for a, some in text_slices(texts, SLICE_CHARS):
        yield a, *shingle_sets(some, k)


@lru_cache(maxsize=4)
def bands(share: int, largest: int = 1 << 34) -> list[int]:
    """First size of every band: whatever is similar to a size in one lies in it or a neighbour."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, 100 * out[-1] // share + 1))
    return out


def blocks_of(band: int, share: int) -> tuple[int, int, int]:
    """Parts of a band, blocks of each part and how many of few shingles may be left out; no part if only equal sets
    are similar there."""
    largest = bands(share)[band + 1] - 1
    most = most_difference(largest, 100 * largest // share, share)
    if not most:
        return 0, 0, 0
    parts = -(-most // PART)
    spare = 1 + most // parts * SPARE // 100
    return parts, most // parts + 1 + spare, spare


def filed(found: np.ndarray, share: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """For a set's own band and the one below: keys, how many each part has, number of parts and their sketches."""
    own = int(np.searchsorted(bands(share), len(found), "right")) - 1
    for band in {own, max(0, own - 1)}:
        parts, n, spare = blocks_of(band, share)
        if not parts:
            continue
        mixed = mix64(found + np.uint64(band))
        block = ((mixed >> np.uint64(8)) % np.uint64(parts * n)).astype(np.int64)
        bit = np.uint64(1) << (mixed & np.uint64(63))
        words, sketch = np.zeros(parts * n, np.uint64), np.zeros((parts, 2), np.uint64)
        np.bitwise_xor.at(words, block, bit)
        mixed = mix64(mixed ^ np.uint64(0x9E3779B97F4A7C15))
        np.bitwise_xor.at(sketch, (block // n, (mixed >> np.uint64(6) & np.uint64(1)).astype(np.int64)),
                          np.uint64(1) << (mixed & np.uint64(63)))
        bits = np.bitwise_count(words).reshape(parts, n)
        few = np.where((bits <= 1).sum(1) <= spare, 1, np.where((bits == 0).sum(1) <= spare, 0, -1))
        kept = bits.astype(np.int64) > few[:, None]
        at = np.flatnonzero(kept)
        yield mix64(mix64(words[at]) + mix64(at.astype(np.uint64) + np.uint64(band << 40))), kept.sum(1), parts, sketch


def block_keys(found: np.ndarray, share: int) -> np.ndarray:
    """The keys under which a set is filed: one per block of its own band and the one below."""
    return np.concatenate([np.zeros(0, np.uint64), *[keys for keys, *_ in filed(found, share)]])


def sketches(docs: DataFrame, k: int, share: int) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, rep (null for an empty set), wide, keys, and for each part how many
    keys are its own (sizes), the number of parts and its sketch (sigs, two numbers), of every row.

    Within a batch only the first row of equal sets carries the wide sketch, keys and parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for start, found, ends in shingled(batch["text"], k):
                n = np.diff(ends)
                some = np.flatnonzero(n)
                rep = np.zeros(len(n), np.int64)
                rep[some] = set_keys(found, ends[some])
                wide, keys, sizes, parts, sigs = ([None] * len(n) for _ in range(5))
                for i in some.tolist():
                    if (r := int(rep[i])) not in seen:
                        seen.add(r)
                        own = found[ends[i]:ends[i + 1]]
                        wide[i] = wide_sketch(own)
                        each = list(filed(own, share))
                        keys[i] = np.concatenate([np.zeros(0, np.int64), *[x[0].view(np.int64) for x in each]])
                        sizes[i] = np.concatenate([np.zeros(0, np.int64), *[x[1] for x in each]])
                        parts[i] = np.concatenate([np.zeros(0, np.int64), *[np.full(x[2], x[2]) for x in each]])
                        sigs[i] = np.concatenate([np.zeros(0, np.int64), *[x[3].view(np.int64).ravel() for x in each]])
                part = batch.slice(start, len(n))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["th"], pa.array(n.astype(np.int64)), pa.array(rep, mask=n == 0),
                     pa.array(wide, pa.binary()), *[pa.array(x, pa.list_(pa.int64())) for x in (keys, sizes, parts, sigs)]],
                    ["doc_id", "th", "n_shingles", "rep", "wide", "keys", "sizes", "parts", "sigs"])
        release_memory()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(
        run, f"doc_id {type_of(docs, 'doc_id')}, th long, n_shingles long, rep long, wide binary, keys array<long>, "
             "sizes array<long>, parts array<long>, sigs array<long>")


def shared_postings(sketched: DataFrame, buckets: int = 0) -> DataFrame:
    """The postings whose key may be shared: one narrow count of keys, kept as a filter of fixed size.

    With ``buckets`` they come packed into so many.
    """
    some = sketched.filter("keys IS NOT NULL").select("keys")
    return postings_under(sketched, repeated(some, buckets or 1), buckets)


def postings_under(sketched: DataFrame, keys: DataFrame, buckets: int = 0) -> DataFrame:
    """The postings under one of the keys, and few others."""
    some = sketched.filter("keys IS NOT NULL")
    filled = sketched.sparkSession.sparkContext.broadcast(Bits.of(keys).words)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bits(filled.value)
        for whole in batches:
            for a, b in slices(whole["keys"].value_lengths().to_pylist(), SLICE_KEYS):
                batch = whole.slice(a, b - a)
                lists = batch["keys"]
                row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                key, sizes = lists.flatten().to_numpy(), batch["sizes"].flatten().to_numpy()
                of = np.repeat(np.arange(len(sizes)), sizes)
                keep = held.holds(key)
                key, row, of = key[keep], pa.array(row[keep]), of[keep]
                sigs = batch["sigs"].flatten().to_numpy().reshape(-1, 2)[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch["rep"].take(row), batch["n_shingles"].take(row).cast(pa.int32()),
                     pa.array(batch["parts"].flatten().to_numpy()[of].astype(np.int32)),
                     *[pa.array(np.ascontiguousarray(sigs[:, i])) for i in range(2)]],
                    ["key", "rep", "n", "parts", "s0", "s1"])
        release_memory()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(({c: b[c].to_numpy() for c in KINDS} for b in rows(batches)), KINDS, buckets)

    lists = some.select("rep", "n_shingles", "keys", "sizes", "parts", "sigs")
    return lists.mapInArrow(run, packed_schema(KINDS)) if buckets else lists.mapInArrow(rows, POSTING)


def sets_of(docs: DataFrame, placed: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """rep, elements of the sets named in reps, from the texts (one for each set) that ``placed`` (rep, th) has them in."""
    filled = docs.sparkSession.sparkContext.broadcast((Bits.of(reps).words, texts_of(placed, reps)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = map(Bits, filled.value)
        for batch in batches:
            batch = batch.filter(pa.array(texts.holds(batch["th"].to_numpy()), pa.bool_()))
            for _, found, ends in shingled(batch["text"], k):
                starts = ends[:-1][np.diff(ends) > 0]
                rep, stop = set_keys(found, starts), np.append(starts, len(found))
                sets = {int(rep[i]): found[stop[i]:stop[i + 1]].tobytes() for i in np.flatnonzero(held.holds(rep)).tolist()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.binary())], ["rep", "elements"])
        release_memory()

    wide = docs.select("text", F.xxhash64("text").alias("th")).mapInArrow(run, "rep long, elements binary")
    return materialise(wide.groupBy("rep").agg(F.first("elements").alias("elements")), "sets")


def labelled(docs: DataFrame, k: int, share: int) -> DataFrame:
    """doc_id, th, n_shingles, root (the component's set number, null for an empty set) of every row."""
    src = docs.select("doc_id", "text")
    sketched = materialise(sketches(src, k, share), "sketches")
    wide = (sketched.filter("wide IS NOT NULL").groupBy("rep")
            .agg(F.first("n_shingles").alias("n"), F.first("wide").alias("wide")))

    placed = sketched.filter("rep IS NOT NULL").select("rep", "th")

    def linked(pairs: DataFrame) -> DataFrame:
        close = materialise(screen(pairs, wide, share), "close")
        reps = close.select(F.col("later").alias("rep")).union(close.select("earlier"))
        return materialise(verify(close, sets_of(src, placed, reps, k), share), "links")

    # about as many keys as shingles
    buckets = buckets_for(sketched.filter("keys IS NOT NULL").agg(F.sum("n_shingles")).first()[0] or 0)
    postings = shared_postings(sketched, buckets)
    # of all blocks' candidates the closest few decide first
    met = pairs_of(postings, KINDS, share).groupBy("later", "earlier").agg(F.min("far").alias("far"), F.max("more").alias("more"))
    tried = materialise(met.groupBy("later").agg(F.array_sort(F.collect_list(F.struct("far", "earlier"))).alias("found"),
                                                 F.max("more").alias("more"))
                        .select("later", F.explode(F.slice("found", 1, CLOSEST)).alias("pair"),
                                (F.col("more") | (F.size("found") > CLOSEST)).alias("more"))
                        .select("later", F.col("pair.earlier").alias("earlier"), "more"), "pairs")
    links = linked(tried.select("later", "earlier"))
    roots = components(links)
    open_sets = tried.filter("more").select("later")
    if not open_sets.isEmpty():
        # all their other candidates that are still in different components, among the postings under their keys
        keys = (among(sketched.filter("keys IS NOT NULL").select("rep", "keys"), "rep", open_sets)
                .select(F.explode("keys").alias("key")))
        grouped = (postings_under(sketched, keys).join(folded(wide), "rep").join(roots, "rep", "left")
                   .withColumn("grp", F.coalesce("root", "rep")).drop("root"))
        rest = materialise(untried(candidate_pairs(grouped, share, every=True, buckets=buckets), tried), "pairs")
        if not rest.isEmpty():
            links = links.unionByName(linked(rest))
            roots = components(links)
    return (sketched.select("doc_id", "th", "n_shingles", "rep").join(roots, "rep", "left")
            .select("doc_id", "th", "n_shingles", F.coalesce("root", "rep").alias("root")))


def join(docs: DataFrame, k: int = 4, share: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; links are sets with 100 * intersection >= share * union."""
    rows = labelled(docs, k, share)
    least = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return (rows.join(least, "root", "left")
            .select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id"))
                    .otherwise(F.col("least")).alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id stays, ties by text hash.

    Documents without a word all stay.  Rows that repeat the kept id and text are reduced to one, the least row.
    """
    rows = materialise(labelled(docs, k, share).filter("root IS NOT NULL")
                       .withColumn("me", F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "th")), "rows")
    first = rows.groupBy("root").agg(F.min("me").alias("first"))
    gone = (rows.join(first, "root").filter(F.col("me") != F.col("first"))
            .select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th")).distinct())
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("th"))
    kept = held.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")), "left_anti")
    twice = (rows.groupBy("doc_id", "th").agg(F.count("*").alias("n")).filter("n > 1")
             .select(F.col("doc_id").alias("t_id"), F.col("th").alias("t_th")))
    if not twice.isEmpty():
        same = F.col("doc.doc_id").eqNullSafe(F.col("t_id")) & (F.col("th") == F.col("t_th"))
        single = kept.join(twice, same, "left_anti").select("doc")
        kept = single.unionByName(kept.join(twice, same, "left_semi").groupBy("doc.doc_id", "th")
                                  .agg(F.min("doc").alias("doc")).select("doc"))
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
