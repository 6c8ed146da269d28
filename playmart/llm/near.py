"""Shared parts of the similarity joins: candidate pairs from postings, set filters, components.

A posting is one row (key, rep, n, s0.., parts, o1, o2): a set ``rep`` of n elements is
filed under ``key``; s0.. are the words of a parity sketch of it, or of one of so many ``parts``
of it; o1, o2, if there, its place in the corpus order.  Two sets whose sketches differ in more bits than
their symmetric difference may hold can't be similar, so that pair is dropped
at once.  Tasks pack their postings into buckets of keys, a row for each bucket and portion; Spark deals the buckets out
and each is sorted in its task, so the JVM moves few rows.  Postings of a second round may carry ``grp``, the component (its own sets don't meet), ``want`` (only wanted sets look for earlier ones)
and w0.., a longer sketch of the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, release_memory, slices

SIGNATURE = ("s0", "s1", "s2", "s3")
#: Words of the longer sketch; a wide sketch has as many bits at least.
FOLDED = tuple(f"w{i}" for i in range(8))
#: Pairs that are compared at once.
PAIRS = 1 << 16
#: Rows that a bucket of keys holds on average, and that a task packs at a time.
BUCKET = 1 << 16
PACKED = 1 << 18


def parity(hashes: np.ndarray, starts: np.ndarray, words: int = 4) -> np.ndarray:
    """A parity sketch of each group of hashes (rows of ``words`` 64-bit words): every element flips one bit.

    ``starts`` are the places where the groups begin; no group is empty.
    """
    out = np.zeros((len(starts), words), np.uint64)
    if len(starts):
        mixed = mix64(hashes ^ np.uint64(0x9E3779B97F4A7C15))
        bit = np.uint64(1) << (mixed & np.uint64(63))
        word = (mixed >> np.uint64(6)) % np.uint64(words)
        for w in range(words):
            out[:, w] = np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), starts)
    return out


def set_keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, whatever the order of its elements; no set is empty."""
    if not len(starts):
        return np.zeros(0, np.int64)
    total = np.add.reduceat(mix64(h), starts) ^ np.bitwise_xor.reduceat(mix64(h + np.uint64(1)), starts)
    return mix64(total).view(np.int64)


def wide_sketch(found: np.ndarray) -> bytes:
    """A parity sketch with at least as many bits as the set has elements; their number is a power of two."""
    size = max(64 * len(FOLDED), 1 << (len(found) - 1).bit_length())
    bit = (mix64(found ^ np.uint64(0xA24BAED4963EE407)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=size) & 1).astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two wide sketches differ; the longer one is folded to the length of the other."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def folded(wide: DataFrame) -> DataFrame:
    """rep, w0..: the wide sketches (rep, wide), all folded to the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, len(FOLDED)), np.uint64)
            for i, sketch in enumerate(batch["wide"].to_pylist()):
                out[i] = np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, len(FOLDED)), axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], *[pa.array(np.ascontiguousarray(w).view(np.int64)) for w in out.T]], ["rep", *FOLDED])

    return wide.select("rep", "wide").mapInArrow(run, ", ".join(["rep long", *[f"{w} long" for w in FOLDED]]))


def most_difference(a, b, share: int):
    """The largest symmetric difference of sets of sizes a and b with 100 * Jaccard >= share."""
    return (100 - share) * (a + b) // (100 + share)


def kinds_of(schema: str) -> dict[str, type]:
    """The columns of postings and their types in numpy, from a schema string."""
    return {c: np.int32 if kind == "int" else np.int64 for c, kind in map(str.split, schema.split(","))}


def packed_schema(kinds: dict[str, type]) -> str:
    return ", ".join(["bucket int", *[f"{c} binary" for c in kinds]])


def buckets_for(rows: int) -> int:
    return max(1, rows // BUCKET)


def packed(parts: Iterator[dict[str, np.ndarray]], kinds: dict[str, type], buckets: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket of keys that a portion of postings has: the bucket, and of each column the values' bytes."""

    def pack(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        bucket = ((cols["key"].view(np.uint64) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        some, first = np.unique(bucket[order], return_index=True)
        ends = np.append(first, len(order))
        return pa.RecordBatch.from_arrays(
            [pa.array(some), *[pa.Array.from_buffers(pa.binary(), len(some), [
                None, pa.py_buffer((ends * cols[c].itemsize).astype(np.int32)), pa.py_buffer(cols[c][order])]) for c in kinds]],
            ["bucket", *kinds])

    kept, held, size = {"key": np.int64} | kinds, [], 0
    for part in parts:
        for a in range(0, len(part["key"]), PACKED):
            held.append({c: part[c][a:a + PACKED].astype(kind, copy=False) for c, kind in kept.items()})
            size += len(held[-1]["key"])
            if size >= PACKED:
                yield pack({c: np.concatenate([h[c] for h in held]) for c in kept})
                held, size = [], 0
    if size:
        yield pack({c: np.concatenate([h[c] for h in held]) for c in kept})


def raw_buckets(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of one bucket after another; rows are sorted by bucket."""

    def whole(held: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        return {c: np.frombuffer(b"".join(x for h in held for x in h[c].to_pylist()), kind) for c, kind in kinds.items()}

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch["bucket"].to_numpy()
        edge = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(bucket)], strict=True):
            if held and held[-1]["bucket"][0].as_py() != bucket[a]:
                yield whole(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield whole(held)


def whole_buckets(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[dict[str, np.ndarray]]:
    """The postings of one bucket after another, of those under keys that occur more than once."""
    for cols in raw_buckets(batches, kinds):
        order = np.argsort(cols["key"])
        key = cols["key"][order]
        same = key[1:] == key[:-1]
        order = order[np.append(same, False) | np.append(False, same)]
        yield {c: v[order] for c, v in cols.items()}


def dealt(packed_rows: DataFrame) -> DataFrame:
    return packed_rows.repartition("bucket").sortWithinPartitions("bucket")


def sorted_by(of: np.ndarray, first: np.ndarray, rest: list[np.ndarray]) -> np.ndarray:
    """The order by ascending small numbers ``of``, then ``first``, then the last of ``rest`` and so on, as by lexsort.

    Where the first two fit into one number that is sorted, and only ties are looked at again.
    """
    if not len(of):
        return np.zeros(0, np.int64)
    least = int(first.min())
    bits = (int(first.max()) - least).bit_length()
    if bits + int(of[-1]).bit_length() > 63:
        return np.lexsort([*rest, first, of])
    one = of.astype(np.int64) << bits | (first - least)
    order = np.argsort(one)
    one = one[order]
    same = one[1:] == one[:-1]
    ties = np.flatnonzero(np.append(same, False) | np.append(False, same))
    if len(ties) and rest:
        of_ties = order[ties]
        order[ties] = of_ties[np.lexsort([*[r[of_ties] for r in rest], one[ties]])]
    return order


class Run:
    """Sorted postings of whole keys, without repeated sets."""

    def __init__(self, cols: dict[str, np.ndarray]):
        by = np.argsort(cols["key"])
        cols = {k: v[by] for k, v in cols.items()}
        key, rep = cols["key"], cols["rep"]
        of = np.cumsum(np.append(False, key[1:] != key[:-1])[:len(key)])
        rest = [cols[k] for k in ("rep", "o2", "o1") if k in cols]
        order = sorted_by(of, rest[-1], rest[:-1])
        # the same sets under a key have equal numbers here, and few others have
        mixed = (mix64(rep.view(np.uint64)) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[order]
        by = np.argsort(mixed)
        same = mixed[by[1:]] == mixed[by[:-1]]
        some = np.sort(by[np.append(same, False) | np.append(False, same)]) if len(by) else by
        at = order[some]
        by = np.lexsort((rep[at], of[at]))     # stable: of a set that a key has several times the first comes first
        again = some[by[1:][(of[at[by[1:]]] == of[at[by[:-1]]]) & (rep[at[by[1:]]] == rep[at[by[:-1]]])]]
        order = np.delete(order, again)
        self.c = {k: v[order] for k, v in cols.items()}
        key = self.c["key"]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        self.start = np.flatnonzero(new)
        self.length = np.diff(np.append(self.start, len(key)))
        self.sig = [self.c[s].view(np.uint64) for s in SIGNATURE if s in self.c]
        self.fold = [self.c[s].view(np.uint64) for s in FOLDED if s in self.c]

    def near(self, i: np.ndarray, j: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of pairs of sets of similar sizes those that may be similar, and the distance of their sketches (times parts)."""
        n = self.c["n"].astype(np.int64)
        if "place" in self.c:  # tokens left from the shared one on, against the overlap that is needed
            left = n - self.c["place"]
            ok = (100 + share) * np.minimum(left[i], left[j]) >= share * (n[i] + n[j])
            i, j = i[ok], j[ok]
        if "grp" in self.c:
            ok = self.c["grp"][i] != self.c["grp"][j]
            i, j = i[ok], j[ok]
        far = np.zeros(len(i), np.int64)
        for s in self.sig:
            far += np.bitwise_count(s[i] ^ s[j])
        most = most_difference(n[i], n[j], share)
        if "parts" in self.c:  # the part that differs least has this share of the difference at most
            parts = self.c["parts"].astype(np.int64)[i]
            ok = far <= most // parts
            far = far * parts
        else:
            ok = far <= most
        i, j, far, most = i[ok], j[ok], far[ok], most[ok]
        if self.fold:
            ok = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in self.fold) <= most
            i, j, far = i[ok], j[ok], far[ok]
        return i, j, far

    def blocks(self, share: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index arrays (i, j) of all pairs of a key, j before i, in bounded portions; with ``want``, i is wanted.

        Only pairs of similar sizes: in the order of sizes, the others of a key are a range for each set.
        """
        n = self.c["n"].astype(np.int64)
        of = np.repeat(np.arange(len(self.start)), self.length)
        by, wide = np.lexsort((n, of)), int(n.max(initial=0)) + 1
        size = n[by]
        at = of * wide + size
        low = np.searchsorted(at, of * wide + -(-share * size // 100))
        if "want" in self.c:
            its = np.flatnonzero(self.c["want"][by] > 0)
            most = np.minimum(100 * size[its] // share, wide - 1) if share else wide - 1
            low, high = low[its], np.searchsorted(at, of[its] * wide + most, "right")
        else:
            its = high = np.arange(len(by))
        count = high - low
        ends = np.cumsum(count)
        for a in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            b = min(a + PAIRS, int(ends[-1]))
            some = np.arange(np.searchsorted(ends, a, "right"), np.searchsorted(ends, b, "left") + 1)
            begin = ends[some] - count[some]
            k = np.repeat(some, np.minimum(ends[some], b) - np.maximum(begin, a))
            i, j = by[its[k]], by[np.arange(a, b) - (ends[k] - count[k]) + low[k]]
            if "want" in self.c:
                yield i[j < i], j[j < i]
            else:
                yield np.maximum(i, j), np.minimum(i, j)

    def closest(self, share: int, most: int = 1) -> pa.RecordBatch:
        """For each set with an earlier candidate under the same key: the closest one, and whether there are more.

        Where that one's sketch differs in over half of what is allowed, up to ``most`` of the closest ones.
        """
        size = len(self.c["key"])
        best, other, count = np.full((size, most), 1 << 30), np.zeros((size, most), np.int64), np.zeros(size, np.int64)
        for i, j in self.blocks(share):
            i, j, far = self.near(i, j, share)
            if not len(i):
                continue
            order = np.lexsort((j, far, i))
            i, j, far = i[order], j[order], far[order]
            first = np.flatnonzero(np.diff(i, prepend=-1))
            found = np.diff(np.append(first, len(i)))
            rank = np.arange(len(i)) - np.repeat(first, found)
            of, at = np.repeat(np.arange(len(first)), found)[rank < most], rank[rank < most]
            i = i[first]
            count[i] += found
            new, its = np.full((len(i), most), 1 << 30), np.zeros((len(i), most), np.int64)
            new[of, at], its[of, at] = far[rank < most], j[rank < most]
            new, its = np.hstack([best[i], new]), np.hstack([other[i], its])
            least = np.argsort(new, axis=1, kind="stable")[:, :most]
            best[i], other[i] = np.take_along_axis(new, least, 1), np.take_along_axis(its, least, 1)
        has, n = np.flatnonzero(count), self.c["n"].astype(np.int64)
        unsure = 2 * best[has, 0] > most_difference(n[has], n[other[has, 0]], share)
        told = np.where(unsure, np.minimum(count[has], most), 1)
        row = np.repeat(np.arange(len(has)), told)
        at = np.arange(len(row)) - np.repeat(np.cumsum(told) - told, told)
        return self._batch(has[row], other[has[row], at], (count[has] > told)[row], best[has[row], at])

    def every(self, share: int) -> Iterator[pa.RecordBatch]:
        """All candidate pairs; with a column ``want``, those whose later set is wanted."""
        for i, j in self.blocks(share):
            i, j, far = self.near(i, j, share)
            if len(i):
                yield self._batch(i, j, np.zeros(len(i), bool), far)

    def _batch(self, i: np.ndarray, j: np.ndarray, more: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.c["rep"][i]), pa.array(self.c["rep"][j]), pa.array(more),
                                           pa.array(far.astype(np.int32))], ["later", "earlier", "more", "far"])


def candidate_pairs(postings: DataFrame, share: int, every: bool = False, most: int = 1, buckets: int = 64) -> DataFrame:
    """later, earlier, more, far: pairs of sets under a common key that their sketches don't rule out.

    Of each later set the closest ones under a key, up to ``most`` (see ``Run.closest``), or every one.  ``more``: it has
    other candidates under that key; ``far``: bits in which the sketches differ.
    """
    kinds = {c: np.int32 if kind == "int" else np.int64 for c, kind in postings.dtypes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(({c: b[c].to_numpy(zero_copy_only=False) for c in kinds} for b in batches), kinds, buckets)
        release_memory()

    return pairs_of(postings.mapInArrow(run, packed_schema(kinds)), kinds, share, every, most)


def pairs_of(packed_rows: DataFrame, kinds: dict[str, type], share: int, every: bool = False, most: int = 1) -> DataFrame:
    """The pairs of ``candidate_pairs`` from packed postings; a task holds the postings of one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in whole_buckets(batches, kinds):
            if len(cols["key"]):
                r = Run(cols)
                yield from r.every(share) if every else [r.closest(share, most)]
        release_memory()

    return dealt(packed_rows).mapInArrow(run, "later long, earlier long, more boolean, far int")


def repeated(keys: DataFrame, buckets: int) -> DataFrame:
    """key: those that the lists in the one column hold more than once in all, and few others.

    Only the bits of a key that a set filter looks at are shuffled, in five bytes, and come back.
    """
    name, kinds = keys.columns[0], {"low": np.uint32, "high": np.uint8}

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            for a, b in slices(batch[name].value_lengths().to_pylist(), PACKED):
                key = batch[name].slice(a, b - a).flatten().to_numpy()
                yield {"key": key, "low": key.astype(np.uint32), "high": (key >> 32).astype(np.uint8)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(parts(batches), kinds, buckets)
        release_memory()

    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in raw_buckets(batches, kinds):
            key = np.sort(cols["high"].astype(np.int64) << 32 | cols["low"])
            same = np.append(key[1:] == key[:-1], False)
            yield pa.RecordBatch.from_arrays([pa.array(key[same & ~np.append(False, same[:-1])])], ["key"])
        release_memory()

    return dealt(keys.mapInArrow(run, packed_schema(kinds))).mapInArrow(twice, "key long")


def untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The distinct pairs (later, earlier) that are not among those tried.

    One aggregation: an anti join would be moved below the distinct and take every repeat of a pair.
    """
    both = (pairs.select("later", "earlier", F.lit(False).alias("tried"))
            .unionAll(tried.select("later", "earlier", F.lit(True).alias("tried"))))
    return both.groupBy("later", "earlier").agg(F.max("tried").alias("tried")).filter("NOT tried").select("later", "earlier")


class Bits:
    """A set filter of bounded size over 64-bit keys: it may hold more than was put in, never less.

    A key sets three bits of one word (a blocked Bloom filter).  It is built by an aggregation over at most
    2 ** (BITS - 6) words, so what reaches the driver is bounded; halves are laid over each other while few words are used.
    """

    BITS = 27

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, keys: DataFrame) -> Bits:
        c = keys.columns[0]
        three = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned({c}, {at}) & 63 AS INT))" for at in (0, cls.BITS, cls.BITS + 6))
        found = (keys.select(F.shiftright(F.pmod(F.col(c), F.lit(1 << cls.BITS)), 6).alias("w"), F.expr(three).alias("b"))
                 .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
        words = np.zeros(1 << (cls.BITS - 6), np.int64)
        words[found["w"].to_numpy()] = found["b"].to_numpy()
        while len(words) > max(1 << 10, 4 * len(found)):
            words = words[:len(words) // 2] | words[len(words) // 2:]
        return cls(words.view(np.uint64))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        word = self.words[((keys & np.uint64(64 * len(self.words) - 1)) >> np.uint64(6)).astype(np.int64)]
        for at in (0, self.BITS, self.BITS + 6):
            word = word & ~(((word >> ((keys >> np.uint64(at)) & np.uint64(63))) & np.uint64(1)) - np.uint64(1))
        return word > 0


def among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose column is one of the keys, and few others: a set filter takes the place of a join."""
    filled = rows.sparkSession.sparkContext.broadcast(Bits.of(keys).words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bits(filled.value)
        for batch in batches:
            yield batch.filter(pa.array(held.holds(batch[column].to_numpy(zero_copy_only=False)), pa.bool_()))
        release_memory()

    return rows.mapInArrow(run, rows.schema)


def texts_of(placed: DataFrame, reps: DataFrame) -> np.ndarray:
    """The words of a set filter over one text hash for each set named in reps.  placed: rep, th of every text's sets."""
    return Bits.of(among(placed.select("rep", "th"), "rep", reps).groupBy("rep").agg(F.min("th").alias("th")).select("th")).words


def verify(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (later, earlier) whose sets have 100 * Jaccard >= share.  sets: rep, elements (sorted uint64, binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                every = np.sort(np.frombuffer(a + b, np.uint64))    # an element of both comes twice
                both = int(np.count_nonzero(every[1:] == every[:-1]))
                keep.append(100 * both >= share * (len(every) - both))
            yield batch.select(["later", "earlier"]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    return (pairs.select("later", "earlier")
            .join(sets.select(F.col("rep").alias("later"), F.col("elements").alias("a")), "later")
            .join(sets.select(F.col("rep").alias("earlier"), F.col("elements").alias("b")), "earlier")
            .select("later", "earlier", "a", "b")
            .mapInArrow(run, "later long, earlier long"))


def screen(pairs: DataFrame, wide: DataFrame, share: int) -> DataFrame:
    """The pairs (later, earlier) that their wide sketches don't rule out.  wide: rep, n, wide.

    The sketches take about a bit per element, so few pairs beside the similar ones need their whole sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [batch[k].to_pylist() for k in ("an", "aw", "bn", "bw")]
            keep = [sketch_distance(x, y) <= most_difference(a, b, share) for a, x, b, y in zip(*c, strict=True)]
            yield batch.select(["later", "earlier"]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    def side(name: str, short: str) -> DataFrame:
        return wide.select(F.col("rep").alias(name), F.col("n").alias(f"{short}n"), F.col("wide").alias(f"{short}w"))

    return (pairs.select("later", "earlier").join(side("later", "a"), "later").join(side("earlier", "b"), "earlier")
            .select("later", "earlier", "an", "aw", "bn", "bw").mapInArrow(run, "later long, earlier long"))


def components(links: DataFrame) -> DataFrame:
    """rep, root: the smallest set number reachable over links (later, earlier), for the sets in them.

    Labels are spread to neighbours and then followed to their own label, until nothing changes.
    """
    edges = materialise(links.select(F.col("later").alias("u"), F.col("earlier").alias("v"))
                        .union(links.select("earlier", "later")).distinct(), "edges")
    labels = materialise(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("root")), "labels")
    while True:
        spread = (edges.join(labels.select(F.col("u").alias("v"), "root"), "v")
                  .groupBy("u").agg(F.min("root").alias("near")))
        step = (labels.join(spread, "u").select("u", F.col("root").alias("before"), F.least("root", "near").alias("root")))
        follow = labels.select(F.col("u").alias("root"), F.col("root").alias("further"))
        after = materialise(step.join(follow, "root", "left")
                            .select("u", "before", F.least("root", "further").alias("root")), "labels")
        if after.filter(F.col("before") != F.col("root")).isEmpty():
            return after.select(F.col("u").alias("rep"), "root")
        labels = after.select("u", "root")
