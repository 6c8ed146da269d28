"""Best-fit packing of documents into token sequences, certified by lower bounds.

Documents are cut into pieces of at most ``size`` tokens.  Whole pieces are a
sequence each.  The rest are dealt over partitions of bounded size and packed
by best-fit decreasing.  Dual feasible functions give a lower bound on the
bins that any packing of the same lengths needs: a partition at its bound is
certified and done.  While the bins of all partitions together exceed the bound
of the whole, the partitions with a gap exchange the documents of their
unfilled bins under a new hash, in fewer partitions, and rerun; the exchange is
kept when it saves bins.  When fewer than two partitions have a gap, or their exchange
saves nothing, unfilled bins of certified partitions join in.  It ends at
the bound, or when that saves nothing either: ``over_bound`` of every row says by
how many sequences the whole may then exceed the fewest possible.

Defined cases: a null text is empty, so it has the end token alone.  Repeated
rows are packed once each.  An empty table gives an empty result.  Extra
columns are ignored.  Ties in length are broken by piece number.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release_memory, type_of
from .pieces import PRE_TOKENS, PieceEncoder
from .trie_bpe import byte_letters

END = 2
SIZE = 1024
#: Pieces a partition packs at once, on average.
PER_PARTITION = 8192
ROUNDS = 6


class RankEncoder(PieceEncoder):
    """tiktoken over the ranks of the tokenizers file, called once per distinct piece.

    In a byte-level file whose ids follow the order of the merges, an id is its token's rank, so both
    libraries give the same ids (tests/llm compares them); tiktoken needs a third of the time.  A file
    whose ids are in another order is left to the tokenizers library.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_letters()
        self.library = None
        if not ids_follow_merges(spec["model"]):
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
        ranks = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.ids = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for t in self.ids:
            ranks.pop(t.encode(), None)
        self.core = tiktoken.Encoding("ranks", pat_str=PRE_TOKENS.replace(r"\p{White_Space}", r"\s")
                                      .replace(r"\P{White_Space}", r"\S"),
                                      mergeable_ranks=ranks, special_tokens={})
        super().__init__(list(self.ids))

    def encode_new(self, pieces: list[str]) -> Iterable[tuple[str, bytes]]:
        if self.library is not None:
            for p, x in zip(pieces, self.library.encode_batch(pieces, add_special_tokens=False), strict=True):
                yield p, array("I", x.ids).tobytes()
            return
        encode = self.core.encode_ordinary
        for p in pieces:
            yield p, array("I", [self.ids[p]] if p in self.ids else encode(p)).tobytes()


def ids_follow_merges(model: dict) -> bool:
    """Whether every token of several bytes is made by one merge, and later merges make larger ids."""
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    return None not in made and all(a < b for a, b in zip(made, made[1:], strict=False))


@lru_cache(maxsize=2)
def encoder(path: str) -> RankEncoder:
    return RankEncoder(path)


def pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32: every document's tokens and end in pieces.

    Only the first piece may be shorter than ``size``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, uid = encoder(path), TaskContext.get().partitionId() << 36
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(enc.encode(batch["text"].to_pylist())):
                ids += end
                n = len(ids) // 4
                a, b, k = 0, n % size or size, 0
                while a < n:
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a:4 * b]))
                    a, b, k = b, b + size, k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + len(row))), batch["doc_id"].take(pa.array(row, pa.int64())),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["uid", "doc_id", "piece", "start", "length", "ids_crc32"])
            uid += len(row)
        enc.forget()
        release_memory()

    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, f"uid long, doc_id {type_of(docs, 'doc_id')}, piece int, start long, length long, "
                             "ids_crc32 long"))


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Bins that any packing needs of counts[x] items of each length x, by dual feasible functions.

    For every k, lengths under k leave the sum and lengths over size - k count as a whole bin.
    For every j up to 32 the rounding function floor((j + 1) * x / size) / j, exact multiples as they are.
    """
    x = np.arange(size + 1)
    mass = counts * x
    best = -(-int(mass.sum()) // size)
    for k in range(1, size // 2 + 1):
        best = max(best, int(counts[size - k + 1:].sum()) - (-int(mass[k:size - k + 1].sum()) // size))
    for j in range(1, 33):
        y = (j + 1) * x
        value = np.where(y % size == 0, x * j, (y // size) * size)  # times j * size
        best = max(best, -(-int((counts * value).sum()) // (j * size)))
    return best


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every item, and the number of bins.  Bins are kept by free space."""
    order = np.argsort(-lengths, kind="stable")
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    # first free space >= i that has a bin: a bit set, searched through one large integer
    have, bins = 0, 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        rest = have >> n
        if rest:
            free = n + (rest & -rest).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                have ^= 1 << free
        else:
            free, b, bins = size, bins, bins + 1
        where[i], offset[i] = b, size - free
        if free > n:
            by_free[free - n].append(b)
            have |= 1 << (free - n)
    return where, offset, bins


PACKED = "uid long, length long, part long, bin long, offset long, fill long, bins long, bound long"


def _deal(items: DataFrame, size: int, parts: int, turn: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        lengths = pdf["length"].to_numpy(np.int64)
        where, offset, bins = best_fit_decreasing(lengths, size)
        fill = np.bincount(where, weights=lengths, minlength=bins).astype(np.int64)
        return pd.DataFrame({"uid": pdf["uid"].to_numpy(), "length": lengths, "part": pdf["part"].to_numpy(),
                             "bin": where, "offset": offset, "fill": fill[where], "bins": bins,
                             "bound": lower_bound(np.bincount(lengths, minlength=size + 1), size)})

    return (items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts)).alias("part"))
            .groupBy("part").applyInPandas(run, PACKED))


def _count(packed: DataFrame) -> int:
    return packed.filter("offset = 0").count()


def pack(items: DataFrame, size: int = SIZE, per_partition: int = PER_PARTITION) -> tuple[DataFrame, dict]:
    """uid, sequence_id, offset for items (uid, length <= size), and what certifies them.

    The report: bins, the bound of all lengths together, exchanges kept, partitions certified at first.
    """
    counts = np.zeros(size + 1, np.int64)
    for r in items.groupBy("length").count().collect():  # at most ``size`` rows
        counts[r["length"]] = r["count"]
    n, bound = int(counts.sum()), lower_bound(counts, size)
    parts = max(1, -(-n // per_partition))
    packed = materialise(_deal(items, size, parts, 0), "pack").withColumn("turn", F.lit(0).cast("long"))
    certified = packed.filter("bins = bound").select("part").distinct().count()
    settled, turn, all_in = [], 0, False
    report = {"bins": _count(packed), "bound": bound, "exchanges": 0, "partitions": parts, "certified": certified}
    while turn < ROUNDS and report["bins"] > bound:
        # filled bins can't be bettered, and a certified partition is done until the others are
        gap = F.lit(True) if all_in else F.col("bins") > F.col("bound")
        move = packed.filter((F.col("fill") < size) & gap)
        sources = move.select("turn", "part").distinct().count()
        if sources < 2:
            if all_in:
                break
            all_in = True
            continue
        turn += 1
        fewer = max(1, min(-(-move.count() // per_partition), sources // 2))    # at most 2 ** ROUNDS times the first size
        again = materialise(_deal(move, size, fewer, turn), "pack").withColumn("turn", F.lit(turn).cast("long"))
        saved = _count(move) - _count(again)
        if saved <= 0:
            if all_in:
                break
            all_in = True
            continue
        settled.append(packed.filter(F.col("fill") == size))
        packed = again.unionByName(packed.filter((F.col("fill") < size) & ~gap))
        report["bins"] -= saved
        report["exchanges"] += 1
    for stay in settled:
        packed = packed.unionByName(stay)
    return packed.selectExpr("uid", "(turn << 56) | (part << 24) | bin AS sequence_id", "offset"), report


def pack_documents(docs: DataFrame, path: str, size: int = SIZE,
                   per_partition: int = PER_PARTITION) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, over_bound."""
    cut = materialise(pieces(docs, path, size), "pieces")
    whole = (cut.filter(F.col("length") == size)
             .withColumn("sequence_id", F.col("uid").bitwiseOR(F.lit(1 << 62))).withColumn("offset", F.lit(0).cast("long")))
    part = cut.filter(F.col("length") < size)
    placed, report = pack(part.select("uid", "length"), size, per_partition)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
               F.lit(report["bins"] - report["bound"]).cast("long").alias("over_bound")]
    return whole.select(columns).unionByName(part.join(placed, "uid").select(columns))
