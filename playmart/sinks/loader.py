"""Idempotent star-schema loader (insert-if-absent), usable from ``foreachBatch``.

Per batch:

1. persist the batch once, so the count, the survivor pick and the write do
   not recompute it (the source may be a stream micro-batch);
2. skip an empty batch (nothing written, no metrics row);
3. one row per key inside the batch, deterministic survivor (``dedup_batch``);
4. ``left_anti`` join with the keys already in the target - null-safe, so a
   replay of the same batch writes nothing.  For the fact table the target
   read is bounded to the batch's ``play_date`` range (partition pruning) and
   ``played_at`` range (Parquet row-group pruning), so the anti-join never
   rescans the whole history; and when the batch's keys are few (a checked
   bound) the target is narrowed by a semi-join against the broadcast batch
   keys first, so a large table is scanned past them, never shuffled.
   Batches of many days or many rows use the key table, if there is one
   (``Warehouse(key_buckets=n)``): one short text per play, bucketed by it, so
   the history is neither listed by day nor shuffled;
5. dense surrogate ids: for dimensions after the table's largest id, for the
   fact a block after the journal's high-water mark, dealt out by the rows
   of each partition of a written copy - no scan and no sort;
6. append (the fact partitioned by ``play_date`` after a ``rebalance`` on it:
   few files per day, a hot day split by AQE), then record ``rows_in /
   rows_new / max_id`` for the batch in a metrics table (overwrite of that
   batch's own folder: replay-safe; a re-run batch records what that run
   wrote, i.e. nothing new).

A load of the fact is several writes: plays, their keys, and the list of days
that it touched (``track_days``, read by ``streaming.panes``).  The journal
holds the batch's ids and days from before the first to after the last, and
the next load first completes what an open entry names (``recover``).

One writer per table is part of the contract: two loaders anti-joining the
same target concurrently could both insert a key.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.scalars import ts_literal
from ..operators.dedup import dedup_batch
from ..operators.ids import with_row_index
from ..schemas import FACT_HISTORY, TableContract
from ..session import drop_checkpoint
from .journal import Journal
from .versions import Files

# Per-batch load metrics: <root>/_load_metrics/table_name=<t>/batch_id=<id>/
# with columns rows_in, rows_new, max_id (all bigint).
METRICS = "_load_metrics"
# Days touched by each load of the fact: <root>/_touched/batch_id=<id>/ with column play_date.
TOUCHED = "_touched"
LOAD_KEY = "load_key"


def load_key() -> Column:
    """The business key of a play as one text that is never NULL (a NULL part has its own mark)."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in (
        F.unix_micros(F.col("played_at").cast("timestamp")).cast("string"), F.col("song_id").cast("string"))])


class Warehouse:
    """Star tables as Parquet folders under one root (in the shared folder).

    ``key_buckets``: keep a key table of so many buckets next to the fact
    (their number is fixed with the first load).  ``track_days``: keep a log of the days
    that each load touches.
    """

    def __init__(self, spark: SparkSession, root: str, key_buckets: int = 0, track_days: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key_buckets = key_buckets
        self.track_days = track_days

    @property
    def touched_path(self) -> str:
        return f"{self.root}/{TOUCHED}"

    def journal(self, table: str) -> Journal:
        return Journal(self.spark, f"{self.root}/_journal/{table}")

    def read_days(self, table: str, days: Sequence[str]) -> DataFrame | None:
        """The rows of the given ``play_date`` folders, without listing others; None if there is none."""
        path = self.path(table)
        try:
            return self.spark.read.option("basePath", path).parquet(
                f"{path}/play_date={{{','.join(sorted(days))}}}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def key_table(self) -> str:
        """Name of the fact's key table in the session's catalog, declared over its folder."""
        name = f"playmart_keys_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LOAD_KEY} STRING) USING parquet "
                       f"CLUSTERED BY ({LOAD_KEY}) INTO {int(self.key_buckets)} BUCKETS "
                       f"LOCATION '{self.root}/_keys/{FACT_HISTORY.name}'")
        return name

    def add_keys(self, rows: DataFrame) -> None:
        """Append the keys of loaded plays: one file per bucket."""
        name = self.key_table()
        (rows.select(load_key().alias(LOAD_KEY)).repartition(self.key_buckets, LOAD_KEY)
         .write.mode("append").insertInto(name))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def beside(self, table: str) -> str:
        """Where a rewritten table waits for the old one to make room (``compact``)."""
        return f"{self.root}/_rewritten_{table}"

    def finish_switch(self, table: str) -> bool:
        """Give a rewritten table its name, if the old one has made room."""
        fs = Files(self.spark, self.root)
        if fs.exists(self.path(table)) or not fs.exists(f"{self.beside(table)}/_SUCCESS"):
            return False
        fs.move(self.beside(table), self.path(table))
        return True

    def read(self, table: str) -> DataFrame | None:
        for again in (True, False):
            try:
                return self.spark.read.parquet(self.path(table))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                if not (again and self.finish_switch(table)):
                    return None
        return None

    def metrics(self) -> DataFrame | None:
        return self.read(METRICS)

    def id_high_water(self, table: str) -> int:
        """Largest surrogate id in the table (0 when empty or absent)."""
        t = self.read(table)
        if t is None or "id" not in t.columns:
            return 0
        return int(t.agg(F.max("id")).first()[0] or 0)

    def record(self, table: str, batch_id: str, rows_in: int, rows_new: int,
               max_id: int | None) -> None:
        row = self.spark.range(1).select(
            F.lit(rows_in).cast("long").alias("rows_in"),
            F.lit(rows_new).cast("long").alias("rows_new"),
            F.lit(max_id).cast("long").alias("max_id"))
        row.write.mode("overwrite").parquet(
            f"{self.root}/{METRICS}/table_name={table}/batch_id={batch_id}")


# A batch of at most this many rows probes the target with its broadcast keys
# (the row count bounds the key count); above it the anti-join is a shuffle join,
# whatever the target's files suggest: keys pack well, and unpacked they pass through the driver.
BROADCAST_BATCH_KEYS = 100_000


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_t_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how)


# Batches spanning more days than this read the whole fact folder instead of
# a glob of its day folders.
MAX_DAY_GLOB = 62


def _fact_span(batch: DataFrame) -> tuple[str, str, int] | None:
    """First and last time of a batch and its number of days; None when a time is NULL or all are."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    lo, hi, nulls = batch.agg(F.date_format(F.min("played_at"), fmt),
                              F.date_format(F.max("played_at"), fmt),
                              F.count_if(F.col("played_at").isNull())).first()
    if lo is None or nulls:
        return None
    return lo, hi, (_dt.date.fromisoformat(hi[:10]) - _dt.date.fromisoformat(lo[:10])).days + 1


def _fact_target_keys(wh: Warehouse, span: tuple[str, str, int] | None, keys: Sequence[str]) -> DataFrame | None:
    """Keys already loaded in the batch's time range (None: nothing loaded there).

    Only the batch's ``play_date`` folders are listed and read (a glob under
    ``basePath``), so a long history is never listed per micro-batch; inside
    them the ``played_at`` range is a literal bound that prunes row groups.
    A NULL ``played_at`` in the batch disables the bounds (NULL keys must be
    compared against all rows).
    """
    if span is None:
        target = wh.read(FACT_HISTORY.name)
        return None if target is None else target.select(*keys)
    lo, hi, days = span
    d0 = _dt.date.fromisoformat(lo[:10])
    if days > MAX_DAY_GLOB:
        target = wh.read(FACT_HISTORY.name)
    else:
        target = wh.read_days(FACT_HISTORY.name, [str(d0 + _dt.timedelta(days=i)) for i in range(days)])
    if target is None:
        return None
    ts_type = target.schema["played_at"].dataType
    return (target.filter(F.col("play_date").between(F.lit(lo[:10]).cast("date"), F.lit(hi[:10]).cast("date")))
            .filter(F.col("played_at").between(ts_literal(lo, ts_type), ts_literal(hi, ts_type)))
            .select(*keys))


def insert_candidates(batch: DataFrame, contract: TableContract, wh: Warehouse,
                      order: Sequence[str] = (), batch_rows: int | None = None) -> DataFrame:
    """The batch's rows to insert: one per key, absent from the target (lazy).

    ``batch_rows`` (the batch's row count, when known) bounds the size of the
    batch keys; within ``BROADCAST_BATCH_KEYS`` they are broadcast to narrow
    the target before the anti-join, above it both sides are shuffled.
    """
    is_fact = contract.name == FACT_HISTORY.name
    keys = list(contract.keys)
    new = dedup_batch(batch, keys, order)
    if batch_rows is None:
        batch_rows = batch.count()
    if is_fact:
        new = new.withColumn("play_date", F.to_date("played_at"))
        span = _fact_span(batch)
        if wh.key_buckets and (span is None or span[2] > MAX_DAY_GLOB or batch_rows > BROADCAST_BATCH_KEYS):
            # bucketed by the join key: the history is read as it lies, only the batch moves
            return (new.withColumn(LOAD_KEY, load_key())
                    .join(wh.spark.table(wh.key_table()), LOAD_KEY, "left_anti").drop(LOAD_KEY))
        existing = _fact_target_keys(wh, span, keys)
    else:
        target = wh.read(contract.name)
        existing = None if target is None else target.select(*keys)
    if existing is not None:
        if batch_rows <= BROADCAST_BATCH_KEYS:
            existing = _null_safe(existing, F.broadcast(batch.select(*keys).distinct()), keys, "left_semi")
        else:
            existing = existing.hint("merge")
        new = _null_safe(new, existing, keys, "left_anti")
    return new


def recover(wh: Warehouse) -> int:
    """Complete a fact load that was cut short; returns the last id given out.

    The open entry's days are read for rows with its ids.  If there are none, the
    block is free again; if there are, their keys are added where they lack
    and the days are announced.  (What is missing of the batch comes with its replay.)
    """
    journal = wh.journal(FACT_HISTORY.name)
    state = journal.state()
    cut = state["open"]
    if cut is None:
        return state["high_water"]
    rows = wh.read_days(FACT_HISTORY.name, cut["days"]) if cut["days"] else None
    mark = state["high_water"] if cut["days"] else cut["last"]     # no day to look at: leave a gap
    if rows is not None:
        landed = rows.filter(F.col("id").between(cut["first"], cut["last"]))
        if not landed.isEmpty():
            mark = cut["last"]
            if wh.key_buckets:
                known = wh.spark.table(wh.key_table())
                wh.add_keys(landed.join(known, load_key() == F.col(LOAD_KEY), "left_anti").checkpoint())
            announce(wh, cut["batch"], cut["days"])
    journal.put(mark)
    return mark


def announce(wh: Warehouse, batch_id: str, days: Sequence[str]) -> None:
    """Log the days that a load touched (at least: naming a day twice is harmless)."""
    if wh.track_days and days:
        (wh.spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("play_date"))
         .coalesce(1).write.mode("overwrite").parquet(f"{wh.touched_path}/batch_id={batch_id}"))


def _load_fact(batch: DataFrame, wh: Warehouse, batch_id: str, order: Sequence[str], rows_in: int,
               with_ids: bool) -> tuple[int, int | None]:
    base = recover(wh)
    # a reliable copy: ids are counted on it and written from it, whatever is lost in between
    new = insert_candidates(batch, FACT_HISTORY, wh, order, rows_in).checkpoint()
    try:
        rows_new, days = new.agg(F.count(F.lit(1)), F.collect_set(F.col("play_date").cast("string"))).first()
        if not rows_new:
            return 0, None
        journal = wh.journal(FACT_HISTORY.name)
        last = base + rows_new if with_ids else base
        journal.put(base, {"batch": batch_id, "first": base + 1, "last": last, "days": sorted(days)})
        out = with_row_index(new, start=base + 1, col="id", checkpoint=False) if with_ids else new
        # one shuffle by day: few files per day folder; AQE splits a hot day
        (out.hint("rebalance", "play_date").write.partitionBy("play_date").mode("append")
         .parquet(wh.path(FACT_HISTORY.name)))
        if wh.key_buckets:
            wh.add_keys(new)
        announce(wh, batch_id, sorted(days))
        journal.put(last)
        return rows_new, last if with_ids else None
    finally:
        drop_checkpoint(new)


def load_table(batch: DataFrame, contract: TableContract, wh: Warehouse, batch_id: str,
               order: Sequence[str] = (), with_ids: bool = True, rows_in: int | None = None) -> int:
    """Insert the batch's rows whose key is absent from the table; return rows written.

    ``rows_in``: the row count of a batch that the caller has already persisted.
    """
    own = rows_in is None
    if own:
        batch = batch.persist()
    try:
        if own:
            rows_in = batch.count()      # reads the source once; later steps use the copy
        if rows_in == 0:
            return 0
        if contract.name == FACT_HISTORY.name:
            rows_new, max_id = _load_fact(batch, wh, batch_id, order, rows_in, with_ids)
        else:
            rows_new, max_id = _load_dim(batch, contract, wh, order, rows_in, with_ids)
        wh.record(contract.name, batch_id, rows_in, rows_new, max_id)
        return rows_new
    finally:
        if own:
            batch.unpersist()


def _load_dim(batch: DataFrame, contract: TableContract, wh: Warehouse, order: Sequence[str], rows_in: int,
              with_ids: bool) -> tuple[int, int | None]:
    new = insert_candidates(batch, contract, wh, order, rows_in).persist()
    try:
        rows_new = new.count()
        max_id = None
        if rows_new:
            out = new
            if with_ids:
                base = wh.id_high_water(contract.name)
                out = with_row_index(new, list(contract.keys), start=base + 1, col="id")
                max_id = base + rows_new
            out.write.mode("append").parquet(wh.path(contract.name))
        return rows_new, max_id
    finally:
        new.unpersist()


def batch_loader(contract: TableContract, wh: Warehouse, query_name: str,
                 order: Sequence[str] = (), with_ids: bool = True):
    """A ``foreachBatch`` callback ``(batch_df, batch_id)`` for one table."""
    def load(batch_df: DataFrame, batch_id: int) -> None:
        load_table(batch_df, contract, wh, f"{query_name}-{batch_id}", order, with_ids)
    return load


def loaded_rows(wh: Warehouse) -> DataFrame:
    """``table_name, rows`` summed from the per-batch metrics."""
    m = wh.metrics()
    return m.groupBy("table_name").agg(F.sum("rows_new").cast("long").alias("rows"))
