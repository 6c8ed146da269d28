"""The streaming job, wired from a config dict.

```python
cfg = {
    "source": {"kind": "kafka", "servers": "broker:9092", "starting_offsets": "earliest"},
    # or {"kind": "landing", "root": "/shared/landing", "max_files_per_trigger": 100}
    "warehouse": "/shared/star",
    "checkpoints": "/shared/checkpoints",
    "dedup": {"dims": "table", "fact": "table"},      # or "state" / "watermark"
    "watermark": "1 hour",
    "trigger": {"processing_time": None, "available_now": False},
    "state_partitions": 64,          # frozen into each stateful query's checkpoint
    "rejects": True,                 # dead letters of every mode (default); a folder per mode and topic
    "strict": False,                 # also reject a field of the wrong type (else it is NULL)
    "report_refresh": {"out": "/shared/reports", "every": "60 seconds"},   # paced by the clock
    # windowed KPIs and daily partials that follow the fact (late plays too); reports then come from them
    "panes": {"out": "/shared/kpis", "intervals": ["1 day", "6 hours"]},
    "key_buckets": 0,                # > 0: keep a key table next to the fact for large backfills
    "max_failures": 8,               # of one query in a row
    "topics": ["song_topic", "album_topic", "artist_topic", "item_topic"],   # default: all
}
Supervisor(spark, starters(spark, cfg)).run()
```

Connection settings come from the config (or the environment through it),
never literals.  Each topic runs as its own query with its own checkpoint
folder, so one failing consumer does not stop the others; the supervisor
starts it again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sinks.loader import Warehouse
from ..sources.tables import read_parquet_star
from ..sources.topics import kafka_topic_stream, landing_topic_stream
from ..schemas import TOPICS
from . import consumers as SC
from . import partials
from .panes import PaneTable, pane_width, start_pane_refresh
from .partials import DistinctTable
from .refresh import clock_stream, one_tick, star_reports, start_report_refresh
from .supervise import Supervisor


def source_factory(spark: SparkSession, src: dict):
    kind = src.get("kind", "landing")
    if kind == "kafka":
        return lambda topic: kafka_topic_stream(spark, src["servers"], topic,
                                                src.get("starting_offsets", "latest"),
                                                src.get("options"))
    if kind == "landing":
        return lambda topic: landing_topic_stream(spark, src["root"], topic,
                                                  src.get("max_files_per_trigger"))
    raise ValueError(f"unknown source kind: {kind}")


def starters(spark: SparkSession, cfg: dict) -> dict[str, Callable[[], StreamingQuery]]:
    """query name -> function that starts it from its checkpoint, for every query of the job."""
    source = source_factory(spark, cfg["source"])
    panes = cfg.get("panes")
    wh = Warehouse(spark, cfg["warehouse"], cfg.get("key_buckets", 0), track_days=bool(panes))
    ck = cfg["checkpoints"].rstrip("/")
    trig = {"available_now": cfg.get("trigger", {}).get("available_now", False),
            "processing_time": cfg.get("trigger", {}).get("processing_time")}
    dedup, delay = cfg.get("dedup", {}), cfg.get("watermark", "1 hour")
    strict, rejects = cfg.get("strict", False), cfg.get("rejects", True)
    out: dict[str, Callable[[], StreamingQuery]] = {}
    for topic in cfg.get("topics", list(TOPICS)):
        mode = dedup.get("fact" if topic == "item_topic" else "dims", "table")
        name = f"load_{topic}"
        out[name] = partial(
            _topic_load, source, topic, wh, f"{ck}/{name}", name, dedup=mode, delay=delay, strict=strict,
            write_rejects=rejects, shuffle_partitions=cfg.get("state_partitions"), **trig)
        if mode != "table" and rejects:
            # a folder of its own: the file sink's log would hide what table mode wrote
            out[f"rejects_{topic}"] = partial(
                _rejects, source, topic, f"{wh.root}/{SC.STREAM_REJECTS}/topic={topic}",
                f"{ck}/rejects_{topic}", f"rejects_{topic}", strict=strict, **trig)
    rr = cfg.get("report_refresh")
    reports = star_reports(lambda: read_parquet_star(spark, wh.root))
    if panes:
        table = PaneTable(wh, f"{panes['out']}/panes", pane_width(*panes.get("intervals", ["1 day"])))
        sets = DistinctTable(table, f"{panes['out']}/sets")
        out["pane_refresh"] = partial(start_pane_refresh, [table, sets], f"{ck}/pane_refresh", **trig)
        reports = lambda as_of: partials.report_tables(table, sets, as_of)
    if rr:
        out["report_refresh"] = lambda: start_report_refresh(
            one_tick(spark) if trig["available_now"] else clock_stream(spark), reports, rr["out"], f"{ck}/report_clock",
            processing_time=rr.get("every", "60 seconds"), available_now=trig["available_now"])
    return out


def _topic_load(source, topic: str, *args, **kw) -> StreamingQuery:
    return SC.start_topic_load(source(topic), topic, *args, **kw)


def _rejects(source, topic: str, *args, **kw) -> StreamingQuery:
    return SC.start_reject_sink(source(topic), topic, *args, **kw)


def start(spark: SparkSession, cfg: dict) -> list[StreamingQuery]:
    """Start every query of the job; nothing restarts them (see ``main``)."""
    return [begin() for begin in starters(spark, cfg).values()]


def main(argv: list[str] | None = None) -> None:
    """``python -m playmart.streaming.jobs config.json``: start and block.

    The session comes from ``spark-submit``/the environment (cluster settings
    from ``session.cluster_conf`` can be passed as ``--conf``).  A query that fails is
    started again from its checkpoint while the others go on (``supervise``); only one
    that fails ``"max_failures"`` times in a row (default 8) ends the process, for the scheduler to see.
    """
    import json
    import sys

    from ..session import apply_job_conf, ensure_checkpoint_dir

    args = sys.argv[1:] if argv is None else argv
    with open(args[0]) as f:
        cfg = json.load(f)
    spark = SparkSession.builder.appName(cfg.get("app_name", "playmart-stream")).getOrCreate()
    apply_job_conf(spark)
    ensure_checkpoint_dir(spark)
    Supervisor(spark, starters(spark, cfg), max_failures=cfg.get("max_failures", 8)).run()


if __name__ == "__main__":
    main()
