"""JDBC append of a (micro-)batch.

Connection settings come from the caller or the environment, never literals.
Parallelism: one connection per partition of the written frame, so the frame
is coalesced/repartitioned to ``num_partitions`` first; ``batchsize`` rows per
round trip.  Insert-if-absent is done before the write (``sinks.loader``
semantics: anti-join the target's keys), so the database needs no conflict
clause.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def jdbc_properties(user: str | None = None, password: str | None = None,
                    driver: str | None = None, env_prefix: str = "PLAYMART_JDBC_") -> dict:
    props = {
        "user": user or os.environ.get(env_prefix + "USER", ""),
        "password": password or os.environ.get(env_prefix + "PASSWORD", ""),
    }
    drv = driver or os.environ.get(env_prefix + "DRIVER")
    if drv:
        props["driver"] = drv
    return props


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict,
                num_partitions: int = 8, batch_size: int = 10000) -> None:
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url, table, mode="append", properties=props)
