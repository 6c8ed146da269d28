"""Table contracts as checks (plain files enforce no UNIQUE, NOT NULL or VARCHAR).

For each table, one scan: a grouped count on the unique key that also counts
the NOT NULL and length failures per key (partial aggregation, so a hot key
is counted map-side), then one tiny sum over the keys.  Result rows:
``table_name, check_name, violations``.

Uniqueness follows SQL UNIQUE: rows with a NULL key part never conflict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TableContract


def check_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """One scan: a per-key partial aggregate carries every check, then one tiny sum."""
    keys = list(contract.keys)
    checks = []
    for c in contract.not_null:
        checks.append((f"not_null:{c}", F.col(c).isNull()))
    for c, n in contract.max_len.items():
        if c in df.columns:
            checks.append((f"max_len:{c}", F.length(F.col(c).cast("string")) > F.lit(n)))
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(cond).alias(f"_c{i}") for i, (_, cond) in enumerate(checks)])
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()
    dup = F.sum(F.when(key_ok, F.col("_n") - 1).otherwise(F.lit(0)))
    totals = per_key.agg(*[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(checks))],
                         dup.alias("_dup"))
    names = [n for n, _ in checks] + ["unique:" + ",".join(keys)]
    cols = [f"_c{i}" for i in range(len(checks))] + ["_dup"]
    stack = ", ".join(f"'{n}', CAST(COALESCE({c}, 0) AS BIGINT)" for n, c in zip(names, cols))
    return totals.select(F.lit(contract.name).alias("table_name"),
                         F.expr(f"stack({len(names)}, {stack}) AS (check_name, violations)"))


def check_star(tables: dict[str, DataFrame], contracts: dict[str, TableContract]) -> DataFrame:
    out = None
    for name, df in tables.items():
        r = check_contract(df, contracts[name])
        out = r if out is None else out.unionByName(r)
    return out
