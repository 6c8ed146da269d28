"""Star-schema table access (reports read these).

A ``Star`` is four DataFrames: three dimensions and the fact.  They can come
from Parquet folders (``read_parquet_star``), catalog tables, or JDBC
(``read_jdbc_table``).  Nothing here collects data; the frames are lazy and
Catalyst prunes columns and pushes the report filters into each scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Star:
    fact: DataFrame        # played_at, song_id, album_id, artist_id, duration_ms
    song: DataFrame        # song_id, song_name, ...
    artist: DataFrame      # artist_id, artist_name, ...
    album: DataFrame       # album_id, album_name, ...


def read_parquet_star(spark: SparkSession, root: str) -> Star:
    """Read the four star tables written by ``sinks.loader`` under ``root``."""
    r = root.rstrip("/")
    return Star(fact=spark.read.parquet(f"{r}/fact_history"),
                song=spark.read.parquet(f"{r}/dim_song"),
                artist=spark.read.parquet(f"{r}/dim_artist"),
                album=spark.read.parquet(f"{r}/dim_album"))


def read_catalog_star(spark: SparkSession, database: str | None = None) -> Star:
    """Read the star from catalog tables (e.g. bucketed/partitioned tables)."""
    q = (lambda t: f"{database}.{t}") if database else (lambda t: t)
    return Star(fact=spark.table(q("fact_history")), song=spark.table(q("dim_song")),
                artist=spark.table(q("dim_artist")), album=spark.table(q("dim_album")))


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    partition_column: str | None = None, lower_bound=None,
                    upper_bound=None, num_partitions: int | None = None,
                    predicates: list[str] | None = None) -> DataFrame:
    """Parallel JDBC read: by a numeric/date column range or by predicates.

    Connection settings come from the caller (options or environment), never
    literals.  Without a partitioning scheme a JDBC read is a single task, so
    large tables must pass one.
    """
    reader = spark.read
    if predicates:
        return reader.jdbc(url, table, predicates=predicates, properties=properties)
    if partition_column:
        return reader.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties)
    return reader.jdbc(url, table, properties=properties)
