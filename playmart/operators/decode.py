"""Topic value -> typed record, with a reject split (quarantine).

``from_json`` is permissive: non-JSON text, an array, or a field of the wrong
type yields a row of NULLs rather than an error.  We ask it to fill a corrupt
column, and split rows into accepted and rejected with a reason:

* ``malformed``: the corrupt column is set (not JSON, an array, or - when
  ``strict`` - any field of the wrong type);
* ``null_key``: the record parsed but a key column is NULL (also a NULL or
  empty value, and a missing key field).

With ``strict=False`` a type mismatch in a non-key field keeps the row with
that field NULL (the permissive reading); only structurally bad text and NULL
keys are rejected.  A JSON number where a text field is expected is read as
its text (Spark's JSON reader), so only integer fields can mismatch here.
All of it is one projection, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import decode_utf8, parse_played_at

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def parse_values(df: DataFrame, schema: T.StructType, value_col: str = "value",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``value_col`` into the record's columns plus ``_corrupt``."""
    data = F.from_json(decode_utf8(value_col), _with_corrupt(schema),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select(*keep, data.alias("_d")).select(*keep, "_d.*")


def decode_records(df: DataFrame, schema: T.StructType, value_col: str = "value",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Reference behaviour: ``from_json`` then ``data.*`` (bad rows become NULLs)."""
    return parse_values(df, schema, value_col, keep).drop(CORRUPT)


def classify(parsed: DataFrame, schema: T.StructType, key_cols: Sequence[str],
             strict: bool = True) -> DataFrame:
    """Add ``_reject`` (NULL when accepted) to a frame from ``parse_values``."""
    fields = [f.name for f in schema.fields]
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f).isNull()
    bad_text = F.col(CORRUPT).isNotNull()
    if not strict:
        bad_text = bad_text & all_null
    key_null = F.lit(False)
    for k in key_cols:
        key_null = key_null | F.col(k).isNull()
    reason = (F.when(bad_text, F.lit("malformed"))
              .when(key_null, F.lit("null_key")))
    return parsed.withColumn("_reject", reason)


def quarantine(df: DataFrame, schema: T.StructType, key_cols: Sequence[str],
               value_col: str = "value", keep: Sequence[str] = (),
               strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Return ``(accepted, rejected)``.

    ``rejected`` keeps the raw text and a ``reason`` so it can be written to a
    dead-letter folder; ``accepted`` has the record's typed columns.  Callers
    that use both should persist ``df`` (or run them in one ``foreachBatch``)
    so the source is read once.
    """
    parsed = classify(parse_values(df, schema, value_col, list(keep) + [value_col]),
                      schema, key_cols, strict)
    fields = [f.name for f in schema.fields]
    accepted = parsed.filter(F.col("_reject").isNull()).select(*keep, *fields)
    rejected = parsed.filter(F.col("_reject").isNotNull()).select(
        *keep, F.col(value_col).cast("string").alias("raw_value"),
        F.col("_reject").alias("reason"))
    return accepted, rejected


def with_parsed_time(records: DataFrame, col: str = "played_at") -> DataFrame:
    """Replace the ISO text column by a TIMESTAMP (bad text -> NULL)."""
    return records.withColumn(col, parse_played_at(col))
