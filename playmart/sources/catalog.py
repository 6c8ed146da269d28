"""Track catalogue from a delimited file with a header (the producer's input).

The header is read as text and each known column is converted with a
``try_cast`` to its contract type (numbers are truncated to integers: ``3.0``
is 3), so one bad cell becomes NULL instead of aborting the load; absent optional columns get their defaults and absent
required columns are NULL (and the rows are then dropped as incomplete).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import to_int
from ..operators.fanout import with_defaults
from ..schemas import CATALOG, CATALOG_REQUIRED


def read_catalog_csv(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = True,
                     reject_col: str | None = None) -> DataFrame:
    """Catalogue rows typed to the contract (no inference pass over the data).

    A quoted cell may hold line breaks; then a file is read by one task, so pass
    ``multi_line=False`` for large files that are known to have none.
    ``reject_col`` adds the raw text of a row whose number of cells differs from
    the header's (NULL otherwise).
    """
    # RFC 4180 quoting: a quote inside a quoted cell is doubled ("")
    reader = (spark.read.option("header", True).option("sep", sep)
              .option("quote", '"').option("escape", '"')
              .option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    if reject_col is None:
        return conform_catalog(reader.csv(path))
    cells = [T.StructField(c, T.StringType()) for c in reader.csv(path).columns]
    raw = (reader.option("columnNameOfCorruptRecord", reject_col)
           .schema(T.StructType([*cells, T.StructField(reject_col, T.StringType())])).csv(path))
    return conform_catalog(raw, (reject_col,))


def conform_catalog(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    present = set(raw.columns)
    cols = [F.col(c) for c in keep]
    for f in CATALOG.fields:
        if f.name in present:
            cell = F.col(f.name)
            typed = to_int(cell) if f.dataType == T.IntegerType() else cell.try_cast(f.dataType)
            cols.append(typed.alias(f.name))
    out = raw.select(*cols)
    for name in CATALOG_REQUIRED:
        if name not in present:
            out = out.withColumn(name, F.lit(None).cast("string"))
    out = with_defaults(out)
    return out.select(*[f.name for f in CATALOG.fields], *keep)


def drop_incomplete(df: DataFrame, required=CATALOG_REQUIRED) -> DataFrame:
    """Drop rows NULL in any required column."""
    return df.na.drop("any", subset=list(required))
