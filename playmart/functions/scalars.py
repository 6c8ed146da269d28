"""Scalar column functions.  All built-ins: they stay inside whole-stage codegen.

Every function takes and returns ``Column``s (names are accepted too), so
they compose in ``select``/``withColumn`` and in streaming plans alike.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text form of play times on the wire, and the character set
# stripped from both ends of an artist list cell.
PLAYED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.000'Z'"
PLAYED_AT_FORMAT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ARTIST_STRIP_CHARS = "[]'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_utf8(value) -> Column:
    """bytes -> text (a Kafka ``value``); text passes through unchanged."""
    return _c(value).cast("string")


def encode_utf8(text) -> Column:
    """text -> bytes; a NULL key stays NULL."""
    return F.encode(_c(text), "UTF-8")


def parse_played_at(text) -> Column:
    """ISO text (with ``Z`` or an offset) -> TIMESTAMP; bad text -> NULL.

    ``try_to_timestamp`` because plain ``to_timestamp`` raises under ANSI mode.
    """
    return F.try_to_timestamp(_c(text))


def format_played_at(ts, micros: bool = False) -> Column:
    """TIMESTAMP -> ``yyyy-MM-ddTHH:mm:ss.000Z`` (seconds precision)."""
    return F.date_format(_c(ts), PLAYED_AT_FORMAT_MICROS if micros else PLAYED_AT_FORMAT)


def weekday_name(ts, padded: bool = False) -> Column:
    """Full weekday name; ``padded`` blank-pads to 9 like a fixed-width format."""
    name = F.date_format(_c(ts), "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def weekday_number(ts) -> Column:
    """Weekday number with Sunday = 0 (``dayofweek`` counts Sunday = 1)."""
    return F.dayofweek(_c(ts)) - F.lit(1)


def bool_label(b) -> Column:
    """Boolean -> ``True`` / ``False`` text."""
    return F.initcap(_c(b).cast("string"))


def to_int(x) -> Column:
    """Integer conversion that truncates; an unconvertible cell becomes NULL."""
    return _c(x).try_cast("double").try_cast("int")


def stable_key(prefix: str, name) -> Column:
    """Name -> stable surrogate business key ``prefix + 16 hex digits of md5``."""
    return F.concat(F.lit(prefix), F.substring(F.md5(_c(name).cast("string")), 1, 16))


def strip_chars(text, chars: str = ARTIST_STRIP_CHARS) -> Column:
    """Strip any of ``chars`` from both ends of the text."""
    return F.btrim(_c(text), F.lit(chars))


def url_from_id(base: str, id_col) -> Column:
    return F.concat(F.lit(base), _c(id_col))


def preview(text, n: int = 200, suffix: str = "...") -> Column:
    """First ``n`` characters plus a suffix that is always appended."""
    return F.concat(F.substring(_c(text), 1, n), F.lit(suffix))


def newline_to_break(text) -> Column:
    return F.replace(_c(text), F.lit("\n"), F.lit("<br>"))


def html_escape(text) -> Column:
    """Escape ``& < > " '`` (ampersand first so escapes are not re-escaped)."""
    out = _c(text)
    for raw, esc in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"),
                     ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def ts_literal(value, like_type: T.DataType | None = None) -> Column:
    """A timestamp literal of the same kind as the column it is compared with.

    Built from text, so it is independent of the Python process time zone and
    folds to a constant that Parquet predicate pushdown can use.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    target = "timestamp_ntz" if isinstance(like_type, T.TimestampNTZType) else "timestamp"
    return F.lit(str(value)).cast(target)
