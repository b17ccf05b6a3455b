"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values ---
KEY_SEPARATOR = "||"  # joins normalised attributes before hashing
SCD_ID_SEPARATOR = "|"
EVENT_ID_SEPARATOR = "::"
SORT_KEY_DATE_FORMAT = "yyyyMMdd"
SORT_KEY_VERSION_WIDTH = 4


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised_text(c: ColumnOrName) -> Column:
    return F.lower(F.trim(col(c)))


def content_key(name: ColumnOrName, *attributes: ColumnOrName) -> Column:
    """SHA-256 hex of the normalised name and the attributes joined by ``||``."""
    parts = [normalised_text(name)] + [col(a).cast("string") for a in attributes]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def inferred_number(c: ColumnOrName, divisor: int = 10) -> Column:
    """Integer part of ``c / divisor`` (truncation, as a cast of the quotient)."""
    return (col(c) / F.lit(divisor)).cast("int")


def version_id(keys: Sequence[ColumnOrName], seq: ColumnOrName) -> Column:
    """Stable id of one history version: SHA-256 of keys and the number of the snapshot that opened it."""
    parts = [col(k).cast("string") for k in keys] + [col(seq).cast("string")]
    return F.sha2(F.concat_ws(SCD_ID_SEPARATOR, *parts), 256)


def event_sort_key(date: ColumnOrName, version: ColumnOrName, source_file: ColumnOrName) -> Column:
    """``yyyyMMdd-vvvv-file``.  The version has four digits, or all of its own when it has more; a
    longer one is preceded by ``~`` for each further digit, so keys still sort by version."""
    digits = col(version).cast("string")
    more = F.greatest(F.length(digits) - SORT_KEY_VERSION_WIDTH, F.lit(0))
    padded = F.concat(F.repeat(F.lit("~"), more), F.lpad(digits, F.greatest(F.length(digits), F.lit(SORT_KEY_VERSION_WIDTH)), "0"))
    return F.concat(F.date_format(col(date), SORT_KEY_DATE_FORMAT), F.lit("-"), padded, F.lit("-"), col(source_file))


def row_changed(a: Column, b: Column) -> Column:
    """Null-safe inequality of two values (structs compare field by field)."""
    return ~a.eqNullSafe(b)


def tracked_struct(columns: Sequence[str], prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in columns])


def false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def ntz(text: str) -> Column:
    """A timestamp-without-zone literal (driver tables carry timestamp_ntz)."""
    return F.lit(text).cast("timestamp_ntz")


# --- file path parts -------------------------------------------------------
# fixed values: directory partition and file-name pattern of snapshot files
ACCOUNT_DIR_PATTERN = r"/AccountName=([^/]+)/"
FILE_NAME_PATTERN = r"^[^_]+_(.+)_(\d{8})_(\d+)\.csv$"
FILE_DATE_FORMAT = "ddMMyyyy"


def file_name(path: ColumnOrName) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def account_from_path(path: ColumnOrName) -> Column:
    """Account from the ``AccountName=<x>`` directory, percent-decoded; ``+``
    stays a plus (plain url_decode would turn it into a space); NULL if absent."""
    raw = F.nullif(F.regexp_extract(col(path), ACCOUNT_DIR_PATTERN, 1), F.lit(""))
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def date_from_file_name(name: ColumnOrName) -> Column:
    digits = F.nullif(F.regexp_extract(col(name), FILE_NAME_PATTERN, 2), F.lit(""))
    return F.try_to_date(digits, FILE_DATE_FORMAT)


def version_from_file_name(name: ColumnOrName) -> Column:
    digits = F.nullif(F.regexp_extract(col(name), FILE_NAME_PATTERN, 3), F.lit(""))
    return digits.try_cast("int")
