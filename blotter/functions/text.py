"""Text keys and recovered fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.schema import UNKNOWN

# --- fixed values: the area at the end of an alert message, and accents to fold
AREA_IN_MESSAGE = r"(?U) en ([A-Za-záéíóúñÑ\s]+)$"
ACCENTED = "áéíóúñ"
PLAIN = "aeioun"
# ------------------------------------------------------------------------------


def anonymous_id(identity: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of an id."""
    return F.substring(F.sha2(identity.cast("string"), 256), 1, 16)


def area_from_message(message: Column, default: str = UNKNOWN) -> Column:
    """The area named at the end of an alert message."""
    area = F.regexp_extract(message, AREA_IN_MESSAGE, 1)
    # A match is never empty, so an empty extract means there was none.
    return F.when(area == "", F.lit(default)).otherwise(
        F.regexp_replace(area, r"(?U)^\s+|\s+$", "")
    )


def fold_key(text: Column, fold_accents: bool = True) -> Column:
    """Lower-case lookup key, by default without accents."""
    lowered = F.lower(text)
    return F.translate(lowered, ACCENTED, PLAIN) if fold_accents else lowered


def collated(text: Column, collation: str) -> Column:
    """The text under one of Spark's collations, as a key to join, group or sort by.

    ``UNICODE_CI_AI`` ignores letter case and all accents, not only the listed ones.
    """
    return F.collate(text, collation)
