"""Attributes looked up by category."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import collated, fold_key
from blotter.schema import CATEGORY_COLORS, DEFAULT_COLOR
from blotter.session import lookup_table

_KEY = "__key"


def category_attribute(
    df: DataFrame,
    category: str = "type",
    entries: Mapping[str, str] | DataFrame = CATEGORY_COLORS,
    default: str = DEFAULT_COLOR,
    out: str = "color",
    fold_accents: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """Add the attribute of each category, or the default.

    With ``fold_accents=False`` only the letter case is folded, so an accented category
    misses a plain key. With a ``collation`` keys are equal that are equal under it, such as
    ``UNICODE_CI_AI`` for any letter case and accent. ``entries`` may be a two-column table, joined
    by its own size.
    """
    if isinstance(entries, DataFrame):
        table = entries.toDF(_KEY, out)
    else:
        table = lookup_table(df.sparkSession, entries, _KEY, out)
    if collation is None:
        same = fold_key(F.col(category), fold_accents) == F.col(_KEY)
    else:
        same = collated(F.col(category), collation) == collated(F.col(_KEY), collation)
    return (
        df.join(table, same, "left")
        .drop(_KEY)
        .withColumn(out, F.coalesce(out, F.lit(default)))
    )


def collated_counts(df: DataFrame, category: str = "type", collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Rows per category, spellings that are equal under the collation as one; the category is
    the least of its spellings."""
    return (
        df.groupBy(collated(F.col(category), collation).alias(_KEY))
        .agg(
            F.min(F.col(category)).alias(category),
            F.count_distinct(category).alias("spellings"),
            F.count(F.lit(1)).alias("n"),
        )
        .drop(_KEY)
    )
