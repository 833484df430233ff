"""Scores and labels of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.schema import CATEGORY_UNIVERSE

# --- fixed values
CRITICAL_LABEL = "CRÍTICA"
NORMAL_LABEL = "ALERTA"
# ---------------


def density_score(total: Column, variety: Column) -> Column:
    return total * variety


def diversity_index(unique: Column, universe: int = CATEGORY_UNIVERSE) -> Column:
    return unique / F.lit(float(universe))


def variety_ratio(unique: Column, universe: int = CATEGORY_UNIVERSE) -> Column:
    return F.concat(unique.cast("string"), F.lit(f"/{universe}"))


def severity_label(is_critical: Column) -> Column:
    return F.when(is_critical, F.lit(CRITICAL_LABEL)).otherwise(F.lit(NORMAL_LABEL))
