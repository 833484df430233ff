"""Rebuilding rollup tables in batch, from the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from blotter.operators.cells import hour_cells
from blotter.operators.rollups import reporter_cells
from blotter.schema import FACT_SCHEMA, FACTS
from blotter.session import cut_lineage, work_folders
from blotter.sources.tables import read_days, read_table
from blotter.streaming.job import (
    EXACT,
    NO_REPORTERS,
    Job,
    check_zone,
    derive_reporters,
    derive_rollups,
    write_rollups,
)


def rebuild_rollups(
    spark: SparkSession, job: Job, days: Sequence[str] | None = None
) -> None:
    """Rebuild the rollups of the given days, or of all days, in one pass over the facts.

    Facts count under the day they are stored in. Given days are replaced as a whole, also by
    nothing, and no other day is touched; without days the tables are replaced. The hour cells
    are written to the shared folder once, every table is derived from them, and the folder
    is deleted at the end.
    """
    check_zone(spark, job)
    if days is None:
        facts = read_table(spark, job.path(FACTS), FACT_SCHEMA)
    else:
        facts = read_days(spark, job.path(FACTS), days, FACT_SCHEMA)
    with work_folders(spark, "rebuild") as [path]:
        tables = derive_rollups(cut_lineage(hour_cells(facts), path), job.universe)
        if job.reporters != NO_REPORTERS:
            tables |= derive_reporters(job, reporter_cells(facts, job.reporters == EXACT))
        write_rollups(spark, job, tables, days)
