"""Which arrivals a live feed keeps, for all slices of a long catch-up at once.

An id is kept on its first arrival and then on the first arrival at least the time to live after
the one kept before. Each arrival points to the first one that may follow it; the kept ones are
those reached from an id's start. Doubling the pointers reaches 2^k arrivals in k rounds, so a
day of catch-up with a time to live of a minute takes at most eleven rounds of joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import cut_lineage

# An id's arrivals are searched in slots of this part of the time to live, each on its own, so the
# arrivals of a hot id are dealt over tasks.
SLOTS = 64


def _id(ids: Sequence[str]) -> Column:
    """All ids as one value, in which nulls equal nulls."""
    return F.struct(*[F.col(i).alias(f"i{n}") for n, i in enumerate(ids)]).alias("id")


def _micros(clock: str) -> Column:
    return F.unix_micros(F.col(clock).cast("timestamp"))


def followers(arrivals: DataFrame, wait: int) -> DataFrame:
    """(id, t, follower): the first arrival of the id at t + ``wait`` or later, if there is one.

    ``arrivals`` has distinct (id, t). It is looked for in the slot of t + wait, and failing that
    it is the first one of a later slot; only the slots' first arrivals are sorted by id.
    """
    width = max(1, wait // SLOTS)
    none = F.lit(None).cast("long")
    asks = arrivals.select("id", (F.col("t") + wait).alias("at"), "t", none.alias("hit"))
    hits = arrivals.select("id", F.col("t").alias("at"), none.alias("t"), F.col("t").alias("hit"))
    slot = F.floor(F.col("at") / width).alias("slot")
    both = asks.unionByName(hits).select("*", slot)
    # From late to early, arrivals before questions of the same time.
    within = (
        Window.partitionBy("id", "slot")
        .orderBy(F.col("at").desc(), F.col("t").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = F.last("hit", ignorenulls=True).over(within)
    asked = both.withColumn("inside", inside).where(F.col("t").isNotNull())
    asked = asked.select("id", "slot", "t", "inside")

    firsts = hits.select("id", slot, "hit").groupBy("id", "slot").agg(F.min("hit").alias("first"))
    open_slots = asks.select("id", slot, none.alias("first")).distinct()
    beyond = (
        Window.partitionBy("id")
        .orderBy(F.col("slot").desc(), F.col("first").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    later = (
        open_slots.unionByName(firsts)
        .withColumn("beyond", F.last("first", ignorenulls=True).over(beyond))
        .where(F.col("first").isNull())
        .select("id", "slot", "beyond")
    )
    found = asked.join(later, ["id", "slot"])
    follower = F.coalesce("inside", "beyond")
    return found.select("id", "t", follower.alias("follower")).where(follower.isNotNull())


def kept_arrivals(
    rows: DataFrame,
    stored: DataFrame,
    ids: Sequence[str],
    clock: str,
    ttl_seconds: int,
    folder: str,
) -> DataFrame:
    """(id, t) of the arrivals in ``rows`` that a live feed keeps after those ``stored`` in it.

    ``id`` is a struct of the ids and ``t`` the arrival in microseconds. No stored arrival may be
    later than the first of ``rows``' slices. Intermediate tables go below ``folder``, which
    the caller deletes when the result has been used.
    """
    wait = int(ttl_seconds * 1_000_000)
    arrivals = rows.select(_id(ids), _micros(clock).alias("t")).distinct()
    arrivals = cut_lineage(arrivals, f"{folder}/arrivals")
    last = stored.groupBy(_id(ids)).agg(F.max(_micros(clock)).alias("last"))
    free = F.col("last").isNull() | (F.col("t") >= F.col("last") + wait)
    reached = arrivals.join(last, "id", "left").where(free).groupBy("id").agg(F.min("t").alias("t"))
    reached = cut_lineage(reached, f"{folder}/reached")
    jumps = cut_lineage(followers(arrivals, wait), f"{folder}/jumps")
    step = 0
    while not jumps.isEmpty():
        step += 1
        onward = reached.join(jumps, ["id", "t"]).select("id", F.col("follower").alias("t"))
        reached = cut_lineage(reached.unionByName(onward), f"{folder}/reached-{step}")
        after = jumps.select("id", F.col("t").alias("follower"), F.col("follower").alias("next"))
        jumps = jumps.join(after, ["id", "follower"]).select(
            "id", "t", F.col("next").alias("follower")
        )
        jumps = cut_lineage(jumps, f"{folder}/jumps-{step}")
    return reached


def kept_rows(rows: DataFrame, kept: DataFrame, ids: Sequence[str], clock: str) -> DataFrame:
    """The rows of the kept arrivals; several where an id arrives more than once at a time."""
    named = kept.select(F.col("id").alias("__id"), F.col("t").alias("__t"))
    keyed = rows.withColumns({"__id": _id(ids), "__t": _micros(clock)})
    return keyed.join(named, ["__id", "__t"], "left_semi").drop("__id", "__t")
