"""Expired markers as events: an id leaves the live set at exactly its time to live."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_MS = 1000
# So many groups of ids keep the live set. Spark calls Python once per group, not per id.
GROUPS = 1024
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _coded(kind: T.DataType) -> tuple[str, Callable[[Column], Column], Callable[[Column], Column]]:
    """How ids are held in Python: the type, the way there and the way back, without loss."""
    if isinstance(kind, T.IntegralType | T.StringType):
        return kind.simpleString(), lambda c: c, lambda c: c
    if isinstance(kind, T.TimestampType):
        return "bigint", F.unix_micros, F.timestamp_micros
    if isinstance(kind, T.BinaryType):
        return "string", F.base64, F.unbase64
    if isinstance(kind, T.StructType | T.ArrayType):
        return "string", lambda c: F.to_json(c, _TIMES), lambda c: F.from_json(c, kind, _TIMES)
    return "string", lambda c: c.cast("string"), lambda c: c.cast(kind)


def expired_markers(
    points: DataFrame,
    ttl_seconds: int,
    id_column: str = "id",
    clock: str = "added_at",
    delay_seconds: int = 0,
    groups: int = GROUPS,
) -> DataFrame:
    """A stream of (id, added, expired): one row for each stay of an id in the live set.

    An id enters with its first arrival and leaves the time to live later; arrivals in between do not
    prolong its stay, and one at or after its end begins the next. The marker is emitted
    when a later arrival of the id or the watermark, ``delay_seconds`` behind the newest arrival,
    has passed the end. Arrivals without a time are left out; arrivals before one of their id
    that was seen in an earlier batch count as repeats, and those behind the watermark are late.

    The ids are dealt by a hash to ``groups`` of keyed state, which holds one number per live id; a
    checkpoint keeps their number. A task holds the live ids of one group and its arrival times in
    one batch, which the trigger's limit on a batch bounds: raise ``groups`` beyond some hundred
    million live ids. Ids that are null are one id, in a group of their own.
    """
    ttl_us = ttl_seconds * 1_000_000
    kind, code, decode = _coded(points.schema[id_column].dataType)

    def follow(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        live = dict(zip(*state.get, strict=True)) if state.exists else {}
        stays = []
        if not state.hasTimedOut:
            rows = pd.concat(chunks, ignore_index=True)
            if key[0] < 0:
                # Nulls only; they stand as None in the state.
                place, ids = np.zeros(len(rows), dtype="int64"), [None]
            else:
                place, ids = pd.factorize(rows["id"])
                ids = ids.tolist()
            at = rows["at"].to_numpy()
            order = np.lexsort((at, place))
            at, ends = at[order].tolist(), np.cumsum(np.bincount(place)).tolist()
            begin = 0
            for one, end in zip(ids, ends, strict=True):
                added = live.get(one)
                if added is None:
                    added = at[begin]
                next_at = bisect_left(at, added + ttl_us, begin, end)
                while next_at < end:
                    stays.append((one, added))
                    added = at[next_at]
                    next_at = bisect_left(at, added + ttl_us, next_at, end)
                live[one] = added
                begin = end
        # Timers are in whole milliseconds and fire when the watermark is past them.
        watermark = state.getCurrentWatermarkMs()
        last = {one: -(-(added + ttl_us) // _MS) - 1 for one, added in live.items()}
        over = [one for one, end in last.items() if end < watermark]
        for one in over:
            stays.append((one, live.pop(one)))
            del last[one]
        if live:
            state.update((list(live.keys()), list(live.values())))
            state.setTimeoutTimestamp(max(min(last.values()), 1))
        elif state.exists:
            state.remove()
        if stays:
            ids, added = zip(*stays, strict=True)
            yield pd.DataFrame({"id": pd.Series(ids, dtype=object), "added_us": added})

    timed = (
        points.where(F.col(clock).isNotNull())
        .select(F.col(id_column).alias("id"), F.col(clock).cast("timestamp").alias("time"))
        .withWatermark("time", f"{delay_seconds} seconds")
    )
    coded = timed.select(code(F.col("id")).alias("id"), "time", F.unix_micros("time").alias("at"))
    group = F.when(F.col("id").isNull(), -1).otherwise(F.pmod(F.xxhash64("id"), F.lit(groups)))
    stays = coded.withColumn("group", group.cast("int")).groupBy("group").applyInPandasWithState(
        follow,
        f"id {kind}, added_us long",
        f"ids array<{kind}>, added_us array<bigint>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    added = F.timestamp_micros("added_us")
    return stays.select(
        decode(F.col("id")).alias("id"),
        added.alias("added"),
        F.timestamp_micros(F.col("added_us") + ttl_us).alias("expired"),
    )
