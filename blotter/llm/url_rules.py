"""URL allow and block rules by a sorted sweep over prefix intervals.

A rule (host, path, verdict) fits its host and every subdomain when the url's path starts with
the rule's path; the longest rule that fits wins. A host is written as a canonical key, its
labels reversed and each ended by a dot (``www.example.com`` is ``com.example.www.``), so that
"host and subdomains" becomes a key prefix, and a prefix an interval of the sorted keys.

One sweep sorts the distinct keys together with the starts and ends of the rule intervals. The
running count of open intervals is the height of the stack; the element at each height is the
last interval opened there. Rows are dealt by key range, and each range begins with the stack
that the ranges before it leave open, so no task sees all keys. Two sweeps run: hosts against
rule hosts, then (rule host, path) against (rule host, rule path).

Everything is DataFrame code. Keys are made distinct before any sweep, so one host or url with
a large share of the rows counts once. Rules may be of any number; nothing is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import discard, only, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALLOW, BLOCK = "allow", "block"
_END, _START, _PROBE = 0, 1, 2


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or a url without ``://``."""
    at = F.instr(url, "://")
    tail = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(tail, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(tail, F.length(host) + 1, F.length(tail)), "^[^?#]*", 0)
    return lower_ascii(host), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def sweep(keys: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For every distinct key the stack of prefixes it starts with, outermost first.

    ``keys`` has a column ``key``, ``prefixes`` a column ``prefix``, both without nulls. Returns
    (key, stack) and the stored table behind it, to be discarded when the result was used.
    """
    at = F.encode("key", "UTF-8")
    starts = prefixes.select(F.col("prefix").alias("key")).distinct()
    # No UTF-8 text holds the byte FF, so the end sorts behind everything with the prefix.
    ends = starts.select("key", F.concat(at, F.lit(b"\xff")).alias("at"), F.lit(_END).alias("kind"))
    events = (
        keys.select("key")
        .distinct()
        .select("key", at.alias("at"), F.lit(_PROBE).alias("kind"))
        .unionByName(starts.select("key", at.alias("at"), F.lit(_START).alias("kind")))
        .unionByName(ends)
        .repartitionByRange("at", "kind")
    )
    placed = stored(events.withColumn("part", F.spark_partition_id()), "sweep")
    step = F.when(F.col("kind") == _START, 1).when(F.col("kind") == _END, -1).otherwise(0)
    # One row per range from here: as many as there are partitions, whatever the input.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("part").agg(F.sum(step).alias("total"))
    base = base.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    here = Window.partitionBy("part").orderBy("at", "kind")
    risen = placed.withColumn("rise", F.sum(step).over(here)).join(base, "part")
    risen = risen.withColumn("height", F.col("rise") + F.col("base"))
    top = risen.agg(F.max("height")).first()[0] or 0
    if not top:
        none = F.array().cast("array<string>").alias("stack")
        return placed.where(F.col("kind") == _PROBE).select("key", none), placed

    def opened(level: int) -> Column:
        return F.when((F.col("kind") == _START) & (F.col("height") == level), F.col("key"))

    levels = range(1, top + 1)
    left = risen.groupBy("part").agg(
        *[F.max_by(opened(i), F.when(opened(i).isNotNull(), F.col("at"))).alias(f"left{i}") for i in levels]
    )
    carried = left.select(
        "part", *[F.last(f"left{i}", ignorenulls=True).over(before).alias(f"from{i}") for i in levels]
    )
    stack = F.array(
        *[
            F.coalesce(F.last(opened(i), ignorenulls=True).over(here), F.col(f"from{i}"))
            for i in levels
        ]
    )
    swept = (
        risen.join(carried, "part")
        .withColumn("stack", F.slice(stack, 1, F.col("height").cast("int")))
        .where(F.col("kind") == _PROBE)
    )
    return swept.select("key", "stack"), placed


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict. Of equal rules the blocking one counts; of two rules
    of one length the one with the longer host. Rules with a null in host or path are ignored.
    A null url has empty host and path, which no rule with a path fits. Repeated pages stay
    repeated; empty tables give empty results; other columns of ``pages`` are not read.
    """
    host, path = url_parts(F.col("url"))
    parsed = only(pages, page_id=page_id, url=url).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    ruled = (
        only(rules, host="host", path="path", verdict="verdict")
        .dropna(subset=["host", "path"])
        .groupBy(lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("anchor", host_key(F.col("rule_host")))
    )
    # '#' occurs in no host, so the part before it is the whole rule host.
    ruled = ruled.withColumn("prefix", F.concat("anchor", F.lit("#"), "rule_path"))
    places = parsed.select("host", "path").distinct()
    hosts = parsed.select("host").distinct().withColumn("key", host_key(F.col("host")))
    stacks, first = sweep(hosts, ruled.select(F.col("anchor").alias("prefix")))
    anchored = (
        places.join(hosts.join(stacks, "key").select("host", "stack"), "host")
        .select("host", "path", F.explode("stack").alias("anchor"))
        .select("host", "path", F.concat("anchor", F.lit("#"), "path").alias("key"))
    )
    fitting, second = sweep(anchored, ruled)
    best = (
        anchored.join(
            fitting.where(F.size("stack") > 0).select("key", F.try_element_at("stack", F.lit(-1)).alias("prefix")),
            "key",
        )
        .join(ruled, "prefix")
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"),
                F.struct(
                    F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "prefix"
                ),
            ).alias("best")
        )
    )
    chosen = stored(best.select("host", "path", "best.rule", "best.verdict"), "rules")
    discard(first, second)
    verdict = F.coalesce("verdict", F.lit(default)).alias("verdict")
    return parsed.join(chosen, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", verdict
    )
